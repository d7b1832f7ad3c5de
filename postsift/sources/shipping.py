"""Make this package importable in Python workers, wherever the driver was started from."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors once per application.

    Functions of a module travel to the workers by name, so the module has to exist there. A changed
    ``sys.path`` of the driver does not reach them; ``addPyFile`` does, and also serves executors that join later.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix=f"{PACKAGE.name}-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(PACKAGE.rglob("*.py")):
            z.write(source, source.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
