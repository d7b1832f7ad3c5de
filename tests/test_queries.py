"""Every registered query runs; those with SQL agree with DuckDB on the small tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, canonical

SLOW = {"k_sweep", "word2vec_encode", "triage_messages", "triage_evaluation", "recluster_recent", "train_one_against_rest", "train_multinomial"}


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{Path(sf) / t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SLOW))
def test_query(spark, sf, db, name):
    df = entry.queries()[name](spark, sf)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    cur = db.execute(sql)
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert canonical(df.columns, rows) == canonical(cols, cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_workers_find_the_package_from_any_folder(tmp_path, sf):
    """A driver script elsewhere, started in an empty folder, with only ``sys.path`` changed."""
    import subprocess
    import sys

    script = tmp_path / "run.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {str(Path(entry.__file__).parent)!r})\n"
        "import __spark_entry__ as e\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert e.oracle_sql()\n"
        f"print('ROWS', e.queries()['user_encoder'](s, {sf!r}).count())\n"
    )
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "ROWS 5200" in done.stdout, done.stderr[-2000:]
