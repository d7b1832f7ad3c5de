"""Connected components of a table of links, as Spark joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.llm.common import Scratch


def connected(links: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """node, root: for each node of the links (columns a, b), the smallest node that it is connected with.

    In each round a node takes the smallest root among its own and its neighbours', and then the root of that root. What one
    root can learn doubles by the second step, so rounds grow with the logarithm of the longest path. Every round
    is a written table. Messages to one node are reduced before they are shuffled. Self-links keep a lone node in the result.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).union(links.select("b", "a")).distinct()
    both = scratch.written(both, f"{name}-links", waves=2)
    roots = scratch.written(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")), f"{name}-0", waves=2)
    for step in range(1, 200):
        heard = both.join(roots.select(F.col("node").alias("other"), F.col("root")), "other").groupBy("node").agg(F.min("root").alias("heard"))
        # A node also tells its root what it heard, so that whole trees are hooked at once.
        told = roots.join(heard, "node").groupBy("root").agg(F.min("heard").alias("told"))
        hooked = roots.join(heard, "node").join(told, "root")
        better = hooked.select("node", F.col("root").alias("before"), F.least("root", "heard", "told").alias("next"))
        jump = better.select(F.col("node").alias("next"), F.col("next").alias("after"))
        new = better.join(jump, "next").select("node", "before", F.least("next", "after").alias("root"))
        new = scratch.written(new, f"{name}-{step}", waves=2)
        changed = new.where("root <> before").limit(1).count()
        scratch.remove(f"{name}-{step - 1}")
        roots = new.select("node", "root")
        if not changed:
            return roots
    raise RuntimeError("the components did not settle")
