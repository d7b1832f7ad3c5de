"""Frequent words and word pairs per group, for all groups in one job.

Pairs are by far the most numerous terms, and nearly all of them are rare. A pair occurs at most as often
as each of its words, so once the words are counted, only pairs of two words that are both frequent
enough for the top list can enter it. Only those are shuffled; the result is that of counting all. What
words must reach, and the words that do, are tables that are joined, so that there may be any number of groups.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postsift.functions import text as tx
from postsift.sources.tables import cut_lineage

def _top(counts: DataFrame, group: str, n: int) -> DataFrame:
    """Most frequent terms per group, ties in term order. Ranked per partition before the shuffle."""
    w = Window.partitionBy(group).orderBy(F.col("n").desc(), F.col("term").asc())
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def _count(terms: DataFrame, group: str, texts_too: bool) -> DataFrame:
    """``(group, term, n)`` from ``(group, terms)``, or with ``n_docs``: then terms are sorted within each
    text, so that one pass counts both occurrences and texts."""
    if not texts_too:
        exploded = tx.explode_rows(terms, group, term=F.col("terms"))
        return exploded.groupBy(group, "term").agg(F.count(F.lit(1)).alias("n"))
    marked = F.transform(
        "terms",
        lambda t, i: F.struct(
            t.alias("term"), ((i == 0) | (t != F.get(F.col("terms"), i - 1))).alias("first")
        ),
    )
    return (
        terms.select(group, F.sort_array("terms").alias("terms"))
        .select(group, F.inline_outer(marked))
        .where(F.col("term").isNotNull())
        .groupBy(group, "term")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("first").alias("n_docs"))
    )


def _top_terms(
    texts: DataFrame, group: str, n: int, fitting: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """``texts (group, words)`` -> top ``n`` words and pairs among those that ``fitting`` lets through; it
    may look at ``n_docs``."""
    by_docs = fitting is not None
    fitting = fitting or (lambda counts: counts)
    singles = cut_lineage(_count(texts.select(group, F.col("words").alias("terms")), group, by_docs))
    # Count of the n-th word that fits: what a pair must reach. 1 where there are fewer words.
    w = Window.partitionBy(group).orderBy(F.col("n").desc(), F.col("term").asc())
    nth = (
        fitting(singles).withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= n)
        .groupBy(group)
        .agg(F.min(F.when(F.col("rank") == n, F.col("n"))).alias("least"))
        .where(F.col("least").isNotNull())
    )
    frequent = cut_lineage(
        _with(singles, nth, group).where(F.col("n") >= F.coalesce("least", F.lit(1))).drop("least")
    )
    # Pairs of each text in order, the first of equal ones marked; those of two frequent words are counted.
    pairs = F.sort_array(F.filter(tx.pairs(F.col("words")), lambda p: p.isNotNull()))
    marked = F.transform("pairs", lambda p, i: F.struct(p["a"], p["b"], ((i == 0) | (p != F.get(F.col("pairs"), i - 1))).alias("first")))
    rows = texts.select(group, pairs.alias("pairs")).select(group, F.inline_outer(marked)).where(F.col("a").isNotNull())
    for side in ("a", "b"):
        words = frequent.select(F.col(group).alias("_group"), F.col("term").alias(f"_{side}"))
        rows = rows.join(words, F.col(group).eqNullSafe(F.col("_group")) & (F.col(side) == F.col(f"_{side}")), "left_semi")
    counted = [F.count(F.lit(1)).alias("n")] + ([F.count_if("first").alias("n_docs")] if by_docs else [])
    pairs = rows.groupBy(group, F.concat("a", F.lit(" "), "b").alias("term")).agg(*counted)
    return _top(fitting(frequent).unionByName(fitting(pairs)), group, n).select(group, "term", "n", "rank")


def _with(rows: DataFrame, table: DataFrame, group: str) -> DataFrame:
    """``rows`` with the columns of a table of one row per group."""
    table = table.withColumnRenamed(group, "_group")
    return rows.join(table, F.col(group).eqNullSafe(F.col("_group")), "left").drop("_group")


def top_keywords(
    df: DataFrame, group: str, text: str, n: int = 10, stop: Sequence[str] = ()
) -> DataFrame:
    """``(group, term, n, rank)``: words of two or more characters, stopwords dropped before pairing."""
    texts = df.where(F.col(text).isNotNull()).select(
        group, tx.drop_tokens(tx.tokens(F.col(text)), stop).alias("words")
    )
    return _top_terms(texts, group, n)


def top_keywords_by_document_share(
    df: DataFrame,
    group: str,
    text: str,
    n: int = 20,
    max_share: float = 0.90,
    min_share: float = 0.005,
    min_docs: int = 2,
    small_group: int = 100,
) -> DataFrame:
    """``(group, term, n, rank)`` without stopwords, but terms in too many or too few texts of the group are
    left out: more than ``max_share``, or fewer than ``min_share`` (at least ``min_docs``) once the group
    has more than ``small_group`` texts."""
    texts = df.where(F.col(text).isNotNull())
    sizes = cut_lineage(texts.groupBy(group).agg(F.count(F.lit(1)).alias("docs")))
    least = F.when(
        F.col("docs") > small_group,
        F.greatest(F.lit(min_docs), F.floor(F.col("docs") * F.lit(min_share))),
    ).otherwise(F.lit(1))

    def fitting(counts: DataFrame) -> DataFrame:
        kept = (F.col("n_docs") <= F.col("docs") * F.lit(max_share)) & (F.col("n_docs") >= least)
        return _with(counts, sizes, group).where(kept).drop("docs")

    words = texts.select(group, tx.tokens(F.col(text)).alias("words"))
    return _top_terms(words, group, n, fitting)
