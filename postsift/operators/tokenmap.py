"""Corpus vocabularies and the application of a ``(lang, token, value)`` table to texts.

For maps that are too large to be literals in the plan: learned spellings and lemmas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.functions import text as tx
from postsift.sources.tables import cut_lineage

# So many changed words go to every task; of more, both sides are shuffled.
BROADCAST_WORDS = 100_000


def vocabulary(df: DataFrame, text: str, lang: str) -> DataFrame:
    """``(lang, token, n)`` of all space-separated words. Counts are partial before the shuffle, so very
    frequent words cost one row per input partition."""
    return (
        tx.explode_rows(
            df, F.col(lang).alias("lang"), token=tx.words(tx.text_or_empty(F.col(text)))
        )
        .groupBy("lang", "token")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def apply_token_map(
    df: DataFrame,
    mapping: DataFrame,
    key: str,
    text: str,
    lang: str,
    out: str,
    salts: int = 16,
) -> DataFrame:
    """Replace words of ``text`` that have an entry for the row's language.

    Each text contributes its distinct words once, and comes back with one small map of its changes, not
    word by word. The changed words are written and counted: up to ``BROADCAST_WORDS`` are broadcast, more are salted, because a few
    words occur in most texts, and joined by shuffle. Spark must not choose by the size of their files, which are
    compressed and hold each word without its salts: the driver would build a table many times that size.
    """
    changes = cut_lineage(
        mapping.where(F.col("token") != F.col("value")).select("lang", "token", "value")
    )
    mentions = tx.explode_rows(
        df,
        F.col(key).alias("_key"),
        F.col(lang).alias("lang"),
        token=F.array_distinct(tx.words(F.col(text))),
    )
    if changes.count() <= BROADCAST_WORDS:
        hits = mentions.join(F.broadcast(changes), ["lang", "token"])
    else:
        salt = F.pmod(F.xxhash64("_key"), F.lit(salts)).cast("int")
        salted = changes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        hits = mentions.withColumn("salt", salt).join(salted.hint("merge"), ["lang", "token", "salt"])
    per_text = (
        hits.groupBy("_key", F.col("lang").alias("_maplang"))
        .agg(F.map_from_entries(F.collect_set(F.struct("token", "value"))).alias("_changes"))
    )
    joined = df.join(per_text, (df[key] == per_text["_key"]) & (df[lang] == per_text["_maplang"]), "left")
    replaced = F.array_join(
        F.transform(
            tx.words(F.col(text)), lambda w: F.coalesce(F.element_at(F.col("_changes"), w), w)
        ),
        " ",
    )
    value = F.when(F.col("_changes").isNull(), F.col(text)).otherwise(replaced)
    return joined.withColumn(out, value).drop("_key", "_maplang", "_changes")
