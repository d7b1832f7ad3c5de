"""Lemmas learned as a job over distinct words: lexicon first, then rules checked against the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.operators import tokenmap

# Endings of English nouns, verbs and adjectives and what stands in their place.
ENGLISH_ENDINGS = (
    ("ies", "y"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("ses", "s"),
    ("xes", "x"),
    ("zes", "z"),
    ("ves", "f"),
    ("s", ""),
    ("ied", "y"),
    ("ed", "e"),
    ("ed", ""),
    ("ing", "e"),
    ("ing", ""),
    ("est", ""),
    ("er", ""),
)


def learn_lemmas(vocab: DataFrame, lexicon: DataFrame, known: DataFrame) -> DataFrame:
    """``(lang, token, value)`` for the words of ``vocab (lang, token, n)``.

    ``lexicon (lang, form, lemma)`` decides where it has the word. Other English words that are not
    ``known (lang, word, n)`` themselves change the first ending that leads to a known word of three
    letters or more.
    """
    words = vocab.select("lang", "token").withColumn("form", F.lower("token"))
    listed = words.join(lexicon.select("lang", "form", "lemma"), ["lang", "form"]).select(
        "lang", "token", F.col("lemma").alias("value")
    )
    open_words = (
        words.where(F.col("lang") == "en")
        .join(lexicon.select("lang", "form"), ["lang", "form"], "left_anti")
        .join(known.select("lang", F.col("word").alias("form")), ["lang", "form"], "left_anti")
    )
    tries = F.filter(
        F.array(
            *[
                F.when(
                    F.col("form").endswith(old) & (F.length("form") >= 3 + len(old) - len(new)),
                    F.struct(
                        F.lit(rank).alias("rank"),
                        F.concat(F.expr(f"left(form, length(form) - {len(old)})"), F.lit(new)).alias("word"),
                    ),
                )
                for rank, (old, new) in enumerate(ENGLISH_ENDINGS)
            ]
        ),
        lambda t: t.isNotNull(),
    )
    by_rule = (
        open_words.select("lang", "token", F.explode(tries).alias("t"))
        .select("lang", "token", F.col("t.rank").alias("rank"), F.col("t.word").alias("word"))
        .join(known.select("lang", "word"), ["lang", "word"], "left_semi")
        .groupBy("lang", "token")
        .agg(F.min(F.struct("rank", "word")).alias("b"))
        .select("lang", "token", F.col("b.word").alias("value"))
    )
    return listed.unionByName(by_rule)


def lemmatise(
    df: DataFrame, lexicon: DataFrame, known: DataFrame, key: str, text: str, lang: str, out: str
) -> DataFrame:
    mapping = learn_lemmas(tokenmap.vocabulary(df, text, lang), lexicon, known)
    return tokenmap.apply_token_map(df, mapping, key, text, lang, out)
