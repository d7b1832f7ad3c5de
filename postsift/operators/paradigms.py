"""Lemmas by rules learned from a corpus: which endings stand in for each other on many stems.

A stem that takes both endings of a pair (``gat-o``, ``gat-os``) is evidence that words on one ending are forms of words on the other. No word list is
needed, only a vocabulary per language; the lexicon and the English rules of `lemmas` come first where they apply.

1. Each known word is split into stem and ending in every way that leaves ``min_stem`` letters, with endings of up to ``max_ending``.
2. Pairs of endings on one stem are counted per language. Pairs that begin with the same letter are the same pair on a longer stem, and
   are left out. An ending needs ``min_stems`` words of its own to be counted, so that the pairs of one stem stay few.
3. A pair is a rule from ``old`` to ``new`` if it has ``min_stems`` stems, and ``min_share`` of the stems on ``old`` take ``new``, too.
   Forms need their base more than bases need each form, so the ending on fewer stems is the form's.
4. A word takes its rule with the largest share whose result is a known word; the result is its lemma. Rules are not applied twice.

All of it is joins and aggregations over distinct words; the corpus itself is read once, for the vocabulary. Counts are partial before they are shuffled, and
the pairs of a stem are bounded by the endings that are frequent enough. An ending has many rules, so words are not changed by each of them and then looked
up: words and known words meet on their stems, and what met is looked up in the rules where it is. The rules are a small table, and go to every task.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.functions import text as tx
from postsift.operators import lemmas, tokenmap
from postsift.sources.tables import cut_lineage

# So many rules go to every task; with more, the pairs of words that met are shuffled.
BROADCAST_RULES = 1_000_000


@dataclass(frozen=True)
class ParadigmSettings:
    min_stem: int = 3
    max_ending: int = 4
    min_stems: int = 10
    min_share: float = 0.5


def splits(words: DataFrame, s: ParadigmSettings = ParadigmSettings(), word: str = "word", *keep: str) -> DataFrame:
    """``lang, keep.., stem, ending``: all ways to cut a word."""
    n = F.length(word)
    sizes = F.filter(F.sequence(F.lit(0), F.lit(s.max_ending)), lambda k: n - k >= s.min_stem)
    cut = F.transform(sizes, lambda k: F.struct(F.substring(word, 1, n - k).alias("stem"), F.substring(word, n - k + 1, k).alias("ending")))
    return tx.explode_rows(words, "lang", *keep, c=cut).select("lang", *keep, "c.stem", "c.ending")


def ending_pairs(known: DataFrame, s: ParadigmSettings = ParadigmSettings()) -> DataFrame:
    """``lang, old, new, stems`` of all pairs of frequent endings with ``min_stems`` stems in common; ``old_stems``, ``new_stems`` and ``old_uses``,
    ``new_uses``: the words on each ending, and how often these occur."""
    cut = cut_lineage(splits(known, s, "word", "n"))
    often = cut.groupBy("lang", "ending").agg(F.count("*").alias("stems"), F.sum("n").alias("uses"))
    often = cut_lineage(often.where(F.col("stems") >= s.min_stems))
    cut = cut_lineage(cut.drop("n").join(often.select("lang", "ending"), ["lang", "ending"], "left_semi"))
    old, new = cut.withColumnRenamed("ending", "old"), cut.withColumnRenamed("ending", "new")
    # Both directions of a pair have the same stems: one is counted.
    apart = (F.col("old") < F.col("new")) & (F.substring("old", 1, 1) != F.substring("new", 1, 1))
    pairs = old.join(new, ["lang", "stem"]).where(apart).groupBy("lang", "old", "new").agg(F.count("*").alias("stems"))
    both = F.array(F.struct("old", "new"), F.struct(F.col("new").alias("old"), F.col("old").alias("new")))
    pairs = pairs.where(F.col("stems") >= s.min_stems).select("lang", F.inline(both), "stems")
    for e in ("old", "new"):
        pairs = pairs.join(often.toDF("lang", e, f"{e}_stems", f"{e}_uses"), ["lang", e])
    return pairs


def paradigm_rules(known: DataFrame, s: ParadigmSettings = ParadigmSettings()) -> DataFrame:
    """``lang, old, new, stems, share``: the rules, learned from ``known (lang, word, n)``."""
    p = ending_pairs(known, s)
    # Of two endings with as many stems, the one used more often, then the shorter one, then the first, is the base.
    order = lambda e: F.struct(-F.col(f"{e}_stems"), -F.col(f"{e}_uses"), F.length(e), F.col(e))
    rules = p.where(order("new") < order("old")).withColumn("share", F.col("stems") / F.col("old_stems")).where(F.col("share") >= s.min_share)
    return rules.select("lang", "old", "new", "stems", "share")


def lemmas_by_rule(words: DataFrame, rules: DataFrame, known: DataFrame, s: ParadigmSettings = ParadigmSettings()) -> DataFrame:
    """``lang, word, lemma`` for distinct ``words (lang, word)`` that a rule leads to a known word.

    The best of several: the largest share, then the most stems, then the longest old ending, then the first result.
    """
    rules = cut_lineage(rules)
    many, longest = rules.agg(F.count("*"), F.max(F.length("new"))).first()
    small = lambda df: df.hint("broadcast" if many <= BROADCAST_RULES else "merge")
    # Both sides of a rule leave the same stem; a result may have an ending that words are not cut to.
    cut = splits(words.select("lang", "word").distinct(), s).withColumnRenamed("ending", "old")
    bases = splits(known.select("lang", "word"), replace(s, max_ending=longest or 0)).withColumnRenamed("ending", "new")
    cut, bases = (df.join(small(rules.select("lang", e).distinct()), ["lang", e], "left_semi") for df, e in ((cut, "old"), (bases, "new")))
    met = cut.join(bases.hint("merge"), ["lang", "stem"])
    hits = met.join(small(rules), ["lang", "old", "new"]).withColumns({"word": F.concat("stem", "old"), "lemma": F.concat("stem", "new")})
    rank = F.struct((-F.col("share")).alias("a"), (-F.col("stems")).alias("b"), (-F.length("old")).alias("c"), F.col("lemma").alias("lemma"))
    return hits.groupBy("lang", "word").agg(F.min(rank).alias("best")).select("lang", "word", F.col("best.lemma").alias("lemma"))


def learn_lemmas(vocab: DataFrame, lexicon: DataFrame, known: DataFrame, rules: DataFrame, s: ParadigmSettings = ParadigmSettings()) -> DataFrame:
    """``(lang, token, value)`` for the words of ``vocab (lang, token, n)``: by lexicon, English by its own endings, all others by learned rules.

    ``rules`` come from `paradigm_rules` of this corpus or of a larger one.
    """
    first = lemmas.learn_lemmas(vocab, lexicon, known)
    words = vocab.where(F.col("lang") != "en").select("lang", "token").withColumn("word", F.lower("token"))
    open_ = words.join(lexicon.select("lang", F.col("form").alias("word")), ["lang", "word"], "left_anti")
    found = lemmas_by_rule(open_, rules, known, s)
    return first.unionByName(open_.join(found, ["lang", "word"]).select("lang", "token", F.col("lemma").alias("value")))


def lemmatise(df: DataFrame, lexicon: DataFrame, known: DataFrame, rules: DataFrame, key: str, text: str, lang: str, out: str) -> DataFrame:
    """Texts with the words that have a lemma replaced."""
    mapping = learn_lemmas(tokenmap.vocabulary(df, text, lang), lexicon, known, rules)
    return tokenmap.apply_token_map(df, mapping, key, text, lang, out)
