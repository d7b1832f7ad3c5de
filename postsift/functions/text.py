"""Text steps as Column -> Column functions. No UDF: every step runs in the JVM and needs no shuffle.

Steps that read their input several times (`expand`) should be applied through ``withColumn`` so that the
input is computed once; `operators.normalise` does that.
"""

from __future__ import annotations

import html.entities
from collections.abc import Callable, Sequence
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postsift.functions import lexicons as lx
from postsift.settings import PUNCTUATION

# Patterns. The classes are spelled out because \w and \s are ASCII-only in Java.
WORD = r"[\p{L}\p{N}_]"
SPACE = r"[\s\p{Z}\x0B\x1C-\x1F\x{85}]"
NOT_SPACE = r"[^\s\p{Z}\x0B\x1C-\x1F\x{85}]"
URL = r"https?://[^\s\p{Z}]+|www\.[^\s\p{Z}]+"
MENTION = "@" + WORD + "+"
HASHTAG = "#" + WORD + "+"
TOKEN = WORD + "{2,}"
HTML_HIDDEN = (
    r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
    r"|<template\b[^>]*>.*?</template\s*>"
)
HTML_TAG = r"</?[a-zA-Z!?][^>]*>"
HTML_ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});"


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def is_blank(c: Column) -> Column:
    """No character other than white space; stops at the first one."""
    return ~text_or_empty(c).rlike(NOT_SPACE)


def collapse_spaces(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACE + "+", " "))


def strip_urls(c: Column) -> Column:
    return F.regexp_replace(c, URL, " ")


def strip_mentions(c: Column) -> Column:
    return F.regexp_replace(c, MENTION, " ")


def strip_hashtags(c: Column) -> Column:
    return F.regexp_replace(c, HASHTAG, " ")


def strip_punctuation(c: Column) -> Column:
    return F.translate(c, PUNCTUATION, "")


def expand(c: Column, pattern: str, replacement: Callable[[Column], Column]) -> Column:
    """Replace each match of ``pattern`` by ``replacement(match)``; texts without a match pass through."""
    between = F.split(c, pattern, -1)
    matches = F.regexp_extract_all(c, F.lit(pattern), F.lit(0))
    joined = F.zip_with(
        between, matches, lambda b, m: F.when(m.isNull(), b).otherwise(F.concat(b, replacement(m)))
    )
    return F.when(c.rlike(pattern), F.array_join(joined, "")).otherwise(c)


@cache
def named_entities() -> dict[str, str]:
    """HTML entity names from the standard library, lower-cased names added where they are free."""
    exact = {k: chr(v) for k, v in html.entities.name2codepoint.items()}
    return {k.lower(): v for k, v in exact.items()} | exact


def decode_entity(m: Column) -> Column:
    body = F.substring(m, 2, 40)
    body = F.regexp_replace(body, ";", "")
    digits = F.regexp_replace(body, "^#[xX]?", "")
    code = (
        F.when(body.rlike("^#[xX]"), F.conv(digits, 16, 10))
        .when(body.startswith("#"), digits)
        .cast("bigint")
    )
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    named = F.element_at(lx.literal_map(named_entities()), body)
    return F.when(valid, char).when(code.isNotNull(), F.lit("�")).otherwise(F.coalesce(named, m))


def html_to_text(c: Column) -> Column:
    """Visible text of markup; comments, scripts, styles and tags go, entities are decoded.

    Only texts holding both ``<`` and ``>`` count as markup. Needs ``decode_entities`` as a second step.
    """
    bare = F.regexp_replace(F.regexp_replace(c, HTML_HIDDEN, ""), HTML_TAG, "")
    return F.when(looks_like_html(c), bare).otherwise(c)


def looks_like_html(c: Column) -> Column:
    return F.contains(c, F.lit("<")) & F.contains(c, F.lit(">"))


def decode_entities(c: Column) -> Column:
    return expand(c, HTML_ENTITY, decode_entity)


def emoji_to_tags(c: Column, lang: Column | None = None, lexicon: lx.Lexicon | None = None) -> Column:
    """Emoji -> the lexicon's phrase for the language, else a neutral tag. The name for the tag is found by
    code point in an array per block, not by search."""
    tables = {g: {k: v for k, v in t.items() if lx.is_emoji(k)} for g, t in (lexicon.entries if lexicon else {}).items()}

    def tag(m: Column) -> Column:
        # A sequence is named after its first character: a family after its first member, a flag by its letters.
        code, second = F.ascii(m), F.ascii(F.substring(m, 2, 1))
        letter = lambda c: F.char(c - F.lit(0x1F1E6 - ord("a")))
        out = F.when(code.between(0x1F1E6, 0x1F1FF) & second.between(0x1F1E6, 0x1F1FF), F.concat(F.lit("emoji_flag_"), letter(code), letter(second)))
        out = out.when(F.endswith(m, F.lit("\u20e3")), F.concat(F.lit("emoji_keycap_"), F.element_at(lx.literal_map(lx.KEYCAPS), F.substring(m, 1, 1))))
        for first, names in lx.emoji_tags():
            out = out.when(code.between(first, first + len(names) - 1), F.get(lx.literal_list(names), code - first))
        words = out.otherwise(m)
        if any(tables.values()):
            words = F.coalesce(by_language(lang, tables, m, False), words)
        return F.concat(F.lit(" "), words, F.lit(" "))

    return expand(c, lx.EMOJI_PATTERN, tag)


def by_language(
    lang: Column, tables: dict[str, dict[str, str]], key: Column, mostly_absent: bool = True
) -> Column:
    """``tables[lang][key]`` or null. For keys that are mostly absent a hash-set test comes first, as a
    search in a map is linear."""
    out = None
    for code, table in sorted(tables.items()):
        if not table:
            continue
        hit = F.element_at(lx.literal_map(table), key)
        if mostly_absent:
            hit = F.when(key.isin(*sorted(table)), hit)
        out = F.when(lang == code, hit) if out is None else out.when(lang == code, hit)
    return F.lit(None).cast("string") if out is None else out


def emoticons_to_words(c: Column, lang: Column, lexicon: lx.Lexicon) -> Column:
    keys = sorted({k for t in lexicon.entries.values() for k in t if not lx.is_emoji(k)})
    if not keys:
        return c
    return expand(
        c,
        "(?i)(?:" + lx.guarded_alternation(keys) + ")",
        lambda m: F.concat(
            F.lit(" "), F.coalesce(by_language(lang, lexicon.entries, F.lower(m), False), m), F.lit(" ")
        ),
    )


def map_words(c: Column, lang: Column, tables: dict[str, dict[str, str]]) -> Column:
    """Replace whole space-separated words by their entry for the language; others stay."""
    words = F.transform(
        F.split(c, " "), lambda w: F.coalesce(by_language(lang, tables, F.lower(w)), w)
    )
    return F.array_join(words, " ")


def drop_words(c: Column, lang: Column, lists: dict[str, Sequence[str]]) -> Column:
    """Drop the language's stopwords; a language without a list keeps its text."""
    out = None
    for code, words in sorted(lists.items()):
        if not words:
            continue
        kept = F.array_join(drop_tokens(F.split(c, " "), words, fold=True), " ")
        out = F.when(lang == code, kept) if out is None else out.when(lang == code, kept)
    return c if out is None else out.otherwise(c)


def english_singular(w: Column) -> Column:
    """Regular English plurals -> singular; words whose final s is no plural are left alone."""
    return (
        F.when(w.isin(*lx.NOT_PLURAL), w)
        .when(w.rlike("^[a-z]{2,}[^aeiou]ies$"), F.regexp_replace(w, "ies$", "y"))
        .when(w.rlike("^[a-z]{2,}(?:ss|x|zz|ch|sh)es$"), F.regexp_replace(w, "es$", ""))
        .when(w.rlike("^[a-z]{2,}[^sui]s$"), F.regexp_replace(w, "s$", ""))
        .otherwise(w)
    )


def lemmatise_words(c: Column, lang: Column, tables: dict[str, dict[str, str]]) -> Column:
    words = F.transform(
        F.split(c, " "),
        lambda w: F.coalesce(
            by_language(lang, tables, F.lower(w)),
            F.when(lang == "en", english_singular(w)),
            w,
        ),
    )
    return F.array_join(words, " ")


def language_to_use(detected: Column, supported: Sequence[str], fallback: str) -> Column:
    return F.when(detected.isin(*supported), detected).otherwise(F.lit(fallback))


def tokens(c: Column) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0))


def words(c: Column) -> Column:
    return F.filter(F.split(collapse_spaces(c), " "), lambda w: w != "")


def drop_tokens(toks: Column, stop: Sequence[str], fold: bool = False) -> Column:
    if not stop:
        return toks
    return F.filter(toks, lambda w: ~(F.lower(w) if fold else w).isin(*stop))


def bigrams(toks: Column) -> Column:
    """Neighbouring words joined by a space; null where either is null."""
    rest = F.greatest(F.size(toks) - 1, F.lit(0))
    return F.zip_with(
        F.slice(toks, F.lit(1), rest), F.slice(toks, F.lit(2), rest), lambda a, b: F.concat(a, F.lit(" "), b)
    )


def pairs(toks: Column) -> Column:
    """Neighbouring words as ``struct(a, b)``; null where either is null."""
    rest = F.greatest(F.size(toks) - 1, F.lit(0))
    return F.zip_with(
        F.slice(toks, F.lit(1), rest),
        F.slice(toks, F.lit(2), rest),
        lambda a, b: F.when(a.isNotNull() & b.isNotNull(), F.struct(a.alias("a"), b.alias("b"))),
    )


def explode_rows(df: DataFrame, *keep: Column | str, **array: Column) -> DataFrame:
    """``keep`` columns and one row per element of the array given by keyword.

    For a plain ``explode`` the optimizer adds a filter on the array and pushes it down to the scan, which
    computes an expensive array a second time (or several). The outer form is left alone.
    """
    ((name, elements),) = array.items()
    return df.select(*keep, F.explode_outer(elements).alias(name)).where(F.col(name).isNotNull())


def letters_only(c: Column) -> Column:
    """Lower-cased letters, a space between words and at both ends; two spaces where there are none."""
    return F.concat(
        F.lit(" "), F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}]+", " ")), F.lit(" ")
    )


def char_trigrams(letters: Column) -> Column:
    """Overlapping trigrams of a `letters_only` text; none for a text without a letter."""
    return F.regexp_extract_all(letters, F.lit("(?=(...))"), F.lit(1))


def stable_bucket(key: Column, seed: int, buckets: int = 10_000) -> Column:
    """Same bucket for the same key and seed on every engine that has md5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets


def sample_order(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
