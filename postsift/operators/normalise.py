"""The text chain: initial clean, language, language-specific steps."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.functions import lexicons as lx
from postsift.functions import text as tx
from postsift.schema import require_columns
from postsift.settings import TextSettings


def _then(df: DataFrame, column: str, *steps) -> DataFrame:
    for step in steps:
        df = df.withColumn(column, step(F.col(column)))
    return df


def initial_clean(
    df: DataFrame, text: str = "text", out: str = "text_clean", s: TextSettings = TextSettings()
) -> DataFrame:
    """Lower case, markup, links, mentions, hashtags, white space: what language detection reads."""
    require_columns(df, [text], "initial_clean")
    df = df.withColumn(out, tx.text_or_empty(F.col(text)))
    if s.lowercase:
        df = _then(df, out, F.lower)
    if s.strip_html:
        # Entities are only decoded in texts taken for markup.
        df = df.withColumn("_markup", tx.looks_like_html(F.col(out)))
        df = _then(df, out, tx.html_to_text)
        df = df.withColumn(
            out, F.when(F.col("_markup"), tx.decode_entities(F.col(out))).otherwise(F.col(out))
        ).drop("_markup")
    if s.strip_urls:
        df = _then(df, out, tx.strip_urls)
    if s.strip_mentions_hashtags:
        df = _then(df, out, tx.strip_mentions, tx.strip_hashtags)
    return _then(df, out, tx.collapse_spaces)


def language_steps(
    df: DataFrame,
    text: str = "text_clean",
    lang: str = "detected_language",
    out: str = "text_preprocessed",
    s: TextSettings = TextSettings(),
    chat_words: lx.Lexicon | None = None,
    emoticons: lx.Lexicon | None = None,
    lemmas: lx.Lexicon | None = None,
) -> DataFrame:
    """Emoji, emoticons, chat words, punctuation, stopwords, lemmas; each in the row's language.

    Spelling correction needs the corpus and is a job of its own (`operators.spelling`).
    """
    require_columns(df, [text, lang], "language_steps")
    df = df.withColumn("_lang", tx.language_to_use(F.col(lang), s.languages, s.fallback_language))
    df = df.withColumn(out, tx.text_or_empty(F.col(text)))
    use = F.col("_lang")
    if s.convert_emoticons:
        table = emoticons or lx.emoticons(s.languages)
        df = _then(
            df,
            out,
            lambda c: tx.emoji_to_tags(c, use, table),
            lambda c: tx.emoticons_to_words(c, use, table),
        )
        df = _then(df, out, tx.collapse_spaces)
    if s.expand_chat_words:
        df = _then(df, out, lambda c: tx.map_words(c, use, (chat_words or lx.chat_words()).entries))
    if s.strip_punctuation:
        df = _then(df, out, tx.strip_punctuation)
    if s.remove_stopwords:
        lists = {code: lx.stopwords(code) for code in s.languages}
        df = _then(df, out, tx.collapse_spaces, lambda c: tx.drop_words(c, use, lists))
    if s.lemmatise:
        table = (lemmas or lx.lemmas()).entries
        df = _then(df, out, tx.collapse_spaces, lambda c: tx.lemmatise_words(c, use, table))
    return _then(df, out, tx.collapse_spaces).drop("_lang")


def normalise(
    df: DataFrame, text: str = "text", lang: str = "detected_language", s: TextSettings = TextSettings(), **lexica
) -> DataFrame:
    """Both parts of the chain for a table that already has a language column."""
    cleaned = initial_clean(df, text, "text_clean", s)
    return language_steps(cleaned, "text_clean", lang, "text_preprocessed", s, **lexica)


class TextNormaliser(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """The chain as a pipeline stage, so that it is saved and loaded with the models behind it."""

    languageCol = Param(Params._dummy(), "languageCol", "language column", TypeConverters.toString)
    settingsJson = Param(Params._dummy(), "settingsJson", "TextSettings as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol="text", outputCol="text_preprocessed", languageCol="detected_language", settingsJson="{}"):
        super().__init__()
        self._setDefault(
            inputCol="text",
            outputCol="text_preprocessed",
            languageCol="detected_language",
            settingsJson="{}",
        )
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, s: TextSettings, **cols) -> TextNormaliser:
        return cls(settingsJson=json.dumps(asdict(s)), **cols)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        raw = json.loads(self.getOrDefault(self.settingsJson))
        if "languages" in raw:
            raw["languages"] = tuple(raw["languages"])
        s = TextSettings(**raw)
        cleaned = initial_clean(dataset, self.getInputCol(), "_clean", s)
        done = language_steps(cleaned, "_clean", self.getOrDefault(self.languageCol), self.getOutputCol(), s)
        return done.drop("_clean")
