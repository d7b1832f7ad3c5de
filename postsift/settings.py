"""Typed settings for every stage. The defaults are fixed values of the pipeline being served."""

from __future__ import annotations

import json
import string
from dataclasses import asdict, dataclass, field, fields

SPLITS = ("discovery", "validation", "evaluation")

# Languages with their own text steps, and the one used for all others.
LANGUAGES = ("en", "es", "fr", "de", "pt", "it", "nl", "ru")
FALLBACK_LANGUAGE = "en"
UNKNOWN_LANGUAGE = "unknown"

# Fixed value: ASCII punctuation without the underscore, which holds neutral tags together.
PUNCTUATION = string.punctuation.replace("_", "")


@dataclass(frozen=True)
class IngestSettings:
    discovery_share: float = 0.70
    validation_share: float = 0.20
    seed: int = 42
    min_rows: int = 3


@dataclass(frozen=True)
class TextSettings:
    """One switch per step; a step that is off never enters the plan."""

    lowercase: bool = True
    strip_html: bool = True
    strip_urls: bool = True
    strip_mentions_hashtags: bool = True
    convert_emoticons: bool = True
    expand_chat_words: bool = True
    strip_punctuation: bool = True
    remove_stopwords: bool = False
    correct_spelling: bool = False
    lemmatise: bool = True
    languages: tuple[str, ...] = LANGUAGES
    fallback_language: str = FALLBACK_LANGUAGE


@dataclass(frozen=True)
class FeatureSettings:
    hashing_dims: int = 384
    pca_components: int = 50
    encoder_batch_size: int = 32


@dataclass(frozen=True)
class ClusterSettings:
    k: int = 8
    seed: int = 42
    max_iter: int = 300
    elbow_max_iter: int = 150
    report_samples: int = 50
    report_keywords: int = 15
    # Upper bound on clusters whose centres or names may be held whole in a task.
    max_clusters: int = 10_000


@dataclass(frozen=True)
class ClassifierSettings:
    c: float = 1.0
    max_iter: int = 1000
    balanced: bool = True
    family: str = "ovr"
    parallelism: int = 8


@dataclass(frozen=True)
class Settings:
    ingest: IngestSettings = field(default_factory=IngestSettings)
    text: TextSettings = field(default_factory=TextSettings)
    features: FeatureSettings = field(default_factory=FeatureSettings)
    clusters: ClusterSettings = field(default_factory=ClusterSettings)
    classifier: ClassifierSettings = field(default_factory=ClassifierSettings)


def settings_json(s: Settings) -> str:
    return json.dumps(asdict(s))


def settings_from_json(text: str) -> Settings:
    found = json.loads(text)
    parts = {}
    for f in fields(Settings):
        kind = f.default_factory
        values = {k: tuple(v) if isinstance(v, list) else v for k, v in found[f.name].items()}
        parts[f.name] = kind(**values)
    return Settings(**parts)
