"""Quality classifier: a sparse ensemble of rules over text statistics.

1. Each text yields a few statistics: shares of kinds of characters, repetition of words, word triples and lines, lengths.
2. A forest of shallow trees is fitted on labelled rows. Every path from a root to a node is a rule: a conjunction of bounds.
3. A logistic regression with an L1 penalty over the rules as 0/1 features keeps few of them, each with a weight.
4. The kept rules are compiled into one Spark column expression over the statistics; scoring is part of the scan.

Trees and regression are MLlib jobs over the labelled rows, of which at most ``train_rows`` are taken, evenly by a hash of the
id; scoring takes every row. A model is a few hundred numbers.

Defined results: null text is empty; statistics of an empty text are 0, and it is scored by the same rules. Without labelled
rows every score is 0.5; with labels of one class only, it is 0.0 or 1.0. Labelled rows with a null label or statistic are not used.
Statistics replace columns of the same name (all begin with ``stat_``).
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from postsift.llm import pretokens as pt
from postsift.llm.bpe import lengths
from postsift.llm.common import Scratch, batches_of

STATISTICS = tuple(
    "stat_" + s
    for s in "log_chars log_words word_chars upper digits symbols marks exclaims accents distinct next_same triples_again lines_again line_words top_word".split()
)
LOWER, UPPER, DIGIT, WHITE, MARK, SYMBOL = range(6)
#: Marks of ordinary prose; other punctuation counts as a symbol.
PROSE = ".,;:!?'\"()-"
SLICE = 1_000_000


@cache
def kinds() -> np.ndarray:
    """The kind of each code point."""
    import unicodedata

    out = np.full(0x110000, SYMBOL, np.uint8)
    by_category = {"Lu": UPPER, "Lt": UPPER, "Ll": LOWER, "Lo": LOWER, "Lm": LOWER, "Mn": LOWER, "Mc": LOWER, "Nd": DIGIT, "Nl": DIGIT, "No": DIGIT}
    for cp in range(0x20000):
        c = chr(cp)
        out[cp] = WHITE if c.isspace() else by_category.get(unicodedata.category(c), SYMBOL)
    out[0x20000:0x3FFFF] = LOWER
    out[[ord(c) for c in PROSE + "¿¡«»“”‘’–—…"]] = MARK
    return out


def word_statistics(text: str) -> tuple[float, ...]:
    words = text.split()
    lines = [x for x in (x.strip() for x in text.split("\n")) if x]
    n = len(words)
    if not n:
        return (0.0,) * 8
    triples = list(zip(words, words[1:], words[2:]))
    counts = Counter(words)
    return (
        n,
        sum(map(len, words)) / n,
        len(counts) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(set(triples)) / len(triples) if triples else 0.0,
        1 - len(set(lines)) / len(lines),
        n / len(lines),
        counts.most_common(1)[0][1] / n,
    )


def statistics(texts: list[str]) -> dict[str, np.ndarray]:
    t = pt.Texts(texts)
    kind = kinds()[t.cp]
    size = np.diff(t.first)
    counts = []
    for marked in (*(kind == k for k in range(6)), t.cp == 33, t.cp >= 0x80):
        until = np.concatenate(([0], np.cumsum(marked)))
        counts.append(until[t.first[1:]] - until[t.first[:-1]])
    lower, upper, digits, white, marks, symbols, exclaims, accents = counts
    n, word_chars, distinct, same, triples, lines, line_words, top = np.array([word_statistics(x) for x in texts], float).reshape(-1, 8).T
    chars = np.maximum(size - white, 1)
    values = (
        np.log1p(size),
        np.log1p(n),
        word_chars,
        upper / np.maximum(upper + lower, 1),
        digits / chars,
        symbols / chars,
        marks / chars,
        exclaims / np.maximum(n, 1),
        accents / chars,
        distinct,
        same,
        triples,
        lines,
        np.log1p(line_words),
        top,
    )
    return {c: np.asarray(v, float) for c, v in zip(STATISTICS, values)}


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the statistics of each text."""
    at = df.columns.index(text)

    def work(whole: pa.RecordBatch) -> Iterator[tuple[int, int, dict]]:
        column = whole.column(at)
        for begin, end in pt.slices(lengths(column).tolist(), SLICE):
            found = statistics([t or "" for t in column.slice(begin, end - begin).to_pylist()])
            yield begin, end, {c: pa.array(v) for c, v in found.items()}

    return batches_of(df, work, dict.fromkeys(STATISTICS, DoubleType()))


@dataclass(frozen=True)
class Rule:
    """Bounds that all hold: statistic, whether at most (else above), threshold."""

    bounds: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        parts = [F.col(s) <= F.lit(b) if low else F.col(s) > F.lit(b) for s, low, b in self.bounds]
        return reduce(lambda a, b: a & b, parts)


@dataclass(frozen=True)
class RuleModel:
    rules: list[Rule] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    intercept: float = 0.0

    def score(self) -> Column:
        """Probability of the label 1, over the columns of ``with_statistics``."""
        parts = [F.when(r.column(), F.lit(w)).otherwise(F.lit(0.0)) for r, w in zip(self.rules, self.weights)]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-reduce(lambda a, b: a + b, parts, F.lit(self.intercept))))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> RuleModel:
        d = json.loads(text)
        rules = [Rule(tuple((s, low, b) for s, low, b in r["bounds"])) for r in d["rules"]]
        return cls(rules, d["weights"], d["intercept"])


def tree_rules(root, bounds: tuple = ()) -> Iterator[Rule]:
    """The rule of each node below the root of an MLlib tree."""
    if root.getClass().getSimpleName() != "InternalNode":
        return
    split = root.split()
    statistic, threshold = STATISTICS[split.featureIndex()], split.threshold()
    for child, low in ((root.leftChild(), True), (root.rightChild(), False)):
        # A later bound on the same side of the same statistic is the tighter one.
        path = tuple(b for b in bounds if b[:2] != (statistic, low)) + ((statistic, low, threshold),)
        yield Rule(tuple(sorted(path)))
        yield from tree_rules(child, path)


def held_out(key: Column, folds: int = 5) -> Column:
    """Rows never learned from: CRC-32 of the id as text divisible by the number of folds. A null id is as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == 0


def fit(
    stats: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    label: str = "quality",
    train_rows: int = 200_000,
    trees: int = 24,
    depth: int = 3,
    penalty: float = 1e-4,
    seed: int = 42,
) -> RuleModel:
    """Learn from the labelled rows that are not held out. ``stats``: ``key`` and the statistics."""
    scratch = Scratch(stats.sparkSession, "quality")
    own = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").cast("double").alias("label"))
    own = own.where(F.col("label").isin(0.0, 1.0) & F.col("key").isNotNull() & ~held_out(F.col("key")))
    rows = own.join(stats.select(F.col(f"`{key}`").alias("key"), *STATISTICS), "key").na.drop()
    n = own.count()
    if n > train_rows:
        rows = rows.where(F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 30)) < int(train_rows / n * (1 << 30)))
    rows = scratch.written(rows, "train", waves=2)
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        share = next(iter(counts), None)
        return RuleModel(intercept=0.0 if share is None else (1e9 if share else -1e9))
    total = sum(counts.values())
    weight = F.when(F.col("label") == 1, F.lit(total / 2 / counts[1.0])).otherwise(F.lit(total / 2 / counts[0.0]))
    rows = rows.withColumn("weight", weight)
    points = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(rows)
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, weightCol="weight", featureSubsetStrategy="onethird", minInstancesPerNode=5, seed=seed
    ).fit(points)
    rules = list(dict.fromkeys(r for t in forest.trees for r in tree_rules(t._call_java("rootNode"))))
    if not rules:
        return RuleModel(intercept=float(np.log(counts[1.0] / counts[0.0])))
    held = rows.select("label", "weight", F.array(*[r.column().cast("double") for r in rules]).alias("held"))
    from pyspark.ml.functions import array_to_vector

    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, weightCol="weight", standardization=False, maxIter=100)
    model = lasso.fit(held.select("label", "weight", array_to_vector("held").alias("features")))
    scratch.remove()
    kept = [(r, float(w)) for r, w in zip(rules, model.coefficients.toArray()) if w]
    return RuleModel([r for r, _ in kept], [w for _, w in kept], float(model.intercept))
