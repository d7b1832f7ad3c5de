"""Byte-pair encoding, token counts, and the splitting they share, against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postsift.llm import bpe, tokencounts

FILES = [public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")]
ODD = [
    "",
    " ",
    "\n\n a",
    "it's  we'll 'round ''s I'M'S x's.\n \n",
    "a\tb\t\tc  d ",
    "ΣΑΣ Σ İstanbul ǅ ﬁ é",
    "日本語 テキスト 🙂👍🏽 x",
    "<|endoftext|> a <|startoftext|>b<|endoftext|>",
    "1234 ½² ³x",
    "x\r\ny \x0b\x0c z\x85 \xa0q",
    "'s't're've'm'll'd 'sx 'rea 'r'e",
    "\x00\x01a​b",
    "z" * 3000,
    "ab" * 400 + " " * 50,
]


@pytest.mark.parametrize("path", FILES)
def test_equals_the_library(path):
    library, own = Tokenizer.from_file(path), bpe.Vocabulary(path)
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("ab's tl  re\n\t'..1é—“<|") for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    found = own.encode(texts)
    assert [x.tolist() for x in found] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in found])))
    decoded = own.decode(np.concatenate(found), offsets).to_pylist()
    assert decoded == [library.decode(x.tolist(), skip_special_tokens=False) for x in found]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    for path in FILES:
        own = bpe.vocabulary(path)
        want = Tokenizer.from_file(path) if path not in LIBRARY else LIBRARY[path]
        LIBRARY[path] = want
        assert own.encode([text])[0].tolist() == want.encode(text, add_special_tokens=False).ids


LIBRARY: dict = {}


def test_forced_cuts_are_never_inside_a_token():
    own = bpe.vocabulary(FILES[0])
    assert 0 < own.may_join.sum() < 256 * 256
    for token in random.Random(1).sample(sorted(own.vocab), 500):
        inside = [own.byte_of[c] for c in token.removesuffix(own.mark)]
        assert own.may_join[inside[:-1], inside[1:]].all()


def test_forgets_when_full(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    own, library = bpe.Vocabulary(FILES[1]), Tokenizer.from_file(FILES[1])
    for text in ("one two three four five six", "seven eight nine ten", "one two"):
        assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_columns_and_nulls(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (2, None, "y"), (2, None, "y")], "`a.b` long, text string, `new0` string")
    done = bpe.decode(bpe.encode(df, FILES[0]), FILES[0])
    assert done.columns == ["a.b", "text", "new0", "ids", "decoded"]
    rows = done.collect()
    assert [len(r["ids"]) for r in rows] == [2, 0, 0] and [r["new0"] for r in rows] == ["x", "y", "y"]
    assert rows[1]["decoded"] == ""
    assert bpe.encode(df.limit(0), FILES[0]).count() == 0
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(spark.createDataFrame([([999_999],)], "ids array<int>"), FILES[0]).collect()


def test_op2(spark, sf):
    import hashlib

    from postsift.llm.queries import LLM_QUERIES

    library = Tokenizer.from_file(FILES[0])
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in LLM_QUERIES["op2_bpe"](spark, sf).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_token_counts(spark):
    lengths = [0, 0, 5, 5, 5, 1023, 1024, 5000, None]
    df = spark.createDataFrame([(n,) for n in lengths], "n_tokens long")
    rows = tokencounts.limits(tokencounts.histogram(df))
    known = [n for n in lengths if n is not None]
    for r in rows.collect():
        assert r.n_docs == known.count(r.length)
        assert r.docs_over == sum(n > r.length for n in known)
        assert r.tokens_over == sum(n for n in known if n > r.length)
        assert r.truncated_tokens == sum(min(n, r.length) for n in known)
        assert r.docs_within == pytest.approx(sum(n <= r.length for n in known) / len(known))
    assert rows.count() == len(set(known))
    assert [tuple(r) for r in tokencounts.quantiles(rows, [0.25, 0.5, 1.0]).collect()] == [(0.25, 0), (0.5, 5), (1.0, 5000)]
    assert tokencounts.truncated_to(rows, 700).first().truncated_tokens == sum(min(n, 700) for n in known)
    assert tokencounts.limits(tokencounts.histogram(df.limit(0))).count() == 0


def test_op8(spark, sf):
    from postsift.llm.queries import LLM_QUERIES

    library = Tokenizer.from_file(FILES[1])
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    known = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    rows = LLM_QUERIES["op8_token_counts"](spark, sf).agg(F.sum("n_docs").alias("n"), F.max("truncated_tokens").alias("t")).first()
    assert (rows.n, rows.t) == (len(known), sum(known))
