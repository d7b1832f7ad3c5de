"""Quoted CSV read by many tasks, against the reader that takes a file whole."""

import random

import pytest
from pyspark.sql import functions as F

from postsift.schema import RAW_MESSAGES, MissingColumns
from postsift.sources import quoted, tables

HEAD = "tweet_id,author_id,inbound,text,created_at,in_response_to_tweet_id,response_tweet_id"


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def field(rng):
    parts = ["a", "b c", "\n", "\n\n", "\r\n", '""', ",", "é", "日本", " ", "x" * 30, "1,2", "\n1,a,true,fake,,,\n"]
    text = "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 2, 5, 20])))
    return f'"{text}"' if rng.random() < 0.8 or any(c in text for c in '",\n\r') else text


def lines(seed, n, end):
    rng = random.Random(seed)
    rows = [f"{i},u{i % 7},{rng.choice(['true', 'false', ''])},{field(rng)},{rng.choice(['', 'Tue Oct 31', field(rng)])},{rng.choice(['', str(i - 1)])},{field(rng)}" for i in range(n)]
    rows[n // 2] = f'{n // 2},long,true,"' + "line of a long text, with commas\n" * 300 + '",,,'  # over many blocks
    return HEAD + end + end.join(rows) + rng.choice(["", end])


def same(a, b):
    assert a.dtypes == b.dtypes
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() == b.count() > 0


@pytest.mark.parametrize("end, seed", [("\n", 1), ("\n", 2), ("\r\n", 3)])
def test_equal_to_the_whole_reader(spark, tmp_path, small_blocks, end, seed):
    for k in range(3):
        (tmp_path / f"{k}.csv").write_bytes(lines(seed + 10 * k, 150, end).encode())
    many = quoted.read_large_csv(spark, str(tmp_path))
    whole = tables.read_messages_csv(spark, str(tmp_path))
    if end == "\r\n":  # the whole reader makes all line breaks of such a file \n, this one leaves those in quotes as they are
        assert many.where("contains(text, '\r\n')").count() > 10
        texts = [f.name for f in RAW_MESSAGES.fields if f.dataType.simpleString() == "string"]
        many, whole = (d.withColumns({c: F.regexp_replace(c, "\r\n", "\n") for c in texts}) for d in (many, whole))
    same(many, whole)
    blocks = quoted.block_starts(quoted.counted_lines(spark, str(tmp_path)))
    assert blocks.count() > 30 and blocks.where("inside = 1").count() > 5
    assert blocks.where("from_block < block - 1000").count() > 3  # blocks within one record
    assert many.where("length(text) > 9000").count() == 3


def test_blank_lines_corrupt_records_and_missing_values(spark, tmp_path, small_blocks):
    rows = ["1,a,true,ok,,,", "", '2,a,true,"",,,', "x,a,true,bad id,,,", "3,a,true,too,many,1,2,3", "4,a", '5,a,true," NA ",,,', "6,a,true,NA,,,"]
    (tmp_path / "x.csv").write_text("﻿" + HEAD + "\n" + "\n".join(rows))
    many = quoted.read_large_csv(spark, str(tmp_path), keep_corrupt=True)
    got = {r.tweet_id: (r.text, r._corrupt_record is not None) for r in many.where("tweet_id is not null").collect()}
    assert got == {1: ("ok", False), 2: ("", False), 3: ("too", True), 4: (None, True), 5: (" NA ", False), 6: ("NA", False)}
    assert many.where("tweet_id is null and _corrupt_record is not null").count() == 1
    dropped = quoted.read_large_csv(spark, str(tmp_path), drop_na_tokens=True)
    assert {r.tweet_id for r in dropped.where("text is null").collect()} == {2, 4, 6}


def test_what_cannot_be_read_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEAD + '\n1,a,true,"open,,,\n2,b,true,x,,,\n')
    with pytest.raises(quoted.OpenQuote, match="a.csv"):
        quoted.read_large_csv(spark, str(tmp_path))
    (tmp_path / "a.csv").write_text("tweet_id,text\n1,x\n")
    with pytest.raises(MissingColumns):
        quoted.read_large_csv(spark, str(tmp_path))
    (tmp_path / "b.csv").write_text(HEAD + "\n1,a,true,x,,,\n")
    with pytest.raises(ValueError, match="different headers"):
        quoted.read_large_csv(spark, str(tmp_path))


def test_only_a_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEAD + "\n")
    df = quoted.read_large_csv(spark, str(tmp_path))
    assert df.isEmpty() and df.columns == [f.name for f in RAW_MESSAGES.fields]


def test_other_columns_and_orders(spark, tmp_path):
    names = HEAD.split(",")[::-1]
    (tmp_path / "a.csv").write_text(",".join(['"more, and more"', *names]) + '\n"z\nz",,,,"t\nt",true,a,9\n')
    row = quoted.read_large_csv(spark, str(tmp_path)).first()
    assert (row.tweet_id, row.text, row.inbound) == (9, "t\nt", True)
    assert quoted.records(spark, str(tmp_path)).where(F.col("line") > 0).count() == 1
