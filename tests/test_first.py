"""First message per id over a stream, against the batch job."""

import datetime as dt

import pytest

from postsift.operators import prepare
from postsift.schema import MissingColumns
from postsift.streaming import first, incremental

SCHEMA = "tweet_id long, created_at timestamp, text string, arrived timestamp"
DAY = dt.datetime(2026, 1, 1)


def at(hours):
    return DAY + dt.timedelta(hours=hours)


FILES = [
    [(1, at(5), "late", at(5)), (2, at(1), "b", at(1)), (3, None, "no time", at(2)), (None, at(1), "no id", at(1))],
    [(1, at(2), "early", at(2)), (2, at(1), "a", at(1)), (3, at(9), "time", at(9)), (4, None, None, at(3)), (None, at(0), "no id, first", at(0))],
    [(1, at(2), "early", at(2))] * 50 + [(4, None, "text", at(3)), (5, at(30), "alone", at(30))],
]


def test_replayed_files_give_the_batch_result(spark, tmp_path):
    """Each file in a run of its own, so that state goes through the checkpoint every time."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [r for f in FILES for r in f]
    for f in [*FILES, [(9, at(24 * 40), "end", at(24 * 40))]]:
        spark.createDataFrame(f, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        arriving = incremental.new_messages(spark, source, spark.createDataFrame([], SCHEMA).schema)
        first.write_first_messages(arriving, out, str(tmp_path / "state"), arrived=arriving.arrived).awaitTermination()
    got = spark.read.parquet(out).select("tweet_id", "created_at", "text").collect()
    want = prepare.dedup_messages(spark.createDataFrame(rows, SCHEMA)).select("tweet_id", "created_at", "text").collect()
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) == 6


def test_sessions_expire(spark):
    """An id that comes back after the horizon is a new message; the batch form of the same aggregation."""
    rows = [(1, at(0), "a", None), (1, at(24 * 6), "b", None), (1, at(24 * 20), "c", None), (2, None, "no time", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r.text for r in first.first_messages(df).collect()) == ["a", "c"]
    assert sorted(r.text for r in first.first_messages(df, horizon="20 days").collect()) == ["a"]
    with pytest.raises(MissingColumns):
        first.first_messages(df.drop("created_at"))


def test_copies_are_reduced_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, at(0), "a", None)], SCHEMA)
    plan = first.first_messages(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_min") == 1 and plan.count("hashpartitioning") == 1
