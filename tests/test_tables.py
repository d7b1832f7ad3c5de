"""Sources, ingest and preparation."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postsift import schema
from postsift.schema import MissingColumns
from postsift.operators import ingest, monitor, prepare
from postsift.plans import triage
from postsift.settings import IngestSettings
from postsift.sources import tables

ROWS = [
    (1, "a", True, 'say "hi"\nthere', "Tue Oct 31 22:10:47 +0000 2017", None, "2,3"),
    (2, "b", False, "agent", "Tue Oct 31 22:11:47 +0000 2017", 1, None),
    (3, "c", True, "NA", "garbage", None, None),
    (4, "d", True, "  ", None, None, None),
    (5, "e", None, "null inbound", None, None, None),
    (6, "f", True, None, None, None, None),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(ROWS, schema.RAW_MESSAGES)


def test_csv_round_trip_keeps_quotes_line_breaks_and_na(spark, raw, tmp_path):
    tables.write_csv(raw, str(tmp_path / "c"))
    back = tables.read_messages_csv(spark, str(tmp_path / "c"))
    got = {r.tweet_id: r.text for r in back.collect()}
    assert got[1] == 'say "hi"\nthere' and got[3] == "NA" and len(got) == 6
    dropped = tables.read_messages_csv(spark, str(tmp_path / "c"), drop_na_tokens=True)
    assert dropped.where("tweet_id = 3").first().text is None


def test_csv_corrupt_records_are_kept_apart(spark, tmp_path):
    (tmp_path / "x.csv").write_text(
        "tweet_id,author_id,inbound,text,created_at,in_response_to_tweet_id,response_tweet_id\n"
        "1,a,True,ok,,,\nnot-a-number,a,True,bad,,,\n"
    )
    df = tables.read_messages_csv(spark, str(tmp_path / "x.csv"), keep_corrupt=True).cache()
    rules = {"readable": F.col("_corrupt_record").isNull(), "has_id": F.col("tweet_id").isNotNull()}
    got = {r.rule: r.n_failed for r in monitor.quality_rules(df, rules).collect()}
    assert got == {"readable": 1, "has_id": 1}


def test_customer_filter(raw):
    assert {r.tweet_id for r in ingest.customer_messages(raw).collect()} == {1, 3}


def test_required_columns(raw):
    with pytest.raises(schema.MissingColumns):
        ingest.customer_messages(raw.drop("text"))
    with pytest.warns(UserWarning):
        assert schema.project(raw, ["tweet_id", "nope"]).columns == ["tweet_id"]
    with pytest.raises(schema.MissingColumns):
        schema.project(raw, ["nope"])


def test_timestamps(spark):
    rows = [("Tue Oct 31 22:10:47 +0000 2017",), ("garbage",), (None,), ("2017-10-31T22:10:47Z",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r[0] for r in df.select(prepare.parse_created_at(F.col("t")).cast("string")).collect()]
    assert got == ["2017-10-31 22:10:47", None, None, "2017-10-31 22:10:47"]


def test_dedup_keeps_the_earliest_and_length_counts_characters(spark):
    t = dt.datetime
    rows = [(1, "late", t(2020, 1, 2)), (1, "a😀é", t(2020, 1, 1)), (2, "x", None), (1, "none", None)]
    df = spark.createDataFrame(rows, "tweet_id long, text string, created_at timestamp")
    out = prepare.dedup_messages(df).withColumn("n", F.length("text"))
    assert {(r.tweet_id, r.text, r.n) for r in out.collect()} == {(1, "a😀é", 3), (2, "x", 1)}
    assert prepare.dedup_report(df, "tweet_id").first()[:] == (4, 2, 2)


def test_dedup_limits_each_partition_before_the_shuffle(spark, sf):
    queries_dir = f"{sf}/conversations.parquet"
    df = spark.read.parquet(queries_dir).select(
        F.col("conv_id").alias("tweet_id"), "text", F.col("turn").alias("created_at")
    )
    plan = prepare.dedup_messages(df)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


def test_split_is_a_partition_of_the_ids_without_leaks(spark):
    ids = spark.range(5000).withColumnRenamed("id", "tweet_id")
    both = ingest.assign_split(ids.union(ids))
    per_id = both.groupBy("tweet_id").agg(F.countDistinct("split").alias("n"))
    assert per_id.where("n <> 1").isEmpty()
    sizes = {r.split: r.pct for r in ingest.split_sizes(both).collect()}
    assert abs(sizes["discovery"] - 70) < 3 and abs(sizes["validation"] - 20) < 3
    again = ingest.assign_split(ids.repartition(7))
    assert again.exceptAll(ingest.assign_split(ids)).isEmpty()


@pytest.mark.parametrize("n, expected", [(10, (7, 2, 1)), (1000, (700, 200, 100)), (3, (2, 0, 1)), (103, (72, 20, 11))])
def test_exact_split_sizes(spark, n, expected):
    ids = spark.range(n).withColumnRenamed("id", "tweet_id")
    got = {r.split: r.n_rows for r in ingest.split_sizes(ingest.assign_exact_split(ids)).collect()}
    assert (got["discovery"], got["validation"], got["evaluation"]) == expected


def test_split_guards(spark):
    few = spark.range(2).withColumnRenamed("id", "tweet_id")
    with pytest.raises(ingest.TooFewRows):
        ingest.assign_exact_split(few)
    with pytest.raises(ingest.TooFewRows):
        ingest.check_split_sizes(ingest.assign_split(few))
    none = ingest.split_sizes(ingest.assign_split(few.where("tweet_id < 0"))).collect()
    assert [r.n_rows for r in none] == [0, 0, 0]


def test_prepared_messages(raw):
    out = triage.prepared(raw)
    assert out.columns == [*schema.PREPARED_COLUMNS, "split"]
    assert {(r.tweet_id, r.tweet_length) for r in out.collect()} == {(1, 14), (3, 2)}


def test_empty_tables_keep_their_schema(spark, raw, tmp_path):
    empty = triage.prepared(raw.where("tweet_id < 0"))
    tables.write_table(empty, str(tmp_path / "t"), by_split=False)
    back = tables.read_table(spark, str(tmp_path / "t"))
    assert back.count() == 0 and set(back.columns) == set(empty.columns)


def test_reading_one_split_lists_one_directory(spark, raw, tmp_path):
    tables.write_table(ingest.assign_split(raw), str(tmp_path / "s"))
    one = tables.read_table(spark, str(tmp_path / "s"), "discovery")
    assert "PartitionFilters: [isnotnull(split" in one._jdf.queryExecution().executedPlan().toString()


def test_vectors_are_checked_on_load(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, "tweet_id long, embedding array<float>")
    path = str(tmp_path / "v")
    tables.save_vectors(make([(1, [1.0, 2.0]), (2, [0.0, 1.0])]), path)
    assert tables.load_vectors(spark, path, dims=2).count() == 2
    for bad in ([(1, [1.0]), (2, [1.0, 2.0]), (3, [1.0, 2.0])], [(1, None), (2, [1.0])], [(1, [1.0]), (1, [2.0])], []):
        tables.save_vectors(make(bad), path)
        with pytest.raises(tables.BadVectors):
            tables.load_vectors(spark, path)


def test_spread_leaves_wide_tables_alone(spark):
    wide = spark.range(0, 1000, 1, 64)
    assert tables.spread(wide) is wide
    assert tables.spread(spark.range(0, 10, 1, 1), "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_intermediate_tables_go_to_the_shared_folder(spark):
    written = tables.cut_lineage(spark.range(3))
    (folder,) = {f.rsplit("/", 2)[0].removeprefix("file:").lstrip("/") for f in written.inputFiles()}
    assert folder == tables.run_folder(spark).removeprefix("file:").lstrip("/")
    assert written.count() == 3


class _Session:
    """As much of a session as `shared_folder` looks at."""

    def __init__(self, master, folder=None):
        from types import SimpleNamespace as Of

        self.conf = Of(get=lambda key, default: folder if key == "spark.checkpoint.dir" else default)
        self.sparkContext = Of(master=master, getCheckpointDir=lambda: None, applicationId="app")


def test_a_cluster_must_name_its_shared_folder():
    assert tables.run_folder(_Session("yarn", "hdfs://shared")) == "hdfs://shared/postsift-app"
    assert tables.run_folder(_Session("local[2]")).startswith("file:///tmp/checkpoints/")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.run_folder(_Session("spark://host:7077"))


def test_csv_keeps_white_space_and_empty_texts(spark, tmp_path):
    texts = ["  hi there  ", "tab\t", "", None, "a\r\nb", 'say "x", y', " ", "NA", "\\"]
    df = spark.createDataFrame([(i, t, "end") for i, t in enumerate(texts)], "tweet_id long, text string, last string")
    tables.write_csv(df, str(tmp_path / "c"))
    back = tables.read_messages_csv(spark, str(tmp_path / "c"), df.schema)
    assert [r.text for r in back.orderBy("tweet_id").collect()] == texts


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    (tmp_path / "x.csv").write_text(
        'more,created_at,text,tweet_id,inbound,author_id,response_tweet_id,in_response_to_tweet_id\n'
        'x,when,"hello, ""you""",7,True,me,"8,9",6\n'
        "x,when,bad,seven,False,me,,\n"
        "x,when\n"
    )
    rows = tables.read_messages_csv(spark, str(tmp_path / "x.csv"), keep_corrupt=True).collect()
    assert [(r.tweet_id, r.text, r.created_at, r.inbound, r.response_tweet_id) for r in rows[:2]] == [
        (7, 'hello, "you"', "when", True, "8,9"),
        (None, "bad", "when", False, None),
    ]
    assert [r._corrupt_record is None for r in rows] == [True, False, False]
    (tmp_path / "y.csv").write_text("tweet_id,text\n1,a\n")
    with pytest.raises(MissingColumns):
        tables.read_messages_csv(spark, str(tmp_path / "y.csv"))


def test_times_are_whole_dates_only(spark):
    good = ["Tue Oct 31 22:10:47 +0000 2017", "2017-10-31", "2017-10-31T22:10:47Z", "2017-10-31 22:10:47.5 +02:00"]
    bad = ["12:30", "T12:30", "2017", "garbage", "", "Tue", None, "Oct 31 2017"]
    df = spark.createDataFrame([(t,) for t in good + bad], "t string").select(prepare.parse_created_at(F.col("t")).alias("t"))
    assert [r.t is not None for r in df.collect()] == [True] * len(good) + [False] * len(bad)
