from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators.dedup import latest_document_per_key, latest_per_key

DAY = [datetime(2024, 1, d) for d in range(1, 10)]
FEED = "k int, v string, ins timestamp_ntz, upd timestamp_ntz"


def test_update_time_wins_over_insert_time(spark, as_rows):
    df = spark.createDataFrame([(1, "old", DAY[0], DAY[5]), (1, "new", DAY[3], None), (2, "x", DAY[0], None)], FEED)
    assert [r[2] for r in as_rows(latest_per_key(df, ["k"], "ins", "upd").select("k", "v", F.lit(0).alias("a")))] == ["old", "x"]


def test_rows_without_times_come_last(spark):
    df = spark.createDataFrame([(1, "none", None, None), (1, "some", DAY[0], None)], FEED)
    assert latest_per_key(df, ["k"], "ins", "upd").first()["v"] == "some"
    assert latest_per_key(df.filter("v = 'none'"), ["k"], "ins", "upd").first()["v"] == "none"


def test_ties_are_settled_by_the_other_columns(spark):
    data = [(1, v, DAY[0], None) for v in "cab"]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, FEED).repartition(3)
        assert latest_per_key(df, ["k"], "ins", "upd").first()["v"] == "a"


def test_null_keys_form_one_group_per_pattern(spark):
    df = spark.createDataFrame(
        [(None, 1, DAY[0]), (None, 1, DAY[1]), (None, 2, DAY[0]), (3, None, DAY[0])], "a int, b int, ins timestamp_ntz"
    )
    assert latest_per_key(df, ["a", "b"], "ins").count() == 3


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, DAY[0]), (1, DAY[1])], "k int, t timestamp_ntz").toDF("my key.`x`", "time of 'day'")
    got = latest_per_key(df, ["my key.`x`"], "time of 'day'").collect()
    assert [tuple(r) for r in got] == [(1, DAY[1])]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select(F.pmod("id", F.lit(2)).alias("k"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ins"))
    plan = latest_per_key(df, ["k"], "ins")._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_latest_document(spark):
    texts = [
        '{"_id":"a","createdAt":"2024-01-01 00:00:00.5","updatedAt":"2024-01-09 00:00:00","n":1}',
        '{"_id":"a","createdAt":"2024-01-05 00:00:00","n":2}',
        '{"_id":7,"createdAt":"NaT","n":3}',
        '{"_id":7,"createdAt":"2024-01-01 00:00:00","n":4}',
    ]
    docs = spark.createDataFrame([(t,) for t in texts], "t string").select(F.parse_json("t").alias("doc"))
    got = latest_document_per_key(docs, "doc", "_id", "createdAt", "updatedAt")
    found = got.select("doc_key", F.variant_get("doc", "$.n", "int").alias("n")).collect()
    assert sorted(tuple(r) for r in found) == [("7", 4), ("a", 1)]
