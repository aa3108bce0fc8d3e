"""A key that holds half of all rows is split over tasks, and nothing is lost."""

import pytest
from pyspark.sql import functions as F

from tidemark.names import col
from tidemark.operators.catalog import wanted_columns
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.deletes import delete_by_key
from tidemark.operators.projection import with_audit_columns
from tidemark.operators.snapshot_diff import new_rows
from tidemark.operators.upsert import upsert

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def half_in_one_key(spark, hot=0):
    ids = spark.range(0, 60_000, numPartitions=12)
    return ids.select(F.when(col("id") < 30_000, F.lit(hot)).otherwise(col("id")).cast("long").alias("k"), F.sha2(col("id").cast("string"), 256).alias("v"))


def ran_split(df):
    df.collect()
    return "skew=true" in df._jdf.queryExecution().toString()


def test_new_rows(spark):
    """Copies travel as one row per map task and are spread again before they are written out."""
    current = half_in_one_key(spark).select("k", F.lit("v").alias("v"))
    got = new_rows(current, current.filter("k >= 59000"), copies_per_task=100)
    per_task = got.filter("k = 0").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 30_000
    assert got.count() == 59_000
    shuffled = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in shuffled[shuffled.index("Exchange hashpartitioning"):]


def test_delete(spark, no_broadcast):
    target = half_in_one_key(spark)
    feed = target.filter("k >= 59000")
    got = delete_by_key(target, feed, ["k"])
    assert ran_split(got)
    assert got.count() == 59_000


@pytest.mark.parametrize("hot", [0, None])
def test_upsert_into_a_target_with_a_hot_key(spark, no_broadcast, hot):
    target = with_audit_columns(half_in_one_key(spark, hot), "2024-01-01")
    feed = target.select("k", F.lit("new").alias("v"), F.lit("2024-01-01").cast("timestamp_ntz").alias("ins"))
    batch = latest_per_key(feed, ["k"], "ins").drop("ins")
    got = upsert(target, batch, ["k"], "2024-02-01")
    assert ran_split(got)
    updated = got.filter(col("edw_updated_timestamp").isNotNull()).count()
    assert (got.count(), updated) == ((60_000, 60_000) if hot == 0 else (60_001, 30_000))


def test_catalog_of_one_wide_object(spark, no_broadcast):
    ids = half_in_one_key(spark).withColumn("n", F.monotonically_increasing_id().cast("string"))
    catalog = ids.select(
        col("k").cast("string").alias("object"),
        col("n").alias("column_name"),
        F.lit("int").alias("data_type"),
        F.lit(1).cast("long").alias("ordinal_position"),
    )
    wanted = catalog.select("object", F.lit("*").alias("column_name"))
    got = wanted_columns(catalog, wanted)
    assert got.count() == 60_000
    assert ran_split(got)
