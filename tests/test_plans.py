"""What the optimizer makes of the operators."""

import pytest
from pyspark.sql import functions as F

from tidemark.showcase import columns, marks_and_ledger, merging, storage  # noqa: F401
from tidemark.showcase.registry import ORACLE, QUERIES
from tidemark.names import ntz
from tidemark.operators import upsert as up
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.filters import changed_since
from tidemark.operators.projection import project_columns, with_audit_columns


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def orders(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def test_incremental_filter_and_columns_reach_the_scan(orders):
    both = orders.withColumnRenamed("o_orderdate", "ins")
    df = project_columns(changed_since(both, "1999-01-01", "ins", "ins"), "o_orderkey, ins")
    plan = plan_of(df)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate," in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_or_of_two_times_reaches_the_scan(spark, tmp_path, orders):
    path = str(tmp_path / "feed")
    orders.select("o_orderkey", F.col("o_orderdate").alias("ins"), F.col("o_orderdate").alias("upd")).write.parquet(path)
    plan = plan_of(changed_since(spark.read.parquet(path), "1999-01-01", "ins", "upd"))
    assert "PushedFilters: [Or(GreaterThan(ins," in plan


def test_rank_filter_becomes_a_group_limit_on_both_sides(orders):
    plan = plan_of(latest_per_key(orders, ["o_orderkey"], "o_orderdate"))
    assert plan.count("WindowGroupLimit") == 2


def test_small_batch_never_shuffles_the_target(orders):
    target = with_audit_columns(orders, "2024-01-01")
    batch = orders.filter(F.col("o_orderdate") > ntz("2001-01-01"))
    existing = up.updated_target(target, batch, ["o_orderkey"], "2024-02-01", small=True, target_unique=True)
    assert "hashpartitioning" not in plan_of(existing) and "BroadcastHashJoin" in plan_of(existing)
    known = plan_of(up.matched_keys(target, batch, ["o_orderkey"], small=True))
    assert "ReadSchema: struct<o_orderkey:bigint>" in known and "SortMergeJoin" not in known


def test_outer_plan_shuffles_each_side_once(spark, orders):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = with_audit_columns(orders, "2024-01-01")
        batch = latest_per_key(orders, ["o_orderkey"], "o_orderdate")
        plan = plan_of(up.upsert(target, batch, ["o_orderkey"], "2024-02-01", target_unique=True))
        joined = plan[: plan.index("isnull(o_orderkey")]
        assert "FullOuter" in joined and joined.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


LOADS = {name for name in QUERIES if "load" in name} | {"schema_readd_column"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LOADS))
def test_no_python_in_plans_and_no_cross_joins(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for part in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert part not in plan


def test_current_batch_reads_one_partition(spark, sf_dir):
    plan = plan_of(QUERIES["current_batch"](spark, sf_dir))
    assert "PartitionFilters: [isnotnull(run_id" in plan and "Subquery" not in plan


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(QUERIES)
