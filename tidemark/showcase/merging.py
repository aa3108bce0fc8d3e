"""Queries: dedup, change detection, upserts, deletes, snapshot differences."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.comparison import row_fingerprint
from tidemark.names import ntz
from tidemark.operators import deletes, upsert
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.filters import inserted_since
from tidemark.operators.projection import with_audit_columns
from tidemark.operators.snapshot_diff import new_rows
from tidemark.showcase import inputs as i
from tidemark.showcase.registry import query


def _order_batch(spark, sf_dir):
    return latest_per_key(i.order_batch(spark, sf_dir), i.ORDER_KEYS, "o_orderdate", "o_updated")


@query("upsert", f"WITH {i.ORDER_UPSERT_SQL} SELECT * FROM merged")
def upsert_orders(spark, sf_dir):
    """Order keys are unique in the target, so one full outer join does."""
    return upsert.upsert(i.order_target(spark, sf_dir), _order_batch(spark, sf_dir), i.ORDER_KEYS, i.SECOND_RUN, True)


@query("upsert_split_plan", f"WITH {i.ORDER_UPSERT_SQL} SELECT * FROM merged")
def upsert_orders_split(spark, sf_dir):
    """The plan for targets that may repeat a key."""
    return upsert.upsert(i.order_target(spark, sf_dir), _order_batch(spark, sf_dir), i.ORDER_KEYS, i.SECOND_RUN)


@query(
    "upsert_counts",
    f"WITH {i.ORDER_UPSERT_SQL} SELECT action, count(*) AS rows FROM merged_all WHERE action <> 'keep' GROUP BY action",
)
def upsert_counts(spark, sf_dir):
    merged = upsert.upsert_with_actions(
        i.order_target(spark, sf_dir), _order_batch(spark, sf_dir), i.ORDER_KEYS, i.SECOND_RUN, True
    )
    return upsert.action_counts(merged)


@query(
    "changed_rows",
    f"""WITH {i.ORDER_TARGET_SQL},{i.ORDER_BATCH_SQL}
    SELECT s.* FROM order_batch s JOIN order_target t ON s.o_orderkey = t.o_orderkey
    WHERE {" OR ".join(f"s.{v} IS DISTINCT FROM t.{v}" for v in i.ORDER_VALUES)}""",
)
def changed_rows(spark, sf_dir):
    return upsert.changed_rows(i.order_target(spark, sf_dir), i.order_batch(spark, sf_dir), i.ORDER_KEYS)


@query(
    "dedup_latest",
    f"""WITH {i.CHANGE_FEED_SQL}
    SELECT * FROM change_feed
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type
      ORDER BY coalesce(upd, ins) DESC NULLS LAST, event_id) = 1""",
)
def dedup_latest(spark, sf_dir):
    return latest_per_key(i.change_feed(spark, sf_dir), ["user_id", "event_type"], "ins", "upd", ["event_id"])


@query("dedup_latest_composite", f"SELECT {', '.join(i.LINE_KEYS + i.LINE_VALUES)} FROM lineitem {i.LATEST_LINES_SQL}")
def dedup_latest_composite(spark, sf_dir):
    return latest_per_key(i.line_rows(spark, sf_dir), i.LINE_KEYS, "l_shipdate", tiebreak=i.LINE_TIEBREAK)


@query(
    "upsert_composite",
    f"""WITH line_target AS (
      SELECT {', '.join(i.LINE_KEYS + i.LINE_VALUES)}, TIMESTAMP '{i.FIRST_RUN}' AS edw_inserted_timestamp,
             CAST(NULL AS TIMESTAMP) AS edw_updated_timestamp
      FROM lineitem WHERE l_shipdate < TIMESTAMP '{i.LINE_SPLIT}' {i.LATEST_LINES_SQL}),
    line_batch AS (
      SELECT {', '.join(i.LINE_KEYS + i.LINE_VALUES)}
      FROM lineitem WHERE l_shipdate >= TIMESTAMP '{i.LINE_FROM}' {i.LATEST_LINES_SQL}),
    {i.upsert_sql("line_target", "line_batch", i.LINE_KEYS, i.LINE_VALUES, i.SECOND_RUN, "merged")}
    SELECT * FROM merged""",
)
def upsert_composite(spark, sf_dir):
    lines = i.line_rows(spark, sf_dir)
    old = lines.filter(F.col("l_shipdate") < ntz(i.LINE_SPLIT))
    new = lines.filter(F.col("l_shipdate") >= ntz(i.LINE_FROM))
    target = with_audit_columns(
        latest_per_key(old, i.LINE_KEYS, "l_shipdate", tiebreak=i.LINE_TIEBREAK), i.FIRST_RUN
    )
    batch = latest_per_key(new, i.LINE_KEYS, "l_shipdate", tiebreak=i.LINE_TIEBREAK)
    return upsert.upsert(target, batch, i.LINE_KEYS, i.SECOND_RUN, True)


@query(
    "deleted_feed_filter",
    f"WITH {i.DELETED_FEED_SQL} SELECT * FROM deleted_feed WHERE deleted_at > TIMESTAMP '{i.BATCH_FROM}'",
)
def deleted_feed_filter(spark, sf_dir):
    return inserted_since(i.deleted_feed(spark, sf_dir), i.BATCH_FROM, "deleted_at")


@query(
    "delete_by_key",
    f"""WITH {i.ORDER_FULL_SQL},{i.DELETED_FEED_SQL}
    SELECT * FROM order_full WHERE o_orderkey NOT IN (SELECT o_orderkey FROM deleted_feed)""",
)
def delete_by_key(spark, sf_dir):
    return deletes.delete_by_key(i.order_full(spark, sf_dir), i.deleted_feed(spark, sf_dir), i.ORDER_KEYS, True)


@query(
    "deleted_rows",
    f"""WITH {i.ORDER_FULL_SQL},{i.DELETED_FEED_SQL}
    SELECT * FROM order_full WHERE o_orderkey IN (SELECT o_orderkey FROM deleted_feed)""",
)
def deleted_rows(spark, sf_dir):
    return deletes.deleted_rows(i.order_full(spark, sf_dir), i.deleted_feed(spark, sf_dir), i.ORDER_KEYS, True)


@query(
    "delete_then_upsert",
    f"""WITH {i.ORDER_TARGET_SQL},{i.DELETED_FEED_SQL},{i.ORDER_BATCH_SQL},
    remaining AS (SELECT * FROM order_target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM deleted_feed)),
    {i.upsert_sql("remaining", "order_batch", i.ORDER_KEYS, i.ORDER_VALUES, i.SECOND_RUN, "merged")}
    SELECT * FROM merged""",
)
def delete_then_upsert(spark, sf_dir):
    remaining = deletes.delete_by_key(i.order_target(spark, sf_dir), i.deleted_feed(spark, sf_dir), i.ORDER_KEYS, True)
    return upsert.upsert(remaining, _order_batch(spark, sf_dir), i.ORDER_KEYS, i.SECOND_RUN, True)


_ORDER_ROW = ", ".join(i.ORDER_KEYS + i.ORDER_VALUES)


@query(
    "hash_new_rows",
    f"""WITH {i.ORDER_TARGET_SQL},{i.ORDER_SOURCE_SQL}
    SELECT * FROM order_source s WHERE NOT EXISTS (
      SELECT 1 FROM order_target t
      WHERE {" AND ".join(f"s.{c} IS NOT DISTINCT FROM t.{c}" for c in i.ORDER_KEYS + i.ORDER_VALUES)})""",
)
def hash_new_rows(spark, sf_dir):
    snapshot = i.order_target(spark, sf_dir).select(*i.ORDER_KEYS, *i.ORDER_VALUES)
    return new_rows(i.order_source(spark, sf_dir), snapshot)


@query(
    "row_fingerprint",
    """SELECT c_custkey, sha256(concat_ws('_', c_custkey, c_name, c_nationkey, c_mktsegment)) AS fingerprint
    FROM customer""",
)
def fingerprints(spark, sf_dir):
    customers = i.table(spark, sf_dir, "customer")
    columns = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    return customers.select("c_custkey", row_fingerprint(customers, columns, legacy=True).alias("fingerprint"))
