"""Queries: marks, incremental reads, run ledger, audit."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.timestamps import effective_timestamp, local_run_time
from tidemark.names import FAILED, SENTINEL_MARK
from tidemark.operators import ledger, marks, upsert
from tidemark.operators.audit import audit_keys
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.filters import changed_since
from tidemark.plans.ledger_store import LedgerStore
from tidemark.shared import fresh_dir
from tidemark.showcase import inputs as i
from tidemark.showcase.registry import query

EVENTS_FROM = "2024-01-20 00:00:00"
_OBJECT = ("shop", "public", "user_7")


@query("high_water_mark", f"WITH {i.CHANGE_FEED_SQL} SELECT greatest(max(ins), max(upd)) AS max_timestamp FROM change_feed")
def high_water_mark(spark, sf_dir):
    return marks.high_water_mark(i.change_feed(spark, sf_dir), "ins", "upd")


@query(
    "incremental_mark",
    f"""WITH {i.CHANGE_FEED_SQL}
    SELECT max(ins) AS max_timestamp FROM change_feed
    WHERE ins > TIMESTAMP '{EVENTS_FROM}' OR upd > TIMESTAMP '{EVENTS_FROM}'""",
)
def incremental_mark(spark, sf_dir):
    changed = changed_since(i.change_feed(spark, sf_dir), EVENTS_FROM, "ins", "upd")
    return marks.incremental_mark(changed, "ins")


@query(
    "empty_batch_mark",
    f"""WITH {i.CHANGE_FEED_SQL}
    SELECT coalesce(max(ins), TIMESTAMP '{SENTINEL_MARK}') AS max_timestamp FROM change_feed WHERE value < 0 AND value > 0""",
)
def empty_batch_mark(spark, sf_dir):
    nothing = i.change_feed(spark, sf_dir).filter((F.col("value") < 0) & (F.col("value") > 0))
    return marks.incremental_mark(nothing, "ins")


@query("batch_count", f"WITH {i.ORDER_SOURCE_SQL} SELECT count(*) AS rows, count(*) = 0 AS is_empty FROM order_source")
def batch_count(spark, sf_dir):
    return marks.batch_count(i.order_source(spark, sf_dir))


@query(
    "incremental_filter",
    f"""WITH {i.CHANGE_FEED_SQL}
    SELECT * FROM change_feed WHERE ins > TIMESTAMP '{EVENTS_FROM}' OR upd > TIMESTAMP '{EVENTS_FROM}'""",
)
def incremental_filter(spark, sf_dir):
    return changed_since(i.change_feed(spark, sf_dir), EVENTS_FROM, "ins", "upd")


@query("effective_timestamp", f"WITH {i.CHANGE_FEED_SQL} SELECT event_id, coalesce(upd, ins) AS effective FROM change_feed")
def effective(spark, sf_dir):
    feed = i.change_feed(spark, sf_dir)
    return feed.select("event_id", effective_timestamp(F.col("upd"), F.col("ins")).alias("effective"))


@query("local_run_time", "SELECT event_id, ts + INTERVAL 330 MINUTE AS local_ts FROM events")
def local_time(spark, sf_dir):
    events = i.table(spark, sf_dir, "events")
    return events.select("event_id", local_run_time(F.col("ts"), "Asia/Kolkata").alias("local_ts"))


_READ_FROM = "date_trunc('milliseconds', max_timestamp - INTERVAL 10 MINUTE) AS read_from"


@query(
    "watermark_lookup",
    f"""WITH {i.VALID_MARKS_SQL}
    SELECT {_READ_FROM} FROM valid_marks WHERE source_object_name = 'user_7' ORDER BY run_id DESC LIMIT 1""",
)
def watermark_lookup(spark, sf_dir):
    return ledger.watermark_lookup(i.run_ledger(spark, sf_dir), _OBJECT)


@query(
    "watermark_per_table",
    f"""WITH {i.VALID_MARKS_SQL}
    SELECT source_database_name, source_schema_name, source_object_name, {_READ_FROM} FROM valid_marks
    QUALIFY row_number() OVER (PARTITION BY source_object_name ORDER BY run_id DESC) = 1""",
)
def watermark_per_table(spark, sf_dir):
    return ledger.watermark_per_object(i.run_ledger(spark, sf_dir))


@query(
    "failed_run_excluded",
    f"""WITH {i.VALID_MARKS_SQL}
    SELECT run_id, source_object_name, max_timestamp FROM valid_marks""",
)
def failed_run_excluded(spark, sf_dir):
    return ledger.valid_marks(i.run_ledger(spark, sf_dir)).select("run_id", "source_object_name", "max_timestamp")


@query(
    "last_success_time",
    f"""WITH {i.RUN_LEDGER_SQL}
    SELECT source_database_name, source_schema_name, source_object_name, created_timestamp AS last_success
    FROM run_ledger WHERE upper(status) = 'SUCCESS'
    QUALIFY row_number() OVER (PARTITION BY source_object_name ORDER BY run_id DESC) = 1""",
)
def last_success_time(spark, sf_dir):
    return ledger.last_success_time(i.run_ledger(spark, sf_dir))


@query(
    "ledger_append",
    f"""WITH {i.RUN_LEDGER_SQL}
    SELECT * FROM run_ledger
    UNION ALL
    SELECT max(run_id) + 1, TIMESTAMP '2024-02-01 00:00:00', TIMESTAMP '2024-02-01 00:00:01.5', 1.5, NULL, 'shop', 'public',
      'orders', 'lake', 'bronze', 'TBL_ORDERS', 'loader', 'FAILED', 'stage batch: no space', NULL, 0, NULL, 0, 0,
      TIMESTAMP '{SENTINEL_MARK}', TIMESTAMP '2024-02-01 00:00:02', 'loader'
    FROM run_ledger""",
)
def ledger_append(spark, sf_dir):
    store = LedgerStore(spark, fresh_dir(spark, "ledger"))
    i.run_ledger(spark, sf_dir).write.parquet(store.path)
    start, end = datetime(2024, 2, 1), datetime(2024, 2, 1, 0, 0, 1, 500000)
    row = {
        "run_id": store.next_run_id(),
        "run_start": start,
        "run_end": end,
        "duration_in_sec": (end - start).total_seconds(),
        "source_database_name": "shop",
        "source_schema_name": "public",
        "source_object_name": "orders",
        "target_database_name": "lake",
        "target_schema_name": "bronze",
        "target_table_name": "TBL_ORDERS",
        "triggered_by": "loader",
        "status": FAILED,
        "error_message": "stage batch: no space",
        "rows_inserted": 0,
        "rows_updated": 0,
        "rows_deleted": 0,
        "max_timestamp": datetime.fromisoformat(SENTINEL_MARK),
        "created_timestamp": datetime(2024, 2, 1, 0, 0, 2),
        "created_by": "loader",
    }
    store.append([row])
    return store.rows()


@query(
    "failure_summary",
    f"""WITH {i.RUN_LEDGER_SQL}
    SELECT source_database_name, CAST(run_start AS DATE) AS job_day,
           row_number() OVER (PARTITION BY source_database_name, CAST(run_start AS DATE) ORDER BY run_id) AS failure_no,
           run_id, source_object_name, error_message
    FROM run_ledger WHERE status = 'FAILED'""",
)
def failure_summary(spark, sf_dir):
    runs = i.run_ledger(spark, sf_dir).withColumn("job_day", F.col("run_start").cast("date"))
    return ledger.failure_summary(runs, ["source_database_name", "job_day"])


def _merged(spark, sf_dir):
    batch = latest_per_key(i.order_batch(spark, sf_dir), i.ORDER_KEYS, "o_orderdate", "o_updated")
    return upsert.upsert(i.order_target(spark, sf_dir), batch, i.ORDER_KEYS, i.SECOND_RUN, True)


@query(
    "audit_inserted",
    f"""WITH {i.ORDER_UPSERT_SQL}
    SELECT CAST(2 AS BIGINT) AS edw_run_id, 'insert' AS edw_action, o_orderkey FROM merged
    WHERE edw_inserted_timestamp >= TIMESTAMP '{i.SECOND_RUN}'""",
)
def audit_inserted(spark, sf_dir):
    return audit_keys(_merged(spark, sf_dir), i.ORDER_KEYS, i.SECOND_RUN, "insert", 2)


@query(
    "audit_updated",
    f"""WITH {i.ORDER_UPSERT_SQL}
    SELECT CAST(2 AS BIGINT) AS edw_run_id, 'update' AS edw_action, o_orderkey FROM merged
    WHERE edw_updated_timestamp >= TIMESTAMP '{i.SECOND_RUN}'""",
)
def audit_updated(spark, sf_dir):
    return audit_keys(_merged(spark, sf_dir), i.ORDER_KEYS, i.SECOND_RUN, "update", 2)
