"""Inputs of the registered queries, derived from the given tables.

Each input has a Spark form and a SQL form of the same rows. All rows of a
table take part; amounts of work grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timestamps import seconds_between, timestamp_text
from tidemark.names import FAILED, SENTINEL_MARK, SUCCESS, ntz
from tidemark.operators.projection import with_audit_columns

FIRST_RUN = "2002-01-01 00:00:00"
SECOND_RUN = "2002-02-01 00:00:00"
THIRD_RUN = "2002-03-01 00:00:00"
SPLIT = "1999-01-01 00:00:00"
BATCH_FROM = "1998-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- orders as target table and batch ---------------------------------------


def order_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders loaded by the first run: those before the split date."""
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderdate") < ntz(SPLIT))
        .select(
            "o_orderkey",
            "o_orderstatus",
            "o_totalprice",
            "o_orderdate",
            F.lit(None).cast("timestamp_ntz").alias("o_updated"),
            ntz(FIRST_RUN).alias("edw_inserted_timestamp"),
            F.lit(None).cast("timestamp_ntz").alias("edw_updated_timestamp"),
        )
    )


def _order_state(orders: DataFrame) -> DataFrame:
    """Present state of the source: finished orders were repriced 30 days later."""
    finished = F.col("o_orderstatus") == "F"
    return orders.select(
        "o_orderkey",
        "o_orderstatus",
        F.when(finished, F.col("o_totalprice") + 10).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.when(finished, F.col("o_orderdate") + F.make_dt_interval(F.lit(30))).alias("o_updated"),
    )


def order_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_state(table(spark, sf_dir, "orders"))


def order_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes read by the second run: orders from a year before the split on."""
    return _order_state(table(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= ntz(BATCH_FROM)))


def order_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as a target."""
    return with_audit_columns(order_source(spark, sf_dir), FIRST_RUN)


def deleted_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low-priority orders are deleted at their order date."""
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderpriority") == "5-LOW")
        .select("o_orderkey", F.col("o_orderdate").alias("deleted_at"))
    )


ORDER_TARGET_SQL = f"""
  order_target AS (
    SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, CAST(NULL AS TIMESTAMP) AS o_updated,
           TIMESTAMP '{FIRST_RUN}' AS edw_inserted_timestamp, CAST(NULL AS TIMESTAMP) AS edw_updated_timestamp
    FROM orders WHERE o_orderdate < TIMESTAMP '{SPLIT}')"""

ORDER_SOURCE_SQL = """
  order_source AS (
    SELECT o_orderkey, o_orderstatus,
           CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 10 ELSE o_totalprice END AS o_totalprice,
           o_orderdate,
           CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 30 DAY END AS o_updated
    FROM orders)"""

ORDER_FULL_SQL = f"""{ORDER_SOURCE_SQL},
  order_full AS (
    SELECT *, TIMESTAMP '{FIRST_RUN}' AS edw_inserted_timestamp, CAST(NULL AS TIMESTAMP) AS edw_updated_timestamp
    FROM order_source)"""

ORDER_BATCH_SQL = f"""{ORDER_SOURCE_SQL},
  order_batch AS (SELECT * FROM order_source WHERE o_orderdate >= TIMESTAMP '{BATCH_FROM}')"""

DELETED_FEED_SQL = """
  deleted_feed AS (
    SELECT o_orderkey, o_orderdate AS deleted_at FROM orders WHERE o_orderpriority = '5-LOW')"""


def upsert_sql(target: str, batch: str, keys: list[str], values: list[str], run_ts: str, name: str) -> str:
    """CTE with the upsert of ``batch`` into ``target``, and the action taken."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    differ = " OR ".join(f"t.{v} IS DISTINCT FROM s.{v}" for v in values)
    all_cols = ", ".join(f"t.{c}" for c in keys + values)
    new_cols = ", ".join(f"s.{c}" for c in keys + values)
    return f"""
  {name}_all AS (
    SELECT {all_cols}, t.edw_inserted_timestamp, t.edw_updated_timestamp, 'keep' AS action
    FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {batch} s WHERE {on} AND ({differ}))
    UNION ALL
    SELECT {new_cols}, t.edw_inserted_timestamp, TIMESTAMP '{run_ts}', 'update'
    FROM {batch} s JOIN {target} t ON {on} WHERE {differ}
    UNION ALL
    SELECT {new_cols}, TIMESTAMP '{run_ts}', CAST(NULL AS TIMESTAMP), 'insert'
    FROM {batch} s WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {on})),
  {name} AS (SELECT * EXCLUDE (action) FROM {name}_all)"""


ORDER_KEYS = ["o_orderkey"]
ORDER_VALUES = ["o_orderstatus", "o_totalprice", "o_orderdate", "o_updated"]
ORDER_UPSERT_SQL = (
    f"{ORDER_TARGET_SQL},{ORDER_BATCH_SQL},"
    + upsert_sql("order_target", "order_batch", ORDER_KEYS, ORDER_VALUES, SECOND_RUN, "merged")
)


# --- events as change feed and documents --------------------------------------


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with insert and update times; purchases and errors were touched again."""
    touched = F.col("event_type").isin("purchase", "error")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "props",
        F.col("ts").alias("ins"),
        F.when(touched, F.col("ts") + F.make_dt_interval(hours=F.expr("CAST(event_id % 5 AS INT)"))).alias("upd"),
    )


CHANGE_FEED_SQL = """
  change_feed AS (
    SELECT event_id, user_id, event_type, value, props, ts AS ins,
           CASE WHEN event_type IN ('purchase', 'error') THEN ts + to_hours(CAST(event_id % 5 AS INTEGER)) END AS upd
    FROM events)"""


#: fields that both forms of a document hold as they stand, with their columns
_DOCUMENT_VALUES = {"user_id": "user_id", "kind": "event_type", "value": "value"}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text per event, keyed by the field k of its properties."""
    body = F.struct(
        F.get_json_object("props", "$.k").alias("_id"),
        timestamp_text(F.col("ins")).alias("createdAt"),
        timestamp_text(F.col("upd")).alias("updatedAt"),
        *[F.col(c).alias(name) for name, c in _DOCUMENT_VALUES.items()],
    )
    return change_feed(spark, sf_dir).select("event_id", "ins", F.to_json(body).alias("body"))


def exported_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents with object ids and dates as a database's export writes them."""

    def dated(time: str):
        iso = F.concat(F.replace(timestamp_text(F.col(time)), F.lit(" "), F.lit("T")), F.lit("Z"))
        return F.when(F.col(time).isNotNull(), F.struct(iso.alias("$date")))

    body = F.struct(
        F.struct(F.get_json_object("props", "$.k").alias("$oid")).alias("_id"),
        dated("ins").alias("createdAt"),
        dated("upd").alias("updatedAt"),
        *[F.col(c).alias(name) for name, c in _DOCUMENT_VALUES.items()],
    )
    return change_feed(spark, sf_dir).select("event_id", "ins", F.to_json(body).alias("body"))


DOCUMENTS_SQL = f"""{CHANGE_FEED_SQL},
  documents_in AS (
    SELECT event_id, json_extract_string(props, '$.k') AS _id, ins, upd, user_id, event_type AS kind, value
    FROM change_feed)"""


# --- a run ledger with one run per user and day -------------------------------


def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load per user and day: user = source object, failed where errors outnumber purchases."""
    def happened(*kinds: str):
        return F.count_if(F.col("event_type").isin(*kinds))

    days = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    runs = (
        table(spark, sf_dir, "events")
        .groupBy("user_id", days.alias("day_no"))
        .agg(
            F.min("ts").alias("run_start"),
            F.max("ts").alias("run_end"),
            happened("error").alias("errors"),
            happened("purchase").alias("purchases"),
            happened("signup", "purchase").alias("new_rows"),
            happened("click").alias("old_rows"),
        )
        .withColumn("failed", F.col("errors") > F.col("purchases"))
    )
    ok = ~F.col("failed")
    return runs.select(
        (F.col("day_no").cast("long") * 1_000_000_000 + F.col("user_id")).alias("run_id"),
        "run_start",
        "run_end",
        seconds_between(F.col("run_start"), F.col("run_end")).alias("duration_in_sec"),
        F.lit(None).cast("string").alias("ip_address"),
        F.lit("shop").alias("source_database_name"),
        F.lit("public").alias("source_schema_name"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("source_object_name"),
        F.lit("lake").alias("target_database_name"),
        F.lit("bronze").alias("target_schema_name"),
        F.concat(F.lit("TBL_USER_"), F.col("user_id").cast("string")).alias("target_table_name"),
        F.lit("loader").alias("triggered_by"),
        F.when(F.col("failed"), FAILED).when(F.col("old_rows") > 0, SUCCESS).otherwise("Success").alias("status"),
        F.when(F.col("failed"), F.concat(F.col("errors").cast("string"), F.lit(" rows refused"))).otherwise("-").alias("error_message"),
        F.lit(None).cast("string").alias("rows_inserted_ids"),
        F.when(ok, F.col("new_rows")).otherwise(0).cast("long").alias("rows_inserted"),
        F.lit(None).cast("string").alias("rows_updated_ids"),
        F.when(ok, F.col("old_rows")).otherwise(0).cast("long").alias("rows_updated"),
        F.lit(0).cast("long").alias("rows_deleted"),
        F.when(ok, F.col("run_end")).otherwise(ntz(SENTINEL_MARK)).alias("max_timestamp"),
        (F.col("run_end") + F.make_dt_interval(mins=F.lit(1))).alias("created_timestamp"),
        F.lit("loader").alias("created_by"),
    )


RUN_LEDGER_SQL = f"""
  runs AS (
    SELECT user_id, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day_no, min(ts) AS run_start, max(ts) AS run_end,
           count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type = 'purchase') AS purchases,
           count(*) FILTER (event_type IN ('signup', 'purchase')) AS new_rows,
           count(*) FILTER (event_type = 'click') AS old_rows
    FROM events GROUP BY ALL),
  run_ledger AS (
    SELECT CAST(day_no AS BIGINT) * 1000000000 + user_id AS run_id, run_start, run_end,
           date_diff('microsecond', run_start, run_end) / 1000000.0 AS duration_in_sec,
           CAST(NULL AS VARCHAR) AS ip_address, 'shop' AS source_database_name, 'public' AS source_schema_name,
           'user_' || user_id AS source_object_name, 'lake' AS target_database_name, 'bronze' AS target_schema_name,
           'TBL_USER_' || user_id AS target_table_name, 'loader' AS triggered_by,
           CASE WHEN errors > purchases THEN 'FAILED' WHEN old_rows > 0 THEN 'SUCCESS' ELSE 'Success' END AS status,
           CASE WHEN errors > purchases THEN errors || ' rows refused' ELSE '-' END AS error_message,
           CAST(NULL AS VARCHAR) AS rows_inserted_ids,
           CASE WHEN errors > purchases THEN 0 ELSE new_rows END AS rows_inserted,
           CAST(NULL AS VARCHAR) AS rows_updated_ids,
           CASE WHEN errors > purchases THEN 0 ELSE old_rows END AS rows_updated,
           CAST(0 AS BIGINT) AS rows_deleted,
           CASE WHEN errors > purchases THEN TIMESTAMP '{SENTINEL_MARK}' ELSE run_end END AS max_timestamp,
           run_end + INTERVAL 1 MINUTE AS created_timestamp, 'loader' AS created_by
    FROM runs)"""

VALID_MARKS_SQL = f"""{RUN_LEDGER_SQL},
  valid_marks AS (
    SELECT * FROM run_ledger
    WHERE upper(status) = 'SUCCESS' AND max_timestamp <> TIMESTAMP '{SENTINEL_MARK}' AND rows_inserted <> 0)"""


# --- column catalogs: one object per customer, one column per order -----------


def _catalog(orders: DataFrame) -> DataFrame:
    kind = F.col("o_orderpriority")
    return orders.select(
        F.concat(F.lit("cust_"), F.col("o_custkey").cast("string")).alias("object"),
        F.concat(F.col("o_orderstatus"), F.lit("_Col_"), F.col("o_orderkey").cast("string")).alias("column_name"),
        F.when(kind == "1-URGENT", "int4")
        .when(kind == "2-HIGH", "numeric")
        .when(kind == "3-MEDIUM", "timestamp without time zone")
        .when(kind == "4-NOT SPECIFIED", "Text")
        .otherwise("double precision")
        .alias("data_type"),
        F.col("o_orderkey").alias("ordinal_position"),
    )


def source_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog(table(spark, sf_dir, "orders"))


def drifted_catalogs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Source: columns from BATCH_FROM on. Target: those before SPLIT, upper case, with audit columns."""
    orders = table(spark, sf_dir, "orders")
    source = _catalog(orders.filter(F.col("o_orderdate") >= ntz(BATCH_FROM)))
    return source, target_catalog(spark, sf_dir)


def target_catalog(spark: SparkSession, sf_dir: str, everything: bool = False) -> DataFrame:
    """Upper-case columns, of the orders before the split or of all, and audit columns."""
    orders = table(spark, sf_dir, "orders")
    own = _catalog(orders if everything else orders.filter(F.col("o_orderdate") < ntz(SPLIT)))
    own = own.withColumn("column_name", F.upper("column_name"))
    audit = own.groupBy("object").agg(F.max("ordinal_position").alias("last"))
    for at, name in enumerate(("EDW_INSERTED_TIMESTAMP", "EDW_UPDATED_TIMESTAMP"), start=1):
        own = own.unionByName(
            audit.select(
                "object",
                F.lit(name).alias("column_name"),
                F.lit("timestamp").alias("data_type"),
                (F.col("last") + at).alias("ordinal_position"),
            )
        )
    return own


CATALOG_SQL = """
  source_catalog AS (
    SELECT 'cust_' || o_custkey AS object, o_orderstatus || '_Col_' || o_orderkey AS column_name,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'int4' WHEN '2-HIGH' THEN 'numeric'
             WHEN '3-MEDIUM' THEN 'timestamp without time zone' WHEN '4-NOT SPECIFIED' THEN 'Text'
             ELSE 'double precision' END AS data_type,
           o_orderkey AS ordinal_position, o_orderdate
    FROM orders)"""

DRIFT_SQL = f"""{CATALOG_SQL},
  new_catalog AS (SELECT * EXCLUDE (o_orderdate) FROM source_catalog WHERE o_orderdate >= TIMESTAMP '{BATCH_FROM}'),
  own_columns AS (
    SELECT object, upper(column_name) AS column_name, data_type, ordinal_position
    FROM source_catalog WHERE o_orderdate < TIMESTAMP '{SPLIT}'),
  target_catalog AS (
    SELECT * FROM own_columns
    UNION ALL
    SELECT object, 'EDW_INSERTED_TIMESTAMP', 'timestamp', max(ordinal_position) + 1 FROM own_columns GROUP BY object
    UNION ALL
    SELECT object, 'EDW_UPDATED_TIMESTAMP', 'timestamp', max(ordinal_position) + 2 FROM own_columns GROUP BY object),
  sides AS (
    SELECT object, lower(column_name) AS column_name, min(data_type) AS data_type, true AS s, false AS t
    FROM new_catalog GROUP BY ALL
    UNION ALL
    SELECT object, lower(column_name), CAST(NULL AS VARCHAR), false, true FROM target_catalog
    WHERE column_name NOT IN ('EDW_INSERTED_TIMESTAMP', 'EDW_UPDATED_TIMESTAMP')),
  both_sides AS (
    SELECT object, column_name, max(data_type) AS source_type, bool_or(s) AS s, bool_or(t) AS t
    FROM sides GROUP BY object, column_name)"""


# --- lineitem for composite keys ------------------------------------------------

LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_VALUES = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"]
LINE_TIEBREAK = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"]
LINE_SPLIT = "2000-01-01 00:00:00"
LINE_FROM = "1999-01-01 00:00:00"


def line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*LINE_KEYS, *LINE_VALUES)


LATEST_LINES_SQL = f"""
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC NULLS LAST, {", ".join(c + " NULLS LAST" for c in LINE_TIEBREAK)}) = 1"""
