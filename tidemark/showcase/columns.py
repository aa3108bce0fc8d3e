"""Queries: projections, types, catalogs and schema drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.timestamps import file_stamp, native_time, parse_timestamp, time_of_day, time_text, timestamp_text
from tidemark.functions.types import read_mapping
from tidemark.operators import catalog, upsert
from tidemark.operators.projection import NATIVE_TIME, project_columns, project_keys, timestamps_as_text, typed_projection
from tidemark.plans.folders import put_text
from tidemark.shared import fresh_dir
from tidemark.showcase import inputs as i
from tidemark.showcase.registry import query


@query("column_list_projection", "SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders")
def column_list_projection(spark, sf_dir):
    return project_columns(i.table(spark, sf_dir, "orders"), "o_orderkey, o_orderstatus,o_orderdate")


@query("key_projection", "SELECT l_orderkey, l_linenumber FROM lineitem")
def key_projection(spark, sf_dir):
    return project_keys(i.table(spark, sf_dir, "lineitem"), "l_orderkey, l_linenumber")


@query("typed_projection", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def typed_orders(spark, sf_dir):
    """Orders staged as text, cast to their declared types."""
    orders = i.table(spark, sf_dir, "orders")
    staged = orders.select(*[F.col(c).cast("string").alias(c) for c in orders.columns])
    types = {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    }
    return typed_projection(staged, types)


@query("time_of_day", "SELECT event_id, strftime(ts, '%H:%M:%S.%f') AS at_time FROM events")
def times(spark, sf_dir):
    return i.table(spark, sf_dir, "events").select("event_id", time_of_day(F.col("ts")).alias("at_time"))


@query("file_timestamp", "SELECT event_id, event_type || '_' || strftime(ts, '%Y-%m-%d_%H-%M-%S') || '.parquet' AS file_name FROM events")
def file_names(spark, sf_dir):
    """Names that are told apart by a moment."""
    name = F.concat("event_type", F.lit("_"), file_stamp(F.col("ts")), F.lit(".parquet"))
    return i.table(spark, sf_dir, "events").select("event_id", name.alias("file_name"))


@query("native_time", "SELECT event_id, strftime(ts, '%H:%M:%S.%f') AS at_time, extract(hour FROM ts) >= 12 AS afternoon FROM events")
def native_times(spark, sf_dir):
    """Times of day as Spark's own type, through Parquet; the text form stays the default."""
    path = fresh_dir(spark, "times")
    events = i.table(spark, sf_dir, "events").select("event_id", timestamp_text(F.col("ts")).alias("at_time"))
    with native_time(spark):
        typed_projection(events, {"event_id": "bigint", "at_time": NATIVE_TIME}).write.parquet(path)
        stored = spark.read.parquet(path)
        noon = F.lit("12:00:00").cast(NATIVE_TIME)
        found = stored.select("event_id", time_text(F.col("at_time")).alias("at_time"), (F.col("at_time") >= noon).alias("afternoon"))
        found.write.parquet(f"{path}-read")
    return spark.read.parquet(f"{path}-read")


@query(
    "datetime_to_text",
    f"""WITH {i.CHANGE_FEED_SQL}
    SELECT event_id, strftime(ins, '%Y-%m-%d %H:%M:%S.%f') AS ins, strftime(upd, '%Y-%m-%d %H:%M:%S.%f') AS upd
    FROM change_feed""",
)
def datetime_to_text(spark, sf_dir):
    return timestamps_as_text(i.change_feed(spark, sf_dir).select("event_id", "ins", "upd"))


@query(
    "multi_format_timestamp",
    f"""WITH {i.CHANGE_FEED_SQL}
    SELECT event_id, CASE WHEN event_type = 'click' THEN date_trunc('second', ins) ELSE ins END AS ins, upd
    FROM change_feed""",
)
def multi_format_timestamp(spark, sf_dir):
    """Text with a fraction, without one (clicks), 'NaT' and null, back to timestamps."""
    feed = i.change_feed(spark, sf_dir)
    with_fraction = timestamp_text(F.col("ins"))
    short = F.substring_index(with_fraction, ".", 1)
    missing = F.when(F.col("event_type") == "view", "NaT")
    as_text = feed.select(
        "event_id",
        F.when(F.col("event_type") == "click", short).otherwise(with_fraction).alias("ins"),
        F.coalesce(timestamp_text(F.col("upd")), missing).alias("upd"),
    )
    return as_text.select(
        "event_id", parse_timestamp(F.col("ins")).alias("ins"), parse_timestamp(F.col("upd")).alias("upd")
    )


_CATALOG_COLUMNS = "object, column_name, data_type, ordinal_position"


@query(
    "column_catalog",
    f"""WITH {i.CATALOG_SQL}
    SELECT {_CATALOG_COLUMNS} FROM source_catalog
    WHERE column_name IN (SELECT 'F_Col_' || o_orderkey FROM orders) OR object IN
      (SELECT 'cust_' || c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def column_catalog(spark, sf_dir):
    """Columns of finished orders by name, and every column of one customer segment ('*')."""
    entries = i.source_catalog(spark, sf_dir)
    named = entries.filter(F.startswith("column_name", F.lit("F"))).select("object", "column_name")
    every = (
        i.table(spark, sf_dir, "customer")
        .filter(F.col("c_mktsegment") == "BUILDING")
        .select(F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("object"), F.lit("*").alias("column_name"))
    )
    return catalog.wanted_columns(entries, named.unionByName(every))


@query(
    "target_columns",
    f"WITH {i.CATALOG_SQL} SELECT object, upper(column_name) AS column_name, data_type, ordinal_position FROM source_catalog",
)
def target_columns(spark, sf_dir):
    return catalog.target_columns(i.target_catalog(spark, sf_dir, everything=True))


def _mapping(spark):
    """A mapping file as a control input: of two rows for a name, the first counts."""
    path = f"{fresh_dir(spark, 'types')}/types.csv"
    lines = [
        "POSTGRESQL,SQLSERVER,WAREHOUSE",
        "int4,int,number",
        "numeric,decimal,decimal",
        "timestamp without time zone,datetime2,timestamp_ntz",
        "text,,varchar",
        "numeric,,float",
    ]
    put_text(spark, path, "\n".join(lines))
    return read_mapping(spark, path, "WAREHOUSE")


_MAPPED = """CASE data_type WHEN 'int4' THEN 'number' WHEN 'numeric' THEN 'decimal'
  WHEN 'timestamp without time zone' THEN 'timestamp_ntz' ELSE 'varchar' END AS warehouse_type"""


@query("type_mapping", f"WITH {i.CATALOG_SQL} SELECT {_CATALOG_COLUMNS}, {_MAPPED} FROM source_catalog")
def mapped_types(spark, sf_dir):
    return catalog.map_types(i.source_catalog(spark, sf_dir), _mapping(spark), "POSTGRESQL")


@query(
    "target_schema",
    f"""WITH {i.CATALOG_SQL}
    SELECT object, column_name, {_MAPPED}, ordinal_position FROM source_catalog
    UNION ALL
    SELECT object, 'edw_inserted_timestamp', 'timestamp_ntz', max(ordinal_position) + 1 FROM source_catalog GROUP BY object
    UNION ALL
    SELECT object, 'edw_updated_timestamp', 'timestamp_ntz', max(ordinal_position) + 2 FROM source_catalog GROUP BY object""",
)
def target_schemas(spark, sf_dir):
    mapped = catalog.map_types(i.source_catalog(spark, sf_dir), _mapping(spark), "POSTGRESQL")
    return catalog.target_schema(mapped)


@query(
    "schema_drift",
    f"""WITH {i.DRIFT_SQL}
    SELECT object, column_name, CASE WHEN s THEN 'added' ELSE 'missing' END AS change, source_type
    FROM both_sides WHERE s <> t""",
)
def drift(spark, sf_dir):
    return catalog.schema_drift(*i.drifted_catalogs(spark, sf_dir))


@query(
    "schema_drift_counts",
    f"""WITH {i.DRIFT_SQL}
    SELECT object, count(*) FILTER (s) AS source_columns, count(*) FILTER (t) AS target_columns,
           count(*) FILTER (s AND NOT t) AS added, count(*) FILTER (t AND NOT s) AS missing
    FROM both_sides GROUP BY object""",
)
def drift_counts(spark, sf_dir):
    return catalog.drift_counts(*i.drifted_catalogs(spark, sf_dir))


_WIDE_VALUES = i.ORDER_VALUES + ["o_orderpriority"]


@query(
    "schema_add_column",
    f"""WITH {i.ORDER_TARGET_SQL},{i.ORDER_SOURCE_SQL},
    wide_target AS (
      SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_updated, CAST(NULL AS VARCHAR) AS o_orderpriority,
             edw_inserted_timestamp, edw_updated_timestamp FROM order_target),
    wide_source AS (
      SELECT s.*, o.o_orderpriority FROM order_source s JOIN orders o ON s.o_orderkey = o.o_orderkey),
    {i.upsert_sql("wide_target", "wide_source", i.ORDER_KEYS, _WIDE_VALUES, i.SECOND_RUN, "merged")}
    SELECT * FROM merged""",
)
def schema_add_column(spark, sf_dir):
    """The source gained a column: widen the target, then upsert the whole source."""
    orders = i.table(spark, sf_dir, "orders")
    source = i.order_source(spark, sf_dir).join(orders.select("o_orderkey", "o_orderpriority"), "o_orderkey")
    target = catalog.add_columns(i.order_target(spark, sf_dir), {"o_orderpriority": "string"})
    return upsert.upsert(target, source, i.ORDER_KEYS, i.SECOND_RUN, True)


@query(
    "schema_drop_column",
    f"""WITH {i.ORDER_TARGET_SQL},{i.ORDER_BATCH_SQL},
    narrow_target AS (SELECT * EXCLUDE (o_orderstatus) FROM order_target),
    narrow_batch AS (SELECT * EXCLUDE (o_orderstatus) FROM order_batch),
    {i.upsert_sql("narrow_target", "narrow_batch", i.ORDER_KEYS, ["o_totalprice", "o_orderdate", "o_updated"], i.SECOND_RUN, "merged")}
    SELECT * FROM merged""",
)
def schema_drop_column(spark, sf_dir):
    batch = i.order_batch(spark, sf_dir).drop("o_orderstatus")
    target = catalog.drop_missing_columns(i.order_target(spark, sf_dir), batch.columns)
    return upsert.upsert(target, batch, i.ORDER_KEYS, i.SECOND_RUN, True)
