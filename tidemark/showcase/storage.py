"""Queries that write and read files: documents, files, staging, whole loads.

They work below the shared folder (``spark.checkpoint.dir``), in a new folder
per call.
"""

from __future__ import annotations

import time
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import functions as F

from tidemark.functions.documents import document_text, document_timestamp
from tidemark.functions.timestamps import overlap_start, timestamp_text, wall_micros
from tidemark.names import AUDIT_COLUMNS, col, ntz
from tidemark.operators import marks, upsert
from tidemark.operators.catalog import catalog_of, document_catalog
from tidemark.operators.dedup import latest_document_per_key, latest_per_key, newest_first, typed_documents
from tidemark.operators.filters import changed_since
from tidemark.operators.projection import REASONS, rejecting_projection, timestamps_as_text, typed_projection, with_audit_columns
from tidemark.plans.folders import put_text
from tidemark.plans.loads import Lake, full_load, incremental_load
from tidemark.plans.retention import retire_stage
from tidemark.shared import fresh_dir
from tidemark.showcase import inputs as i
from tidemark.showcase.marks_and_ledger import EVENTS_FROM
from tidemark.showcase.registry import query
from tidemark.sources.control import load_specs, read_control
from tidemark.sources.documents import read_changed_documents, read_documents, stage_documents, staged_documents_since
from tidemark.sources.files import (
    archived_until,
    file_manifest,
    latest_per_file_key,
    newer_than_archive,
    read_object,
    read_since,
    read_tabular,
)
from tidemark.sources.footers import AT, KEYLESS, MEASURES, footer_aggregate, with_measures
from tidemark.sources.inference import read_text, stage_inferred
from tidemark.sources.jdbc import JdbcSource
from tidemark.sources.origins import DocumentOrigin, TableOrigin
from tidemark.sources.staging import (
    current_batch,
    read_matching,
    read_staged,
    run_path,
    stage_batch,
    stage_parted,
    write_document_chunks,
    write_full_chunks,
)
from tidemark.spec import CONTROL_COLUMNS, LoadSpec

# --- control files -------------------------------------------------------------

_CONTROL_SQL = """SELECT CAST(c_custkey AS INTEGER) AS CONTROL_ID, lower(c_mktsegment) AS SRC_DB_NAME,
  'db_' || c_nationkey AS DATABASE_NAME, 'dbo' AS SCHEMA_NAME, 'table' AS OBJ_TYPE, c_name AS OBJ_NAME,
  'added_at' AS INSRT_TIME_COL, 'changed_at' AS UPDT_TIME_COL, 'id, "line"' AS PRIMARY_KEY_COL, '*' AS COL_NAMES,
  'no' AS IS_DELETION, '-' AS DELETED_TBL, 'tbl_' || c_custkey AS SF_TBL FROM customer"""


@query("control_scan", _CONTROL_SQL)
def control_scan(spark, sf_dir):
    """A control file with one row per customer, quoted commas included."""
    text = F.col("c_custkey").cast("string")
    rows = i.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("CONTROL_ID"),
        F.lower("c_mktsegment"),
        F.concat(F.lit("db_"), F.col("c_nationkey").cast("string")),
        F.lit("dbo"),
        F.lit("table"),
        F.col("c_name"),
        F.lit("added_at"),
        F.lit("changed_at"),
        F.lit('id, "line"'),
        F.lit("*"),
        F.lit("no"),
        F.lit("-"),
        F.concat(F.lit("tbl_"), text),
    )
    path = fresh_dir(spark, "control")
    rows.toDF(*CONTROL_COLUMNS).write.option("header", True).option("escape", '"').csv(path)
    return read_control(spark, path)


# --- relational sources ------------------------------------------------------------


class InSession(JdbcSource):
    """A source whose queries the session answers itself, from a view: no database is at hand.

    Rows carry the number of the range they were read in.
    """

    def select_text(self, schema, name, columns):
        return super().select_text(schema, name, columns).replace(f"{self._name(schema)}.", "")  # views have no schema

    def _load(self, spark, options, predicates=None):
        table = spark.sql(f"SELECT * FROM {options['dbtable']}")
        if predicates is None:
            return table
        parts = [table.where(p).withColumn("range_no", F.lit(at).cast("long")) for at, p in enumerate(predicates, start=1)]
        return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "range_reads",
    """WITH tiles AS (SELECT *, ntile(16) OVER (ORDER BY o_orderdate, o_orderkey) AS range_no FROM orders)
    SELECT range_no, count(*) AS rows, min(o_orderkey) AS least_key, sum(o_totalprice) AS price FROM tiles GROUP BY range_no""",
)
def range_reads(spark, sf_dir):
    """What each task of a relational read gets: ranges of as many rows each, by insert time and key."""
    i.table(spark, sf_dir, "orders").createOrReplaceTempView("tidemark_remote_orders")
    source = InSession("hive2", "jdbc:hive2://warehouse/{database}", "reader", "NOT_SET", partitions=16)
    rows = source.read(
        spark, "shop", spark.catalog.currentDatabase(), "tidemark_remote_orders", None, ("o_orderkey",), ("o_orderdate",)
    )
    return rows.groupBy("range_no").agg(
        F.count("*").alias("rows"), F.min("o_orderkey").alias("least_key"), F.sum("o_totalprice").alias("price")
    )


# --- documents -------------------------------------------------------------------

_DOC_FIELDS = {"_id": "string", "user_id": "long", "kind": "string", "value": "double"}
_DOC_SQL_COLUMNS = """_id, user_id, kind, value,
  strftime(ins, '%Y-%m-%d %H:%M:%S.%f') AS created, strftime(upd, '%Y-%m-%d %H:%M:%S.%f') AS updated"""


def _collection(spark, sf_dir, label: str) -> str:
    """The documents as an export: one JSON document per line."""
    path = fresh_dir(spark, label)
    i.documents(spark, sf_dir).select("body").write.text(path)
    return path


def _fields(docs, doc: str = "doc"):
    return docs.select(
        *[F.try_variant_get(col(doc), f"$.{n}", t).alias(n) for n, t in _DOC_FIELDS.items()],
        document_text(col(doc), "createdAt").alias("created"),
        document_text(col(doc), "updatedAt").alias("updated"),
    )


@query("doc_scan", f"WITH {i.DOCUMENTS_SQL} SELECT {_DOC_SQL_COLUMNS} FROM documents_in")
def doc_scan(spark, sf_dir):
    return _fields(read_documents(spark, _collection(spark, sf_dir, "docs")))


@query("doc_array_scan", f"WITH {i.DOCUMENTS_SQL} SELECT {_DOC_SQL_COLUMNS} FROM documents_in")
def doc_array_scan(spark, sf_dir):
    """An export of JSON arrays, each of at most 1000 documents, unfolded again."""
    chunk = F.floor(F.col("event_id") / 1000)
    arrays = i.documents(spark, sf_dir).groupBy(chunk.alias("chunk")).agg(F.collect_list("body").alias("bodies"))
    path = fresh_dir(spark, "arrays")
    arrays.select(F.concat(F.lit("["), F.array_join("bodies", ","), F.lit("]"))).write.text(path)
    return _fields(read_documents(spark, path, json_array=True, one_line=True))


@query(
    "doc_incremental_scan",
    f"""WITH {i.DOCUMENTS_SQL} SELECT {_DOC_SQL_COLUMNS} FROM documents_in
    WHERE ins > TIMESTAMP '{EVENTS_FROM}' OR upd > TIMESTAMP '{EVENTS_FROM}'""",
)
def doc_incremental_scan(spark, sf_dir):
    path = _collection(spark, sf_dir, "docs")
    return _fields(read_changed_documents(spark, path, EVENTS_FROM, "createdAt", "updatedAt"))


@query(
    "doc_staged_scan",
    f"""WITH {i.DOCUMENTS_SQL} SELECT {_DOC_SQL_COLUMNS} FROM documents_in
    WHERE ins > TIMESTAMP '{EVENTS_FROM}' OR upd > TIMESTAMP '{EVENTS_FROM}'""",
)
def doc_staged_scan(spark, sf_dir):
    """The same from a stage, whose scan filters by the time kept beside each document."""
    docs = read_documents(spark, _collection(spark, sf_dir, "docs"))
    staged = stage_documents(docs, fresh_dir(spark, "staged"), "createdAt", "updatedAt")
    return _fields(staged_documents_since(staged, datetime.fromisoformat(EVENTS_FROM)))


_FIELDS_SQL = ", ".join(
    f"('{name}', '{dtype}', {at}, {held})"
    for at, (name, dtype, held) in enumerate(
        [("_id", "string", "_id"), ("createdAt", "string", "ins"), ("kind", "string", "kind"), ("updatedAt", "string", "upd"),
         ("user_id", "bigint", "user_id"), ("value", "decimal", "value")], start=1
    )
)


@query(
    "doc_catalog",
    f"""WITH {i.DOCUMENTS_SQL}
    SELECT 'members' AS object, f.column_name, f.data_type, CAST(f.place AS BIGINT) AS ordinal_position, f.documents
    FROM (SELECT count(_id) AS _id, count(ins) AS ins, count(kind) AS kind, count(upd) AS upd, count(user_id) AS user_id,
                 count(value) AS value FROM documents_in) n,
         LATERAL (VALUES {_FIELDS_SQL}) f(column_name, data_type, place, documents) WHERE f.documents > 0""",
)
def doc_catalog(spark, sf_dir):
    """Fields, types and numbers of a collection; digits of decimals vary with the data."""
    docs = read_documents(spark, _collection(spark, sf_dir, "docs"))
    found = document_catalog(docs, "members")
    return found.withColumn("data_type", F.regexp_replace("data_type", r"^(decimal\(.*|double)$", "decimal"))


def _variants(spark, sf_dir):
    docs = i.documents(spark, sf_dir)
    return docs.select("event_id", "ins", F.parse_json("body").alias("doc"))


@query("doc_key_projection", f"WITH {i.DOCUMENTS_SQL} SELECT event_id, _id AS doc_key FROM documents_in")
def doc_key_projection(spark, sf_dir):
    return _variants(spark, sf_dir).select("event_id", document_text(col("doc"), "_id").alias("doc_key"))


@query("doc_high_water_mark", f"WITH {i.DOCUMENTS_SQL} SELECT greatest(max(ins), max(upd)) AS max_timestamp FROM documents_in")
def doc_high_water_mark(spark, sf_dir):
    return marks.document_high_water_mark(_variants(spark, sf_dir), "doc", "createdAt", "updatedAt")


_LATEST_DOC = "QUALIFY row_number() OVER (PARTITION BY _id ORDER BY coalesce(upd, ins) DESC NULLS LAST, event_id) = 1"


@query("doc_dedup_latest", f"WITH {i.DOCUMENTS_SQL} SELECT {_DOC_SQL_COLUMNS} FROM documents_in {_LATEST_DOC}")
def doc_dedup_latest(spark, sf_dir):
    return _fields(
        latest_document_per_key(_variants(spark, sf_dir), "doc", "_id", "createdAt", "updatedAt", ["event_id"])
    )


@query(
    "doc_upsert",
    f"""WITH {i.DOCUMENTS_SQL},
    latest_old AS (SELECT * FROM documents_in WHERE ins < TIMESTAMP '{EVENTS_FROM}' {_LATEST_DOC}),
    latest_all AS (SELECT * FROM documents_in {_LATEST_DOC})
    SELECT {", ".join("a." + c for c in ("_id", "user_id", "kind", "value"))},
           strftime(a.ins, '%Y-%m-%d %H:%M:%S.%f') AS created, strftime(a.upd, '%Y-%m-%d %H:%M:%S.%f') AS updated,
           CASE WHEN o._id IS NULL THEN TIMESTAMP '{i.SECOND_RUN}' ELSE TIMESTAMP '{i.FIRST_RUN}' END AS edw_inserted_timestamp,
           CASE WHEN o.event_id <> a.event_id THEN TIMESTAMP '{i.SECOND_RUN}' END AS edw_updated_timestamp
    FROM latest_all a LEFT JOIN latest_old o ON a._id = o._id""",
)
def doc_upsert(spark, sf_dir):
    """First run: documents before a date. Second run: every batch staged so far, ranked together.

    All documents are staged once, with their key and times as columns.
    """
    typed, times = typed_documents(_variants(spark, sf_dir), "doc", {"_id": "doc_key"}, "createdAt", "updatedAt")
    staged = stage_batch(typed, fresh_dir(spark, "documents"), 1)

    def latest(batch):
        return latest_per_key(batch, ["doc_key"], *newest_first(times), ["event_id"]).select("doc_key", "doc")

    target = with_audit_columns(latest(staged.filter(F.col("ins") < ntz(EVENTS_FROM))), i.FIRST_RUN)
    merged = upsert.upsert_documents(target, latest(staged), "doc", "_id", i.SECOND_RUN, target_unique=True)
    return merged.select(
        *[F.try_variant_get("doc", f"$.{n}", t).alias(n) for n, t in _DOC_FIELDS.items()],
        document_text(col("doc"), "createdAt").alias("created"),
        document_text(col("doc"), "updatedAt").alias("updated"),
        "edw_inserted_timestamp",
        "edw_updated_timestamp",
    )


@query("chunked_json_sink", "SELECT conv_id, turn, role, text FROM conversations")
def chunked_json_sink(spark, sf_dir):
    """Conversations as JSON files of at most 1000 documents, read back."""
    path = fresh_dir(spark, "chunks")
    write_document_chunks(i.table(spark, sf_dir, "conversations"), path, 1000)
    return read_tabular(spark, path, "json", "conv_id long, turn long, role string, text string")


@query(
    "full_chunks",
    """WITH numbered AS (SELECT (row_number() OVER () - 1) // 100 AS chunk FROM conversations)
    SELECT documents, count(*) AS files FROM (SELECT count(*) AS documents FROM numbered GROUP BY chunk) GROUP BY documents""",
)
def full_chunks(spark, sf_dir):
    """Conversations as JSON files of exactly 100 documents, the rest in one: files by their number of documents."""
    path = fresh_dir(spark, "chunks")
    write_full_chunks(i.table(spark, sf_dir, "conversations"), path, 100, fresh_dir(spark, "numbered"))
    rows = read_tabular(spark, path, "json", "conv_id long, turn long, role string, text string")
    files = rows.groupBy(F.input_file_name()).agg(F.count("*").alias("documents"))
    return files.groupBy("documents").agg(F.count("*").alias("files"))


# --- files ------------------------------------------------------------------------


def _event_files(spark, sf_dir, label: str, kinds: list[str] | None = None, after: datetime | None = None) -> str:
    """Events as CSV, one folder per event type: object=export_<type>; ``after`` adds files to a folder, later than a moment."""
    path = label if after else fresh_dir(spark, label)
    if after:  # file times may be as coarse as a second
        time.sleep(max(0.0, after.replace(tzinfo=timezone.utc).timestamp() + 1.01 - time.time()))
    events = i.table(spark, sf_dir, "events")
    if kinds:
        events = events.filter(F.col("event_type").isin(kinds))
    named = timestamps_as_text(events).withColumn("object", F.concat(F.lit("export_"), F.col("event_type")))
    named.write.mode("append").partitionBy("object").option("header", True).csv(path)
    return path


@query("file_manifest", "SELECT DISTINCT 'object=export_' || event_type AS file_key, true AS has_data FROM events")
def manifest_of_files(spark, sf_dir):
    root = _event_files(spark, sf_dir, "files")
    found = latest_per_file_key(file_manifest(spark, root, ".csv"), root)
    return found.select("file_key", (F.col("bytes") > 0).alias("has_data"))


@query("file_select", "SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type = 'click'")
def file_select(spark, sf_dir):
    """The file that answers to 'Click', whatever its case."""
    root = _event_files(spark, sf_dir, "files")
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    return read_object(spark, root, "Click", "csv", schema).drop("props")


@query(
    "file_newer_than_archive",
    "SELECT DISTINCT 'object=export_' || event_type AS file_key FROM events WHERE event_type NOT IN ('click', 'view')",
)
def file_newer_than_archive(spark, sf_dir):
    """Clicks and views were archived after they were written; the rest was not."""
    root = _event_files(spark, sf_dir, "files")
    archive = _event_files(spark, sf_dir, "archive", ["click", "view"])
    fresh = newer_than_archive(
        file_manifest(spark, root, ".csv"), root, file_manifest(spark, archive, ".csv"), archive
    )
    return fresh.select("file_key")


@query(
    "files_since",
    """SELECT event_id, ts, user_id, event_type, value FROM events WHERE event_type NOT IN ('click', 'view')""",
)
def files_since(spark, sf_dir):
    """Rows of the files that came after the newest archived one; older files are not listed into the scan."""
    root = _event_files(spark, sf_dir, "files", ["click", "view"])
    mark = archived_until(file_manifest(spark, root, ".csv"))
    _event_files(spark, sf_dir, root, ["error", "purchase", "signup"], mark)
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    return read_since(spark, root, "csv", schema, mark).drop("props")


@query(
    "inferred_stage",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'int,string,int,double,string' AS types FROM customer""",
)
def inferred_stage(spark, sf_dir):
    """Customers as CSV, staged and typed in one pass over the file."""
    path = fresh_dir(spark, "csv")
    i.table(spark, sf_dir, "customer").write.option("header", True).csv(path)
    staged, types = stage_inferred(read_text(spark, path), fresh_dir(spark, "staged"))
    return staged.select(F.col("c_custkey").cast("long"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment").withColumn(
        "types", F.lit(",".join(types.values()))
    )


@query(
    "staged_mark",
    """SELECT max(o_orderdate) AS max_timestamp, count(*) AS rows, false AS has_null_keys FROM orders""",
)
def staged_mark(spark, sf_dir):
    """Mark and size of a staged batch from the footers of its files."""
    path = fresh_dir(spark, "staged")
    orders = i.table(spark, sf_dir, "orders")
    with_measures(orders, ["o_orderdate"], ["o_orderkey"]).write.parquet(path)
    found = footer_aggregate(spark, path, MEASURES, F.max(AT), F.count(F.lit(1)), F.max(KEYLESS))
    since = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.col("at").cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(20,0)")
    return found.toDF("at", "rows", "keyless").select(
        (since + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))).alias("max_timestamp"),
        "rows",
        (F.col("keyless") > 0).alias("has_null_keys"),
    )


@query(
    "rejected_values",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS o_custkey,
      CASE WHEN o_orderkey % 7 = 0 AND o_orderkey % 11 = 0 THEN 'o_custkey: n/a is no bigint; o_orderdate: soon is no timestamp_ntz'
           WHEN o_orderkey % 7 = 0 THEN 'o_custkey: n/a is no bigint'
           WHEN o_orderkey % 11 = 0 THEN 'o_orderdate: soon is no timestamp_ntz' END AS why
    FROM orders""",
)
def rejected_values(spark, sf_dir):
    """Orders as text with values that are none of their type: good rows and misfits, parted in one pass."""
    orders = i.table(spark, sf_dir, "orders")
    key, text = F.col("o_orderkey"), lambda name: F.col(name).cast("string")
    staged = orders.select(
        text("o_orderkey").alias("o_orderkey"),
        F.when(key % 7 == 0, "n/a").otherwise(text("o_custkey")).alias("o_custkey"),
        F.when(key % 11 == 0, "soon").otherwise(text("o_orderdate")).alias("o_orderdate"),
    )
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderdate": "timestamp_ntz"}
    good, misfits = stage_parted(rejecting_projection(staged, types), REASONS, fresh_dir(spark, "parted"), 1)
    why = F.transform(REASONS, lambda r: F.concat(r["column"], F.lit(": "), r["text"], F.lit(" is no "), r["type"]))
    rejected = misfits.select("o_orderkey", "o_custkey", F.array_join(why, "; ").alias("why"))
    return good.select("o_orderkey", "o_custkey", F.lit(None).cast("string").alias("why")).unionByName(rejected)


@query("file_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def file_scan(spark, sf_dir):
    """Customers as CSV with a header, types inferred from the data."""
    path = fresh_dir(spark, "csv")
    i.table(spark, sf_dir, "customer").write.option("header", True).csv(path)
    found = read_tabular(spark, path, "csv")
    return found.select(F.col("c_custkey").cast("long"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query(
    "file_catalog",
    """SELECT 'customer' AS object, column_name, data_type, row_number() OVER () AS ordinal_position
    FROM (VALUES ('c_custkey', 'int'), ('c_name', 'string'), ('c_nationkey', 'int'), ('c_acctbal', 'double'),
                 ('c_mktsegment', 'string')) AS t(column_name, data_type)""",
)
def file_catalog(spark, sf_dir):
    """Columns of a file as inferred from all of its rows."""
    path = fresh_dir(spark, "csv")
    i.table(spark, sf_dir, "customer").write.option("header", True).csv(path)
    return catalog_of(spark, {"customer": read_tabular(spark, path, "csv")})


@query(
    "file_incremental",
    f"""WITH {i.CHANGE_FEED_SQL} SELECT event_id, value, ins, upd FROM change_feed
    WHERE ins > TIMESTAMP '{EVENTS_FROM}' OR upd > TIMESTAMP '{EVENTS_FROM}'""",
)
def file_incremental(spark, sf_dir):
    path = fresh_dir(spark, "csv")
    feed = i.change_feed(spark, sf_dir).select("event_id", "value", "ins", "upd")
    timestamps_as_text(feed).write.option("header", True).csv(path)
    rows = read_tabular(spark, path, "csv", "event_id long, value double, ins timestamp_ntz, upd timestamp_ntz")
    return changed_since(rows, EVENTS_FROM, "ins", "upd")


@query("staged_scan", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def staged_scan(spark, sf_dir):
    """Orders staged as text beside another table, found by path pattern and cast to their types."""
    root = fresh_dir(spark, "stages")
    orders = i.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    text = orders.select(*[F.col(c).cast("string").alias(c) for c in orders.columns])
    text.write.parquet(run_path(f"{root}/tbl_orders", 1))
    text.withColumn("o_custkey", F.lit("-1")).write.parquet(run_path(f"{root}/tbl_other", 1))
    staged = read_matching(spark, root, ".*tbl_orders.*", text.schema)
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double", "o_orderdate": "timestamp_ntz"}
    return typed_projection(staged, types)


@query(
    "current_batch",
    """SELECT event_id, user_id, event_type, value, ts, CAST(date_diff('week', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS run_id
    FROM events
    WHERE date_diff('week', DATE '2024-01-01', CAST(ts AS DATE)) =
      (SELECT max(date_diff('week', DATE '2024-01-01', CAST(ts AS DATE))) FROM events)""",
)
def newest_batch(spark, sf_dir):
    """Events staged in weekly runs; the current batch is the newest run, whose id is known."""
    stage, newest = _weekly_runs(spark, sf_dir)
    return current_batch(read_staged(spark, stage, f"{_EVENT_COLUMNS}, run_id int"), newest)


_EVENT_COLUMNS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"


def _weekly_runs(spark, sf_dir) -> tuple[str, int]:
    """Events staged with the week as run id; the folder and the newest run."""
    stage = fresh_dir(spark, "stage")
    events = i.table(spark, sf_dir, "events").drop("props")
    week = F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / 7).cast("int")
    events.withColumn("run_id", week).write.partitionBy("run_id").parquet(stage)
    return stage, events.agg(F.max(week)).first()[0]


@query(
    "retained_stage",
    """SELECT event_id, user_id, event_type, value, ts, CAST(date_diff('week', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS run_id
    FROM events
    WHERE date_diff('week', DATE '2024-01-01', CAST(ts AS DATE)) >
      (SELECT max(date_diff('week', DATE '2024-01-01', CAST(ts AS DATE))) - 2 FROM events)""",
)
def retained_stage(spark, sf_dir):
    """The same stage after all runs but the newest two were removed."""
    stage, newest = _weekly_runs(spark, sf_dir)
    retire_stage(spark, stage, newest, keep=2)
    return read_staged(spark, stage, f"{_EVENT_COLUMNS}, run_id int")


# --- whole loads -------------------------------------------------------------------


def _order_spec(**changes) -> LoadSpec:
    row = {
        "CONTROL_ID": 1,
        "SRC_DB_NAME": "shop",
        "DATABASE_NAME": "shop",
        "SCHEMA_NAME": "public",
        "OBJ_TYPE": "table",
        "OBJ_NAME": "orders",
        "INSRT_TIME_COL": "o_orderdate",
        "UPDT_TIME_COL": "o_updated",
        "PRIMARY_KEY_COL": "o_orderkey",
        "COL_NAMES": "*",
        "IS_DELETION": "no",
        "DELETED_TBL": "-",
        "SF_TBL": "tbl_orders",
    }
    return LoadSpec.from_control({**row, **changes})


def _checked(rows: list[dict]) -> None:
    failed = [r["error_message"] for r in rows if r["status"] != "SUCCESS"]
    if failed:
        raise RuntimeError(f"load failed: {failed}")


def _at(moment: str):
    return lambda: datetime.fromisoformat(moment)


def _lake(spark, root: str, source: str, at: str) -> Lake:
    return Lake(spark, root, {"shop": TableOrigin(source)}, clock=_at(at))


def _two_loads(spark, sf_dir, label: str, spec: LoadSpec, stored=lambda df: df) -> Lake:
    """Early orders loaded whole, then the present orders loaded by what changed; ``stored`` is how the source keeps them."""
    root = fresh_dir(spark, label)
    early = i.order_target(spark, sf_dir).select(*i.ORDER_KEYS, *i.ORDER_VALUES)
    stored(early).write.parquet(f"{root}/before/orders")
    stored(i.order_source(spark, sf_dir)).write.parquet(f"{root}/after/orders")
    if spec.deleted_object:
        feed = i.deleted_feed(spark, sf_dir)
        feed = feed.withColumnRenamed("deleted_at", spec.inserted_col) if spec.inserted_col else feed
        feed.limit(0).write.parquet(f"{root}/before/{spec.deleted_object}")
        feed.write.parquet(f"{root}/after/{spec.deleted_object}")
    _checked(full_load(_lake(spark, root, f"{root}/before", i.FIRST_RUN), [spec]))
    lake = _lake(spark, root, f"{root}/after", i.SECOND_RUN)
    _checked(incremental_load(lake, [spec]))
    return lake


# as _LATEST_DOC; no two events of one key have the same time
_LATEST_BODY = "QUALIFY row_number() OVER (PARTITION BY _id ORDER BY coalesce(upd, ins) DESC NULLS LAST, ins, event_id) = 1"


@query(
    "full_load",
    f"""WITH {i.ORDER_SOURCE_SQL}
    SELECT *, TIMESTAMP '{i.FIRST_RUN}' AS edw_inserted_timestamp, CAST(NULL AS TIMESTAMP) AS edw_updated_timestamp
    FROM order_source""",
)
def load_everything(spark, sf_dir):
    root = fresh_dir(spark, "full")
    i.order_source(spark, sf_dir).write.parquet(f"{root}/source/orders")
    lake = _lake(spark, root, f"{root}/source", i.FIRST_RUN)
    spec = _order_spec()
    _checked(full_load(lake, [spec]))
    return lake.current(spec)


@query(
    "control_load",
    """SELECT CAST(1 AS BIGINT) AS run_id, 'TBL_CUSTOMER' AS target_table_name, count(*) AS rows_inserted FROM customer
    UNION ALL SELECT 2, 'TBL_PART', count(*) FROM part
    UNION ALL SELECT 3, 'TBL_SUPPLIER', count(*) FROM supplier UNION ALL SELECT 4, 'TBL_ORDERS', count(*) FROM orders
    UNION ALL SELECT 5, 'TBL_NATION', count(*) FROM nation UNION ALL SELECT 6, 'TBL_REGION', count(*) FROM region""",
)
def load_control_file(spark, sf_dir):
    """Six objects of a control file, each with a key of its own, loaded side by side."""
    root = fresh_dir(spark, "control")
    objects = {
        "customer": "c_custkey",
        "part": "p_partkey",
        "supplier": "s_suppkey",
        "orders": "o_orderkey",
        "nation": "n_nationkey",
        "region": "r_regionkey",
    }
    lines = [",".join(CONTROL_COLUMNS)]
    for number, (name, key) in enumerate(objects.items(), start=1):
        i.table(spark, sf_dir, name).write.parquet(f"{root}/source/{name}")
        lines.append(f"{number},shop,shop,public,table,{name},-,-,{key},*,no,-,tbl_{name}")
    put_text(spark, f"{root}/control/control.csv", "\n".join(lines))
    lake = _lake(spark, root, f"{root}/source", i.FIRST_RUN)
    _checked(full_load(lake, load_specs(read_control(spark, f"{root}/control"))))
    return lake.ledger.rows().select("run_id", "target_table_name", "rows_inserted")


@query(
    "incremental_load",
    f"""WITH {i.ORDER_TARGET_SQL},{i.ORDER_SOURCE_SQL},
    mark AS (
      SELECT date_trunc('milliseconds', greatest(max(o_orderdate), max(o_updated)) - INTERVAL 10 MINUTE) AS w FROM order_target),
    changed AS (SELECT * FROM order_source WHERE o_orderdate > (SELECT w FROM mark) OR o_updated > (SELECT w FROM mark)),
    {i.upsert_sql("order_target", "changed", i.ORDER_KEYS, i.ORDER_VALUES, i.SECOND_RUN, "merged")}
    SELECT * FROM merged""",
)
def load_changes(spark, sf_dir):
    """First run loads the early orders; the source moves on; the second run loads what changed."""
    spec = _order_spec()
    return _two_loads(spark, sf_dir, "incremental", spec).current(spec)


_INCREMENTAL_SQL = f"""{i.ORDER_TARGET_SQL},{i.ORDER_SOURCE_SQL},
    mark AS (
      SELECT date_trunc('milliseconds', greatest(max(o_orderdate), max(o_updated)) - INTERVAL 10 MINUTE) AS w FROM order_target),
    changed AS (SELECT * FROM order_source WHERE o_orderdate > (SELECT w FROM mark) OR o_updated > (SELECT w FROM mark))"""


@query(
    "incremental_load_zoned",
    f"""WITH {_INCREMENTAL_SQL},
    {i.upsert_sql("order_target", "changed", i.ORDER_KEYS, i.ORDER_VALUES, i.SECOND_RUN, "merged")}
    SELECT * FROM merged""",
)
def load_zoned_changes(spark, sf_dir):
    """As incremental_load for a source whose times are instants: they are stored as their wall clock in UTC."""
    spec = _order_spec()

    def instants(df):
        return df.withColumns({t: F.timestamp_micros(wall_micros(F.col(t))) for t in spec.times})

    return _two_loads(spark, sf_dir, "zoned", spec, instants).current(spec)


@query(
    "update_only_loads",
    f"""WITH {i.ORDER_SOURCE_SQL}, early AS (SELECT * FROM order_source WHERE o_orderdate < TIMESTAMP '{i.SPLIT}'),
    mark AS (SELECT date_trunc('milliseconds', max(o_orderdate) - INTERVAL 10 MINUTE) AS w FROM early)
    SELECT CAST(1 AS BIGINT) AS run_id, count(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated,
           max(w) AS read_from FROM early, mark
    UNION ALL
    SELECT 2, 0, count(*) FILTER (o_orderstatus = 'F' AND (o_orderdate > w OR o_updated > w)),
           date_trunc('milliseconds', greatest(max(o_orderdate), max(o_updated)) - INTERVAL 10 MINUTE) FROM early, mark""",
)
def load_updates_only(spark, sf_dir):
    """A second run that only updates moves the start of the third."""
    root, spec = fresh_dir(spark, "updates"), _order_spec()
    early = F.col("o_orderdate") < ntz(i.SPLIT)
    i.order_target(spark, sf_dir).select(*i.ORDER_KEYS, *i.ORDER_VALUES).write.parquet(f"{root}/before/orders")
    i.order_source(spark, sf_dir).filter(early).write.parquet(f"{root}/after/orders")
    _checked(full_load(_lake(spark, root, f"{root}/before", i.FIRST_RUN), [spec]))
    lake = _lake(spark, root, f"{root}/after", i.SECOND_RUN)
    _checked(incremental_load(lake, [spec]))
    start = overlap_start(F.col("max_timestamp"), lake.overlap_minutes)
    return lake.ledger.rows().select("run_id", "rows_inserted", "rows_updated", start.alias("read_from"))


@query(
    "schema_readd_column",
    f"""SELECT o_orderkey, o_orderdate, CASE WHEN o_orderdate >= TIMESTAMP '{i.BATCH_FROM}' THEN o_custkey END AS o_orderstatus,
           CASE WHEN o_orderdate < TIMESTAMP '{i.SPLIT}' THEN TIMESTAMP '{i.FIRST_RUN}' ELSE TIMESTAMP '{i.THIRD_RUN}' END AS edw_inserted_timestamp,
           CASE WHEN o_orderdate >= TIMESTAMP '{i.BATCH_FROM}' AND o_orderdate < TIMESTAMP '{i.SPLIT}' THEN TIMESTAMP '{i.THIRD_RUN}' END AS edw_updated_timestamp
    FROM orders WHERE o_orderdate < TIMESTAMP '{i.SPLIT}' OR o_orderdate >= TIMESTAMP '{i.BATCH_FROM}'""",
)
def schema_readd_column(spark, sf_dir):
    """A column goes and comes back with another type: rows not read again have no value in it."""
    root, spec = fresh_dir(spark, "readd"), _order_spec(UPDT_TIME_COL="-")
    orders = i.table(spark, sf_dir, "orders")
    early = orders.filter(F.col("o_orderdate") < ntz(i.SPLIT))
    early.select("o_orderkey", "o_orderdate", "o_orderstatus").write.parquet(f"{root}/one/orders")
    early.select("o_orderkey", "o_orderdate").write.parquet(f"{root}/two/orders")
    late = orders.filter(F.col("o_orderdate") >= ntz(i.BATCH_FROM))
    late.select("o_orderkey", "o_orderdate", F.col("o_custkey").alias("o_orderstatus")).write.parquet(f"{root}/three/orders")
    _checked(full_load(_lake(spark, root, f"{root}/one", i.FIRST_RUN), [spec]))
    _checked(incremental_load(_lake(spark, root, f"{root}/two", i.SECOND_RUN), [spec]))
    lake = _lake(spark, root, f"{root}/three", i.THIRD_RUN)
    _checked(incremental_load(lake, [spec]))
    return lake.current(spec)


@query(
    "typed_load",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, strftime(ts, '%H:%M:%S.%f') AS at,
           (event_id || '.' || lpad(CAST(user_id % 100 AS VARCHAR), 2, '0')) AS price
    FROM events""",
)
def typed_load(spark, sf_dir):
    """Text columns of a source that declares JSON, time and decimal: each is stored as what it is."""
    root = fresh_dir(spark, "typed")
    price = F.concat_ws(".", "event_id", F.lpad((F.col("user_id") % 100).cast("string"), 2, "0"))
    rows = i.table(spark, sf_dir, "events").select(
        "event_id", "props", timestamp_text(F.col("ts")).alias("at"), price.alias("price"), "ts"
    )
    rows.write.parquet(f"{root}/source/events")
    types = {"event_id": "bigint", "props": "json", "at": "time", "price": "decimal(14,2)", "ts": "timestamp_ntz"}
    origin = TableOrigin(f"{root}/source", types={"events": types})
    spec = _order_spec(OBJ_NAME="events", INSRT_TIME_COL="ts", UPDT_TIME_COL="-", PRIMARY_KEY_COL="event_id", SF_TBL="tbl_events")
    lake = Lake(spark, root, {"shop": origin}, clock=_at(i.FIRST_RUN))
    _checked(full_load(lake, [spec]))
    return lake.current(spec).select(
        "event_id", F.try_variant_get("props", "$.k", "bigint").alias("k"), "at", F.col("price").cast("string").alias("price")
    )


@query(
    "snapshot_load",
    f"""WITH {i.ORDER_TARGET_SQL},{i.ORDER_SOURCE_SQL},
    {i.upsert_sql("order_target", "order_source", i.ORDER_KEYS, i.ORDER_VALUES, i.SECOND_RUN, "merged")}
    SELECT * FROM merged""",
)
def load_snapshot_changes(spark, sf_dir):
    """As incremental_load for a source without modified times: snapshots are compared."""
    spec = _order_spec(INSRT_TIME_COL="-", UPDT_TIME_COL="-")
    return _two_loads(spark, sf_dir, "snapshot", spec).current(spec)


@query(
    "deleting_load",
    f"""WITH {i.ORDER_TARGET_SQL},{i.ORDER_SOURCE_SQL},{i.DELETED_FEED_SQL},
    mark AS (
      SELECT date_trunc('milliseconds', greatest(max(o_orderdate), max(o_updated)) - INTERVAL 10 MINUTE) AS w FROM order_target),
    changed AS (SELECT * FROM order_source WHERE o_orderdate > (SELECT w FROM mark) OR o_updated > (SELECT w FROM mark)),
    remaining AS (
      SELECT * FROM order_target WHERE o_orderkey NOT IN (
        SELECT o_orderkey FROM deleted_feed WHERE deleted_at > (SELECT w FROM mark))),
    {i.upsert_sql("remaining", "changed", i.ORDER_KEYS, i.ORDER_VALUES, i.SECOND_RUN, "merged")}
    SELECT * FROM merged""",
)
def load_with_deletes(spark, sf_dir):
    """As incremental_load with a feed of deleted rows, applied before the upsert."""
    spec = _order_spec(IS_DELETION="yes", DELETED_TBL="orders_deleted")
    return _two_loads(spark, sf_dir, "deleting", spec).current(spec)


_DELETING_SQL = f"""{_INCREMENTAL_SQL},{i.DELETED_FEED_SQL},
    gone AS (SELECT o_orderkey FROM deleted_feed WHERE deleted_at > (SELECT w FROM mark)),
    remaining AS (SELECT * FROM order_target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM gone)),
    {i.upsert_sql("remaining", "changed", i.ORDER_KEYS, i.ORDER_VALUES, i.SECOND_RUN, "merged")}"""


@query(
    "load_audit",
    f"""WITH {_DELETING_SQL}
    SELECT CAST(2 AS BIGINT) AS edw_run_id, action AS edw_action, o_orderkey FROM merged_all WHERE action <> 'keep'""",
)
def load_audit(spark, sf_dir):
    """Keys that the second run of deleting_load inserted or updated."""
    spec = _order_spec(IS_DELETION="yes", DELETED_TBL="orders_deleted")
    return _two_loads(spark, sf_dir, "audit", spec).audit(spec, 2)


@query(
    "load_counts",
    f"""WITH {_DELETING_SQL}
    SELECT CAST(1 AS BIGINT) AS run_id, count(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_deleted
    FROM order_target
    UNION ALL
    SELECT 2, count(*) FILTER (action = 'insert'), count(*) FILTER (action = 'update'),
           (SELECT count(*) FROM order_target WHERE o_orderkey IN (SELECT o_orderkey FROM gone))
    FROM merged_all""",
)
def load_counts(spark, sf_dir):
    """What the ledger says of both runs of deleting_load."""
    spec = _order_spec(IS_DELETION="yes", DELETED_TBL="orders_deleted")
    rows = _two_loads(spark, sf_dir, "counts", spec).ledger.rows()
    return rows.select("run_id", "rows_inserted", "rows_updated", "rows_deleted")


@query(
    "audit_of_idle_run",
    f"""WITH {i.ORDER_SOURCE_SQL}
    SELECT CAST(1 AS BIGINT) AS run_id, count(*) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated, count(*) AS audit_rows
    FROM order_source UNION ALL SELECT 2, 0, 0, 0""",
)
def audit_of_idle_run(spark, sf_dir):
    """A run that finds nothing new logs zeros and has no audit rows."""
    root, spec = fresh_dir(spark, "idle"), _order_spec()
    i.order_source(spark, sf_dir).write.parquet(f"{root}/source/orders")
    _checked(full_load(_lake(spark, root, f"{root}/source", i.FIRST_RUN), [spec]))
    lake = _lake(spark, root, f"{root}/source", i.SECOND_RUN)
    _checked(incremental_load(lake, [spec]))
    audits = lake.audit(spec, 1).unionByName(lake.audit(spec, 2))
    held = audits.groupBy(F.col("edw_run_id").alias("run_id")).agg(F.count("*").alias("audit_rows"))
    runs = lake.ledger.rows().select("run_id", "rows_inserted", "rows_updated").join(held, "run_id", "left")
    return runs.fillna(0, ["audit_rows"])


@query(
    "deleting_snapshot_load",
    f"""WITH {i.ORDER_TARGET_SQL},{i.ORDER_SOURCE_SQL},{i.DELETED_FEED_SQL},
    remaining AS (SELECT * FROM order_target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM deleted_feed)),
    changed AS (
      SELECT * FROM order_source s WHERE NOT EXISTS (
        SELECT 1 FROM order_target t
        WHERE {" AND ".join(f"s.{c} IS NOT DISTINCT FROM t.{c}" for c in i.ORDER_KEYS + i.ORDER_VALUES)})),
    {i.upsert_sql("remaining", "changed", i.ORDER_KEYS, i.ORDER_VALUES, i.SECOND_RUN, "merged")}
    SELECT * FROM merged""",
)
def load_snapshot_with_deletes(spark, sf_dir):
    """As snapshot_load with a feed of deleted rows that has no time either."""
    spec = _order_spec(INSRT_TIME_COL="-", UPDT_TIME_COL="-", IS_DELETION="yes", DELETED_TBL="orders_deleted")
    return _two_loads(spark, sf_dir, "deleting_snapshot", spec).current(spec)


def _document_load_sql(*keys: str) -> str:
    on = " AND ".join(f"o.{k} = n.{k}" for k in keys)
    latest = _LATEST_BODY.replace("PARTITION BY _id", f"PARTITION BY {', '.join(keys)}")
    return f"""WITH {i.DOCUMENTS_SQL},
    old AS (SELECT * FROM documents_in WHERE ins < TIMESTAMP '{EVENTS_FROM}'),
    mark AS (SELECT date_trunc('milliseconds', greatest(max(ins), max(upd)) - INTERVAL 10 MINUTE) AS w FROM old),
    latest_old AS (SELECT * FROM old {latest}),
    latest_new AS (
      SELECT * FROM documents_in WHERE ins > (SELECT w FROM mark) OR upd > (SELECT w FROM mark) {latest}),
    pairs AS (
      SELECT coalesce(n.event_id, o.event_id) AS event_id,
             CASE WHEN o._id IS NULL THEN TIMESTAMP '{i.SECOND_RUN}' ELSE TIMESTAMP '{i.FIRST_RUN}' END AS edw_inserted_timestamp,
             CASE WHEN o.event_id <> n.event_id THEN TIMESTAMP '{i.SECOND_RUN}' END AS edw_updated_timestamp
      FROM latest_old o FULL JOIN latest_new n ON {on})
    SELECT {", ".join("d." + c for c in ("_id", "user_id", "kind", "value"))},
           strftime(d.ins, '%Y-%m-%d %H:%M:%S.%f') AS created, strftime(d.upd, '%Y-%m-%d %H:%M:%S.%f') AS updated,
           edw_inserted_timestamp, edw_updated_timestamp
    FROM pairs p JOIN documents_in d ON p.event_id = d.event_id"""


def _load_documents(spark, sf_dir, label: str, keys: str, written=i.documents):
    """A collection loaded whole, then by what changed since the mark."""
    root = fresh_dir(spark, label)
    docs = written(spark, sf_dir)
    docs.filter(F.col("ins") < ntz(EVENTS_FROM)).select("body").write.text(f"{root}/before/members")
    docs.select("body").write.text(f"{root}/after/members")
    spec = _order_spec(
        SRC_DB_NAME="mongodb",
        OBJ_TYPE="collection",
        OBJ_NAME="members",
        PRIMARY_KEY_COL=keys,
        INSRT_TIME_COL="createdAt",
        UPDT_TIME_COL="updatedAt",
        SF_TBL="tbl_members",
    )
    before, after = (DocumentOrigin(f"{root}/{place}") for place in ("before", "after"))
    _checked(full_load(Lake(spark, root, {"mongodb": before}, clock=_at(i.FIRST_RUN)), [spec]))
    lake = Lake(spark, root, {"mongodb": after}, clock=_at(i.SECOND_RUN))
    _checked(incremental_load(lake, [spec]))
    doc = col("json_data")
    return lake.current(spec).select(
        document_text(doc, "_id").alias("_id"),
        *[F.try_variant_get(doc, f"$.{n}", t).alias(n) for n, t in _DOC_FIELDS.items() if n != "_id"],
        timestamp_text(document_timestamp(doc, "createdAt")).alias("created"),
        timestamp_text(document_timestamp(doc, "updatedAt")).alias("updated"),
        *AUDIT_COLUMNS,
    )


@query("document_load", _document_load_sql("_id"))
def load_documents(spark, sf_dir):
    return _load_documents(spark, sf_dir, "documents", "_id")


@query("document_load_composite", _document_load_sql("_id", "kind"))
def load_documents_by_two_keys(spark, sf_dir):
    """Two fields make the key: every document of a pair counts by itself."""
    return _load_documents(spark, sf_dir, "composite", "_id, kind")


@query("document_load_exported", _document_load_sql("_id"))
def load_exported_documents(spark, sf_dir):
    """Object ids and dates as a database's export writes them."""
    return _load_documents(spark, sf_dir, "exported", "_id", i.exported_documents)
