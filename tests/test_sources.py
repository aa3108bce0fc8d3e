import os
from datetime import datetime
from functools import reduce

import pytest
from pyspark.sql import functions as F

from tidemark.functions.documents import document_text, document_timestamp, with_document_times
from tidemark.functions.types import MAPPING_SCHEMA
from tidemark.operators.dedup import typed_documents
from tidemark.operators.filters import any_later, documents_changed_since
from tidemark.shared import fresh_dir, shared_dir
from tidemark.sources.control import load_specs, read_control
from tidemark.sources.documents import read_changed_documents, read_documents
from tidemark.sources.files import file_manifest, names_object, read_object, read_tabular, relative_key, select_object
from tidemark.sources.jdbc import JdbcSource
from tidemark.sources.origins import ConnectorOrigin, JdbcOrigin
from tidemark.sources.staging import current_batch, read_matching, read_staged, run_path, stage_batch, write_document_chunks
from tidemark.spec import CONTROL_COLUMNS, LoadSpec


# --- shared folder --------------------------------------------------------------


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert fresh_dir(spark, "x") != fresh_dir(spark, "x")
    assert fresh_dir(spark, "x").startswith(shared_dir(spark) + "/x-")


# --- control files ----------------------------------------------------------------


def test_control_file(spark, tmp_path):
    path = tmp_path / "control.csv"
    path.write_text(
        ",".join(CONTROL_COLUMNS)
        + '\n3,sqlserver,shop,dbo,table,Orders,added,changed,"id, line","id,line,v",yes,orders_deleted,tbl_orders'
        + "\n1,-,-,-,FILE,stock,at,at,_id,-,-,-,tbl_stock"
        + "\n2,mongodb,crm,-,collection,members,createdAt,updatedAt,_id,*,no,-,tbl_members\n"
    )
    stock, members, orders = load_specs(read_control(spark, str(path)))
    assert orders.keys == ("id", "line") and orders.columns == ("id", "line", "v")
    assert orders.deleted_object == "orders_deleted" and orders.identity == ("shop", "dbo", "Orders")
    assert stock.is_file and stock.columns is None and stock.identity == ("-", "-", "stock")
    assert members.is_documents and members.columns is None and members.deleted_object is None


# --- JDBC ------------------------------------------------------------------------


def test_jdbc_options(monkeypatch):
    monkeypatch.setenv("SHOP_SECRET", "s3")
    source = JdbcSource("sqlserver", "jdbc:sqlserver://db:1433;databaseName={database}", "reader", "SHOP_SECRET", 32)
    query = source.select_text("dbo", "Order]s", "id, total")
    assert query == "SELECT [id], [total] FROM [dbo].[Order]]s]"
    options = source.read_options(query, "shop")
    assert options["dbtable"] == f"({query}) src" and options["url"].endswith("databaseName=shop")
    assert options["password"] == "s3" and options["driver"].endswith("SQLServerDriver")
    assert options["preferTimestampNTZ"] == "true"


def test_jdbc_without_a_secret():
    source = JdbcSource("postgresql", "jdbc:postgresql://db/shop", "reader", "NOT_SET")
    assert source.select_text("public", "orders", None) == 'SELECT * FROM "public"."orders"'
    assert source.read_options("SELECT 1")["password"] == ""


def test_jdbc_ranges_are_over_times_and_keys_of_the_object(spark):
    source = JdbcSource("postgresql", "jdbc:postgresql://db/x", "reader", "NOT_SET", 8)
    schema = spark.createDataFrame([], "Id string, n decimal(9,0), At timestamp_ntz, d date, f double, b binary").schema

    def names(keys, times):
        return [f.name for f in source.range_columns(schema, keys, times)]

    assert names(("n", "id"), ("at", "d")) == ["At", "n", "Id"]
    assert names(("n", "at"), ("At",)) == ["At", "n"]
    assert names(("f", "b"), ()) == [] and names(("missing", "ID"), ("b",)) == ["Id"]


class Database(JdbcSource):
    """Answers queries from views of the session, and keeps how each read was split."""

    def _load(self, spark, options, predicates=None):
        text = options["dbtable"].replace('"', "`").replace("[", "`").replace("]", "`").replace("DATETIME2", "TIMESTAMP_NTZ")
        text = text.replace("N'", "'").replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)")
        table = spark.sql(f"SELECT * FROM {text}")
        if predicates is None:
            return table
        conditions = [
            p.replace('"', "`").replace("[", "`").replace("]", "`").replace("N'", "'")
            .replace("DATETIME2", "TIMESTAMP_NTZ").replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)")
            for p in predicates
        ]
        parts = [table.where(condition) for condition in conditions]
        splits.append([part.count() for part in parts])
        return reduce(lambda a, b: a.unionByName(b), parts)


splits = []


@pytest.mark.parametrize("kind", ["postgresql", "sqlserver"])
@pytest.mark.parametrize("keys, times", [(("k",), ()), (("at",), ()), (("name", "k"), ()), (("k", "name"), ("at",)), (("hot", "k"), ())])
def test_jdbc_ranges_hold_as_many_rows_each(spark, kind, keys, times):
    """Keys and times that bunch up, one value that half of the rows have, and nulls."""
    spark.range(4000).selectExpr(
        "CASE WHEN id % 50 = 7 THEN NULL ELSE id * id * id END AS k",
        "concat('it''s ', cast(id % 400 AS string)) AS name",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(floor(pow(2, id / 200.0)) AS decimal(18, 6))) AS at",
        "CASE WHEN id % 2 = 0 THEN 5 ELSE id END AS hot",
    ).createOrReplaceTempView("objects")
    source = Database(kind, "jdbc:x", "reader", "NOT_SET", 16)
    source_read = lambda since=None: source.read(spark, "d", "s", "t", None, keys, times, since)
    object.__setattr__(source, "select_text", lambda *a: "SELECT * FROM objects")
    splits.clear()
    everything = sorted(map(tuple, spark.table("objects").collect()), key=repr)
    assert sorted(map(tuple, source_read().collect()), key=repr) == everything
    *ranges, nulls = splits[0]
    assert nulls == (80 if "k" in keys else 0) and len(ranges) == 16
    assert max(ranges) <= 2 * min(ranges)


def test_jdbc_ranges_cover_the_rows_after_the_mark(spark):
    spark.range(1000).selectExpr(
        "id AS k", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id AS int), 0) AS at"
    ).createOrReplaceTempView("objects")
    source = Database("postgresql", "jdbc:x", "reader", "NOT_SET", 4)
    object.__setattr__(source, "select_text", lambda *a: "SELECT * FROM objects")
    splits.clear()
    found = source.read(spark, "d", "s", "t", None, ("k",), ("at",), "2024-01-01 15:00:00")
    assert found.count() == 1000
    # the 99 rows after the mark are dealt out evenly; all before it lie in the first range
    assert [abs(size - 25) <= 1 for size in splits[0][1:4]] == [True] * 3 and splits[0][4] == 0
    assert '"at" > \'2024-01-01 15:00:00\'' in source.cuts_query("q", found.schema.fields, ("at",), "2024-01-01 15:00:00")
    empty = source.read(spark, "d", "s", "t", None, ("k",), ("at",), "2030-01-01 00:00:00")
    assert empty.count() == 1000


@pytest.mark.parametrize(
    "keys, times",
    [(("k",), ()), (("hot", "k"), ()), (("k",), ("at",)), (("k",), ("load",)), (("day", "price", "k"), ()), (("name", "k"), ()), (("k",), ("zoned",))],
)
def test_cuts_by_steps_are_those_of_a_window_over_all_rows(spark, keys, times):
    """Bunched values, a time that all rows share, repeated rows and nulls."""
    spark.range(1500).selectExpr(
        "CASE WHEN id % 50 = 7 THEN NULL ELSE (id DIV 2) * (id DIV 2) * 1234567891 - 5000000000 END AS k",
        "CASE WHEN id % 2 = 0 THEN 5 ELSE id END AS hot",
        "concat('it''s ', cast(id % 40 AS string)) AS name",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(floor(pow(2, id / 75.0)) AS decimal(18, 6))) AS at",
        "timestamp'2024-11-03 04:00:00' + make_dt_interval(0, 0, id DIV 3, 0) AS zoned",
        "timestamp_ntz'2024-01-01 10:20:30.123456' AS load",
        "date'2024-01-01' + cast(id % 3 AS int) AS day",
        "cast(id % 7 / 4 AS decimal(9, 2)) AS price",
    ).createOrReplaceTempView("objects")
    query = "SELECT * FROM objects"
    for cell_rows, since in ((20, None), (200, "2024-01-01 10:00:00")):
        source = Database("hive2", "jdbc:x", "reader", "NOT_SET", 16, cell_rows=cell_rows)
        columns = source.range_columns(spark.table("objects").schema, keys, times)
        given = (query, columns, times, since if times else None)
        tiles = spark.sql(source.cuts_query(*given)).collect()
        expected = [tuple(row)[:-1] for row in sorted(tiles, key=lambda row: row["tile"])]
        assert len(expected) == 15 and source.cuts(spark, "d", *given) == expected


def test_no_window_over_all_rows_where_it_would_run_in_one_task(spark):
    """On Hive and Spark every window has partitions, and no part with more rows than allowed is put in order."""
    asked = []

    class Asked(Database):
        def _load(self, spark, options, predicates=None):
            asked.append(options["dbtable"])
            return super()._load(spark, options, predicates)

    spark.range(5000).selectExpr(
        "id AS k", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id DIV 100 AS int)) AS at"
    ).createOrReplaceTempView("objects")
    source = Asked("hive2", "jdbc:x", "reader", "NOT_SET", 8, cell_rows=100)
    object.__setattr__(source, "select_text", lambda *a: "SELECT * FROM objects")
    splits.clear()
    assert source.read(spark, "d", "s", "t", None, ("k",), ("at",)).count() == 5000
    assert splits[0] == [625] * 8 + [0]
    windows = [text for text in asked if "OVER (" in text]
    assert windows and all("OVER (PARTITION BY cell" in text for text in windows)
    ordered = windows[-1]
    parts = ordered[ordered.index("FROM (SELECT k0, k1, CASE") + 6 : ordered.rindex(") parts")]
    assert max(r["count"] for r in spark.sql(parts).groupBy("cell").count().collect()) <= 100


class Reads(JdbcSource):
    """Keeps the options of each read; rows come from the session."""

    def _load(self, spark, options, predicates=None):
        seen.append({**options, "predicates": predicates})
        if "NTILE(" in options["dbtable"]:
            return spark.sql("SELECT TIMESTAMP_NTZ'2024-01-09 00:00:00' AS k0, 3 AS k1, 2 AS tile")
        if "information_schema" in options["dbtable"]:
            return spark.sql(
                "SELECT 't' AS object, 'ID' AS column_name, 'INT4' AS data_type, 1L AS ordinal_position, 32 AS numeric_precision, 0 AS numeric_scale "
                "UNION ALL SELECT 't', 'price', 'numeric', 2L, 12, 2 UNION ALL SELECT 't', 'doc', 'jsonb', 3L, null, null"
            )
        return spark.sql("SELECT 1 AS id, 1.5BD AS price, TIMESTAMP_NTZ'2024-01-02 00:00:00' AS at")


seen = []


def test_jdbc_reads_follow_the_control_row(spark):
    seen.clear()
    mapping = spark.createDataFrame(
        [("POSTGRESQL", "int4", "number", 0), ("POSTGRESQL", "numeric", "decimal", 1)], MAPPING_SCHEMA
    )
    origin = JdbcOrigin(Reads("postgresql", "jdbc:postgresql://db/{database}", "r", "NOT_SET", 4), mapping, "varchar")
    row = dict.fromkeys(CONTROL_COLUMNS, "-") | {
        "CONTROL_ID": 1, "DATABASE_NAME": "crm", "SCHEMA_NAME": "s", "OBJ_NAME": "t", "PRIMARY_KEY_COL": "id",
        "INSRT_TIME_COL": "at", "COL_NAMES": "id, Price, doc",
    }
    spec = LoadSpec.from_control(row)
    assert origin.open(spark, spec, "t", "2024-01-05 00:00:00").count() == 1
    assert {o["url"] for o in seen} == {"jdbc:postgresql://db/crm"}
    assert "\"at\" > '2024-01-05 00:00:00'" in seen[1]["dbtable"]
    cut = """("at" > CAST('2024-01-09 00:00:00' AS TIMESTAMP) OR ("at" = CAST('2024-01-09 00:00:00' AS TIMESTAMP) AND "id" >= 3))"""
    whole = '"at" IS NOT NULL AND "id" IS NOT NULL AND '
    assert seen[2]["predicates"] == [f"{whole}NOT ({cut})", f"{whole}{cut}", '"at" IS NULL OR "id" IS NULL']
    assert origin.declared(spark, spec) == {"id": "bigint", "Price": "decimal(12,2)", "doc": "string"}
    with pytest.raises(Exception, match="no mapping for type jsonb"):
        JdbcOrigin(origin.source, mapping).declared(spark, spec)
    assert JdbcOrigin(origin.source).declared(spark, spec) is None


# --- files -------------------------------------------------------------------------


@pytest.mark.parametrize(
    "key, matches",
    [("Stock.csv", False), ("stock", True), ("in/Stock_2024.csv", True), ("in/my_STOCK.csv", True), ("in/livestock.csv", False)],
)
def test_object_names(spark, key, matches):
    assert spark.range(1).select(names_object(F.lit(key), "Stock")).first()[0] is matches


@pytest.mark.parametrize(
    "path, root, key",
    [
        ("file:/data/in/a/b.csv", "/data/in", "a/b.csv"),
        ("file:/data/in/a/part-00000-x.csv", "file:///data/in/", "a"),
        ("s3a://bucket/in/b.csv", "s3a://bucket/in", "b.csv"),
        ("hdfs://nn:8020/in/b.csv", "hdfs://nn:8020/in", "b.csv"),
        ("hdfs://nn:8020/in/b.csv", "/in", "b.csv"),
        ("file:/data/x/data/b.csv", "/data", "x/data/b.csv"),
        ("file:///data/x/data/b.csv", "/data/", "x/data/b.csv"),
        ("s3a://data/x/data/b.csv", "s3a://data", "x/data/b.csv"),
        ("file:/other/b.csv", "/data", "other/b.csv"),
    ],
)
def test_relative_keys(spark, path, root, key):
    assert spark.range(1).select(relative_key(F.lit(path), root)).first()[0] == key


def test_newest_matching_file_wins(spark, tmp_path):
    for name, age in (("a_stock.csv", 100), ("b_stock.csv", 50), ("other.csv", 0), ("c_stock.txt", 0)):
        (tmp_path / name).write_text("id,at\n1,2024-03-10 02:30:00.5\n")
        os.utime(tmp_path / name, (1_700_000_000 - age,) * 2)
    manifest = file_manifest(spark, str(tmp_path), ".csv")
    assert manifest.count() == 3
    assert select_object(manifest, str(tmp_path), "stock").first()["file_key"] == "b_stock.csv"
    got = read_object(spark, str(tmp_path), "STOCK", "csv")
    assert dict(got.dtypes) == {"id": "int", "at": "timestamp_ntz"}
    assert got.select(F.col("at").cast("string")).first()[0] == "2024-03-10 02:30:00.5"
    with pytest.raises(FileNotFoundError):
        read_object(spark, str(tmp_path), "nothing", "csv")


def test_manifest_does_not_open_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x")
    plan = file_manifest(spark, str(tmp_path), ".csv")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


# --- documents ------------------------------------------------------------------------


def test_json_array_gives_one_row_per_element(spark, tmp_path):
    (tmp_path / "c.json").write_text('[{"_id": 1, "n": {"a": [1]}},\n {"_id": 2}]')
    docs = read_documents(spark, str(tmp_path), json_array=True)
    assert sorted(r[0] for r in docs.select(F.to_json("doc")).collect()) == ['{"_id":1,"n":{"a":[1]}}', '{"_id":2}']


def test_changed_documents(spark, tmp_path):
    (tmp_path / "c.json").write_text(
        '{"_id":1,"c":"2024-01-01 00:00:00","u":"2024-01-03 00:00:00.5"}\n'
        '{"_id":2,"c":"2024-01-01 00:00:00"}\n'
        '{"_id":3,"c":"2024-01-02 00:00:00","u":"NaT"}\n'
    )
    got = read_changed_documents(spark, str(tmp_path), "2024-01-01 12:00:00", "c", "u")
    assert sorted(r[0] for r in got.select(F.variant_get("doc", "$._id", "int")).collect()) == [1, 3]


def test_documents_as_exports_write_them(spark, tmp_path):
    (tmp_path / "c.json").write_text(
        '{"_id":{"$oid":"64a0"},"c":{"$date":"2024-01-01T10:00:00Z"},"u":{"$date":{"$numberLong":"1704196800000"}}}\n'
        '{"_id":"64a1","c":"2024-01-01T12:00:00+02:00","u":{"$date":1704196800500}}\n'
        '{"_id":7,"c":"2024-01-01T10:00:00.25"}\n'
    )
    docs = read_documents(spark, str(tmp_path))
    got = docs.select(*[document_text(F.col("doc"), "_id")], *[document_timestamp(F.col("doc"), f) for f in "cu"])
    ten = datetime(2024, 1, 1, 10)
    assert sorted(map(tuple, got.collect())) == [
        ("64a0", ten, datetime(2024, 1, 2, 12)),
        ("64a1", ten, datetime(2024, 1, 2, 12, 0, 0, 500_000)),
        ("7", ten.replace(microsecond=250_000), None),
    ]
    for times in (("c", None), (None, "c"), ("c", "c")):
        assert read_changed_documents(spark, str(tmp_path), "2024-01-01 10:00:00", *times).count() == 1
    assert read_changed_documents(spark, str(tmp_path), "2024-01-01 10:00:00", None, None).count() == 3


def test_connector_rows_become_documents(spark, tmp_path):
    spark.createDataFrame([("a", 1, [1, 2])], "_id string, n int, l array<int>").write.parquet(str(tmp_path / "c"))
    spec = LoadSpec.from_control(dict.fromkeys(CONTROL_COLUMNS, "-") | {"CONTROL_ID": 1, "PRIMARY_KEY_COL": "_id"})
    docs = ConnectorOrigin("parquet", {}, "path").open(spark, spec, str(tmp_path / "c"))
    assert [r[0] for r in docs.select(F.to_json("doc")).collect()] == ['{"_id":"a","l":[1,2],"n":1}']


def test_document_chunks(spark, tmp_path):
    path = str(tmp_path / "chunks")
    write_document_chunks(spark.range(25).coalesce(1), path, 10)
    back = read_tabular(spark, path, "json", "id long")
    sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert sorted(sizes) == [5, 10, 10]


# --- staging -----------------------------------------------------------------------------


def test_staged_runs(spark, tmp_path):
    stage = str(tmp_path / "stage")
    for run, data in ((1, [(1,)]), (2, [(2,), (3,)])):
        stage_batch(spark.createDataFrame(data, "id int"), stage, run)
    stage_batch(spark.createDataFrame([(9,)], "id int"), stage, 2)  # a run may be staged again
    staged = read_staged(spark, stage)
    assert staged.count() == 2
    assert [r.id for r in current_batch(staged).collect()] == [9]
    assert [r.id for r in current_batch(staged, 1).collect()] == [1]
    assert run_path(stage, 1).endswith("run_id=1")


def test_files_whose_path_does_not_match_are_not_opened(spark, tmp_path):
    root = str(tmp_path / "stages")
    stage_batch(spark.createDataFrame([(1,), (2,)], "id int"), f"{root}/tbl_a", 1)
    (tmp_path / "stages" / "tbl_b").mkdir()
    (tmp_path / "stages" / "tbl_b" / "part-0.parquet").write_text("not Parquet at all")
    assert sorted(r.id for r in read_matching(spark, root, ".*tbl_a.*", "id int").collect()) == [1, 2]
    with pytest.raises(Exception):
        read_matching(spark, root, ".*", "id int").collect()


def test_spec_without_times():
    row = dict.fromkeys(CONTROL_COLUMNS, "-")
    spec = LoadSpec.from_control({**row, "CONTROL_ID": 1, "PRIMARY_KEY_COL": "id", "DATABASE_NAME": None})
    assert spec.identity == ("-", "-", "-") and spec.times == ()
    assert not spec.has_modified_time and spec.deleted_object is None


_TIMES = ("createdAt", "updatedAt")
_TIMED = [
    """{"_id": 1, "createdAt": {"$date": "2024-03-10T02:30:00.123456Z"}}""",
    """{"_id": 2, "createdAt": {"$date": {"$numberLong": "1710037800000"}}, "updatedAt": "2024-03-10 02:30:00.5"}""",
    """{"_id": 3, "createdAt": "2024-03-09T21:30:00-05:00", "updatedAt": {"$date": "2024-03-11T00:00Z"}}""",
    """{"_id": 4, "createdAt": "2024-03-10T02:29:59.999999999Z", "updatedAt": "NaT"}""",
    """{"_id": 5, "createdAt": "2024-03-10T02:30:00"}""",
    """{"_id": 6}""",
]


def test_times_of_documents_with_and_without_an_offset(spark):
    docs = spark.createDataFrame([(t,) for t in _TIMED], "t string").select(F.parse_json("t").alias("doc"))
    read = with_document_times(docs, "doc", {"c": "createdAt", "u": "updatedAt"})
    day = lambda *rest: datetime(2024, 3, 10, 2, *rest)
    found = read.select(F.variant_get("doc", "$._id", "int"), "c", "u").collect()
    assert sorted(map(tuple, found)) == [
        (1, day(30, 0, 123456), None),
        (2, day(30), day(30, 0, 500000)),
        (3, day(30), datetime(2024, 3, 11)),
        (4, day(29, 59, 999999), None),
        (5, day(30), None),
        (6, None, None),
    ]


@pytest.mark.parametrize("step", ["scan", "typed"])
def test_a_filter_by_time_reads_each_field_of_a_document_once(spark, tmp_path, step):
    """A filter merged into the projection of the times would read them again at each mention."""
    (tmp_path / "c.json").write_text("\n".join(_TIMED))
    docs, mark = read_documents(spark, str(tmp_path)), "2024-03-10 02:30:00"
    if step == "scan":
        later = documents_changed_since(docs, mark, "doc", *_TIMES)
    else:
        typed, times = typed_documents(docs, "doc", {"_id": "doc_key"}, *_TIMES)
        later = any_later(typed, mark, times)
    assert sorted(r[0] for r in later.select(F.variant_get("doc", "$._id", "int")).collect()) == [1, 2, 3]
    plan = later._jdf.queryExecution().optimizedPlan().toString()
    for field in _TIMES:
        assert plan.count(f"$['{field}']") == 1, plan
