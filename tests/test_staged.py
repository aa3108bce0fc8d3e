"""What is found while rows are staged, and what stages can be asked for without reading them."""

import json
import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.timestamps import native_time, time_text
from tidemark.operators.catalog import document_catalog, drift_counts, schema_drift
from tidemark.operators.projection import NATIVE_TIME, REASONS, rejecting_projection, typed_projection
from tidemark.sources.documents import read_documents, stage_documents, staged_documents_since
from tidemark.sources.files import archived_until, file_manifest, read_since
from tidemark.sources.footers import AT, KEYLESS, MEASURES, footer_aggregate, measured, with_measures
from tidemark.sources.inference import infer_types, read_text, stage_inferred
from tidemark.sources.staging import stage_parted, write_full_chunks


def plan_of(df):
    return df._jdf.queryExecution().toString()


# --- footers ------------------------------------------------------------------------

DAY = datetime(2024, 3, 1, 12, 30, 0, 123456)
TIMED = "k int, v string, ins timestamp_ntz, upd timestamp_ntz"


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([(1, "a", DAY, None), (2, "b", DAY, DAY + timedelta(hours=1))], (DAY + timedelta(hours=1), 2, False)),
        ([(None, "a", DAY, None), (2, "b", None, None)], (DAY, 2, True)),
        ([(1, "a", None, None)], (None, 1, False)),
        ([(1, None, datetime(1600, 1, 1), None)], (datetime(1600, 1, 1), 1, False)),
        ([], (None, 0, False)),
    ],
)
def test_measures_come_from_footers(spark, tmp_path, rows, expected):
    path = str(tmp_path / "stage")
    with_measures(spark.createDataFrame(rows, TIMED).repartition(3), ["ins", "upd"], ["k"]).write.parquet(path)
    assert measured(spark, path) == expected
    found = footer_aggregate(spark, path, MEASURES, F.max(AT), F.count(F.lit(1)), F.max(KEYLESS))
    assert f"PushedAggregation: [MAX({AT}), COUNT(*), MAX({KEYLESS})]" in plan_of(found)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_measures_without_times_or_keys(spark, tmp_path):
    path = str(tmp_path / "stage")
    with_measures(spark.createDataFrame([(1,), (None,)], "k int"), [], []).write.parquet(path)
    assert measured(spark, path) == (None, 2, False)


# --- inference ----------------------------------------------------------------------

TEXTS = {
    "i": (["1", " -7 ", None, "+3"], "int"),
    "b": (["1", "99999999999", None, "3"], "bigint"),
    "d": (["1", "2.5", "-1e3", ".5"], "double"),
    "z": (["2024-01-01", "2024-2-3", None, None], "date"),
    "t": (["2024-01-01 10:00:00", "2024-01-02T10:00:00.25", "2024-01-02 10:00", None], "timestamp_ntz"),
    "mixed": (["2024-01-01", "2024-01-01 10:00:00", None, None], "string"),
    "o": (["true", "FALSE", None, None], "boolean"),
    "s": (["1", "x", None, "3"], "string"),
    "none": ([None, None, None, None], "string"),
    "bad": (["2024-13-01", "2024-01-01", None, None], "string"),
    "0.5": (["1.", "x", "", None], "string"),
}


def test_types_are_found_as_text_is_staged(spark, tmp_path):
    rows = list(zip(*(values for values, _ in TEXTS.values()), strict=True))
    schema = ", ".join(f"`{name}` string" for name in TEXTS)
    text = spark.createDataFrame(rows, schema).repartition(2).withColumn("kept", F.lit(5))
    staged, types = stage_inferred(text, str(tmp_path / "stage"))
    assert types == {name: dtype for name, (_, dtype) in TEXTS.items()} == infer_types(text)
    assert dict(staged.dtypes) == {**types, "kept": "int"}
    got = staged.orderBy(F.col("i").desc_nulls_last()).collect()
    assert [r.i for r in got] == [3, 1, -7, None]
    assert {r.t for r in got} == {datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 10, 0, 0, 250000), datetime(2024, 1, 2, 10), None}


def test_an_empty_file_is_text(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a,b\n")
    staged, types = stage_inferred(read_text(spark, str(tmp_path / "f.csv")), str(tmp_path / "stage"))
    assert types == {"a": "string", "b": "string"} and staged.count() == 0


def test_a_file_is_opened_once_for_its_rows(spark, tmp_path):
    """Types come with the pass that stages: only one job reads more than the header."""
    (tmp_path / "f.csv").write_text("a,b\n" + "1,x\n" * 1000)
    text = read_text(spark, str(tmp_path / "f.csv"))
    tracker, group = spark.sparkContext.statusTracker(), "inference"
    spark.sparkContext.setJobGroup(group, "staging")
    try:
        _, types = stage_inferred(text, str(tmp_path / "stage"))
        jobs = tracker.getJobIdsForGroup(group)
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert types == {"a": "int", "b": "string"} and len(jobs) == 1


# --- chunks -------------------------------------------------------------------------


@pytest.mark.parametrize("rows, per_file, parts", [(1000, 64, 7), (128, 64, 3), (10, 64, 4), (0, 5, 2), (300, 1, 5)])
def test_every_file_but_one_is_full(spark, tmp_path, rows, per_file, parts):
    df = spark.range(rows, numPartitions=parts).withColumn("text", F.concat(F.lit("é"), "id"))
    path = tmp_path / "chunks"
    write_full_chunks(df, str(path), per_file, str(tmp_path / "numbered"))
    sizes = sorted(len(p.read_text().splitlines()) for p in path.glob("*.json"))
    sizes = [size for size in sizes if size]
    whole, rest = divmod(rows, per_file)
    assert sizes == sorted([per_file] * whole + [rest] * (rest > 0))
    found = [json.loads(line) for p in path.glob("*.json") for line in p.read_text().splitlines()]
    assert sorted(r["id"] for r in found) == list(range(rows))
    assert all(set(r) == {"id", "text"} for r in found)


# --- rejected values ----------------------------------------------------------------


def test_rows_are_parted_by_values_that_do_not_fit(spark, tmp_path):
    rows = [("1", "2.50", '{"a":1}', "07:30", "x"), ("one", "y", "{", "25:99", "x"), (None, None, None, None, None), ("3", "1e9", "[]", "1:00", "x")]
    df = spark.createDataFrame(rows, "id string, `p.q` string, doc string, at string, note string")
    types = {"id": "int", "p.q": "decimal(5,2)", "doc": "json", "at": "time", "note": "string"}
    types["`p.q`".strip("`")] = "decimal(5,2)"
    good, bad = stage_parted(rejecting_projection(df, types), REASONS, str(tmp_path / "typed"), 3)
    assert good.columns == list(types) and bad.columns == [*types, REASONS]
    assert sorted((r.id is None, r.id, r.at) for r in good.collect()) == [(False, 1, "07:30:00.000000"), (True, None, None)]
    reasons = {r.note and r.at: [tuple(x) for x in r[REASONS]] for r in bad.collect()}
    assert reasons[None] == [("id", "one", "int"), ("p.q", "y", "decimal(5,2)"), ("doc", "{", "json"), ("at", "25:99", "time")]
    assert reasons["01:00:00.000000"] == [("p.q", "1e9", "decimal(5,2)")]
    folders = {name for name in os.listdir(tmp_path / "typed" / "run_id=3") if "=" in name}
    assert folders == {"tidemark_rejected=true", "tidemark_rejected=false"}


def test_no_row_to_part(spark, tmp_path):
    df = spark.createDataFrame([], "id string")
    good, bad = stage_parted(rejecting_projection(df, {"id": "int"}), REASONS, str(tmp_path / "typed"), 1)
    assert good.count() == bad.count() == 0 and good.columns == ["id"]


# --- files since a mark -------------------------------------------------------------


def test_only_files_since_the_mark_are_listed(spark, tmp_path):
    now = time.time()
    for name, age in (("old", 100.0), ("same", 50.0), ("half", 49.5), ("new", 10.0)):
        (tmp_path / f"{name}.csv").write_text(f"name,n\n{name},1\n")
        os.utime(tmp_path / f"{name}.csv", (int(now) - age, int(now) - age))
    root, schema = str(tmp_path), "name string, n int"
    mark = archived_until(file_manifest(spark, root, ".csv").where("path like '%same%'"))
    fresh = read_since(spark, root, "csv", schema, mark)
    assert sorted(r.name for r in fresh.collect()) == ["half", "new"]
    listed = {os.path.basename(p) for p in fresh.inputFiles()}
    assert "old.csv" not in listed and {"half.csv", "new.csv"} <= listed
    assert read_since(spark, root, "csv", schema, None).count() == 4
    later = file_manifest(spark, root, ".csv", mark)
    assert sorted(os.path.basename(r.path) for r in later.collect()) == ["half.csv", "new.csv"]
    assert archived_until(later.where("false")) is None


# --- documents ----------------------------------------------------------------------


def test_the_scan_of_staged_documents_filters_by_time(spark, tmp_path):
    lines = [f'{{"_id":"{n}","createdAt":"2024-01-{n:02d} 00:00:00"}}' for n in range(1, 29)]
    lines += ['{"_id":"u","createdAt":"2024-01-01 00:00:00","updatedAt":"2024-01-28 06:00:00"}', '{"_id":"none"}']
    (tmp_path / "docs.json").write_text("\n".join(lines))
    staged = stage_documents(read_documents(spark, str(tmp_path / "docs.json")), str(tmp_path / "stage"), "createdAt", "updatedAt")
    fresh = staged_documents_since(staged, datetime(2024, 1, 27))
    assert fresh.columns == ["doc"]
    assert sorted(r[0] for r in fresh.select(F.variant_get("doc", "$._id", "string")).collect()) == ["28", "u"]
    micros = (datetime(2024, 1, 27) - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    assert f"GreaterThan({AT},{micros})" in plan_of(fresh)


def test_the_catalog_of_a_collection(spark):
    lines = ['{"b":1,"a":"x","o":{"x":1}}', '{"b":2.5,"o":{"y":"t"},"l":[1]}', '{"b":null,"l":["s"]}', "[1,2]", "7", '{}']
    docs = spark.createDataFrame([(line,) for line in lines], "s string").select(F.parse_json("s").alias("doc"))
    found = document_catalog(docs, "c").orderBy("ordinal_position").collect()
    assert [(r.object, r.column_name, r.ordinal_position, r.documents) for r in found] == [
        ("c", "a", 1, 1), ("c", "b", 2, 2), ("c", "l", 3, 2), ("c", "o", 4, 2),
    ]
    types = {r.column_name: r.data_type for r in found}
    assert types["a"] == "string" and types["b"].startswith("decimal") and types["l"] == "array<variant>"
    assert types["o"] == "object<x: bigint, y: string>"
    assert document_catalog(docs.where("false"), "c").count() == 0


def test_drift_between_two_exports_of_a_collection(spark):
    def catalog(*lines):
        docs = spark.createDataFrame([(line,) for line in lines], "s string").select(F.parse_json("s").alias("doc"))
        return document_catalog(docs, "c")

    before, after = catalog('{"a":1,"B":"x"}'), catalog('{"b":"x","c":true}', '{"c":false}')
    drift = {(r.column_name, r.change, r.source_type) for r in schema_drift(after, before).collect()}
    assert drift == {("a", "missing", None), ("c", "added", "boolean")}
    (counts,) = drift_counts(after, before).collect()
    assert (counts.source_columns, counts.target_columns, counts.added, counts.missing) == (2, 2, 1, 1)


# --- times of day -------------------------------------------------------------------


def test_times_keep_their_type_through_parquet(spark, tmp_path):
    rows = [("07:30",), ("23:59:59.000001",), ("2024-01-01 10:00:00.5",), (None,)]
    df, path = spark.createDataFrame(rows, "at string"), str(tmp_path / "t")
    with native_time(spark):
        typed_projection(df, {"at": NATIVE_TIME}).write.parquet(path)
        stored = spark.read.parquet(path)
        assert stored.dtypes == [("at", "time(6)")]
        got = [r[0] for r in stored.select(time_text(F.col("at"))).collect()]
        assert stored.agg(F.max("at")).first()[0].hour == 23
        lenient = typed_projection(spark.createDataFrame([("x",), ("1:00",)], "at string"), {"at": NATIVE_TIME}, lenient=True)
        assert sorted((r.at.hour if r.at else -1) for r in lenient.collect()) == [-1, 1]
    assert sorted(got, key=str) == ["07:30:00.000000", "10:00:00.500000", "23:59:59.000001", None]
    text = typed_projection(df, {"at": "time"})
    assert text.dtypes == [("at", "string")] and sorted((r.at for r in text.collect()), key=str) == sorted(got, key=str)
