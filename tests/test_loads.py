from dataclasses import replace
from datetime import datetime, timedelta
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from tidemark.functions.documents import document_text
from tidemark.names import FAILED, SUCCESS, col
from tidemark.operators import deletes, upsert
from tidemark.operators.upsert import total_bytes
from tidemark.plans.ledger_store import LedgerStore, local_clock
from tidemark.plans.loads import Lake, full_load, incremental_load
from tidemark.plans.retention import retire
from tidemark.sources.origins import DocumentOrigin, FileOrigin, TableOrigin
from tidemark.spec import LoadSpec

SCHEMA = "id int, v string, ins timestamp_ntz, upd timestamp_ntz"
START = datetime(2024, 5, 1)


def day(n):
    return datetime(2024, 1, 1) + timedelta(days=n)


def spec_of(**changes):
    row = {
        "CONTROL_ID": 1, "SRC_DB_NAME": "shop", "DATABASE_NAME": "d", "SCHEMA_NAME": "s", "OBJ_TYPE": "table",
        "OBJ_NAME": "t", "INSRT_TIME_COL": "ins", "UPDT_TIME_COL": "upd", "PRIMARY_KEY_COL": "id", "COL_NAMES": "*",
        "IS_DELETION": "no", "DELETED_TBL": "-", "SF_TBL": "tbl_t",
    }
    return LoadSpec.from_control({**row, **changes})


class Clock:
    """A new minute on every call."""

    def __init__(self):
        self.now = START

    def __call__(self):
        self.now += timedelta(minutes=1)
        return self.now


@pytest.fixture
def lake(spark, tmp_path):
    origins = {
        "shop": TableOrigin(str(tmp_path / "source")),
        "-": FileOrigin(str(tmp_path / "files")),
        "mongodb": DocumentOrigin(str(tmp_path / "docs")),
    }
    return Lake(spark, str(tmp_path / "lake"), origins, buckets=4, clock=Clock())


@pytest.fixture
def put(spark, tmp_path):
    def write(data, schema=SCHEMA, name="t"):
        spark.createDataFrame(data, schema).write.mode("overwrite").parquet(str(tmp_path / "source" / name))

    return write


def values(df, *names):
    return sorted(tuple(r) for r in df.select(*(names or ("id", "v"))).collect())


def ok(rows):
    assert [r["status"] for r in rows] == [SUCCESS], rows[0]["error_message"]
    return rows[0]


def counts(row):
    return row["rows_inserted"], row["rows_updated"], row["rows_deleted"]


def test_full_then_incremental(lake, put):
    spec = spec_of()
    put([(1, "a", day(1), None), (1, "a2", day(1), day(2)), (2, "b", day(1), None), (3, "c", day(1), None)])
    first = ok(full_load(lake, [spec]))
    assert counts(first) == (3, 0, 0) and first["max_timestamp"] == day(2)
    assert values(lake.current(spec)) == [(1, "a2"), (2, "b"), (3, "c")]
    put([(1, "a2", day(1), day(2)), (2, "B", day(1), day(5)), (3, "c", day(1), None), (4, "d", day(4), None)])
    second = ok(incremental_load(lake, [spec]))
    assert counts(second) == (1, 1, 0) and second["max_timestamp"] == day(5)
    assert values(lake.current(spec)) == [(1, "a2"), (2, "B"), (3, "c"), (4, "d")]
    assert values(lake.audit(spec, second["run_id"]), "edw_action", "id") == [("insert", 4), ("update", 2)]
    stamps = {r.id: r for r in lake.current(spec).collect()}
    assert stamps[2].edw_updated_timestamp == second["run_start"] and stamps[2].edw_inserted_timestamp == first["run_start"]
    assert stamps[4].edw_inserted_timestamp == second["run_start"] and stamps[4].edw_updated_timestamp is None
    # nothing new: the overlap is read again and changes nothing
    third = ok(incremental_load(lake, [spec]))
    assert counts(third) == (0, 0, 0)
    assert values(lake.current(spec)) == [(1, "a2"), (2, "B"), (3, "c"), (4, "d")]
    assert third["max_timestamp"] == day(5)


@pytest.mark.parametrize("hash_bytes", [-1, 1 << 20])
def test_both_merge_plans_delete_and_take_null_keys(spark, tmp_path, put, hash_bytes):
    lake = Lake(spark, str(tmp_path / "lake"), {"shop": TableOrigin(str(tmp_path / "source"))}, 4, clock=Clock(), hash_bytes=hash_bytes)
    spec = spec_of(IS_DELETION="yes", DELETED_TBL="t_deleted")
    put([(n, "a", day(1), None) for n in range(20)])
    put([], "id int, ins timestamp_ntz", "t_deleted")
    ok(full_load(lake, [spec]))
    put([(3, "b", day(1), day(3)), (None, "x", day(3), None), (None, "y", day(3), None), (4, "c", day(3), None)])
    put([(4, day(3)), (5, day(3)), (None, day(3))], "id int, ins timestamp_ntz", "t_deleted")
    assert counts(ok(incremental_load(lake, [spec]))) == (3, 1, 2)
    got = lake.current(spec).select("id", "v").collect()
    assert sorted(r.v for r in got if r.id is None) == ["x", "y"]
    assert {r.id: r.v for r in got if r.id is not None} == {n: "b" if n == 3 else "c" if n == 4 else "a" for n in range(20) if n != 5}


@pytest.mark.parametrize("hash_bytes", [-1, 1 << 20])
def test_both_merge_plans_write_the_same(spark, tmp_path, put, hash_bytes):
    lake = Lake(spark, str(tmp_path / "lake"), {"shop": TableOrigin(str(tmp_path / "source"))}, 4, clock=Clock(), hash_bytes=hash_bytes)
    spec = spec_of()
    put([(n, "a", day(1), None) for n in range(50)])
    ok(full_load(lake, [spec]))
    put([(n, "b" if n % 3 else "a", day(1), day(3)) for n in range(40, 70)])
    row = ok(incremental_load(lake, [spec]))
    assert counts(row) == (20, 10, 0)
    got = dict(values(lake.current(spec)))
    assert len(got) == 70 and got[41] == "b" and got[42] == "a" and got[3] == "a"


def test_incremental_without_history_is_a_full_load(lake, put):
    spec = spec_of()
    put([(1, "a", day(1), None)])
    assert counts(ok(incremental_load(lake, [spec]))) == (1, 0, 0)


def test_empty_source(lake, put):
    spec = spec_of()
    put([])
    row = ok(full_load(lake, [spec]))
    assert counts(row) == (0, 0, 0) and row["max_timestamp"].year == 9999
    assert lake.current(spec).count() == 0
    put([(1, "a", day(1), None)])
    assert counts(ok(incremental_load(lake, [spec]))) == (1, 0, 0)
    assert values(lake.current(spec)) == [(1, "a")]


def test_mark_never_goes_back(lake, put):
    spec = spec_of()
    put([(1, "a", day(9), None)])
    ok(full_load(lake, [spec]))
    put([(1, "z", day(9) - timedelta(minutes=5), None), (2, "b", day(9) - timedelta(minutes=5), None)])
    row = ok(incremental_load(lake, [spec]))
    assert counts(row) == (1, 1, 0) and row["max_timestamp"] == day(9)


def test_one_failure_does_not_stop_the_rest(lake, put):
    put([(1, "a", day(1), None)])
    broken = spec_of(OBJ_NAME="missing", SF_TBL="tbl_missing")
    failed, done = full_load(lake, [broken, spec_of()])
    assert failed["status"] == FAILED and failed["error_message"].startswith("read source:")
    assert counts(failed) == (0, 0, 0) and failed["max_timestamp"].year == 9999
    assert done["status"] == SUCCESS and (failed["run_id"], done["run_id"]) == (1, 2)
    assert lake.current(broken) is None
    assert lake.ledger.rows().count() == 2


def test_death_before_the_ledger_row_leaves_the_old_version(lake, put, monkeypatch):
    spec = spec_of()
    put([(1, "a", day(1), None)])
    ok(full_load(lake, [spec]))
    put([(1, "b", day(1), day(2)), (2, "c", day(2), None)])

    def die(self, rows):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(LedgerStore, "append", die)
        with pytest.raises(KeyboardInterrupt):
            incremental_load(lake, [spec])
    assert values(lake.current(spec)) == [(1, "a")]
    assert counts(ok(incremental_load(lake, [spec]))) == (1, 1, 0)
    assert values(lake.current(spec)) == [(1, "b"), (2, "c")]


def test_new_column_reloads_everything(lake, put):
    spec = spec_of()
    put([(1, "a", day(1), None), (2, "b", day(1), None), (3, "gone", day(1), None)])
    ok(full_load(lake, [spec]))
    put([(1, "a", day(1), None, 10), (2, "b", day(1), None, 20)], SCHEMA + ", Extra int")
    assert counts(ok(incremental_load(lake, [spec]))) == (0, 2, 0)
    assert values(lake.current(spec), "id", "Extra") == [(1, 10), (2, 20), (3, None)]


def test_missing_column_is_dropped(lake, put):
    spec = spec_of()
    put([(1, "a", day(1), None)])
    ok(full_load(lake, [spec]))
    put([(1, day(1), None), (2, day(2), None)], "id int, ins timestamp_ntz, upd timestamp_ntz")
    assert counts(ok(incremental_load(lake, [spec]))) == (1, 0, 0)
    assert "v" not in lake.current(spec).columns
    assert lake.current(spec).count() == 2


def test_column_names_fold_case(lake, put):
    spec = spec_of()
    put([(1, "a", day(1), None)])
    ok(full_load(lake, [spec]))
    put([(1, "b", day(1), day(2)), (2, "c", day(2), None)], SCHEMA.replace("v string", "V string"))
    assert counts(ok(incremental_load(lake, [spec]))) == (1, 1, 0)
    assert values(lake.current(spec)) == [(1, "b"), (2, "c")]


def test_source_columns_may_be_called_version_or_run_id(lake, put):
    spec = spec_of(PRIMARY_KEY_COL="run_id")
    schema = "run_id int, version string, ins timestamp_ntz, upd timestamp_ntz"
    put([(5, "a", day(1), None)], schema)
    ok(full_load(lake, [spec]))
    put([(5, "b", day(1), day(2)), (6, "c", day(2), None)], schema)
    ok(incremental_load(lake, [spec]))
    assert values(lake.current(spec), "run_id", "version") == [(5, "b"), (6, "c")]


def test_local_clock():
    gap = local_clock("Asia/Kolkata")() - local_clock("UTC")()
    assert abs(gap - timedelta(hours=5, minutes=30)) < timedelta(seconds=5)


def test_deleted_feed_comes_before_the_upsert(lake, put):
    spec = spec_of(IS_DELETION="yes", DELETED_TBL="t_deleted")
    put([(n, "a", day(1), None) for n in range(6)])
    put([], "id int, ins timestamp_ntz", "t_deleted")
    ok(full_load(lake, [spec]))
    put([(1, "again", day(3), None), (6, "new", day(3), None)])
    put([(0, day(2)), (1, day(2)), (5, day(0)), (99, day(2))], "id int, ins timestamp_ntz", "t_deleted")
    row = ok(incremental_load(lake, [spec]))
    assert counts(row) == (2, 0, 2)
    assert values(lake.current(spec)) == [(1, "again"), (2, "a"), (3, "a"), (4, "a"), (5, "a"), (6, "new")]
    # deletes alone
    put([])
    put([(2, day(8))], "id int, ins timestamp_ntz", "t_deleted")
    assert counts(ok(incremental_load(lake, [spec]))) == (0, 0, 1)
    assert [r[0] for r in values(lake.current(spec))] == [1, 3, 4, 5, 6]


@pytest.mark.parametrize("hash_bytes", [-1, 1 << 20])
def test_deleted_row_that_is_sent_again_unchanged_comes_back(spark, tmp_path, put, hash_bytes):
    lake = Lake(
        spark, str(tmp_path / "lake"), {"shop": TableOrigin(str(tmp_path / "source"))}, 4,
        clock=Clock(), hash_bytes=hash_bytes,
    )
    spec = spec_of(IS_DELETION="yes", DELETED_TBL="t_deleted")
    put([(1, "a", day(1), None), (2, "b", day(1), None)])
    put([], "id int, ins timestamp_ntz", "t_deleted")
    ok(full_load(lake, [spec]))
    put([(1, day(1))], "id int, ins timestamp_ntz", "t_deleted")  # both rows are read again, within the overlap
    row = ok(incremental_load(lake, [spec]))
    assert counts(row) == (1, 0, 1)
    assert values(lake.current(spec)) == [(1, "a"), (2, "b")]


def test_null_keys_are_inserted_each_time_or_set_aside(spark, lake, put, tmp_path):
    spec = spec_of()
    put([(None, "n", day(1), None), (None, "n", day(1), None), (None, "m", day(1), None), (1, "a", day(1), None)])
    ok(full_load(lake, [spec]))
    assert counts(ok(full_load(lake, [spec]))) == (3, 0, 0)
    strict = Lake(spark, str(tmp_path / "strict"), lake.origins, 4, reject_null_keys=True, clock=Clock())
    ok(full_load(strict, [spec]))
    assert values(strict.current(spec)) == [(1, "a")]
    assert spark.read.parquet(strict.stage(spec, "rejects")).count() == 3


def test_column_list(lake, put):
    spec = spec_of(COL_NAMES="id, ins, upd")
    put([(1, "a", day(1), None)])
    ok(full_load(lake, [spec]))
    assert lake.current(spec).columns[:3] == ["id", "ins", "upd"]


def test_object_without_modified_time(lake, put):
    spec = spec_of(INSRT_TIME_COL="-", UPDT_TIME_COL="-")
    schema = "id int, v string"
    put([(1, "a"), (2, "b")], schema)
    assert counts(ok(full_load(lake, [spec]))) == (2, 0, 0)
    put([(1, "a"), (2, "B"), (3, "c")], schema)
    row = ok(incremental_load(lake, [spec]))
    assert counts(row) == (1, 1, 0)
    assert lake.spark.read.parquet(f"{lake.stage(spec)}/run_id={row['run_id']}").count() == 2
    assert values(lake.current(spec)) == [(1, "a"), (2, "B"), (3, "c")]
    assert counts(ok(incremental_load(lake, [spec]))) == (0, 0, 0)


def test_file_object(lake, tmp_path):
    spec = spec_of(SRC_DB_NAME="-", OBJ_TYPE="FILE", OBJ_NAME="stock", UPDT_TIME_COL="ins")
    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "in_Stock.csv").write_text("id,v,ins\n1,a,2024-01-01 00:00:00\n2,b,2024-01-02 00:00:00.25\n")
    assert counts(ok(full_load(lake, [spec]))) == (2, 0, 0)
    (folder / "in_Stock.csv").write_text("id,v,ins\n1,never read,2024-01-01 00:00:00\n3,c,2024-01-03 00:00:00\n")
    assert counts(ok(incremental_load(lake, [spec]))) == (1, 0, 0)
    assert values(lake.current(spec)) == [(1, "a"), (2, "b"), (3, "c")]


def test_documents(lake, tmp_path):
    spec = spec_of(
        SRC_DB_NAME="mongodb", OBJ_TYPE="collection", OBJ_NAME="members", PRIMARY_KEY_COL="_id",
        INSRT_TIME_COL="createdAt", UPDT_TIME_COL="updatedAt", SF_TBL="tbl_members",
    )
    folder = tmp_path / "docs" / "members"
    folder.mkdir(parents=True)
    old = '{"_id":"a","createdAt":"2024-01-01 00:00:00","n":{"x":1}}\n{"_id":"b","createdAt":"2024-01-01 00:00:00"}\n'
    (folder / "1.json").write_text(old)
    assert counts(ok(full_load(lake, [spec]))) == (2, 0, 0)
    (folder / "1.json").write_text(
        old.replace('"n":{"x":1}', '"updatedAt":"2024-01-05 00:00:00","n":{"x":2}')
        + '{"_id":"c","createdAt":"2024-01-04 00:00:00","tags":[1,2]}\n'
    )
    row = ok(incremental_load(lake, [spec]))
    assert counts(row) == (1, 1, 0) and row["max_timestamp"] == datetime(2024, 1, 5)
    got = {r[0]: r[1] for r in lake.current(spec).select(document_text(col("json_data"), "_id"), F.to_json("json_data")).collect()}
    assert set(got) == {"a", "b", "c"} and '"x":2' in got["a"] and got["c"] == '{"_id":"c","createdAt":"2024-01-04 00:00:00","tags":[1,2]}'
    assert counts(ok(incremental_load(lake, [spec]))) == (0, 0, 0)


def test_full_load_equals_incremental_from_nothing(spark, tmp_path, put):
    put([(n, str(n), day(n % 5), day(n % 7) if n % 2 else None) for n in range(40)])
    spec, results = spec_of(), []
    for name, load in (("full", full_load), ("incremental", incremental_load)):
        lake = Lake(spark, str(tmp_path / name), {"shop": TableOrigin(str(tmp_path / "source"))}, 4, clock=Clock())
        ok(load(lake, [spec]))
        results.append(values(lake.current(spec)))
    assert results[0] == results[1] and len(results[0]) == 40


def files_of(lake, spec, run_id):
    table = lake.table(spec)
    return lake.spark.read.parquet(f"{table.root}/run_id={run_id}/buckets={table.buckets}").inputFiles()


def test_first_load_writes_one_file_per_bucket(lake, put):
    """Rows leave the window grouped by bucket; where its partitions do not fit the buckets, they are dealt out once more."""
    put([(n, "a", day(1), None) for n in range(400)])
    for buckets in (4, 3):
        few = replace(lake, root=f"{lake.root}{buckets}", buckets=buckets)
        ok(full_load(few, [spec_of()]))
        assert len(files_of(few, spec_of(), 1)) == buckets


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hashed", [True, False])
def test_the_target_is_not_shuffled(spark, lake, put, hashed):
    """Neither for the upsert nor for deletes; the rows leave the join by bucket, so they are written without a shuffle too."""
    spec = spec_of()
    put([(n, "a", day(1), None) for n in range(400)])
    ok(full_load(lake, [spec]))
    table = lake.table(spec)
    target = table.keyed(table.version(1))
    batch = spark.createDataFrame([(5, "b", day(2), None), (500, "c", day(2), None)], SCHEMA)
    feed = spark.createDataFrame([(7,)], "id int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = upsert.merged_by_key(deletes.keyed_remaining(target, feed, ["id"]), batch, ["id"], "2024-05-02", hashed)
        plan = plan_of(merged)
        rows = merged.groupBy("_action").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    sides = plan.split("FileScan parquet")
    assert "Bucketed: true" in plan and plan.count("FileScan") == 1
    assert "Exchange" not in sides[0], plan
    assert ("ShuffledHashJoin" in plan) == hashed
    assert {r["_action"]: r["count"] for r in rows} == {"keep": 398, "update": 1, "insert": 1}


def test_an_upsert_writes_one_file_per_bucket(lake, put):
    spec = spec_of()
    put([(n, "a", day(1), None) for n in range(400)])
    ok(full_load(lake, [spec]))
    put([(n, "b", day(1), day(2)) for n in range(300, 500)])
    assert counts(ok(incremental_load(lake, [spec]))) == (100, 100, 0)
    assert len(files_of(lake, spec, 2)) == 4
    again = lake.spark.read.parquet(*files_of(lake, spec, 2))
    assert again.groupBy(F.pmod(F.hash("id"), F.lit(4)), F.input_file_name()).count().count() == 4


def test_another_session_reads_and_writes_the_target(lake, put):
    """Tables are declared by who needs them: nothing but the folders has to last."""
    spec = spec_of()
    put([(1, "a", day(1), None), (2, "b", day(1), None), (None, "n", day(1), None)])
    ok(full_load(lake, [spec]))
    lake.spark.sql(f"DROP TABLE {lake.table(spec).name(1)}")
    assert values(lake.current(spec).where("id is not null")) == [(1, "a"), (2, "b")] and lake.current(spec).count() == 3
    lake.spark.sql(f"DROP TABLE {lake.table(spec).name(1)}")
    put([(2, "B", day(1), day(3))])
    assert counts(ok(incremental_load(lake, [spec]))) == (0, 1, 0)
    assert sorted(r.v for r in lake.current(spec).collect()) == ["B", "a", "n"]


def test_keys_with_odd_names_and_quotes_in_the_path(spark, tmp_path):
    place = str(tmp_path / "it's")
    lake = Lake(spark, f"{place}/lake", {"shop": TableOrigin(f"{place}/source")}, 2, clock=Clock())
    spec = spec_of(PRIMARY_KEY_COL="the key")
    schema = "`the key` string, `v.w` string, ins timestamp_ntz, upd timestamp_ntz"
    for at, rows in enumerate([[("x", "a", day(1), None)], [("x", "b", day(1), day(2)), ("y", "c", day(2), None)]]):
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{place}/source/t")
        ok(incremental_load(lake, [spec]))
        spark.sql(f"DROP TABLE {lake.table(spec).name(at + 1)}")
    assert values(lake.current(spec), "`the key`", "`v.w`") == [("x", "b"), ("y", "c")]


def test_rows_read_again_write_nothing(lake, put):
    spec = spec_of()
    put([(n, "a", day(1), None) for n in range(20)] + [(50, None, day(1), day(1))])
    ok(full_load(lake, [spec]))
    row = ok(incremental_load(lake, [spec]))
    assert counts(row) == (0, 0, 0) and row["max_timestamp"] == day(1)
    assert lake.table(spec).version(row["run_id"]).run_id == 1
    third = ok(incremental_load(lake, [spec]))
    assert lake.table(spec).version(third["run_id"]).run_id == 1 and lake.current(spec).count() == 21
    assert lake.audit(spec, third["run_id"]).count() == 0


# --- objects side by side -------------------------------------------------------


def test_objects_are_loaded_side_by_side(lake, put):
    """All objects wait for each other: one after another they would wait in vain."""
    names = [f"t{n}" for n in range(6)]
    for name in names:
        put([(1, name, day(1), None)], name=name)
    specs = [spec_of(OBJ_NAME=name, SF_TBL=f"tbl_{name}") for name in names]
    specs.insert(3, spec_of(OBJ_NAME="missing", SF_TBL="tbl_missing"))
    together, groups = Barrier(7), []

    class Meeting(TableOrigin):
        def open(self, spark, spec, name, since=None):
            together.wait(60)
            groups.append(spark.sparkContext.getLocalProperty("spark.jobGroup.id"))
            return super().open(spark, spec, name, since)

    wide = replace(lake, origins={"shop": Meeting(lake.origins["shop"].root)})
    rows = full_load(wide, specs)
    assert [r["status"] for r in rows] == [SUCCESS] * 3 + [FAILED] + [SUCCESS] * 3
    assert [r["run_id"] for r in rows] == list(range(1, 8))
    assert sorted(groups) == sorted(f"tidemark {s.target} {at}" for at, s in enumerate(specs, 1))
    for spec in specs[:3] + specs[4:]:
        assert values(lake.current(spec)) == [(1, spec.object_name)]
    assert lake.ledger.rows().count() == 7 and len(lake.ledger.rows().inputFiles()) <= 2
    assert lake.spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def test_a_target_of_two_rows_is_loaded_one_after_the_other(lake, put):
    put([(1, "a", day(1), None)], name="one")
    put([(1, "b", day(2), None), (2, "c", day(2), None)], name="two")
    specs = [spec_of(OBJ_NAME="one"), spec_of(OBJ_NAME="two"), spec_of(OBJ_NAME="one", SF_TBL="tbl_other")]
    rows = incremental_load(lake, specs)
    assert [counts(r) for r in rows] == [(1, 0, 0), (1, 1, 0), (1, 0, 0)]
    assert len({r["run_id"] for r in rows}) == 3
    assert values(lake.current(specs[0])) == [(1, "b"), (2, "c")]


def test_a_smaller_pool_loads_all(lake, put):
    for name in "abcd":
        put([(1, name, day(1), None)], name=name)
    specs = [spec_of(OBJ_NAME=name, SF_TBL=f"tbl_{name}") for name in "abcd"]
    rows = full_load(replace(lake, at_once=1), specs)
    assert [counts(r) for r in rows] == [(1, 0, 0)] * 4
    # a second object of one name keeps a mark of its own
    states = lake.ledger.states([(s.identity, s.target) for s in specs] + [(("d", "s", "x"), "tbl_a")], 10)
    assert [s.run_id for s in states] == [5, 6, 7, 8, 9]
    assert [s.committed for s in states] == [1, 2, 3, 4, 1] and [s.mark for s in states] == [day(1)] * 4 + [None]


def test_measured_size(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "s string, n int")
    assert df.agg(total_bytes(df)).first()[0] == 2 * 32 + 3
    assert df.limit(0).agg(total_bytes(df)).first()[0] == 0


# --- time zones, marks and clocks -----------------------------------------------


@pytest.mark.parametrize("zone", ["America/New_York", "UTC", "Asia/Tokyo"])
def test_marks_of_instants_do_not_shift(spark, lake, tmp_path, zone):
    """Times with a time zone: neither the session's zone nor the driver's changes what is read."""
    spec = spec_of(UPDT_TIME_COL="-")
    schema = "id int, v string, ins timestamp"
    place, before = str(tmp_path / "source" / "t"), spark.conf.get("spark.sql.session.timeZone")

    def put(*rows):
        text = spark.createDataFrame(rows, "id int, v string, ins string")
        text.select("id", "v", F.col("ins").cast("timestamp")).write.mode("overwrite").parquet(place)

    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        put((1, "a", "2024-01-01T12:00:00Z"))
        first = ok(full_load(lake, [spec]))
        assert first["max_timestamp"] == datetime(2024, 1, 1, 12)
        put((1, "a", "2024-01-01T12:00:00Z"), (2, "b", "2024-01-01T14:00:00Z"), (3, "c", "2024-01-01T12:20:00Z"))
        assert counts(ok(incremental_load(lake, [spec]))) == (2, 0, 0)
        assert dict(lake.current(spec).select("id", F.col("ins").cast("string")).collect())[2] == "2024-01-01 14:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert spark.read.parquet(place).schema.simpleString() == "struct<" + schema.replace(" ", ":").replace(",:", ",") + ">"


def test_the_mark_follows_runs_that_only_update(lake, put):
    spec = spec_of()
    put([(1, "a", day(1), None), (2, "b", day(1), None)])
    ok(full_load(lake, [spec]))
    put([(1, "A", day(1), day(5)), (2, "b", day(1), None)])
    assert counts(ok(incremental_load(lake, [spec]))) == (0, 1, 0)
    state = lake.ledger.state(spec.identity, spec.target, 10)
    assert state.mark == day(5) and state.read_from == day(5) - timedelta(minutes=10)


def test_a_clock_set_back_audits_only_its_own_run(lake, put):
    spec = spec_of()
    put([(n, "a", day(1), None) for n in range(20)])
    first = ok(full_load(lake, [spec]))
    lake.clock.now -= timedelta(minutes=45)
    put([(3, "b", day(1), day(2))])
    row = ok(incremental_load(lake, [spec]))
    assert row["run_start"] > first["run_start"] and row["duration_in_sec"] >= 0
    assert values(lake.audit(spec, row["run_id"]), "edw_action", "id") == [("update", 3)]


def test_an_empty_database_cell_keeps_its_mark(lake, put):
    spec = spec_of(DATABASE_NAME=None, SCHEMA_NAME=" ")
    put([(1, "a", day(1), None)])
    ok(full_load(lake, [spec]))
    assert lake.ledger.state(spec.identity, spec.target, 10).mark == day(1)


def test_two_writers_cannot_commit_one_run(lake, put):
    put([(1, "a", day(1), None)])
    row = ok(full_load(lake, [spec_of()]))
    with pytest.raises(RuntimeError, match="one writer"):
        lake.ledger.append([row])


def test_the_ledger_names_target_and_user(spark, tmp_path, put):
    origins = {"shop": TableOrigin(str(tmp_path / "source"))}
    lake = Lake(spark, str(tmp_path / "lake"), origins, 4, target_database="lake", target_schema="bronze", clock=Clock())
    put([(1, "a", day(1), None)])
    ok(full_load(lake, [spec_of()]))
    (row,) = lake.ledger.rows().collect()
    assert (row.target_database_name, row.target_schema_name) == ("lake", "bronze")
    assert row.triggered_by == row.created_by == spark.sparkContext.sparkUser()


# --- types and columns ----------------------------------------------------------


def test_json_time_and_decimal_columns(spark, tmp_path, put):
    types = {"id": "bigint", "doc": "json", "at": "time", "price": "decimal(12,2)", "ins": "timestamp_ntz", "upd": "timestamp_ntz"}
    origins = {"shop": TableOrigin(str(tmp_path / "source"), types={"t": types})}
    lake = Lake(spark, str(tmp_path / "lake"), origins, 4, clock=Clock())
    schema = "id int, doc string, at string, price string, ins timestamp_ntz, upd timestamp_ntz"
    put([(1, '{"n": 1}', "07:30", "1.505", day(1), None), (2, None, None, None, day(1), None)], schema)
    ok(full_load(lake, [spec_of()]))
    put([(1, '{"n": 2}', "07:30", "1.51", day(1), day(2)), (2, None, None, None, day(1), None)], schema)
    assert counts(ok(incremental_load(lake, [spec_of()]))) == (0, 1, 0)
    got = lake.current(spec_of())
    assert dict(got.dtypes)["doc"] == "variant" and dict(got.dtypes)["price"] == "decimal(12,2)"
    row = got.where("id = 1").select(F.try_variant_get("doc", "$.n", "int"), "at", F.col("price").cast("string")).first()
    assert tuple(row) == (2, "07:30:00.000000", "1.51")


@pytest.mark.parametrize("kind, value", [("string", "new"), ("int", 5)])
def test_a_column_that_comes_back_is_a_new_one(lake, put, kind, value):
    spec, narrow = spec_of(), "id int, ins timestamp_ntz, upd timestamp_ntz"
    put([(1, "old", day(1), None), (2, "old", day(1), None), (3, "old", day(1), None)])
    ok(full_load(lake, [spec]))
    put([(1, day(1), None), (2, day(1), None), (3, day(1), None)], narrow)
    ok(incremental_load(lake, [spec]))
    put([(1, value, day(1), None), (4, value, day(3), None)], SCHEMA.replace("v string", f"v {kind}"))
    ok(incremental_load(lake, [spec]))
    assert values(lake.current(spec)) == [(1, value), (2, None), (3, None), (4, value)]
    put([(2, value, day(1), day(4))], SCHEMA.replace("v string", f"v {kind}"))
    ok(incremental_load(lake, [spec]))
    assert values(lake.current(spec)) == [(1, value), (2, value), (3, None), (4, value)]


# --- deletes and documents ------------------------------------------------------


def test_deletes_without_modified_times(lake, put):
    spec = spec_of(INSRT_TIME_COL="-", UPDT_TIME_COL="-", IS_DELETION="yes", DELETED_TBL="t_deleted")
    put([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    put([(9,)], "id int", "t_deleted")
    ok(full_load(lake, [spec]))
    put([(1, "a"), (3, "c")], "id int, v string")
    put([(9,), (2,)], "id int", "t_deleted")
    assert counts(ok(incremental_load(lake, [spec]))) == (0, 0, 1)
    assert values(lake.current(spec)) == [(1, "a"), (3, "c")]
    put([(1, "a"), (2, "back"), (3, "c")], "id int, v string")
    assert counts(ok(incremental_load(lake, [spec]))) == (1, 0, 0)
    put([(1, "a"), (2, "back"), (3, "C")], "id int, v string")  # the old entry for 2 is not applied again
    assert counts(ok(incremental_load(lake, [spec]))) == (0, 1, 0)
    assert values(lake.current(spec)) == [(1, "a"), (2, "back"), (3, "C")]


def collection(tmp_path, *lines):
    folder = tmp_path / "docs" / "members"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "1.json").write_text("\n".join(lines) + "\n")


def doc_spec(**changes):
    row = {
        "SRC_DB_NAME": "mongodb", "OBJ_TYPE": "collection", "OBJ_NAME": "members", "PRIMARY_KEY_COL": "_id",
        "INSRT_TIME_COL": "createdAt", "UPDT_TIME_COL": "updatedAt", "SF_TBL": "tbl_members",
    }
    return spec_of(**{**row, **changes})


def test_documents_with_several_keys(lake, tmp_path):
    spec = doc_spec(PRIMARY_KEY_COL="shop, no")
    collection(
        tmp_path,
        '{"shop":"a","no":1,"createdAt":"2024-01-01 00:00:00"}',
        '{"shop":"a","no":2,"createdAt":"2024-01-01 00:00:00"}',
        '{"shop":"b","no":1,"createdAt":"2024-01-01 00:00:00"}',
    )
    assert counts(ok(full_load(lake, [spec]))) == (3, 0, 0)
    assert values(lake.current(spec), "doc_key_1", "doc_key_2") == [("a", "1"), ("a", "2"), ("b", "1")]
    collection(tmp_path, '{"shop":"a","no":2,"createdAt":"2024-01-01 00:00:00","updatedAt":"2024-01-02 00:00:00"}')
    assert counts(ok(incremental_load(lake, [spec]))) == (0, 1, 0)


@pytest.mark.parametrize("times", [{"UPDT_TIME_COL": "-"}, {"UPDT_TIME_COL": "createdAt"}, {"INSRT_TIME_COL": "-", "UPDT_TIME_COL": "-"}])
def test_documents_with_one_time_or_none(lake, tmp_path, times):
    spec = doc_spec(**times)
    one = '{"_id":{"$oid":"a"},"createdAt":{"$date":"2024-01-01T00:00:00Z"},"n":1}'
    collection(tmp_path, one, '{"n":7}', '{"n":8}')
    assert counts(ok(full_load(lake, [spec]))) == (3, 0, 0)
    collection(tmp_path, one, '{"_id":{"$oid":"b"},"createdAt":{"$date":"2024-01-02T00:00:00Z"},"n":2}')
    assert counts(ok(incremental_load(lake, [spec]))) == (1, 0, 0)
    assert [r[0] for r in values(lake.current(spec).where("doc_key is not null"), "doc_key")] == ["a", "b"]


def test_all_documents_without_a_key_are_set_aside(spark, lake, tmp_path):
    strict = Lake(spark, str(tmp_path / "strict"), lake.origins, 4, reject_null_keys=True, clock=Clock())
    collection(tmp_path, '{"_id":"a","createdAt":"2024-01-01 00:00:00"}', '{"n":7}', '{"n":7}', '{"n":8}')
    assert counts(ok(full_load(strict, [doc_spec()]))) == (1, 0, 0)
    assert spark.read.parquet(strict.stage(doc_spec(), "rejects")).count() == 3


# --- retention --------------------------------------------------------------------


def test_only_what_kept_runs_need_stays(spark, lake, put, tmp_path):
    spec = spec_of()
    for run in range(1, 6):
        put([(n, f"v{run if n == run else 0}", day(1), day(run)) for n in range(30)] + [(100 + run, "new", day(run), None)])
        ok(incremental_load(lake, [spec]))
    before = values(lake.current(spec))
    gone = retire(lake, spec, keep=2)
    assert gone["batch"] == [1, 2, 3] and gone["tables"] == [1, 2, 3]
    left = sorted(p.name for p in (tmp_path / "lake/tables/tbl_t").iterdir())
    assert left == ["run_id=4", "run_id=5"]
    table = lake.table(spec)
    assert values(lake.current(spec)) == before and values(table.read(table.version(4)))
    # runs that change nothing show an older version, which stays
    for _ in range(3):
        ok(incremental_load(lake, [spec]))
    gone = retire(lake, spec, keep=2)
    assert gone["tables"] == [4, 6] and table.version(8).run_id == 5 and values(lake.current(spec)) == before
    assert lake.audit(spec, 1).count() > 0
    put([(0, "after", day(1), day(9))])
    assert counts(ok(incremental_load(lake, [spec]))) == (0, 1, 0)
    assert retire(lake, spec_of(SF_TBL="never")) == {}
    with pytest.raises(ValueError):
        retire(lake, spec, keep=0)


# --- rejected values and found types ----------------------------------------------


def test_misfits_are_set_aside_and_counted(spark, tmp_path, put):
    types = {"id": "bigint", "price": "decimal(6,2)", "ins": "timestamp_ntz", "upd": "timestamp_ntz"}
    origins = {"shop": TableOrigin(str(tmp_path / "source"), types={"t": types})}
    lake = Lake(spark, str(tmp_path / "lake"), origins, 4, clock=Clock(), reject_misfits=True)
    schema = "id string, price string, ins timestamp_ntz, upd timestamp_ntz"
    put([("1", "1.50", day(1), None), ("x", "2", day(1), None), ("3", "lots", day(2), None)], schema)
    row = ok(full_load(lake, [spec_of()]))
    assert counts(row) == (1, 0, 0) and row["error_message"].startswith("2 rows set aside")
    assert row["max_timestamp"] == day(2) and lake.ledger.rows().first()["error_message"] == row["error_message"]
    misfits = spark.read.parquet(f"{lake.stage(spec_of(), 'typed')}/run_id=1/tidemark_rejected=true")
    assert sorted(r[0][0]["text"] for r in misfits.select("tidemark_reasons").collect()) == ["lots", "x"]
    put([("3", "3.00", day(2), day(3))], schema)
    row = ok(incremental_load(lake, [spec_of()]))
    assert counts(row) == (1, 0, 0) and row["error_message"] == "-"
    strict = Lake(spark, str(tmp_path / "strict"), origins, 4, clock=Clock())
    put([("x", "2", day(1), None)], schema)
    assert full_load(strict, [spec_of()])[0]["status"] == FAILED


def test_file_objects_get_the_types_of_their_text(lake, tmp_path):
    """Without times: snapshots are compared as text, whatever types each of them has."""
    spec = spec_of(SRC_DB_NAME="-", OBJ_TYPE="FILE", OBJ_NAME="stock", INSRT_TIME_COL="-", UPDT_TIME_COL="-")
    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "stock.csv").write_text("id,price,at\n1,1.5,2024-01-01 10:00:00\n2,2,2024-01-02 10:00:00\n")
    assert counts(ok(full_load(lake, [spec]))) == (2, 0, 0)
    assert [t for _, t in lake.current(spec).dtypes[:3]] == ["int", "double", "timestamp_ntz"]
    (folder / "stock.csv").write_text("id,price,at\n1,1.5,2024-01-01 10:00:00\n2,3,2024-01-02 10:00:00\n3,4,\n")
    assert counts(ok(incremental_load(lake, [spec]))) == (1, 1, 0)
    (folder / "stock.csv").write_text("id,price,at,more\n1,1.5,2024-01-01 10:00:00,7\n2,3,2024-01-02 10:00:00,8\n3,4,,9\n")
    assert counts(ok(incremental_load(lake, [spec]))) == (0, 3, 0)
    assert dict(lake.current(spec).dtypes)["more"] == "int" and values(lake.current(spec), "id", "price", "more") == [(1, 1.5, 7), (2, 3.0, 8), (3, 4.0, 9)]
