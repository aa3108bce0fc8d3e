from datetime import datetime

from tidemark.operators.audit import audit_of_run
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.projection import with_audit_columns
from tidemark.operators.upsert import merged_by_key
from tidemark.plans.tables import VersionedTable
from tidemark.sources.staging import run_path
from tidemark.streaming.staged_upsert import follow_stage

SCHEMA = "id int, v string, ins timestamp_ntz"


def test_staged_files_are_merged_once(spark, tmp_path):
    stage, table = str(tmp_path / "stage"), VersionedTable(spark, str(tmp_path / "table"), ("id",), 2)
    empty = with_audit_columns(spark.createDataFrame([], SCHEMA), "2024-01-01")
    table.write(0, empty, empty, 2)
    seen = []

    def merge(batch, batch_id):
        run = len(seen) + 1
        base, stamp = table.version(run - 1), f"2024-01-0{run + 1}"
        latest = latest_per_key(batch, ["id"], "ins")
        merged = merged_by_key(table.keyed(base), latest, ["id"], stamp, hashed=True).drop("_action")
        table.write(run, merged, table.keyless(base), base.buckets)
        done = audit_of_run(table.read(table.version(run)), ["id"], stamp, run).groupBy("edw_action").count().collect()
        seen.append((batch_id, {r["edw_action"]: r["count"] for r in done}))

    def put(run, data):
        spark.createDataFrame(data, SCHEMA).write.parquet(run_path(stage, run))
        query = follow_stage(spark, stage, SCHEMA, str(tmp_path / "checkpoint"), merge)
        query.awaitTermination(120)
        assert query.exception() is None

    day = [datetime(2024, 1, d) for d in (1, 2, 3)]
    put(1, [(1, "a", day[0]), (1, "b", day[1]), (2, "c", day[0])])
    put(2, [(2, "d", day[2]), (3, "e", day[2])])
    assert seen == [(0, {"insert": 2}), (1, {"insert": 1, "update": 1})]
    got = sorted((r.id, r.v) for r in table.read(table.version(2)).collect())
    assert got == [(1, "b"), (2, "d"), (3, "e")]
