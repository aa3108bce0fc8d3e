"""Full and incremental loads of the objects of a control file.

Each object goes through: read from its mark, stage, type, keep the latest row
per key, apply deletes, upsert, write the next version, audit. The objects run side
by side, each with a job group of its own and in a scheduler pool of its own (which
``spark.scheduler.mode=FAIR`` makes share the executors). Their ledger rows are the
commit: one read of the ledger before, one append after. Only control rows, marks
and counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.comparison import any_null
from tidemark.functions.timestamps import wall_clock
from tidemark.functions.types import stored_as
from tidemark.names import AUDIT_COLUMNS, col
from tidemark.operators import deletes, upsert
from tidemark.operators.audit import audit_of_run
from tidemark.operators.dedup import latest_per_key, newest_first, typed_documents
from tidemark.operators.filters import any_later, changed_since, inserted_since
from tidemark.operators.projection import REASONS, project_columns, rejecting_projection, typed_projection, with_audit_columns
from tidemark.operators.snapshot_diff import new_rows
from tidemark.plans import folders
from tidemark.plans.ledger_store import LedgerStore, LoadState, failed_row, ledger_row, utc_now
from tidemark.plans.tables import Version, VersionedTable
from tidemark.sources.footers import AT, KEYLESS, measured, with_measures
from tidemark.sources.inference import stage_inferred
from tidemark.sources.staging import run_path, stage_batch, stage_parted
from tidemark.spec import LoadSpec

DOC_KEY = "doc_key"
DOC = "json_data"


def document_keys(spec: LoadSpec) -> tuple[str, ...]:
    """Columns that hold the key fields of a document, as text: ``doc_key``, or numbered ones for several."""
    if len(spec.keys) == 1:
        return (DOC_KEY,)
    return tuple(f"{DOC_KEY}_{at}" for at in range(1, len(spec.keys) + 1))


@dataclass(frozen=True)
class Lake:
    """Where a set of loads keeps its data, and how."""

    spark: SparkSession
    root: str
    origins: dict[str, object]
    buckets: int = 8
    overlap_minutes: int = 10
    # a staged batch of at most this many bytes a bucket is kept in memory by the tasks of the upsert
    hash_bytes: int = 4 * 1024 * 1024
    # objects loaded side by side
    at_once: int = 8
    drop_missing: bool = True
    reject_null_keys: bool = False
    # rows with a value that is none of its declared type are set aside with the reasons, and do not fail the load
    reject_misfits: bool = False
    # what the ledger says of the target
    target_database: str = "-"
    target_schema: str = "-"
    # stamps runs and rows; see ``local_clock`` for another time zone
    clock: Callable[[], datetime] = field(default=utc_now)

    @property
    def ledger(self) -> LedgerStore:
        return LedgerStore(self.spark, f"{self.root}/ledger")

    def stage(self, spec: LoadSpec, kind: str = "batch") -> str:
        return f"{self.root}/stage/{kind}/{spec.target}"

    def table(self, spec: LoadSpec) -> VersionedTable:
        keys = document_keys(spec) if spec.is_documents else spec.keys
        return VersionedTable(self.spark, f"{self.root}/tables/{spec.target}", keys, self.buckets)

    def current(self, spec: LoadSpec) -> DataFrame | None:
        """The target as of its last committed run."""
        run_id = self.ledger.committed_run(spec.target)
        if run_id is None:
            return None
        table = self.table(spec)
        return table.read(table.version(run_id))

    def audit(self, spec: LoadSpec, run_id: int) -> DataFrame:
        return self.spark.read.parquet(run_path(f"{self.root}/audit/{spec.target}", run_id))


def full_load(lake: Lake, specs: list[LoadSpec]) -> list[dict]:
    """Load every object whole. Returns the ledger rows."""
    return _run(lake, specs, incremental=False)


def incremental_load(lake: Lake, specs: list[LoadSpec]) -> list[dict]:
    """Load what changed since each object's mark; objects without one load whole."""
    return _run(lake, specs, incremental=True)


def _waves(specs: list[LoadSpec]) -> list[list[LoadSpec]]:
    """Objects that can be loaded side by side: a target or a mark that two rows share is used by one after the other."""
    waves: list[list[LoadSpec]] = []
    last: dict[object, int] = {}
    for spec in specs:
        shared = (spec.target.upper(), spec.identity)
        at = max(last.get(name, -1) for name in shared) + 1
        last.update(dict.fromkeys(shared, at))
        if at == len(waves):
            waves.append([])
        waves[at].append(spec)
    return waves


def _run(lake: Lake, specs: list[LoadSpec], incremental: bool) -> list[dict]:
    lake.ledger.create()
    user = lake.spark.sparkContext.sparkUser()
    by = {
        "target_database_name": lake.target_database,
        "target_schema_name": lake.target_schema,
        "triggered_by": user,
        "created_by": user,
    }
    done = []
    for wave in _waves(specs):
        states = lake.ledger.states([(spec.identity, spec.target) for spec in wave], lake.overlap_minutes)

        def one(spec: LoadSpec, state: LoadState) -> dict:
            context = lake.spark.sparkContext
            context.setJobGroup(f"tidemark {spec.target} {state.run_id}", f"load {spec.object_name} into {spec.target}")
            context.setLocalProperty("spark.scheduler.pool", spec.target)
            return _load(lake, spec, state, incremental) | by

        with ThreadPoolExecutor(min(lake.at_once, len(wave))) as pool:
            # wrapped once for each thread: a wrapper's local properties are shared by those who call it
            begun = [
                pool.submit(inheritable_thread_target(lake.spark)(one), spec, state)
                for spec, state in zip(wave, states, strict=True)
            ]
            rows = [load.result() for load in begun]
        lake.ledger.append(rows)
        done += rows
    return done


def _load(lake: Lake, spec: LoadSpec, state: LoadState, incremental: bool) -> dict:
    """Load one object; its ledger row, also if it failed."""
    started = lake.clock()
    if state.stamp and started <= state.stamp:
        # a clock set back: stamps tell runs apart, so they only ever rise
        started = state.stamp + timedelta(microseconds=1)
    load = _Load(lake, spec, state, started.isoformat(sep=" "), incremental)
    try:
        outcome = load.run()
        return ledger_row(spec, state.run_id, started, max(lake.clock(), started), **outcome)
    except Exception as error:  # one object's failure must not stop the others
        return failed_row(spec, state.run_id, started, max(lake.clock(), started), error, load.step)


@dataclass
class _Load:
    lake: Lake
    spec: LoadSpec
    state: LoadState
    run_ts: str
    incremental: bool
    step: str = "read control row"
    misfits: int = 0

    def run(self) -> dict:
        self.table = self.lake.table(self.spec)
        self.run_id, self.committed = self.state.run_id, self.state.committed
        self.base = None if self.committed is None else self.table.version(self.committed)
        self.read_from = self.state.read_from if self.incremental and self.base else None
        if self.spec.is_documents:
            return self._documents()
        return self._rows()

    # --- reading -----------------------------------------------------------

    def _origin(self):
        return self.lake.origins[self.spec.source]

    def _source(self) -> DataFrame:
        self.step = "read source"
        since = str(self.read_from) if self.read_from else None
        df = self._origin().open(self.lake.spark, self.spec, self.spec.object_name, since)
        return wall_clock(project_columns(df, self.spec.columns), list(self.spec.times))

    def _stage(self, df: DataFrame, kind: str, times: tuple[str, ...] | list[str] = ()) -> DataFrame:
        """Stage rows with what ``_measure`` needs; text of an origin without types gets them in the same pass."""
        self.step = "stage batch"
        self.staged_at = run_path(self.lake.stage(self.spec, kind), self.run_id)
        rows = with_measures(df, times, self.table.keys)
        if getattr(self._origin(), "infers", False):
            staged, _ = stage_inferred(rows, self.staged_at)
        else:
            staged = stage_batch(rows, self.lake.stage(self.spec, kind), self.run_id)
        return staged.drop(AT, KEYLESS)

    def _mark(self, found: datetime | None) -> dict:
        """New mark, never below the one before; an empty batch logs the sentinel."""
        if found is None:
            return {}
        return {"max_timestamp": max(found, self.state.mark) if self.state.mark else found}

    def _typed(self, df: DataFrame) -> DataFrame:
        self.step = "type columns"
        declared = self._declared()
        if not declared:
            return df
        if not self.lake.reject_misfits:
            return typed_projection(df, declared)
        typed = rejecting_projection(df, declared)
        good, misfits = stage_parted(typed, REASONS, self.lake.stage(self.spec, "typed"), self.run_id)
        self.misfits = misfits.count()
        return good

    def _declared(self) -> dict[str, str] | None:
        """Storage types; the times of the object are wall clock, as they are read."""
        declared = self._origin().declared(self.lake.spark, self.spec)
        times = {t.lower() for t in self.spec.times}
        return declared and {
            name: "timestamp_ntz" if name.lower() in times and dtype == "timestamp" else dtype
            for name, dtype in declared.items()
        }

    def _measure(self) -> None:
        """Greatest time of the batch, its rows, and whether some have a null key, from the footers of the staged files."""
        self.newest, self.rows, self.keyless_rows = measured(self.lake.spark, self.staged_at)

    def _split(self, df: DataFrame, inserted: str | None, updated: str | None, tiebreak=None) -> tuple[DataFrame, DataFrame]:
        """The latest row per key, and every row with a null key.

        Null keys match nothing, so each read of such a row inserts it again;
        optionally they are set aside, all of them.
        """
        none = df.sparkSession.createDataFrame([], df.schema)
        if not self.keyless_rows:
            return latest_per_key(df, self.table.keys, inserted, updated, tiebreak), none
        missing = any_null([col(k) for k in self.table.keys])
        latest = latest_per_key(df.filter(~missing), self.table.keys, inserted, updated, tiebreak)
        if self.lake.reject_null_keys:
            stage_batch(df.filter(missing), self.lake.stage(self.spec, "rejects"), self.run_id)
            self.keyless_rows = False
            return latest, none
        return latest, df.filter(missing)

    # --- relational and file objects -----------------------------------------

    def _rows(self) -> dict:
        spec, lake = self.spec, self.lake
        source = self._source()
        schema = self._evolved(source)
        inserted, updated = newest_first(list(spec.times))
        if spec.has_modified_time:
            changed = source
            if self.read_from is not None:
                changed = changed_since(source, str(self.read_from), inserted, updated)
            staged = self._stage(changed, "batch", spec.times)
        else:
            staged = self._snapshot_changes(source, "snapshot", "batch")
        if schema is not None:
            schema = self._evolved(staged)  # with the types found on the way
        self._measure()
        latest, keyless = self._split(self._typed(staged), inserted, updated)
        outcome = self._commit(latest, keyless, self._deleted(), schema)
        if self.misfits:
            outcome["error_message"] = f"{self.misfits} rows set aside: a value is none of its declared type"
        return {**outcome, **self._mark(self.newest)}

    def _snapshot_changes(self, source: DataFrame, kind: str, changes: str) -> DataFrame:
        """Objects without a modified time: rows that the last committed run's copy does not hold."""
        self.step = "compare snapshots"
        keep = self._keys_stage if kind == "deleted" else self._stage
        current = keep(source, kind)
        if not self.incremental or self.base is None:
            return current
        stage = self.lake.stage(self.spec, kind)
        # as they were staged: types that are found on the way may differ between snapshots
        now, before = (
            self.lake.spark.read.parquet(run_path(stage, run)).drop(AT, KEYLESS) for run in (self.run_id, self.committed)
        )
        if set(before.columns) != set(now.columns):
            return current
        return keep(new_rows(now, before.select(*[col(c) for c in now.columns])), changes)

    def _keys_stage(self, feed: DataFrame, kind: str) -> DataFrame:
        return stage_batch(feed, self.lake.stage(self.spec, kind), self.run_id)

    def _evolved(self, source: DataFrame) -> T.StructType | None:
        """Schema the target takes in this run if it is another one; a new column forces a full read."""
        if self.base is None:
            return None
        self.step = "compare columns"
        stored = self.table.keyless(self.base).schema
        own = {n.lower() for n in stored.names} - set(AUDIT_COLUMNS)
        new = [f for f in source.schema.fields if f.name.lower() not in own]
        gone = own - {n.lower() for n in source.columns}
        kept = [f for f in stored.fields if not (self.lake.drop_missing and f.name.lower() in gone)]
        if new:
            self.read_from = None
            declared = {name.lower(): stored_as(dtype) for name, dtype in (self._declared() or {}).items()}
            types = [T.DataType.fromDDL(declared.get(f.name.lower(), f.dataType.simpleString())) for f in new]
            added = [T.StructField(f.name, dtype) for f, dtype in zip(new, types, strict=True)]
            at = next(n for n, f in enumerate(kept) if f.name in AUDIT_COLUMNS)
            kept[at:at] = added
        return T.StructType(kept) if new or len(kept) < len(stored.fields) else None

    def _deleted(self) -> DataFrame | None:
        """Keys deleted since the last run.

        A feed without a time is kept whole by each run and compared with the
        copy before: an old entry must not delete a row that came back since.
        """
        spec = self.spec
        if spec.deleted_object is None:
            return None
        self.step = "read deleted rows"
        since = str(self.read_from) if self.read_from else None
        feed = self._origin().open(self.lake.spark, spec, spec.deleted_object, since)
        feed = wall_clock(feed, [spec.inserted_col])
        if spec.inserted_col is None:
            fresh = self._snapshot_changes(feed.select(*[col(c) for c in spec.keys]), "deleted", "deleted_new")
            return None if self.base is None else fresh
        if self.base is None:
            return None
        feed = feed.select(*[col(c) for c in dict.fromkeys((*spec.keys, spec.inserted_col))])
        if self.read_from is not None:
            feed = inserted_since(feed, str(self.read_from), spec.inserted_col)
        return stage_batch(feed, self.lake.stage(spec, "deleted"), self.run_id)

    # --- documents -------------------------------------------------------------

    def _documents(self) -> dict:
        """Documents are parsed once, into the stage: keys and times are columns of it."""
        spec, lake = self.spec, self.lake
        self.step = "read source"
        docs = self._origin().open(lake.spark, spec, spec.object_name)
        docs = docs.select(col(docs.columns[0]).alias(DOC))
        fields = dict(zip(spec.keys, self.table.keys, strict=True))
        typed, times = typed_documents(docs, DOC, fields, spec.inserted_col, spec.updated_col)
        if self.read_from is not None:
            typed = any_later(typed, str(self.read_from), times)
        staged = self._stage(typed, "batch", times)
        self._measure()
        latest, keyless = self._split(staged, *newest_first(times), [DOC])
        return {**self._commit(latest.drop(*times), keyless.drop(*times), None, None), **self._mark(self.newest)}

    # --- writing -----------------------------------------------------------------

    def _commit(
        self, latest: DataFrame, keyless: DataFrame, deleted: DataFrame | None, schema: T.StructType | None
    ) -> dict:
        table, keys = self.table, self.table.keys
        if self.base is None:
            self.step = "write target"
            keyed = with_audit_columns(self._by_bucket(latest), self.run_ts)
            return self._written(keyed, with_audit_columns(keyless, self.run_ts), table.buckets)
        stored = table.keyless(self.base)
        target, old = (_in_schema(df, schema or stored.schema) for df in (table.keyed(self.base), stored))
        latest, keyless = (_in_types(df, target.schema) for df in (latest, keyless))
        gone = 0
        if deleted is not None:
            self.step = "find deleted rows"
            feed = _in_types(deleted.select(*[col(k) for k in keys]), target.schema)
            gone = deletes.deleted_rows(target.select(*[col(k) for k in keys]), feed, keys, target_unique=True).count()
            if gone:
                target = deletes.keyed_remaining(target, feed, keys)
        self.step = "upsert"
        if schema is None and not gone and self._nothing_new(target, latest):
            table.keep(self.run_id, self.base)
            self._audit(target.limit(0))
            return {}
        hashed = folders.total_bytes(self.lake.spark, self.staged_at) <= self.lake.hash_bytes * self.base.buckets
        merged = upsert.merged_by_key(target, latest, keys, self.run_ts, hashed).drop(upsert.ACTION)
        fresh = upsert.as_inserts(keyless, target, self.run_ts).drop(upsert.ACTION)
        return self._written(merged, old.unionByName(fresh), self.base.buckets) | {"rows_deleted": gone}

    def _by_bucket(self, latest: DataFrame) -> DataFrame:
        """Rows that come from the window by key lie by bucket if its partitions are a multiple of the buckets."""
        conf = self.lake.spark.conf
        partitions = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
        partitions = partitions or conf.get("spark.sql.shuffle.partitions")
        if int(partitions) % self.table.buckets == 0:
            return latest
        return latest.repartition(self.table.buckets, *[col(k) for k in self.table.keys])

    def _nothing_new(self, target: DataFrame, latest: DataFrame) -> bool:
        """Whether the batch only holds rows that are read again because reads overlap.

        Where rows are newer than the mark there is something new, and nothing to look up.
        """
        if not self.rows:
            return True
        if self.keyless_rows or self.read_from is None or (self.newest and self.newest > self.state.mark):
            return False
        return upsert.not_stored_yet(target, latest, self.table.keys).isEmpty()

    # --- results -------------------------------------------------------------------

    def _written(self, keyed: DataFrame, keyless: DataFrame, buckets: int) -> dict:
        """Write the version and its audit; counts come from what was written.

        Accumulators would count the rows of a retried task twice.
        """
        version: Version = self.table.write(self.run_id, keyed, keyless, buckets)
        found = self._audit(self.table.read(version)).groupBy("edw_action").count().collect()
        rows = {row["edw_action"]: row["count"] for row in found}
        return {"rows_inserted": rows.get("insert", 0), "rows_updated": rows.get("update", 0)}

    def _audit(self, rows: DataFrame) -> DataFrame:
        """Keys this run inserted or updated."""
        self.step = "write audit keys"
        found = audit_of_run(rows, self.table.keys, self.run_ts, self.run_id)
        return stage_batch(found, f"{self.lake.root}/audit/{self.spec.target}", self.run_id)


def _in_schema(stored: DataFrame, schema: T.StructType) -> DataFrame:
    """Stored rows with the columns a target takes from now on; those they lack are null."""
    held = set(stored.columns)
    return stored.select(
        *[(col(f.name) if f.name in held else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    )


def _in_types(batch: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a batch under the target's names and types; names fold case as the drift check does."""
    given = {c.lower(): c for c in batch.columns}
    shared = [f for f in schema.fields if f.name.lower() in given]
    return batch.select(*[col(given[f.name.lower()]).cast(f.dataType).alias(f.name) for f in shared])
