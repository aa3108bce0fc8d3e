"""Upsert of a batch into a target with audit columns.

For each batch row: no target row with equal keys -> insert, with the inserted
stamp; equal keys and any column different -> update, with the updated stamp;
otherwise the target row stays as it is. A null key matches nothing, so it is
always inserted; such rows bypass the joins, where they would all hash to one
task.

Three plans give the same rows:

``outer``      one full outer join. Each side is shuffled once. For targets with
               unique keys, which is what upserts leave behind: a full outer
               join cannot be split should one key fill a task.
``split``      target LEFT OUTER batch, plus batch LEFT ANTI target keys. The
               target is always the splittable side, so adaptive execution can
               break up a hot key of a target that is not unique. Spark
               broadcasts the batch by itself when its statistics allow.
``broadcast``  as ``split`` with the batch broadcast: the target is never
               shuffled. The batch is measured first; one over the limit is
               merged by ``split``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.comparison import any_null, rows_differ
from tidemark.functions.documents import document_text
from tidemark.names import AUDIT_COLUMNS, INSERTED_AT, UPDATED_AT, col, ntz, quoted, whole_key

ACTION = "_action"
_IN_TARGET = "__in_target"
_IN_BATCH = "__in_batch"

PLANS = ("split", "outer", "broadcast")
#: a batch of more uncompressed bytes is not broadcast
BROADCAST_BYTES = 32 * 1024 * 1024


def total_bytes(df: DataFrame) -> Column:
    """Aggregate of the uncompressed bytes of the rows."""
    size = F.lit(16 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(col(f.name)), F.lit(0))
        elif isinstance(f.dataType, (T.VariantType, T.StructType, T.ArrayType, T.MapType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(col(f.name)))), F.lit(0))
    return F.coalesce(F.sum(size), F.lit(0))


def _keys_equal(keys, left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [col(k, left) == col(k, right) for k in keys])


def _batch_value(name: str, field, batch_types: dict) -> Column:
    value = col(name, "s")
    return value if batch_types[name] == field.dataType else value.cast(field.dataType)


def _merged_columns(target: DataFrame, batch: DataFrame, keys, run_ts: Column, outer: bool) -> list[Column]:
    """Output columns of the join of target (t) and batch (s), and the action."""
    batch_types = {f.name: f.dataType for f in batch.schema.fields}
    shared = [f for f in target.schema.fields if f.name in batch_types and f.name not in AUDIT_COLUMNS]
    differ = rows_differ(
        [
            (_batch_value(f.name, f, batch_types), col(f.name, "t"), f.dataType)
            for f in shared
            if f.name not in keys
        ]
    )
    in_batch = col(_IN_BATCH, "s").isNotNull()
    inserted = col(_IN_TARGET, "t").isNull() if outer else F.lit(False)
    updated = in_batch & differ & ~inserted
    out = []
    for field in target.schema.fields:
        name, old = field.name, col(field.name, "t")
        if name == INSERTED_AT:
            value = F.when(inserted, run_ts).otherwise(old)
        elif name == UPDATED_AT:
            value = F.when(updated, run_ts).otherwise(old)
        elif name in batch_types:
            value = F.when(inserted | updated, _batch_value(name, field, batch_types)).otherwise(old)
        else:
            value = old
        out.append(value.alias(name))
    action = F.when(inserted, "insert").when(updated, "update").otherwise("keep")
    return out + [action.alias(ACTION)]


def as_inserts(batch: DataFrame, target: DataFrame, run_ts: str | Column) -> DataFrame:
    """Batch rows as new rows of the target, with ``_action``."""
    run_ts, out = ntz(run_ts), []
    for field in target.schema.fields:
        if field.name == INSERTED_AT:
            value = run_ts
        elif field.name in batch.columns and field.name != UPDATED_AT:
            value = col(field.name).cast(field.dataType)
        else:
            value = F.lit(None).cast(field.dataType)
        out.append(value.alias(field.name))
    return batch.select(*out, F.lit("insert").alias(ACTION))


def _has_null_key(keys) -> Column:
    return any_null([col(k) for k in keys])


def merged_by_key(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str] | tuple[str, ...],
    run_ts: str | Column,
    hashed: bool = False,
) -> DataFrame:
    """The merged rows and ``_action``, for a target and a batch without null keys: one full outer join.

    A target bucketed by the keys is not shuffled. With ``hashed`` each task keeps
    its part of the batch in memory, and the target is not sorted either.
    """
    side = batch.withColumn(_IN_BATCH, F.lit(True))
    return (
        target.withColumn(_IN_TARGET, F.lit(True))
        .alias("t")
        .join((side.hint("shuffle_hash") if hashed else side).alias("s"), _keys_equal(keys, "t", "s"), "full_outer")
        .select(*_merged_columns(target, batch, keys, ntz(run_ts), outer=True))
    )


def _outer_plan(target: DataFrame, batch: DataFrame, keys, run_ts: Column) -> DataFrame:
    no_key = _has_null_key(keys)
    joined = merged_by_key(target.filter(~no_key), batch.filter(~no_key), keys, run_ts)
    kept = target.filter(no_key).withColumn(ACTION, F.lit("keep"))
    return joined.unionByName(kept).unionByName(as_inserts(batch.filter(no_key), target, run_ts))


def updated_target(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str] | tuple[str, ...],
    run_ts: str | Column,
    small: bool = False,
    target_unique: bool = False,
) -> DataFrame:
    """The target's own rows after the upsert, with ``_action``.

    With ``small`` the batch is broadcast and the rows stay where the target
    scan has them.
    """
    side = batch.filter(~_has_null_key(keys)).withColumn(_IN_BATCH, F.lit(True))
    if small or target_unique:
        on = _keys_equal(keys, "t", "s")
    else:
        on = whole_key(keys, "t") == whole_key(keys, "s")
    return (
        target.alias("t")
        .join((F.broadcast(side) if small else side).alias("s"), on, "left_outer")
        .select(*_merged_columns(target, batch, keys, ntz(run_ts), outer=False))
    )


def matched_keys(
    target: DataFrame, batch: DataFrame, keys: list[str] | tuple[str, ...], small: bool = False
) -> DataFrame:
    """Batch keys the target holds, each once; reads only the key columns of the target."""
    names = [quoted(k) for k in keys]
    wanted = batch.filter(~_has_null_key(keys)).select(*names)
    wanted = (F.broadcast(wanted) if small else wanted).alias("w")
    known = target.select(*names).alias("k")
    return known.join(wanted, _keys_equal(keys, "k", "w"), "left_semi").distinct()


def inserted_rows(
    target: DataFrame,
    batch: DataFrame,
    known: DataFrame,
    keys: list[str] | tuple[str, ...],
    run_ts: str | Column,
) -> DataFrame:
    """Batch rows whose key is not in ``known``, as target rows, with ``_action``."""
    # this use of the batch starts like the one in updated_target, so its shuffle can be reused
    keyed = batch.filter(~_has_null_key(keys))
    fresh = keyed.alias("s").join(known.alias("k"), _keys_equal(keys, "s", "k"), "left_anti")
    return as_inserts(fresh.unionByName(batch.filter(_has_null_key(keys))), target, ntz(run_ts))


def _split_plan(target: DataFrame, batch: DataFrame, keys, run_ts: Column, unique: bool, small: bool) -> DataFrame:
    if small:
        # at most as many keys as the measured batch has rows
        known = F.broadcast(matched_keys(target, batch, keys, small=True))
    else:
        known = target.select(*[quoted(k) for k in keys]).filter(~_has_null_key(keys))
        # collapse repeated keys before the shuffle: this side cannot be split
        known = known if unique else known.distinct()
    existing = updated_target(target, batch, keys, run_ts, small, unique)
    return existing.unionByName(inserted_rows(target, batch, known, keys, run_ts))


def upsert_with_actions(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str] | tuple[str, ...],
    run_ts: str | Column,
    target_unique: bool = False,
    plan: str | None = None,
) -> DataFrame:
    """Merged rows plus ``_action``: 'insert', 'update' or 'keep'.

    ``batch`` must hold one row per key (see ``latest_per_key``) and no column the
    target lacks (see ``catalog.add_columns``). The default plan is 'outer' for a
    target with unique keys and 'split' otherwise.
    """
    plan = plan or ("outer" if target_unique else "split")
    if plan not in PLANS:
        raise ValueError(f"plan must be one of {PLANS}, not {plan!r}")
    unknown = [c for c in batch.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"batch columns missing in target: {unknown}")
    if plan == "outer":
        return _outer_plan(target, batch, keys, ntz(run_ts))
    small = plan == "broadcast" and batch.agg(total_bytes(batch)).first()[0] <= BROADCAST_BYTES
    return _split_plan(target, batch, keys, ntz(run_ts), target_unique, small)


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str] | tuple[str, ...],
    run_ts: str | Column,
    target_unique: bool = False,
    plan: str | None = None,
) -> DataFrame:
    return upsert_with_actions(target, batch, keys, run_ts, target_unique, plan).drop(ACTION)


def action_counts(merged: DataFrame) -> DataFrame:
    """Rows per action of ``upsert_with_actions``, without the kept rows."""
    return (
        merged.filter(col(ACTION) != "keep")
        .groupBy(col(ACTION).alias("action"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _values_differ(target: DataFrame, batch: DataFrame, keys) -> Column:
    types = {f.name: f.dataType for f in batch.schema.fields}
    values = [c for c in batch.columns if c in target.columns and c not in keys]
    return rows_differ([(col(c, "s"), col(c, "t"), types[c]) for c in values])


def changed_rows(target: DataFrame, batch: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Batch rows whose key exists in the target with other values."""
    on = _keys_equal(keys, "s", "t") & _values_differ(target, batch, keys)
    return batch.alias("s").join(target.alias("t"), on, "inner").select("s.*")


def not_stored_yet(target: DataFrame, batch: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Batch rows the target does not hold with the same values."""
    on = _keys_equal(keys, "s", "t") & ~_values_differ(target, batch, keys)
    return batch.alias("s").join(target.alias("t"), on, "left_anti")


def upsert_documents(
    target: DataFrame,
    batch: DataFrame,
    doc: str,
    key: str,
    run_ts: str | Column,
    key_as: str = "doc_key",
    target_unique: bool = False,
    plan: str | None = None,
) -> DataFrame:
    """Replace whole documents whose content differs; matched on one text key.

    The key is kept as a column of its own beside the document, so joins read a
    string with statistics and not the document.
    """
    wanted = batch if key_as in batch.columns else batch.withColumn(key_as, document_text(col(doc), key))
    return upsert(target, wanted.select(quoted(key_as), quoted(doc)), [key_as], run_ts, target_unique, plan)


def merge_into_catalog(batch: DataFrame, table: str, keys: tuple[str, ...], run_ts: str) -> None:
    """The same upsert on a catalog table with row-level operations (Iceberg, Delta)."""
    stored = batch.sparkSession.table(table)
    on, changed = F.lit(True), F.lit(False)
    own = [c for c in batch.columns if c in stored.columns]
    for key in keys:
        on = on & (F.col(f"{table}.`{key}`") == F.col(f"batch.`{key}`"))
    for name in own:
        changed = changed | ~F.col(f"{table}.`{name}`").eqNullSafe(F.col(f"batch.`{name}`"))
    values = {f"`{c}`": F.col(f"batch.`{c}`") for c in own}
    (
        batch.alias("batch")
        .mergeInto(table, on)
        .whenMatched(changed)
        .update({**values, UPDATED_AT: ntz(run_ts)})
        .whenNotMatched()
        .insert({**values, INSERTED_AT: ntz(run_ts), UPDATED_AT: F.lit(None).cast("timestamp_ntz")})
        .merge()
    )
