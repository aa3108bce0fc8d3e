"""Column catalogs, type mapping and schema drift.

A catalog holds ``(object, column_name, data_type, ordinal_position)`` for all
objects of a control file at once, so each step is one pass however many
objects there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.names import AUDIT_COLUMNS, col, whole_key

CATALOG_SCHEMA = "object string, column_name string, data_type string, ordinal_position long"


def catalog_of(spark: SparkSession, frames: dict[str, DataFrame]) -> DataFrame:
    """Catalog of DataFrames: names and types only, no data is read."""
    rows = [
        (name, field.name, field.dataType.simpleString(), at)
        for name, df in frames.items()
        for at, field in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def document_catalog(docs: DataFrame, name: str, doc: str = "doc") -> DataFrame:
    """Catalog of a collection: the fields of all its documents, with the type that holds all of a field's values.

    One aggregate by field name, folded in the map tasks; types of nested objects and
    arrays are merged field by field. Fields come in the order of their names, as documents
    have none. Also gives ``documents``, how many hold the field with a value. What is no
    object has no fields.
    """
    fields = docs.lateralJoin(docs.sparkSession.tvf.variant_explode(col(doc).outer())).where("key IS NOT NULL")
    held = F.count_if(~F.is_variant_null(col("value")))
    found = fields.groupBy(col("key").alias("column_name")).agg(
        F.lower(F.schema_of_variant_agg("value")).alias("data_type"), held.alias("documents")
    )
    # as many rows as a document has fields
    place = F.row_number().over(Window.orderBy("column_name")).cast("long")
    return found.select(F.lit(name).alias("object"), "column_name", "data_type", place.alias("ordinal_position"), "documents")


def listed_columns(catalog: DataFrame, names: list[str] | None) -> DataFrame:
    """Rows of the named columns; None keeps all."""
    return catalog if names is None else catalog.filter(col("column_name").isin(list(names)))


def wanted_columns(catalog: DataFrame, wanted: DataFrame) -> DataFrame:
    """The same for many objects: ``wanted(object, column_name)`` lists what each keeps.

    An object with the column name '*' keeps everything.
    """
    pairs = wanted.select("object", "column_name").distinct()
    exact = catalog.join(pairs, ["object", "column_name"], "left_semi")
    every = pairs.filter(col("column_name") == "*").select("object").distinct()
    rest = catalog.join(pairs, ["object", "column_name"], "left_anti").alias("r")
    rest = rest.filter(col("object").isNotNull())
    # one object may hold much of the catalog
    return exact.unionByName(
        rest.join(every.alias("e"), whole_key(["object"], "r") == whole_key(["object"], "e"), "left_semi")
    )


def _is_audit() -> Column:
    return F.lower(col("column_name")).isin(*AUDIT_COLUMNS)


def target_columns(catalog: DataFrame) -> DataFrame:
    """Columns of each target in ordinal order, audit columns left out."""
    return catalog.filter(~_is_audit()).orderBy("object", "ordinal_position")


def map_types(
    catalog: DataFrame,
    mapping: DataFrame | None,
    dialect: str,
    fallback: str | None = "varchar",
) -> DataFrame:
    """Adds ``warehouse_type``: the first mapping row of the dialect with that name, whatever its case.

    ``mapping`` is what ``functions.types.read_mapping`` gives, of any length;
    the least ``row_no`` of a name wins. Types without a row get ``fallback``;
    with None the query fails on the first such type. Without a mapping, source
    types are kept as they are.
    """
    if mapping is None:
        return catalog.withColumn("warehouse_type", col("data_type"))
    known = (
        mapping.filter(col("dialect") == dialect)
        .groupBy(F.lower("source_type").alias("__name"))
        .agg(F.min_by("warehouse_type", "row_no").alias("__mapped"))
        .alias("m")
    )
    # a common type may hold much of the catalog
    named = catalog.withColumn("__name", F.lower("data_type")).alias("c")
    joined = named.join(known, whole_key(["__name"], "c") == whole_key(["__name"], "m"), "left")
    if fallback is None:
        unmapped = F.raise_error(F.concat(F.lit("no mapping for type "), col("data_type"))).cast("string")
    else:
        unmapped = F.lit(fallback)
    mapped = F.coalesce(col("__mapped"), unmapped)
    return joined.select("c.*", mapped.alias("warehouse_type")).drop("__name")


def target_schema(mapped: DataFrame) -> DataFrame:
    """Target columns of each object: its mapped columns, then the two audit columns."""
    own = mapped.select("object", "column_name", "warehouse_type", "ordinal_position")
    audit = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.lit(at).cast("long").alias("offset"))
            for at, name in enumerate(AUDIT_COLUMNS, start=1)
        ]
    )
    added = (
        own.groupBy("object")
        .agg(F.max("ordinal_position").alias("last"))
        .select("object", "last", F.inline(audit))
        .select(
            "object",
            "column_name",
            F.lit("timestamp_ntz").alias("warehouse_type"),
            (col("last") + col("offset")).alias("ordinal_position"),
        )
    )
    return own.unionByName(added)


def _sides(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row per object and case-folded column name, with the side it is on.

    Union and aggregate, not a join: repeated names collapse before the shuffle
    and no object can overload one task's join buffer.
    """
    tagged = source.select(
        "object", F.lower("column_name").alias("column_name"), "data_type", F.lit(True).alias("s"), F.lit(False).alias("t")
    ).unionByName(
        target.filter(~_is_audit()).select(
            "object", F.lower("column_name").alias("column_name"), "data_type", F.lit(False).alias("s"), F.lit(True).alias("t")
        )
    )
    return tagged.groupBy("object", "column_name").agg(
        F.bool_or("s").alias("in_source"),
        F.bool_or("t").alias("in_target"),
        F.min(F.when(col("s"), col("data_type"))).alias("source_type"),
    )


def schema_drift(source: DataFrame, target: DataFrame) -> DataFrame:
    """Columns on one side only: 'added' in the source or 'missing' from it."""
    return (
        _sides(source, target)
        .filter(col("in_source") != col("in_target"))
        .select(
            "object",
            "column_name",
            F.when(col("in_source"), "added").otherwise("missing").alias("change"),
            "source_type",
        )
    )


def drift_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Column counts per object and side, with the number of differences each way."""
    return (
        _sides(source, target)
        .groupBy("object")
        .agg(
            F.count_if(col("in_source")).alias("source_columns"),
            F.count_if(col("in_target")).alias("target_columns"),
            F.count_if(col("in_source") & ~col("in_target")).alias("added"),
            F.count_if(col("in_target") & ~col("in_source")).alias("missing"),
        )
    )


def add_columns(target: DataFrame, types: dict[str, str]) -> DataFrame:
    """Target with new null columns, placed before the audit columns."""
    known = {c.lower() for c in target.columns}
    fresh = [F.lit(None).cast(t).alias(n) for n, t in types.items() if n.lower() not in known]
    own = [col(c) for c in target.columns if c not in AUDIT_COLUMNS]
    return target.select(*own, *fresh, *[col(c) for c in AUDIT_COLUMNS if c in target.columns])


def drop_missing_columns(target: DataFrame, source_columns: list[str]) -> DataFrame:
    """Target without the columns the source no longer has."""
    keep = {c.lower() for c in source_columns} | set(AUDIT_COLUMNS)
    return target.select(*[col(c) for c in target.columns if c.lower() in keep])
