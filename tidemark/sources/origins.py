"""Where the objects of a control file live.

An origin opens one object as a lazy DataFrame. ``declared`` gives the storage
types of its columns where the source names types of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.types import storage_type
from tidemark.operators.catalog import map_types
from tidemark.sources.documents import as_documents, read_documents
from tidemark.sources.files import read_object
from tidemark.sources.jdbc import JdbcSource
from tidemark.spec import LoadSpec


@dataclass(frozen=True)
class JdbcOrigin:
    """Tables of one server; each control row names its database.

    ``mapping`` is a table of ``functions.types.read_mapping``. With it, columns
    are stored as it says, and a type it does not name is refused, or taken as
    ``unmapped``. Without it, columns keep the types that JDBC reads.
    """

    source: JdbcSource
    mapping: DataFrame | None = None
    unmapped: str | None = None

    def open(self, spark: SparkSession, spec: LoadSpec, name: str, since: str | None = None) -> DataFrame:
        times = spec.times if name == spec.object_name else spec.times[:1]
        keys = spec.keys if name == spec.object_name else ()
        columns = spec.columns if name == spec.object_name else None
        return self.source.read(spark, spec.database, spec.schema, name, columns, keys, times, since)

    def declared(self, spark: SparkSession, spec: LoadSpec) -> dict[str, str] | None:
        """One row per column of one object."""
        if self.mapping is None:
            return None
        catalog = self.source.catalog(spark, spec.database, spec.schema, spec.object_name)
        mapped = map_types(catalog, self.mapping, self.source.kind.upper(), self.unmapped)
        return declared_types(mapped.orderBy("ordinal_position").collect(), spec.columns)


def declared_types(rows: list, columns: tuple[str, ...] | None) -> dict[str, str]:
    """Storage type by column: those of the control row under its names, else all."""
    types = {
        row["column_name"]: storage_type(row["warehouse_type"], row["numeric_precision"], row["numeric_scale"])
        for row in rows
    }
    if columns is None:
        return types
    folded = {name.lower(): dtype for name, dtype in types.items()}
    missing = [name for name in columns if name.lower() not in folded]
    if missing:
        raise ValueError(f"columns not in the source's catalog: {missing}")
    return {name: folded[name.lower()] for name in columns}


@dataclass(frozen=True)
class TableOrigin:
    """Tables kept as folders of Parquet (or another Spark format) below a root.

    ``types`` gives storage types, by object and column, as a catalog would.
    """

    root: str
    kind: str = "parquet"
    types: dict[str, dict[str, str]] | None = None

    def open(self, spark: SparkSession, spec: LoadSpec, name: str, since: str | None = None) -> DataFrame:
        return spark.read.format(self.kind).load(f"{self.root}/{name}")

    def declared(self, spark: SparkSession, spec: LoadSpec) -> dict[str, str] | None:
        return (self.types or {}).get(spec.object_name)


@dataclass(frozen=True)
class FileOrigin:
    """Tabular files found below a root by object name; CSV without a schema is text, typed as it is staged."""

    root: str
    kind: str = "csv"
    schema: str | None = None

    @property
    def infers(self) -> bool:
        return self.kind == "csv" and self.schema is None

    def open(self, spark: SparkSession, spec: LoadSpec, name: str, since: str | None = None) -> DataFrame:
        return read_object(spark, self.root, name, self.kind, self.schema, as_text=self.infers)

    def declared(self, spark: SparkSession, spec: LoadSpec) -> None:
        return None


@dataclass(frozen=True)
class DocumentOrigin:
    """Exported collections, one folder of JSON files each."""

    root: str
    json_array: bool = False

    def open(self, spark: SparkSession, spec: LoadSpec, name: str, since: str | None = None) -> DataFrame:
        return read_documents(spark, f"{self.root}/{name}", self.json_array)

    def declared(self, spark: SparkSession, spec: LoadSpec) -> None:
        return None


@dataclass(frozen=True)
class ConnectorOrigin:
    """Collections read through a Spark connector for a document database.

    ``kind`` is its format; ``name_option`` the option that takes the collection.
    Rows that come as columns are put together as documents.
    """

    kind: str
    options: dict[str, str]
    name_option: str = "collection"

    def open(self, spark: SparkSession, spec: LoadSpec, name: str, since: str | None = None) -> DataFrame:
        return as_documents(spark.read.format(self.kind).options(**self.options, **{self.name_option: name}).load())

    def declared(self, spark: SparkSession, spec: LoadSpec) -> None:
        return None
