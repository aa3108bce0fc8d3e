"""Target tables as Spark's own bucketed tables, one for each version.

A run writes the whole target into a folder of its own, bucketed and sorted by
the key, and the ledger row of the run makes it the version readers see:

    <root>/run_id=<run>/buckets=<n>   rows, as a table of n buckets
    <root>/run_id=<run>/keyless       rows with a null in their key
    <root>/run_id=<run>/same_as=<r>   instead of both, for a run that changed nothing

Spark reads such a table without shuffling it for joins on the key, and writes it
again from such a join without shuffling it either. A run that died is written
again in place. Rows with a null key match nothing and would all lie in one
bucket, so they are plain Parquet.

Changing a row means writing its table: without row-level files there is no other
way. Targets too large for that belong in a catalog that has them
(``operators.upsert.merge_into_catalog``).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.names import quoted
from tidemark.plans import folders


@dataclass(frozen=True)
class Version:
    run_id: int
    buckets: int


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    root: str
    keys: tuple[str, ...]
    buckets: int = 8

    def version(self, run_id: int) -> Version:
        """The version that a committed run left."""
        said = dict(name.split("=") for name in folders.names(self.spark, self._place(run_id)) if "=" in name)
        if "same_as" in said:
            return self.version(int(said["same_as"]))
        return Version(run_id, int(said["buckets"]))

    def _place(self, run_id: int) -> str:
        return f"{self.root}/run_id={run_id}"

    def name(self, run_id: int) -> str:
        """The table of a run in the session's catalog; where the catalog is a shared one, other tools see it there."""
        return "tidemark_" + hashlib.md5(self._place(run_id).encode()).hexdigest()

    def _keyless_at(self, version: Version) -> str:
        return f"{self._place(version.run_id)}/keyless"

    def keyless(self, version: Version) -> DataFrame:
        """Rows with a null in their key; the declared table has their schema, so no file is opened for it."""
        return self.spark.read.schema(self.keyed(version).schema).parquet(self._keyless_at(version))

    def keyed(self, version: Version) -> DataFrame:
        """Rows with whole keys, as the bucketed table; a session that did not write it declares it first."""
        name, place = self.name(version.run_id), f"{self._place(version.run_id)}/buckets={version.buckets}"
        if not self.spark.catalog.tableExists(name):
            keys = ", ".join(quoted(k) for k in self.keys)
            # there is always a file of the keyless rows, also where there are none
            schema = self.spark.read.parquet(self._keyless_at(version)).schema
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet "
                f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {version.buckets} BUCKETS "
                f"LOCATION '{place.replace("'", "\\'")}'"
            )
        return self.spark.table(name)

    def read(self, version: Version) -> DataFrame:
        return self.keyed(version).unionByName(self.keyless(version))

    def write(self, run_id: int, keyed: DataFrame, keyless: DataFrame, buckets: int) -> Version:
        """Write the rows of a run. They are written as they lie: the caller sees that they lie by bucket."""
        self.drop(run_id)
        writer = keyed.write.format("parquet").bucketBy(buckets, *self.keys).sortBy(*self.keys)
        writer.option("path", f"{self._place(run_id)}/buckets={buckets}").saveAsTable(self.name(run_id))
        version = Version(run_id, buckets)
        keyless.select(*[quoted(c) for c in keyed.columns]).write.parquet(self._keyless_at(version))
        return version

    def keep(self, run_id: int, version: Version) -> Version:
        """A run that changed no row."""
        self.drop(run_id)
        folders.mark(self.spark, f"{self._place(run_id)}/same_as={version.run_id}")
        return version

    def drop(self, run_id: int) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(run_id)}")
        folders.remove(self.spark, self._place(run_id))
