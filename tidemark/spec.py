"""One control row = one object to load."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from tidemark.names import split_names

# Header of a control file, in file order.
CONTROL_COLUMNS = [
    "CONTROL_ID",
    "SRC_DB_NAME",
    "DATABASE_NAME",
    "SCHEMA_NAME",
    "OBJ_TYPE",
    "OBJ_NAME",
    "INSRT_TIME_COL",
    "UPDT_TIME_COL",
    "PRIMARY_KEY_COL",
    "COL_NAMES",
    "IS_DELETION",
    "DELETED_TBL",
    "SF_TBL",
]

CONTROL_SCHEMA = T.StructType(
    [
        T.StructField(name, T.IntegerType() if name == "CONTROL_ID" else T.StringType())
        for name in CONTROL_COLUMNS
    ]
)


def _absent(value: str | None) -> bool:
    return value is None or value.strip() in ("", "-")


@dataclass(frozen=True)
class LoadSpec:
    control_id: int
    source: str
    database: str
    schema: str
    object_type: str
    object_name: str
    inserted_col: str | None
    updated_col: str | None
    keys: tuple[str, ...]
    columns: tuple[str, ...] | None
    deleted_object: str | None
    target: str

    @classmethod
    def from_control(cls, row: dict) -> "LoadSpec":
        columns = row["COL_NAMES"]
        every = _absent(columns) or columns.strip() == "*"
        deletes = (row["IS_DELETION"] or "").strip().lower() == "yes"
        return cls(
            control_id=row["CONTROL_ID"],
            source=(row["SRC_DB_NAME"] or "-").strip().lower(),
            database="-" if _absent(row["DATABASE_NAME"]) else row["DATABASE_NAME"].strip(),
            schema="-" if _absent(row["SCHEMA_NAME"]) else row["SCHEMA_NAME"].strip(),
            object_type=(row["OBJ_TYPE"] or "").strip().lower(),
            object_name=row["OBJ_NAME"],
            inserted_col=None if _absent(row["INSRT_TIME_COL"]) else row["INSRT_TIME_COL"].strip(),
            updated_col=None if _absent(row["UPDT_TIME_COL"]) else row["UPDT_TIME_COL"].strip(),
            keys=tuple(split_names(row["PRIMARY_KEY_COL"])),
            columns=None if every else tuple(split_names(columns)),
            deleted_object=row["DELETED_TBL"] if deletes and not _absent(row["DELETED_TBL"]) else None,
            target=row["SF_TBL"],
        )

    @property
    def is_file(self) -> bool:
        return self.object_type == "file"

    @property
    def is_documents(self) -> bool:
        return self.object_type == "collection"

    @property
    def has_modified_time(self) -> bool:
        return bool(self.times)

    @property
    def times(self) -> tuple[str, ...]:
        """The insert and update columns there are, each once."""
        return tuple(dict.fromkeys(c for c in (self.inserted_col, self.updated_col) if c))

    @property
    def identity(self) -> tuple[str, str, str]:
        """Database, schema and object: two objects of one name keep separate marks."""
        if self.is_file:
            return ("-", "-", self.object_name)
        return (self.database, self.schema, self.object_name)
