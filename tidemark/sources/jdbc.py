"""Relational sources over JDBC, read in parallel."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.names import split_names

# Driver class per source name.
DRIVERS = {
    "sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "postgresql": "org.postgresql.Driver",
    "hive2": "org.apache.hive.jdbc.HiveDriver",
}
_QUOTES = {"sqlserver": ("[", "]"), "postgresql": ('"', '"'), "hive2": ("`", "`")}
#: engines that bring all rows of a window without partitions together in one task
_ONE_TASK_WINDOWS = {"hive2"}
_WALL_TIMES = {"sqlserver": "DATETIME2", "postgresql": "TIMESTAMP", "hive2": "TIMESTAMP_NTZ"}


#: types whose values a database and a literal put in the same order
_ORDERED = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.StringType
)

_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: values that one count by steps of a number may give
_STEPS = 4000


@dataclass(frozen=True)
class _Cell:
    """Neighbouring rows that hold cuts: the condition they meet, their number, and the places of the cuts among them."""

    condition: str
    rows: int
    places: tuple[int, ...]

    def part(self, condition: str, rows: int, upto: int) -> _Cell:
        before = int(upto) - int(rows)
        inside = tuple(place - before for place in self.places if before < place <= int(upto))
        return _Cell(f"{self.condition} AND {condition}" if self.condition else condition, int(rows), inside)


def _any_of(cells: list[_Cell]) -> str:
    return " OR ".join(f"({c.condition})" if c.condition else "1 = 1" for c in cells)


def _numbered(cells: list[_Cell]) -> str:
    whens = " ".join(f"WHEN {c.condition or '1 = 1'} THEN {at}" for at, c in enumerate(cells))
    return f"CASE {whens} END"


def _steps(key: str, dtype: T.DataType) -> list[tuple[str, T.DataType]]:
    """Values that rise with a column, from coarse to fine; those of whole numbers follow from their extent."""
    if isinstance(dtype, T.StringType):
        return []
    if isinstance(dtype, T.TimestampNTZType):
        return [(f"CAST({key} AS DATE)", T.DateType()), (f"HOUR({key}) * 60 + MINUTE({key})", T.IntegerType()), (key, dtype)]
    if isinstance(dtype, T.TimestampType):  # the clock of a zone may go back
        seconds = f"UNIX_TIMESTAMP({key})"
        return [(f"FLOOR({seconds} / 86400)", T.LongType()), (seconds, T.LongType())]
    return [(key, dtype)]


def _width(least, greatest) -> int:
    """Width of the first steps between two numbers; later ones divide it again."""
    return 1 if least is None else (int(greatest) - int(least)) // _STEPS + 1


@dataclass(frozen=True)
class JdbcSource:
    """Where and how to read; the password stays in the environment.

    ``url`` may hold ``{database}``, which each control row fills in. A read is
    split into ``partitions`` ranges that hold as many rows each: the database says
    where they meet, from the insert time and the keys of the object, over the rows
    that will be read. With one partition, or no column that can be ordered, JDBC
    reads through one connection.
    """

    kind: str
    url: str
    user: str
    password_env: str
    partitions: int = 1
    fetch_size: int = 10_000
    # rows that are put in order at once to find a cut, where a window over all rows would run in one task
    cell_rows: int = 100_000

    def connection_options(self, database: str | None = None) -> dict[str, str]:
        return {
            "url": self.url.replace("{database}", database or ""),
            "user": self.user,
            "password": os.environ.get(self.password_env, ""),
            "driver": DRIVERS[self.kind],
            "fetchsize": str(self.fetch_size),
            # times without a zone are read as such: the session zone must not shift them
            "preferTimestampNTZ": "true",
        }

    def _name(self, name: str) -> str:
        left, right = _QUOTES[self.kind]
        return left + name.replace(right, right + right) + right

    def select_text(self, schema: str, name: str, columns: str | list[str] | tuple[str, ...] | None) -> str:
        if columns is None or columns == "*":
            listed = "*"
        else:
            names = split_names(columns) if isinstance(columns, str) else columns
            listed = ", ".join(self._name(n) for n in names)
        return f"SELECT {listed} FROM {self._name(schema)}.{self._name(name)}"

    def read_options(self, query: str, database: str | None = None) -> dict[str, str]:
        """Options of one read of a query, as a subquery table."""
        return {**self.connection_options(database), "dbtable": f"({query}) src"}

    def range_columns(self, schema: T.StructType, keys: tuple[str, ...], times: tuple[str, ...]) -> list[T.StructField]:
        """The insert time and the keys, as far as they can be ordered: rows of one time are told apart by key."""
        fields = {f.name.lower(): f for f in schema.fields}
        named = dict.fromkeys(name.lower() for name in (*times[:1], *keys))
        return [fields[n] for n in named if n in fields and isinstance(fields[n].dataType, _ORDERED)]

    def cuts_query(
        self, query: str, columns: list[T.StructField], times: tuple[str, ...] = (), since: str | None = None
    ) -> str:
        """The first row of every range but the first, by number of rows and not by value, over the rows to read."""
        names = [self._name(f.name) for f in columns]
        given = ", ".join(f"{name} AS k{at}" for at, name in enumerate(names))
        order = ", ".join(names)
        whole = " AND ".join(f"{name} IS NOT NULL" for name in names)
        later = " OR ".join(f"{self._name(t)} > '{_literal(since)}'" for t in times) if since else ""
        where = f"{whole} AND ({later})" if later else whole
        keys = ", ".join(f"k{at}" for at in range(len(names)))
        tiles = f"SELECT {given}, NTILE({self.partitions}) OVER (ORDER BY {order}) AS tile FROM ({query}) src WHERE {where}"
        firsts = f"SELECT {keys}, tile, ROW_NUMBER() OVER (PARTITION BY tile ORDER BY {keys}) AS place FROM ({tiles}) tiles"
        return f"SELECT {keys}, tile FROM ({firsts}) firsts WHERE place = 1 AND tile > 1"

    def _rows_to_cut(self, query: str, columns: list[T.StructField], times: tuple[str, ...], since: str | None) -> str:
        """The range columns, as ``k0`` and on, of the rows to read that have them all."""
        names = [self._name(f.name) for f in columns]
        given = ", ".join(f"{name} AS k{at}" for at, name in enumerate(names))
        whole = " AND ".join(f"{name} IS NOT NULL" for name in names)
        later = " OR ".join(f"{self._name(t)} > '{_literal(since)}'" for t in times) if since else ""
        return f"SELECT {given} FROM ({query}) src WHERE {f'{whole} AND ({later})' if later else whole}"

    def step_query(self, rows: str, step: str, cells: list[_Cell]) -> str:
        """The values of a step at which places of the cells lie, with their rows and the rows of the cell before them."""
        parts = f"SELECT {_numbered(cells)} AS cell, {step} AS step FROM ({rows}) q WHERE {_any_of(cells)}"
        counted = f"SELECT cell, step, COUNT(*) AS n FROM ({parts}) parts GROUP BY cell, step"
        upto = "SUM(n) OVER (PARTITION BY cell ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        summed = f"SELECT cell, step, n, {upto} AS upto FROM ({counted}) counted"
        held = " OR ".join(
            f"(cell = {at} AND upto >= {place} AND upto - n < {place})" for at, c in enumerate(cells) for place in c.places
        )
        return f"SELECT cell, step, n, upto FROM ({summed}) summed WHERE {held}"

    def placed_query(self, rows: str, columns: list[T.StructField], cells: list[_Cell]) -> str:
        """The rows at the places of the cells, counted within each cell."""
        keys = ", ".join(f"k{at}" for at in range(len(columns)))
        parts = f"SELECT {keys}, {_numbered(cells)} AS cell FROM ({rows}) q WHERE {_any_of(cells)}"
        placed = f"SELECT {keys}, cell, ROW_NUMBER() OVER (PARTITION BY cell ORDER BY {keys}) AS place FROM ({parts}) parts"
        wanted = " OR ".join(f"(cell = {at} AND place IN ({', '.join(map(str, c.places))}))" for at, c in enumerate(cells))
        return f"SELECT {keys}, cell, place FROM ({placed}) placed WHERE {wanted}"

    def cuts(
        self,
        spark: SparkSession,
        database: str,
        query: str,
        columns: list[T.StructField],
        times: tuple[str, ...] = (),
        since: str | None = None,
    ) -> list[tuple]:
        """The first row of every range but the first; one row for each reaches the driver."""

        def ask(text: str) -> list:
            return self._load(spark, self.read_options(text, database)).collect()

        if self.kind in _ONE_TASK_WINDOWS:
            return self._cuts_by_steps(ask, self._rows_to_cut(query, columns, times, since), columns)
        found = ask(self.cuts_query(query, columns, times, since))
        return [tuple(row)[:-1] for row in sorted(found, key=lambda row: row["tile"])]

    def _cuts_by_steps(self, ask: Callable[[str], list], rows: str, columns: list[T.StructField]) -> list[tuple]:
        """The same rows as ``cuts_query`` finds, without a window over all rows.

        Rows are counted by coarse values of the range columns; only the cells that
        hold a cut are counted by finer ones, until no cell has more than
        ``cell_rows`` rows. Those are put in order, cell by cell. Decimals are
        counted by value; rows that differ in a text alone stay one cell.
        """
        total = ask(f"SELECT COUNT(*) AS n FROM ({rows}) q")[0]["n"]
        size, more = divmod(total, self.partitions)
        places = [tile * size + min(tile, more) + 1 for tile in range(1, min(self.partitions, total))]
        if not places:
            return []
        cells = [_Cell("", total, tuple(places))]
        for at, column in enumerate(columns):
            key, dtype = f"k{at}", column.dataType
            steps = _steps(key, dtype)
            if isinstance(dtype, _NUMBERS) and any(c.rows > self.cell_rows for c in cells):
                extent = f"SELECT MIN({key}) AS least, MAX({key}) AS greatest FROM ({rows}) q WHERE {_any_of(cells)}"
                width, coarse = _width(*ask(extent)[0]), []
                while width > 1:
                    coarse.append((f"FLOOR({key} / {width})", T.LongType()))
                    width //= _STEPS
                steps = coarse + steps
            for step, kind in steps:
                if all(c.rows <= self.cell_rows for c in cells):
                    break
                found = sorted(ask(self.step_query(rows, step, cells)), key=lambda row: (row["cell"], row["step"]))
                cells = [cells[r["cell"]].part(f"{step} = {self._value(r['step'], kind)}", r["n"], r["upto"]) for r in found]
            if not steps or steps[-1][0] != key:
                break  # rows of a cell may differ in this column still
        found = ask(self.placed_query(rows, columns, cells)) if cells else []
        return [tuple(row)[: len(columns)] for row in sorted(found, key=lambda row: (row["cell"], row["place"]))]

    def _value(self, value, dtype: T.DataType) -> str:
        if isinstance(dtype, T.StringType):
            return f"{'N' if self.kind == 'sqlserver' else ''}'{_literal(value)}'"
        if isinstance(dtype, T.DateType):
            return f"CAST('{value}' AS DATE)"
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            return f"CAST('{value}' AS {_WALL_TIMES[self.kind]})"
        return str(value)

    def _from(self, columns: list[T.StructField], cut: tuple) -> str:
        """Rows at or after a cut, column by column."""
        found = ""
        for at in reversed(range(len(columns))):
            name, value = self._name(columns[at].name), self._value(cut[at], columns[at].dataType)
            found = f"({name} > {value} OR ({name} = {value} AND {found}))" if found else f"{name} >= {value}"
        return found

    def range_predicates(self, columns: list[T.StructField], cuts: list[tuple]) -> list[str]:
        """One condition a task; each row meets exactly one. Rows with a null in the columns are a range of their own."""
        names = [self._name(f.name) for f in columns]
        whole = " AND ".join(f"{name} IS NOT NULL" for name in names)
        starts = [self._from(columns, cut) for cut in dict.fromkeys(cuts)]
        ranges = [
            " AND ".join([whole, *([low] if low else []), *([f"NOT ({high})"] if high else [])])
            for low, high in zip([None, *starts], [*starts, None], strict=True)
        ]
        return [*ranges, " OR ".join(f"{name} IS NULL" for name in names)]

    def _load(self, spark: SparkSession, options: dict[str, str], predicates: list[str] | None = None) -> DataFrame:
        if predicates is None:
            return spark.read.format("jdbc").options(**options).load()
        more = {name: value for name, value in options.items() if name not in ("url", "dbtable")}
        return spark.read.jdbc(options["url"], options["dbtable"], predicates=predicates, properties=more)

    def read(
        self,
        spark: SparkSession,
        database: str,
        schema: str,
        name: str,
        columns=None,
        keys: tuple[str, ...] = (),
        times: tuple[str, ...] = (),
        since: str | None = None,
    ) -> DataFrame:
        """Lazy table; Catalyst adds filters such as the incremental predicate to the remote query.

        ``since`` is the mark that predicate will have; ranges are laid over the
        rows after it.
        """
        query = self.select_text(schema, name, columns)
        options = self.read_options(query, database)
        whole = self._load(spark, options)
        ranged = self.range_columns(whole.schema, keys, times) if self.partitions > 1 else []
        if not ranged:
            return whole
        cuts = self.cuts(spark, database, query, ranged, times, since)
        return self._load(spark, options, self.range_predicates(ranged, cuts))

    def catalog_query(self, schema: str, name: str) -> str:
        return (
            "SELECT table_name AS object, column_name, data_type, ordinal_position, numeric_precision, numeric_scale "
            "FROM information_schema.columns "
            f"WHERE table_name = '{_literal(name)}' AND table_schema = '{_literal(schema)}'"
        )

    def catalog(self, spark: SparkSession, database: str, schema: str, name: str) -> DataFrame:
        """Column names, types, positions and precisions as the source itself declares them."""
        return self._load(spark, self.read_options(self.catalog_query(schema, name), database))


def _literal(text: str) -> str:
    return text.replace("'", "''")
