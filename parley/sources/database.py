"""Tables of an SQLite file as a data source, read by the standard library: no driver, read only, in key ranges.

    spark.dataSource.register(Database)
    spark.read.format("database").option("path", file).option("table", "users").load()

Columns are those of the schema that the caller gives, or all with their declared types. In the format ``database_pushed`` filters on columns go into the
file's own query (Spark then wants spark.sql.python.filterPushdown.enabled). Each task
reads one range of row ids, ``partitions`` (8) for each file, so a large table is no one task's work. Files have to be
in a folder that the executors share; several files (``path`` with a pattern) are one table.
"""

from __future__ import annotations

import glob
import os
import sqlite3
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlparse

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

#: Rows that are fetched at a time.
FETCH = 5000


def plain(path: str) -> str:
    """A file: address as a path; anything else as it is."""
    return urlparse(path).path if path.startswith("file:") else path


def connect(path: str) -> sqlite3.Connection:
    """Read only; a file that isn't there is an error rather than a new, empty one."""
    return sqlite3.connect(f"file:{quote(path)}?mode=ro", uri=True)


def name(identifier: str) -> str:
    return '"' + identifier.replace('"', '""') + '"'


def spark_type(declared: str):
    """By SQLite's rule of affinity."""
    d = (declared or "").upper()
    if "BOOL" in d:
        return BooleanType()
    if "INT" in d:
        return LongType()
    if any(x in d for x in ("CHAR", "CLOB", "TEXT")):
        return StringType()
    if any(x in d for x in ("REAL", "FLOA", "DOUB", "NUMERIC", "DECIMAL")):
        return DoubleType()
    return BinaryType() if "BLOB" in d else StringType()


def seen(column: str, kind) -> str:
    """A column as ``typed`` gives it; a real number in a text column aside."""
    c = name(column)
    if isinstance(kind, StringType):
        return f"CASE WHEN typeof({c}) <> 'blob' THEN CAST({c} AS TEXT) END"
    if isinstance(kind, BooleanType):
        return f"CASE WHEN typeof({c}) IN ('integer', 'real') THEN {c} <> 0 END"
    kinds = {LongType: "'integer'", DoubleType: "'integer', 'real'", BinaryType: "'blob'"}[type(kind)]
    return f"CASE WHEN typeof({c}) IN ({kinds}) THEN {c} END"


def condition(f: Filter, types: dict[str, object]) -> tuple[str, list] | None:
    """A filter as SQL with its values, or None if it stays with Spark. SQLite keeps values of any type in a column and would compare them its own
    way, so it compares what Spark sees of them (``seen``), with values of the column's kind. Texts compare by UTF-8 bytes in both."""
    if isinstance(f, Not):
        inner = condition(f.child, types)
        return inner and (f"NOT ({inner[0]})", inner[1])
    path = f.attribute
    if len(path) != 1 or path[0] not in types:
        return None
    kind = types[path[0]]
    column = seen(path[0], kind)
    fits = lambda v: isinstance(v, bool) if isinstance(kind, BooleanType) else isinstance(v, (int, float)) and not isinstance(v, bool) and v == v if isinstance(kind, (LongType, DoubleType)) else isinstance(v, str) and isinstance(kind, StringType)
    if isinstance(f, IsNull):
        return f"{column} IS NULL", []
    if isinstance(f, IsNotNull):
        return f"{column} IS NOT NULL", []
    if isinstance(f, In):
        values = list(f.value)
        return (f"{column} IN ({', '.join('?' * len(values))})", values) if values and all(map(fits, values)) and len(values) < 500 else None
    if not fits(f.value):
        return None
    if isinstance(f, EqualNullSafe):
        return f"{column} IS ?", [f.value]
    for cls, op in ((EqualTo, "="), (GreaterThanOrEqual, ">="), (GreaterThan, ">"), (LessThanOrEqual, "<="), (LessThan, "<")):
        if isinstance(f, cls):
            return f"{column} {op} ?", [f.value]
    if isinstance(kind, StringType):
        if isinstance(f, StringStartsWith):
            return f"substr({column}, 1, ?) = ?", [len(f.value), f.value]
        if isinstance(f, StringEndsWith):
            return f"(? = 0 OR substr({column}, -?) = ?)", [len(f.value), len(f.value), f.value]
        if isinstance(f, StringContains):
            return f"instr({column}, ?) > 0", [f.value]
    return None


def written(rows: DataFrame, folder: str, table: str) -> int:
    """Write ``rows`` (numbers, texts, booleans, bytes) to SQLite files under ``folder``, one for each partition; how many rows. A file gets its name
    when it is whole, the same one whenever its task is run again."""
    columns = [f.name for f in rows.schema]
    declared = {BooleanType: "BOOLEAN", LongType: "INTEGER", DoubleType: "REAL", BinaryType: "BLOB"}
    fields = ", ".join(f"{name(f.name)} {declared.get(type(f.dataType), 'INTEGER' if isinstance(f.dataType, IntegerType) else 'TEXT')}" for f in rows.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        os.makedirs(folder, exist_ok=True)
        whole = f"{folder}/part-{task.partitionId():05d}.db"
        part = f"{whole}-{task.taskAttemptId()}"
        n, con = 0, sqlite3.connect(part)
        con.execute(f"CREATE TABLE {name(table)} ({fields})")
        for b in batches:
            con.executemany(f"INSERT INTO {name(table)} VALUES ({', '.join('?' * len(columns))})", zip(*(c.to_pylist() for c in b.columns)))
            n += b.num_rows
        con.commit()
        con.close()
        os.replace(part, whole)
        yield pa.RecordBatch.from_pydict({"n": [n]})

    return rows.mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


@dataclass
class Range(InputPartition):
    """Rows of one file whose row ids are from ``low`` to ``high``, both included; all rows of a table without row ids."""

    path: str
    low: int | None
    high: int | None


class RangeReader(DataSourceReader):
    def __init__(self, files: list[str], table: str, schema: StructType, parts: int) -> None:
        self.files, self.table, self.columns, self.parts = files, table, schema, parts
        self.where: list[tuple[str, list]] = []

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for path in self.files:
            with connect(path) as con:
                try:
                    low, high = con.execute(f"SELECT min(rowid), max(rowid) FROM {name(self.table)}").fetchone()
                except sqlite3.OperationalError:  # a table without row ids, or a view
                    con.execute(f"SELECT 1 FROM {name(self.table)} LIMIT 1")
                    out.append(Range(path, None, None))
                    continue
            if low is None:
                continue
            step = max(1, -(-(high - low + 1) // self.parts))
            out += [Range(path, a, min(a + step - 1, high)) for a in range(low, high + 1, step)]
        return out or [Range("", None, None)]

    def read(self, partition: Range) -> Iterator[tuple]:
        if not partition.path:
            return
        where, values = [f"({w})" for w, _ in self.where], [v for _, vs in self.where for v in vs]
        if partition.low is not None:
            where.append("rowid BETWEEN ? AND ?")
            values += [partition.low, partition.high]
        sql = f"SELECT {', '.join(name(f.name) for f in self.columns) or '1'} FROM {name(self.table)}" + (f" WHERE {' AND '.join(where)}" if where else "")
        kinds = [f.dataType for f in self.columns]
        con = connect(partition.path)
        try:
            cursor = con.execute(sql, values)
            while rows := cursor.fetchmany(FETCH):
                for row in rows:
                    yield tuple(None if v is None else typed(v, k) for v, k in zip(row, kinds))
        finally:
            con.close()


def typed(value, kind):
    """A stored value in its column's type. SQLite keeps what it was given: what is no such value is null."""
    if isinstance(kind, BooleanType):
        return bool(value) if isinstance(value, (int, float)) else None
    if isinstance(kind, LongType):
        return value if isinstance(value, int) else None
    if isinstance(kind, DoubleType):
        return float(value) if isinstance(value, (int, float)) else None
    if isinstance(kind, BinaryType):
        return value if isinstance(value, bytes) else None
    return value if isinstance(value, str) else None if isinstance(value, bytes) else str(value)


class DatabaseReader(RangeReader):
    """With filters in the file's query."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        types = {f.name: f.dataType for f in self.columns}
        for f in filters:
            made, of = condition(f, types), f
            while isinstance(of, Not):
                of = of.child
            loose = isinstance(types.get(of.attribute[0]), StringType)
            if made is None or loose:
                yield f  # Spark's to apply; real numbers in a text column are written as each of the two does
            if made is not None:
                self.where.append((f"typeof({name(of.attribute[0])}) = 'real' OR ({made[0]})", made[1]) if loose else made)


class Database(DataSource):
    kind = RangeReader

    @classmethod
    def name(cls) -> str:
        return "database"

    def _files(self) -> list[str]:
        found = sorted(glob.glob(plain(self.options["path"])))
        if not found:
            raise FileNotFoundError(self.options["path"])
        return found

    def schema(self) -> StructType:
        with connect(self._files()[0]) as con:
            rows = con.execute(f"PRAGMA table_info({name(self.options['table'])})").fetchall()
        if not rows:
            raise ValueError(f"no table {self.options['table']}")
        return StructType([StructField(r[1], spark_type(r[2])) for r in rows])

    def reader(self, schema: StructType) -> DataSourceReader:
        return self.kind(self._files(), self.options["table"], schema, int(self.options.get("partitions", "8")))


class PushedDatabase(Database):
    """The same with filters in the files' queries; Spark wants spark.sql.python.filterPushdown.enabled for it."""

    kind = DatabaseReader

    @classmethod
    def name(cls) -> str:
        return "database_pushed"
