"""The record store as it is on disk: tables of a SQLite file as a Spark data source.

    spark.dataSource.register(SqliteSource)
    spark.read.format("sqlite").option("path", file).option("table", "embedding_metadata").load()

Partitions are ranges of ``rowid`` of about equal length between the least and the greatest, which
SQLite finds in its tree, so that a task reads its rows and no others. The option ``only``, a JSON
object of columns and the values that may stand in them, goes into the statement, where an index may
serve it, and is checked again on the values as they are read. (It is an option because Spark 4.1
keeps the filters that it hands to a Python source with a DataFrame that is used again, whose next
query then misses rows.) Columns are those of the table's declaration, or of the schema that the reader is given, by
name. A file or a table that isn't there gives no rows (of the given schema, or of ``EMPTY``).

The file has to be on every machine that reads (a shared mount, or ``SparkContext.addFile`` with the
bare name as ``path``). It is opened read-only; a reader that meets a lock waits ``seconds``.

Defined results: an integer column's text or real values, which SQLite lets in, are null unless they
are whole numbers; booleans are 0 and 1, else null; a text column's numbers are their text, its blobs
their UTF-8 or null; null stays null; a table without ``rowid`` is one partition.
"""

from __future__ import annotations

import json
import os
import sqlite3
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, BooleanType, DataType, DoubleType, LongType, StringType, StructField, StructType

from findery.sources import eav

PARTS, SECONDS, ROWS, MOST_ASKED = 16, 30, 8192, 500
ENTITIES, METADATA = "embeddings", "embedding_metadata"
EMPTY = StructType([StructField("id", LongType()), StructField("key", StringType())])


def _name(x: str) -> str:
    return '"' + x.replace('"', '""') + '"'


def _kind(declared: str) -> DataType:
    """The type that a declaration stands for, by SQLite's rules of affinity; booleans by name."""
    d = declared.upper()
    if "BOOL" in d:
        return BooleanType()
    if "INT" in d:
        return LongType()
    if any(x in d for x in ("CHAR", "CLOB", "TEXT")):
        return StringType()
    if any(x in d for x in ("REAL", "FLOA", "DOUB", "NUM", "DEC")):
        return DoubleType()
    return BinaryType() if "BLOB" in d else StringType()


def _opened(path: str, seconds: float) -> sqlite3.Connection | None:
    from pyspark import SparkFiles

    place = path.removeprefix("file://") if path.startswith("file://") else path
    if not os.path.exists(place) and "/" not in place:
        place = SparkFiles.get(place)
    if not os.path.exists(place):
        return None
    return sqlite3.connect(f"file:{quote(os.path.abspath(place))}?mode=ro", uri=True, timeout=seconds)


def _value(x, kind: DataType):
    if x is None:
        return None
    if isinstance(kind, LongType):
        try:
            return int(x) if not isinstance(x, (float, bytes)) or (isinstance(x, float) and x.is_integer()) else None
        except ValueError:
            return None
    if isinstance(kind, BooleanType):
        return bool(x) if x in (0, 1) else None
    if isinstance(kind, DoubleType):
        try:
            return float(x) if not isinstance(x, bytes) else None
        except ValueError:
            return None
    if isinstance(kind, BinaryType):
        return x if isinstance(x, bytes) else str(x).encode()
    if isinstance(x, bytes):
        try:
            return x.decode()
        except UnicodeDecodeError:
            return None
    return str(x)


class Range(InputPartition):
    def __init__(self, low: int | None, high: int | None):
        """Rows with low <= rowid <= high; without numbers, all."""
        self.low, self.high = low, high


class SqliteReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.path, self.table = schema, options.get("path", ""), options.get("table", "")
        self.parts, self.seconds = int(options.get("parts", PARTS)), float(options.get("seconds", SECONDS))
        self.only: dict[str, list] = json.loads(options.get("only", "{}"))

    def _tests(self, declared: dict[str, DataType]) -> tuple[list[str], list]:
        """``only`` as SQL that lets through at least what it says: text that is a blob is seen when it is read, and columns not declared as what is asked for are left alone."""
        tests, given = [], []
        for column, values in self.only.items():
            kind = declared.get(column)
            if isinstance(kind, (StringType, LongType)) and len(values) <= MOST_ASKED and all(isinstance(v, str if isinstance(kind, StringType) else int) and not isinstance(v, bool) for v in values):
                blob = f" OR typeof({_name(column)}) = 'blob'" if isinstance(kind, StringType) else ""
                tests.append(f"({_name(column)} IN ({', '.join('?' * len(values))}){blob})")
                given += values
        return tests, given

    def _declared(self) -> dict[str, DataType]:
        db = _opened(self.path, self.seconds)
        if db is None:
            return {}
        try:
            return {name: _kind(declared) for _, name, declared, *_ in db.execute(f"PRAGMA table_info({_name(self.table)})") if declared}
        finally:
            db.close()

    def partitions(self) -> list[InputPartition]:
        db = _opened(self.path, self.seconds)
        if db is None:
            return [Range(1, 0)]
        try:
            ends = db.execute(f"SELECT (SELECT min(rowid) FROM {_name(self.table)}), (SELECT max(rowid) FROM {_name(self.table)})").fetchone()
        except sqlite3.OperationalError as e:
            if "no such table" in str(e):
                return [Range(1, 0)]
            if "rowid" not in str(e):
                raise
            return [Range(None, None)]
        finally:
            db.close()
        low, high = ends
        if low is None:
            return [Range(1, 0)]
        step = max(1, -(-(high + 1 - low) // self.parts))
        return [Range(a, min(a + step - 1, high)) for a in range(low, high + 1, step)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if partition.low is not None and partition.low > partition.high:
            return
        db = _opened(self.path, self.seconds)
        if db is None:
            return
        try:
            db.text_factory = lambda b: b.decode(errors="replace")
            there = {r[1] for r in db.execute(f"PRAGMA table_info({_name(self.table)})")}
            if not there:
                return
            declared = self._declared()
            tests, given = self._tests(declared)
            if partition.low is not None:
                tests, given = [*tests, "rowid BETWEEN ? AND ?"], [*given, partition.low, partition.high]
            own = {f.name: f.dataType for f in self.schema.fields}
            names = [*own, *(c for c in self.only if c not in own)]
            kinds = [own.get(c) or declared.get(c, StringType()) for c in names]
            columns = ", ".join(_name(c) if c in there else "NULL" for c in names) or "NULL"
            cursor = db.execute(f"SELECT {columns} FROM {_name(self.table)}" + (f" WHERE {' AND '.join(tests)}" if tests else ""), given)
            schema = to_arrow_schema(self.schema)
            while rows := cursor.fetchmany(ROWS):
                cells = [[_value(x, kind) for x in column] for column, kind in zip(zip(*rows, strict=True), kinds, strict=False)]
                keep = pa.array([all(cells[names.index(c)][i] in v for c, v in self.only.items()) for i in range(len(rows))], pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, a.type) for c, a in zip(cells, schema, strict=False)], schema=schema).filter(keep)
        finally:
            db.close()


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> StructType:
        db = _opened(self.options.get("path", ""), SECONDS)
        if db is None:
            return EMPTY
        try:
            own = db.execute(f"PRAGMA table_info({_name(self.options.get('table', ''))})").fetchall()
        finally:
            db.close()
        return StructType([StructField(name, _kind(declared)) for _, name, declared, *_ in own]) if own else EMPTY

    def reader(self, schema: StructType) -> SqliteReader:
        return SqliteReader(schema, dict(self.options))


def read_sqlite(spark: SparkSession, path: str, parts: int = PARTS, entities: str = ENTITIES, metadata: str = METADATA, keys: list[str] | None = None, ids: list[int] | None = None) -> tuple[DataFrame, DataFrame]:
    """``entities`` (id, embedding_id) and ``entity_metadata`` of a store's file, for ``eav.records`` and ``eav.issuers``; no rows where there is no file. ``keys``, ``ids``: the metadata keys and the entities that are read."""
    spark.dataSource.register(SqliteSource)
    own = {} if ids is None else {"id": ids}

    def get(table: str, shape: str, only: dict) -> DataFrame:
        return spark.read.format("sqlite").schema(shape).options(path=path, table=table, parts=str(parts), only=json.dumps(only)).load()

    rows = get(metadata, "id long, key string, string_value string, int_value long, float_value double, bool_value boolean", own | ({} if keys is None else {"key": keys}))
    return get(entities, "id long, embedding_id string", own), rows


def issuers(spark: SparkSession, path: str, parts: int = PARTS) -> DataFrame:
    """The issuers of a store's file, whose other keys aren't read."""
    return eav.issuers(read_sqlite(spark, path, parts, keys=["issuer"])[1])
