"""Tables keyed by ``ord`` that follow a change set, in versions: records, and what is derived from them.

A version is a list of parts, each a written table with its number, and the tombstones that came with
it: rows of an ``ord`` in a part before the tombstone's are dead. A change set (rows that were added or
changed, whole, and ``gone``) makes a new part and its tombstones; the version that names them is
written last, so a failed change leaves the version before it, and a reader keeps what it began with.
More than ``PARTS`` parts are compacted into one. Parts may be laid out by a column (``by``): a folder
for each of its values, which filters and joins on it prune.

Defined results: a null ``ord`` takes no part; rows that share an ``ord`` are each there, and are
changed and deleted together; of a change set that deletes and adds an ``ord``, the added rows stay; an
unknown version is an error; an empty table is a version with an empty part.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from findery.scratch import few, remove_at_end, shared_dir

PARTS = 8


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def numbers(spark: SparkSession, path: str) -> list[int]:
    """Versions that were written whole."""
    fs, where = _fs(spark, f"{path}/versions")
    names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    return sorted(int(n[1:]) for n in names if n.startswith("v") and fs.exists(_fs(spark, f"{path}/versions/{n}/_SUCCESS")[1]))


@dataclass(frozen=True)
class Table:
    """A version of a table: what it reads doesn't change."""

    spark: SparkSession
    path: str
    version: int
    parts: tuple[tuple[int, str], ...]
    schema: StructType
    by: str | None = None

    def _part(self, name: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/parts/{name}/rows")

    def read(self) -> DataFrame:
        """The live rows. Without tombstones, no join."""
        each = [self._part(name, self.schema).withColumn("_part", F.lit(n)) for n, name in self.parts]
        rows = each[0]
        for x in each[1:]:
            rows = rows.unionByName(x)
        later = [self.spark.read.schema("ord long").parquet(f"{self.path}/parts/{name}/gone").select(F.col("ord").alias("_gone"), F.lit(n).alias("_upto")) for n, name in self.parts[1:]]
        if later:
            dead = later[0]
            for x in later[1:]:
                dead = dead.unionByName(x)
            dead = dead.groupBy("_gone").agg(F.max("_upto").alias("_upto"))
            rows = rows.join(dead, (F.col("ord") == F.col("_gone")) & (F.col("_part") < F.col("_upto")), "left_anti")
        return rows.select(self.schema.names)


def _write(rows: DataFrame, path: str, by: str | None) -> None:
    (rows.repartitionByRange(by, "ord").sortWithinPartitions(by, "ord").write.partitionBy(by) if by else rows.write).parquet(path)


def _commit(spark: SparkSession, path: str, version: int, parts: list[tuple[int, str]], schema: StructType, by: str | None) -> Table:
    rows = spark.createDataFrame([(n, p, schema.json(), by) for n, p in parts], "number int, part string, shape string, by string")
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{path}/versions/v{version:09}")
    return load(spark, path, version)


def load(spark: SparkSession, path: str, version: int | None = None) -> Table:
    """The newest version, or the one asked for."""
    there = numbers(spark, path)
    if not there or (version is not None and version not in there):
        raise ValueError(f"no version {'' if version is None else version} of a table in {path}")
    own = there[-1] if version is None else version
    rows = spark.read.schema("number int, part string, shape string, by string").parquet(f"{path}/versions/v{own:09}").orderBy("number").collect()
    return Table(spark, path, own, tuple((r["number"], r["part"]) for r in rows), StructType.fromJson(_json(rows[0]["shape"])), rows[0]["by"])


def _json(text: str) -> dict:
    import json

    return json.loads(text)


def create(rows: DataFrame, path: str | None = None, by: str | None = None) -> Table:
    """A table's first version; without a path, in the shared folder until the application ends."""
    spark = rows.sparkSession
    if path is None:
        path = f"{shared_dir(spark)}/findery/table-{uuid.uuid4().hex}"
        remove_at_end(spark, path)
    own, name = rows.filter("ord IS NOT NULL"), uuid.uuid4().hex
    _write(own, f"{path}/parts/{name}/rows", by)
    return _commit(spark, path, 1, [(1, name)], rows.schema, by)


def apply(table: Table, changes: DataFrame, most: int = PARTS) -> Table:
    """``changes``: the table's columns and ``gone``. The next version."""
    spark, number = table.spark, table.parts[-1][0] + 1
    own, name = changes.filter("ord IS NOT NULL"), uuid.uuid4().hex
    _write(own.filter("NOT coalesce(gone, false)").select(table.schema.names), f"{table.path}/parts/{name}/rows", table.by)
    few(own.select(F.col("ord").cast("long").alias("ord")).distinct()).write.parquet(f"{table.path}/parts/{name}/gone")
    new = Table(spark, table.path, table.version + 1, (*table.parts, (number, name)), table.schema, table.by)
    if len(new.parts) > most:
        return compact(new)
    return _commit(spark, new.path, new.version, list(new.parts), new.schema, new.by)


def compact(table: Table) -> Table:
    """The same version in one part, without the dead."""
    name = uuid.uuid4().hex
    _write(table.read(), f"{table.path}/parts/{name}/rows", table.by)
    return _commit(table.spark, table.path, table.version, [(table.parts[-1][0], name)], table.schema, table.by)
