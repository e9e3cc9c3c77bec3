"""Cutting lineage with tables in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Where that is unset, one of our own in local mode, an error on a cluster, whose machines share no such folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all machines share")
        base = "/tmp/checkpoints/findery"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def remove_at_end(spark: SparkSession, path: str) -> None:
    """The files go when the application ends."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)


#: Tasks that a core gets of a stage that has more partitions than that.
WAVES = 4


def few(df: DataFrame) -> DataFrame:
    """Rows that come off an exchange, in ``WAVES`` tasks a core at most: partitions beyond that are read one after another, and each task's file is one instead of many small ones. Not for the output of hash joins, whose tables a task holds to its end."""
    return df.coalesce(max(1, WAVES * df.sparkSession.sparkContext.defaultParallelism))


def materialize(df: DataFrame, name: str, exchanged: bool = False) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back, until the application ends.

    What follows depends on replicated files only, so a lost executor costs no recomputation
    of what came before. ``exchanged``: the rows come off an exchange, and go to ``few`` files.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/findery/{name}-{uuid.uuid4().hex}"
    (few(df) if exchanged else df).write.parquet(path)
    remove_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, least: int = 1 << 22) -> DataFrame:
    """``df`` over all cores where it is smaller than ``least`` bytes for each: such a table is often one row group, so one task."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size < cores * least else df


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions this session deals rows to."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
