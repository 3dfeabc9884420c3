"""Session settings and a durable cut of long plans."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

PARTITION_BYTES = 128 << 20
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot admission even where that adds a shuffle after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Let a join on more keys reuse a partitioning on fewer of them.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    # What a Python task holds at a time is bounded in bytes, not only in rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def tune(spark: SparkSession, *, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings the operators are designed for.

    ``shuffle_bytes``, the largest amount one shuffle moves, sets how many partitions
    shuffles start with; adaptive execution merges the small ones.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if shuffle_bytes:
        start = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shuffle_bytes // PARTITION_BYTES + 1)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(start))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where none is named, a session on one machine gets a folder beside its warehouse;
    a cluster gets an error, since no folder can be invented that all machines share.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-stages"
    return folder.rstrip("/")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its input is too small for its splits to reach them.

    A scan of one small file is one task, whatever is computed from it. Inputs of more than a
    partition's bytes for each core are left as they are, so large texts are not shuffled.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size <= cores * PARTITION_BYTES else df


_staged: set[str] = set()


def stage(df: DataFrame, *, folder: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Used where several jobs read one costly result: the table survives lost
    executors, and readers still prune columns and push filters down. ``clear``
    removes one such table, ``clear_all`` every table that this process wrote.
    """
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    _staged.add(path)
    return spark.read.schema(schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    _staged.discard(path)


def clear(df: DataFrame) -> None:
    """Remove the table that ``stage`` returned as ``df``; nothing may read it afterwards."""
    files = df.inputFiles()[:1]
    for path in [p for p in _staged if files and p.rsplit("/", 1)[1] == files[0].rsplit("/", 2)[1]]:
        _remove(df.sparkSession, path)


def clear_all(spark: SparkSession) -> None:
    """Remove every table staged by this process; results that read them must be stored before."""
    for path in list(_staged):
        _remove(spark, path)
