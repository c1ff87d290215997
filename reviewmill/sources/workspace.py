"""Intermediate tables in the shared folder of the cluster.

A written table cuts lineage, survives lost executors and keeps the columnar reader's pruning
and size statistics, so Catalyst itself decides from the real size whether to broadcast it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, or the warehouse, which executors share as well."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir", None)
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return configured.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, grouped by application so old runs can be swept."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/reviewmill/{application}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table once and read it back with its declared schema."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_by(df: DataFrame, name: str, key: str, values: list, spread_by: str) -> dict:
    """Write a table partitioned by ``key`` and return one DataFrame for each value.

    Each folder is read alone, so its size estimate is its own and a small part can be
    broadcast while a large one is shuffled.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    rest = df.drop(key).schema
    df.repartition(key, spread_by).write.partitionBy(key).parquet(path)
    written = {row[key] for row in spark.read.parquet(path).select(key).distinct().collect()}
    empty = spark.createDataFrame([], rest)
    return {
        value: spark.read.schema(rest).parquet(f"{path}/{key}={value}") if value in written else empty
        for value in values
    }


# A scan of at most this many splits (about one gigabyte by default) counts as small.
SMALL_SPLITS = 8


def spread_small_scan(df: DataFrame, key: str) -> DataFrame:
    """Redistribute a small scan that has fewer splits than cores, as for one small file.

    A larger table passes through unchanged, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(min(cores, 64), key) if df.rdd.getNumPartitions() < min(cores, SMALL_SPLITS) else df


# Bytes of files for one task whose rows grow many times over in memory.
PART_BYTES = 16 << 20


def file_bytes(df: DataFrame) -> int:
    """Bytes of the files a table is read from; 0 if it is not read from files."""
    context, total = df.sparkSession.sparkContext, 0
    for name in df.inputFiles():  # encoded as in a URI
        location = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(name))
        total += location.getFileSystem(context._jsc.hadoopConfiguration()).getFileStatus(location).getLen()
    return total


def in_small_parts(df: DataFrame) -> DataFrame:
    """Redistribute a table into parts of about ``PART_BYTES`` of its files, row by row, so that no task has much
    more; a table whose scan gives each core half as much again at most passes through unchanged."""
    parts = -(-file_bytes(df) // PART_BYTES)
    return df.repartition(parts) if 2 * parts > 3 * df.sparkSession.sparkContext.defaultParallelism else df


def _file_system(spark: SparkSession, path: str):
    """Hadoop path and file system of a location."""
    context = spark.sparkContext
    location = context._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(context._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    location, system = _file_system(spark, path)
    return system.exists(location)


def sweep(spark: SparkSession) -> None:
    """Delete the intermediate tables this application wrote; call it when its results are stored."""
    location, system = _file_system(spark, f"{shared_folder(spark)}/reviewmill/{spark.sparkContext.applicationId}")
    system.delete(location, True)
