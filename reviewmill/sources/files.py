"""File inventory with checksums."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# binaryFile holds a whole file in memory; larger files are hashed as a stream instead.
INLINE_LIMIT = 256 * 1024 * 1024


def _stream_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hash each listed file in 1 MiB blocks, so memory does not grow with the file."""
    import hashlib

    from pyarrow import fs

    for batch in batches:
        rows = []
        for path, length in zip(batch["path"], batch["length"]):
            uri = path.replace("file:/", "file:///", 1) if not path.startswith("file:///") else path
            system, inner = fs.FileSystem.from_uri(uri)
            md5, sha = hashlib.md5(), hashlib.sha256()
            with system.open_input_stream(inner) as stream:
                while block := stream.read(1024 * 1024):
                    md5.update(block)
                    sha.update(block)
            rows.append((path, length, md5.hexdigest(), sha.hexdigest()))
        yield pd.DataFrame(rows, columns=["path", "length", "md5", "sha256"])


def file_inventory(
    spark: SparkSession,
    folder: str,
    *,
    pattern: str = "*",
    expected_sha256: str | None = None,
    inline_limit: int = INLINE_LIMIT,
) -> DataFrame:
    """One row per file: ``path, length, md5, sha256, verified`` (NULL without an expected hash).

    Files are spread over tasks. The length filter is pushed into the scan, so the content of a
    file over ``inline_limit`` is never loaded whole.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    small = files.where(F.col("length") <= inline_limit).select(
        "path", "length", F.md5("content").alias("md5"), F.sha2("content", 256).alias("sha256")
    )
    large = (
        files.where(F.col("length") > inline_limit)
        .select("path", "length")
        .repartition("path")
        .mapInPandas(_stream_digests, "path string, length long, md5 string, sha256 string")
    )
    verdict = F.col("sha256") == F.lit(expected_sha256) if expected_sha256 else F.lit(None).cast("boolean")
    return small.unionByName(large).withColumn("verified", verdict)


def inventory_totals(inventory: DataFrame) -> DataFrame:
    """Number of files and bytes of an inventory."""
    return inventory.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )
