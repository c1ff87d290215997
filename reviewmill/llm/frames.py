"""Small helpers shared by the operators: column choice, row keys, packed texts."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: characters that end a word, as a Java and RE2 character class without brackets
BREAK_CLASS = r"\x20\x09-\x0D"
BATCH_ROWS = 1024


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only. Names are matched exactly, so other columns may clash in any way,
    also by letter case; a column that is absent becomes null."""
    places = {name: i for i, name in reversed(list(enumerate(df.columns)))}
    held = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return held.select(*[(F.col(f"c{places[n]}") if n in places else F.lit(None)).alias(n) for n in names])


def keyed_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, row_hash, text`` of every row. Rows with equal id and text share their key; they
    get the same result, and whatever is looked up by key is looked up once for each."""
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.select("doc_id", F.xxhash64("doc_id", "text").alias("row_hash"), "text")


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Join condition on the key of ``keyed_texts``; a null id equals a null id."""
    return (left["row_hash"] == right["row_hash"]) & left["doc_id"].eqNullSafe(right["doc_id"])


#: what an Arrow batch holds at most: texts are long, and a worker holds a batch several times over
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS), "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches, in the executors' Java memory and in their Python workers."""
    for key, value in BATCHES.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def give_back() -> None:
    """Return what a finished task has freed; idle workers are kept, and would hold it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library has its own ways
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def by_batch(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | StructType, *, trim: bool = True
) -> DataFrame:
    """``mapInArrow`` for a function of one batch, which gets ``BATCH_ROWS`` rows at most.

    ``trim`` gives freed memory back after each task, at the cost of asking for it again in the next.
    """
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                yield from function(batch.slice(start, BATCH_ROWS))
        if trim:
            give_back()

    return df.mapInArrow(run, schema)


def packed_texts(texts: DataFrame, *, trim: bool = True) -> DataFrame:
    """``doc_id, row_hash, packed``: texts compressed for a shuffle; null becomes empty."""

    def pack(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        packed = [squeeze((t or "").encode()) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["row_hash"], pa.array(packed, pa.binary())],
            names=["doc_id", "row_hash", "packed"],
        )

    return by_batch(texts.select("doc_id", "row_hash", "text"), pack, "doc_id long, row_hash long, packed binary", trim=trim)


def unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def join_texts(texts: DataFrame, extra: DataFrame, how: str, *, trim: bool = True) -> DataFrame:
    """Packed texts with the columns of ``extra`` (one row for each key) beside them."""
    packed = packed_texts(texts, trim=trim)
    kept = [extra[c] for c in extra.columns if c not in ("doc_id", "row_hash")]
    return packed.join(extra, same_row(packed, extra), how).select(packed["doc_id"], packed["row_hash"], "packed", *kept)


def held_rows(docs: DataFrame) -> DataFrame:
    """All columns as ``c0, c1, ...`` and the key of ``keyed_texts`` as ``held_id, held_hash``, so that no
    name of the table can clash; ``toDF(*docs.columns)`` gives the names back."""
    held = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    doc_id, text = (F.col(f"c{docs.columns.index(name)}") for name in ("doc_id", "text"))
    key = doc_id.cast("long")
    return held.select("*", key.alias("held_id"), F.xxhash64(key, text.cast("string")).alias("held_hash"))
