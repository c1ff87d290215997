"""Token counts of documents in flat token files.

A token file is a flat run of little-endian ids, every document followed by the end-of-document id,
without an index. It is read in blocks of a fixed number of ids that know nothing of documents.
Each block is searched for separators in one vector operation. A prefix scan over the blocks of a
file then gives every block the number of separators before it and the place where its first
document began, which stitches the documents that cross block borders.

``write_token_table`` keeps the blocks as rows of a table, so that lost tasks and any store that
Spark can write are taken care of; ``read_token_files`` cuts plain files into the same rows.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmill.llm.frames import pick
from reviewmill.sources.workspace import fresh_path

TOKENIZERS = "/opt/tokenizers"
RANKS = "byte_bpe_50k.tiktoken"
END_OF_DOCUMENT = 50256
BLOCK_TOKENS = 1 << 15
ID_BYTES = 2


@lru_cache(maxsize=1)
def encoder(folder: str):
    """The byte-level tokenizer of a worker; strings that look like special tokens are ordinary text."""
    import public_tokenizers
    import tiktoken

    with open(os.path.join(folder, RANKS), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def write_token_table(docs: DataFrame, *, folder: str = TOKENIZERS, block_tokens: int = BLOCK_TOKENS) -> str:
    """Tokenise documents into one flat file for each partition of the scan; returns the table's path.

    Rows with a ``payload`` are the blocks ``(file, block)``; the other rows are the manifest, which
    says what document has which place in the file. Null and empty texts have no tokens.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, block, ordinal = TaskContext.get().partitionId(), 0, 0
        tokens, held = encoder(folder), np.zeros(0, np.uint16)
        schema = pa.schema([("file", pa.int32()), ("block", pa.int64()), ("payload", pa.binary()), ("ordinal", pa.int64()), ("doc_id", pa.int64())])

        def blocks(ids: np.ndarray, last: bool) -> tuple[list[dict], np.ndarray]:
            nonlocal block
            rows, whole = [], len(ids) if last else len(ids) - len(ids) % block_tokens
            for start in range(0, whole, block_tokens):
                rows.append({"file": file, "block": block, "payload": ids[start : min(whole, start + block_tokens)].tobytes()})
                block += 1
            return rows, ids[whole:]

        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                found = [held]
                for text in part["text"].to_pylist():
                    found.append(np.array(tokens.encode_ordinary(text or "") + [END_OF_DOCUMENT], np.uint16))
                rows, held = blocks(np.concatenate(found), False)
                for doc_id in part["doc_id"].to_pylist():
                    rows.append({"file": file, "ordinal": ordinal, "doc_id": doc_id})
                    ordinal += 1
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        yield pa.RecordBatch.from_pylist(blocks(held, True)[0], schema=schema)

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    path = fresh_path(docs.sparkSession, "token-files")
    table = rows.mapInArrow(write, "file int, block long, payload binary, ordinal long, doc_id long")
    table.write.option("compression", "zstd").parquet(path)
    return path


def read_token_files(spark: SparkSession, path: str, *, block_tokens: int = BLOCK_TOKENS, id_bytes: int = ID_BYTES) -> DataFrame:
    """Blocks ``file, block, payload`` of plain token files, of less than 2 GB each, as Spark reads them."""
    width = block_tokens * id_bytes
    files = spark.read.format("binaryFile").load(path).where("length > 0").select(F.col("path").alias("file"), "content")
    blocks = files.select("file", "content", F.explode(F.sequence(F.lit(0), F.floor((F.length("content") - 1) / width))).alias("block"))
    return blocks.select("file", "block", F.substring("content", (F.col("block") * width + 1).cast("int"), F.lit(width)).alias("payload"))


def count_tokens(
    blocks: DataFrame, *, end: int = END_OF_DOCUMENT, block_tokens: int = BLOCK_TOKENS, id_bytes: int = ID_BYTES
) -> DataFrame:
    """``file, ordinal, start, n_tokens``: the documents of each file in order, separators not counted.

    Ids after the last separator of a file are one more document; nothing after it is none. An
    empty document has 0 tokens. All blocks but a file's last have ``block_tokens`` ids.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ends = [], []
            for payload in batch["payload"].to_pylist():
                ids = np.frombuffer(payload, f"<u{id_bytes}")
                sizes.append(len(ids))
                ends.append(np.flatnonzero(ids == end).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch["file"], batch["block"], pa.array(sizes, pa.int32()), pa.array(ends, pa.list_(pa.int32()))],
                names=["file", "block", "size", "ends"],
            )

    kind = blocks.schema["file"].dataType.simpleString()
    found = blocks.select("file", F.col("block").cast("long"), "payload").mapInArrow(search, f"file {kind}, block long, size int, ends array<int>")
    found = found.withColumn("offset", F.col("block") * block_tokens)
    # Where a file ends without a separator there is one after its last id.
    by_file = Window.partitionBy("file").orderBy("block")
    last = F.lead("block").over(by_file).isNull()
    tail = F.col("size") - 1 - F.coalesce(F.get("ends", F.size("ends") - 1), F.lit(-1))
    open_end = last & (tail > 0)
    closed = found.withColumn("ends", F.when(open_end, F.concat("ends", F.array("size"))).otherwise(F.col("ends")))
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    behind = F.when(F.size("ends") > 0, F.col("offset") + F.get("ends", F.size("ends") - 1) + 1)
    scanned = closed.select(
        "file", "offset", "ends",
        F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)).alias("ordinals"),
        F.coalesce(F.max(behind).over(before), F.lit(0)).alias("open"),
    )
    docs = scanned.select("file", "offset", "ends", "ordinals", "open", F.posexplode("ends").alias("k", "stop"))
    start = F.when(F.col("k") == 0, F.col("open")).otherwise(F.col("offset") + F.get("ends", F.col("k") - 1) + 1)
    return docs.select("file", (F.col("ordinals") + F.col("k")).alias("ordinal"), start.alias("start"), (F.col("offset") + F.col("stop") - start).alias("n_tokens"))


def document_token_counts(docs: DataFrame, *, folder: str = TOKENIZERS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``doc_id, file, ordinal, start, n_tokens`` of documents packed into token files and counted there.

    One row for each row; repeated rows are documents of their own; other columns are ignored.
    """
    table = docs.sparkSession.read.parquet(write_token_table(docs, folder=folder, block_tokens=block_tokens))
    counts = count_tokens(table.where("payload is not null").select("file", "block", "payload"), block_tokens=block_tokens)
    manifest = table.where("ordinal is not null").select("file", "ordinal", "doc_id")
    return manifest.join(counts, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "start", "n_tokens")
