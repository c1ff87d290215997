"""Removal of word passages that an earlier document already has, on a De Bruijn graph.

An edge of the graph is a window of ``width`` words, from the node of its first ``width - 1`` words to
the node of its last ones. Only edges that two documents have matter, so the graph is built in steps:

1. Neighbouring edges of a document with one anchor, the least hash of the short grams in a window,
   form a *path*. Equal edges have equal anchors; equal paths become one row by partial aggregation.
2. An anchor within a single document is dropped. A path of several documents is repeated as a whole;
   its source is the first document that has it.
3. Paths that share their anchor may branch: they are read again and expanded into edges, each with two
   independent hashes and the coordinate of its first place. The edges' sources come from an aggregate
   and a join.
4. Consecutive edges whose sources are consecutive places of one document are compacted into a path
   again. A path so keeps the coordinates of its source, from end to end.
5. Spans go back to every document that has the path, by a join, if their source is an earlier one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import kernels
from reviewmill.llm.fingerprints import PrefixArrays
from reviewmill.llm.frames import by_batch, join_texts, keyed_texts, unpack
from reviewmill.sources.workspace import materialise

WIDTH = 50
GRAM = 8
PATH = ["anchor", "content", "n"]


def _word_hashes(part: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end, first = kernels.words(part, offsets)
    return kernels.PrefixHash(part.astype(np.uint64) + np.uint64(1)).span(start, end), first


def _paths(batch: pa.RecordBatch, width: int, gram: int) -> Iterator[pa.RecordBatch]:
    data, offsets = kernels.text_bytes(batch["text"])
    for low, high in kernels.chunks(offsets):
        hashes, first = _word_hashes(data[offsets[low] : offsets[high]], offsets[low : high + 1])
        prefix = kernels.PrefixHash(hashes)
        anchor = kernels.sliding_min(prefix.spans_of(gram), width - gram + 1)
        row = np.repeat(np.arange(high - low), np.diff(first))[: len(anchor)]
        whole = np.arange(len(anchor)) + width <= first[1:][row]
        start = kernels.change_points(anchor, row, whole)
        stop = np.append(start[1:], len(anchor)).astype(np.int64) if len(start) else start
        start, stop = start[whole[start]], stop[whole[start]]
        if not len(start):
            continue
        at = row[start]
        rows = batch.slice(low, high - low).take(pa.array(at))
        yield pa.RecordBatch.from_arrays(
            [
                rows["doc_id"],
                rows["row_hash"],
                pa.array((start - first[at]).astype(np.int32)),
                pa.array((stop - start).astype(np.int32)),
                pa.array(anchor[start].view(np.int64)),
                pa.array(prefix.span(start, stop + width - 1).view(np.int64)),
            ],
            names=["doc_id", "row_hash", "start", "n", "anchor", "content"],
        )


def document_paths(texts: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Runs of neighbouring windows with one anchor: ``start`` in words, ``n`` windows."""
    return by_batch(
        texts,
        lambda batch: _paths(batch, width, gram),
        "doc_id long, row_hash long, start int, n int, anchor long, content long",
        trim=False,
    )


EDGE = "path long, place int, edge long, proof int, source_id long, source_at int"


def _edges(batch: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    """The edges of the paths wanted from each text, with the place of their path's first occurrence."""
    names = [f.split(" ")[0] for f in EDGE.split(", ")]
    for packed, wanted in zip(batch["packed"].to_pylist(), batch["wanted"].to_pylist(), strict=True):
        data = np.frombuffer(unpack(packed), np.uint8)
        hashes, _ = _word_hashes(data, np.array([0, len(data)]))
        prefix, arrays = kernels.PrefixHash(hashes), PrefixArrays((hashes % np.uint64(kernels.PRIME)).astype(np.int64))
        n, begin, low_at = (np.array([w[k] for w in wanted]) for k in ("n", "start", "low_at"))
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = place + np.repeat(begin, n)
        sums, back = arrays.sums[0], arrays.back[0]
        proof = (sums[at + width] - sums[at]) % kernels.PRIME * back[at] % kernels.PRIME
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array([w["path"] for w in wanted]), n)),
                pa.array(place.astype(np.int32)),
                pa.array(prefix.span(at, at + width).view(np.int64)),
                pa.array(proof.astype(np.int32)),
                pa.array(np.repeat(np.array([w["low"] for w in wanted]), n)),
                pa.array((place + np.repeat(low_at, n)).astype(np.int32)),
            ],
            names=names,
        )


def _with_runs(rows: DataFrame) -> DataFrame:
    """Add ``runs``, of ``a, b, source_id, source_at``, to rows with ``edges`` in order: consecutive edges
    whose sources are consecutive places of one document."""

    def begins(e: Column) -> Column:
        before = F.get("edges", e.i - 1)
        follows = (before.source_id == e.source_id) & (before.source_at + 1 == e.source_at) & (before.place + 1 == e.place)
        return ~F.coalesce(follows, F.lit(False))

    numbered = F.transform(
        "edges", lambda e, i: F.struct(i.alias("i"), e.place.alias("place"), e.source_id.alias("source_id"), e.source_at.alias("source_at"))
    )
    rows = rows.withColumn("heads", F.filter(numbered, begins))

    def run(e: Column, k: Column) -> Column:
        after = F.coalesce(F.get("heads", k + 1).i, F.size("edges"))
        last = F.get("edges", after - 1).place
        return F.struct(e.place.alias("a"), (last + 1).alias("b"), e.source_id.alias("source_id"), e.source_at.alias("source_at"))

    return rows.withColumn("runs", F.transform("heads", run))


def shared_paths(texts: DataFrame, width: int, gram: int) -> DataFrame:
    """The document paths whose anchor is in more than one document."""
    ids = document_paths(texts, width, gram).groupBy("anchor").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    return document_paths(texts, width, gram).join(ids.where("least < most").select("anchor"), "anchor", "left_semi")


def sourced_paths(texts: DataFrame, found: DataFrame, width: int) -> DataFrame:
    """Runs of paths with an earlier source: ``path (a hash of anchor, content, n), runs``.

    A path of several documents is a run as a whole, from the first of them. A path that shares its
    anchor with others also has runs of those edges that are in a document before its own first one.
    """
    # Every one of these is a hash aggregate of fixed width. ``low`` is the path's source; the text
    # that it is read from is another representative, by row, so that its place and row agree.
    paths = found.groupBy(*PATH).agg(
        F.min("doc_id").alias("low"),
        F.min_by("start", "doc_id").alias("low_at"),
        F.max("doc_id").alias("high"),
        F.min("row_hash").alias("row_hash"),
        F.min_by("doc_id", "row_hash").alias("doc_id"),
        F.min_by("start", "row_hash").alias("start"),
    )
    paths = materialise(paths.withColumn("path", F.xxhash64(*PATH)), "paths")
    run = F.struct(F.lit(0).alias("a"), F.col("n").alias("b"), F.col("low").alias("source_id"), F.col("low_at").alias("source_at"))
    whole = paths.where("low < high").select("path", F.array(run).alias("runs"))

    anchors = paths.groupBy("anchor").agg(F.count(F.lit(1)).alias("paths")).where("paths > 1")
    by_row = paths.join(anchors, "anchor").groupBy("doc_id", "row_hash").agg(
        F.collect_list(F.struct("path", "n", "start", "low", "low_at")).alias("wanted")
    )
    edges = by_batch(join_texts(texts, by_row, "inner", trim=False), lambda batch: _edges(batch, width), EDGE, trim=False)
    sources = edges.groupBy("edge", "proof").agg(F.min("source_id").alias("first_id"), F.min_by("source_at", "source_id").alias("first_at"))
    joined = edges.select("path", "place", "edge", "proof", "source_id").join(sources, ["edge", "proof"])
    earlier = joined.where("first_id < source_id").select(
        "path", F.struct("place", F.col("first_id").alias("source_id"), F.col("first_at").alias("source_at")).alias("edge")
    )
    lists = earlier.groupBy("path").agg(F.sort_array(F.collect_list("edge")).alias("edges"))
    return whole.unionByName(_with_runs(lists).select("path", "runs"))


def repeated_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Word spans of a text that an earlier document has: ``doc_id, row_hash, a, b, source_id, source_at``.

    Neighbouring spans may overlap. Rows without an id have no place in the order: they neither lose
    words nor make others lose them.
    """
    texts = keyed_texts(docs).where("doc_id is not null")
    found = materialise(shared_paths(texts, width, gram), "document-paths")
    runs = sourced_paths(texts, found, width)
    named = found.select("doc_id", "row_hash", "start", F.xxhash64(*PATH).alias("path"))
    placed = named.join(runs, "path").select("doc_id", "row_hash", "start", F.explode("runs").alias("r"))
    return placed.where("r.source_id < doc_id").select(
        "doc_id",
        "row_hash",
        (F.col("start") + F.col("r.a")).alias("a"),
        (F.col("start") + F.col("r.b") + (width - 1)).alias("b"),
        "r.source_id",
        "r.source_at",
    )


def _remove(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    out = []
    for doc_id, packed, spans in zip(*[batch[c].to_pylist() for c in ("doc_id", "packed", "spans")], strict=True):
        # bytes.split() breaks at just the six characters that end a word
        words = unpack(packed).split()
        kept = words
        if spans:
            gone = kernels.covered(np.array([s["a"] for s in spans]), np.array([s["b"] for s in spans]), len(words))
            kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
        text = b" ".join(kept)
        out.append({"doc_id": doc_id, "n_words": len(words), "n_removed": len(words) - len(kept), "kept": text.decode(), "kept_sha256": hashlib.sha256(text).hexdigest()})
    kind = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("kept_sha256", pa.string())]
    yield pa.RecordBatch.from_pylist(out, schema=pa.schema(kind))


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Every document without the words that an earlier document's passages cover.

    Returns ``doc_id, n_words, n_removed, kept, kept_sha256``, one row per input row; ``kept`` has the
    remaining words joined by one space. Null and empty texts have no words; rows with one id do not
    precede each other, so copies of a row all stay; other columns are ignored.
    """
    texts = keyed_texts(docs)
    spans = repeated_spans(docs, width, gram)
    by_row = spans.groupBy("doc_id", "row_hash").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    joined = join_texts(texts, by_row, "left", trim=False).select("doc_id", "packed", "spans")
    return by_batch(joined, _remove, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string", trim=False)
