"""Removal of byte strings that occur more than once in a corpus.

**Method.** Threshold-bounded interval expansion on a Burrows-Wheeler transform (``bwt``) decides
which windows of ``minimum`` bytes occur twice. So that no task needs the whole corpus, windows
that can be equal are first brought together:

1. Each window has an anchor, the least hash of the short grams in it. Neighbouring windows with
   one anchor form a *segment*; equal windows have equal anchors.
2. Equal segments become one *string* with a count, by partial aggregation. A group of copies of
   any size is then a single row.
3. Only strings that share their anchor with another string, or hold a window twice themselves (as
   a periodic stretch does), are read again and expanded. Any other string is repeated just if its
   count is above one.
4. An anchor with many strings, such as a passage quoted by a large part of the corpus in as many
   surroundings, is split: its strings are cut into segments again by anchors of another hash, and
   steps 2 and 3 are repeated. Strings that are still crowded after ``LEVELS`` of this are cut down
   to their windows whose hash occurs twice, counted in buckets of hashes whose number follows the
   number of strings, so that the surroundings drop out and the rest is, again, a few equal strings.
5. The repeated spans go back to every segment that has the string, by a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import bwt, kernels
from reviewmill.llm.frames import by_batch, held_rows, join_texts, keyed_texts, unpack
from reviewmill.sources.workspace import materialise

MINIMUM = 400
GRAM = 24
#: strings of an anchor beyond which they are split further
MANY_STRINGS = 64
LEVELS = 3
#: bytes that one expansion works on (or one anchor's strings, if they are more)
EXPANSION_BYTES = 1 << 18

STRING = ["anchor", "content", "n"]
CUT = pa.schema(
    [("anchor", pa.int64()), ("content", pa.int64()), ("n", pa.int32()), ("copies", pa.int64()), ("strings", pa.int64()), ("bytes", pa.binary())]
)
SPANS = "array<struct<a:int,b:int>>"
#: bytes of texts whose segments are found at once; about two dozen arrays of 8 bytes a window are held for them
SEGMENT_BYTES = 1 << 18


def _byte_hash(data: np.ndarray) -> kernels.PrefixHash:
    return kernels.PrefixHash(data.astype(np.uint64) + np.uint64(1))


def _places(low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges laid end to end: the range and the place of every item."""
    return np.repeat(np.arange(len(low)), size), np.arange(size.sum()) + np.repeat(low - np.cumsum(size) + size, size)


def _own_repeats(
    prefix: kernels.PrefixHash, grams: np.ndarray, anchor: np.ndarray, start: np.ndarray, stop: np.ndarray, minimum: int, gram: int
) -> np.ndarray:
    """Which segments hold a window hash twice. Equal windows have their anchor at two places of the
    segment, so only segments with two such places have their windows compared."""
    reach = minimum - gram + 1
    pad = np.zeros(reach - 1, np.uint64)
    chosen = np.flatnonzero(kernels.sliding_min(~np.concatenate([pad, anchor, pad]), reach) == ~grams)  # least of some window
    low = np.searchsorted(chosen, start)
    own, at = _places(low, np.searchsorted(chosen, stop + reach - 1) - low)
    times = np.bincount(own[grams[chosen[at]] == anchor[start][own]], minlength=len(start))
    again, some = np.zeros(len(start), bool), np.flatnonzero(times > 1)
    own, at = _places(start[some], (stop - start)[some])
    windows = prefix.span(at, at + minimum)
    order = np.lexsort((windows, own))
    own, windows = own[order], windows[order]
    again[some[own[1:][(own[1:] == own[:-1]) & (windows[1:] == windows[:-1])]]] = True
    return again


def _segment_bounds(
    part: np.ndarray, ends: np.ndarray, minimum: int, gram: int, salt: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first window, end of windows, anchor and content hash of the segments of texts laid end
    to end, and whether a segment holds a window twice."""
    prefix = _byte_hash(part)
    grams = prefix.spans_of(gram)
    if salt:
        grams = kernels.mix(grams ^ np.uint64(salt))
    anchor = kernels.sliding_min(grams, minimum - gram + 1)
    row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[: len(anchor)]
    whole = np.arange(len(anchor)) + minimum <= ends[1:][row]
    start = kernels.change_points(anchor, row, whole)
    stop = np.append(start[1:], len(anchor)).astype(np.int64) if len(start) else start
    start, stop = start[whole[start]], stop[whole[start]]
    again = _own_repeats(prefix, grams, anchor, start, stop, minimum, gram) if len(start) else np.zeros(0, bool)
    return row[start], start, stop, anchor[start], prefix.span(start, stop + minimum - 1), again


def _segments(batch: pa.RecordBatch, minimum: int, gram: int) -> Iterator[pa.RecordBatch]:
    data, offsets = kernels.text_bytes(batch["text"])
    for low, high in kernels.chunks(offsets, SEGMENT_BYTES):
        part, ends = data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        at, start, stop, anchor, content, again = _segment_bounds(part, ends, minimum, gram)
        if not len(start):
            continue
        rows = batch.slice(low, high - low).take(pa.array(at))
        yield pa.RecordBatch.from_arrays(
            [
                rows["doc_id"],
                rows["row_hash"],
                pa.array((start - ends[at]).astype(np.int32)),
                pa.array((stop - start).astype(np.int32)),
                pa.array(anchor.view(np.int64)),
                pa.array(content.view(np.int64)),
                pa.array(again),
            ],
            names=["doc_id", "row_hash", "start", "n", "anchor", "content", "again"],
        )


def segments(texts: DataFrame, minimum: int = MINIMUM, gram: int = GRAM) -> DataFrame:
    """Runs of neighbouring windows with one anchor: ``start`` in bytes, ``n`` windows, ``again`` if two are equal."""
    return by_batch(
        texts,
        lambda batch: _segments(batch, minimum, gram),
        "doc_id long, row_hash long, start int, n int, anchor long, content long, again boolean",
    )


def _cut(batch: pa.RecordBatch, minimum: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the strings wanted from each text."""
    out, size = [], 0
    for packed, wanted in zip(batch["packed"].to_pylist(), batch["wanted"].to_pylist(), strict=True):
        text = unpack(packed)
        for w in wanted:
            start = w.pop("start")
            out.append(w | {"bytes": text[start : start + w["n"] + minimum - 1]})
            size += w["n"] + minimum
        if size > 8 * kernels.CHUNK_BYTES:
            yield pa.RecordBatch.from_pylist(out, schema=CUT)
            out, size = [], 0
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=CUT)


SHARE = "anchor long, bucket long, content long, n int, copies long, places array<int>, windows array<long>"


def _shares(batch: pa.RecordBatch, minimum: int) -> Iterator[pa.RecordBatch]:
    """The window hashes of each string, dealt to as many buckets as its anchor has times ``MANY_STRINGS`` strings."""
    out = []
    for anchor, content, n, copies, strings, data in zip(
        *[batch[c].to_pylist() for c in (*STRING, "copies", "strings", "bytes")], strict=True
    ):
        hashes = _byte_hash(np.frombuffer(data, np.uint8)).spans_of(minimum)
        bucket = (hashes % np.uint64(-(-strings // MANY_STRINGS))).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.append(kernels.change_points(bucket[order]), n)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            at = order[a:b]
            out.append(
                {"anchor": anchor, "bucket": int(bucket[at[0]]), "content": content, "n": n, "copies": copies,
                 "places": at.astype(np.int32), "windows": hashes[at].view(np.int64)}
            )
    kind = [("anchor", pa.int64()), ("bucket", pa.int64()), ("content", pa.int64()), ("n", pa.int32()), ("copies", pa.int64()),
            ("places", pa.list_(pa.int32())), ("windows", pa.list_(pa.int64()))]
    yield pa.RecordBatch.from_pylist(out, schema=pa.schema(kind))


def _twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places whose window hash is there twice in its bucket; the buckets arrive one after the other."""
    names = ["anchor", "bucket", "content", "n", "copies", "places", "windows"]
    kind = pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("n", pa.int32()), ("places", pa.list_(pa.int32()))])
    held: list[tuple] = []

    def results() -> pa.RecordBatch:
        sizes = [len(h[6]) for h in held]
        _, which = np.unique(np.concatenate([np.array(h[6], np.int64) for h in held]), return_inverse=True)
        times = np.bincount(which, np.repeat([h[4] for h in held], sizes))[which] > 1
        out, at = [], 0
        for (anchor, _, content, n, _, places, _), size in zip(held, sizes, strict=True):
            found = np.array(places, np.int32)[times[at : at + size]]
            if len(found):
                out.append({"anchor": anchor, "content": content, "n": n, "places": found})
            at += size
        return pa.RecordBatch.from_pylist(out, schema=kind)

    for batch in batches:
        for row in zip(*[batch[c].to_pylist() for c in names], strict=True):
            if held and row[:2] != held[0][:2]:
                yield results()
                held = []
            held.append(row)
    if held:
        yield results()


PART = "anchor long, content long, n int, offset int, part_anchor long, part long, part_n int, again boolean, copies long, bytes binary"
_PART = pa.schema(
    [("anchor", pa.int64()), ("content", pa.int64()), ("n", pa.int32()), ("offset", pa.int32()), ("part_anchor", pa.int64()),
     ("part", pa.int64()), ("part_n", pa.int32()), ("again", pa.bool_()), ("copies", pa.int64()), ("bytes", pa.binary())]
)


def _split(batch: pa.RecordBatch, minimum: int, gram: int, salt: int) -> Iterator[pa.RecordBatch]:
    """The strings' segments by another anchor, as strings of their own. Equal windows of one anchor
    also agree in the next one, so both together name the new group."""
    found = []
    for anchor, content, n, copies, data in zip(*[batch[c].to_pylist() for c in (*STRING, "copies", "bytes")], strict=True):
        part = np.frombuffer(data, np.uint8)
        _, start, stop, anchors, contents, again = _segment_bounds(part, np.array([0, len(part)]), minimum, gram, salt)
        groups = kernels.mix(anchors + np.uint64(anchor & (2**64 - 1)) * np.uint64(3)).view(np.int64)
        parts = (start, stop, groups, contents.view(np.int64), again)
        for a, b, group, own, twice in zip(*[x.tolist() for x in parts], strict=True):
            found.append(
                {"anchor": anchor, "content": content, "n": n, "offset": a, "part_anchor": group, "part": own,
                 "part_n": b - a, "again": twice, "copies": copies, "bytes": data[a : b + minimum - 1]}
            )
    yield pa.RecordBatch.from_pylist(found, schema=_PART)


def _trim(batch: pa.RecordBatch, minimum: int) -> Iterator[pa.RecordBatch]:
    """The stretches of a string that consist of windows worth a comparison, as strings of their own."""
    found = []
    for anchor, content, n, copies, data, places in zip(
        *[batch[c].to_pylist() for c in (*STRING, "copies", "bytes", "places")], strict=True
    ):
        flags = np.zeros(n, bool)
        flags[places] = True
        prefix = _byte_hash(np.frombuffer(data, np.uint8))
        start, stop = kernels.runs(flags)
        contents = prefix.span(start, stop + minimum - 1).view(np.int64)
        for a, b, own in zip(start.tolist(), stop.tolist(), contents.tolist(), strict=True):
            found.append(
                {"anchor": anchor, "content": content, "n": n, "offset": a, "part_anchor": anchor, "part": own,
                 "part_n": b - a, "again": True, "copies": copies, "bytes": data[a : b + minimum - 1]}
            )
    yield pa.RecordBatch.from_pylist(found, schema=_PART)


def _expand(batches: Iterator[pa.RecordBatch], minimum: int) -> Iterator[pa.RecordBatch]:
    """Repeated windows of strings that arrive in order of their anchor. One copy of each string takes
    part; if there are more, all its own windows are repeated."""
    held: list[tuple] = []
    size = 0

    def results() -> pa.RecordBatch:
        text = np.frombuffer(b"".join(x[-1] + b"\xff" for x in held), np.uint8)
        flags = bwt.repeated_starts(text, minimum)
        out, at = [], 0
        for anchor, content, n, copies, data in held:
            own = flags[at : at + n] if copies == 1 else np.ones(n, bool)
            a, b = kernels.runs(own.copy())
            out.append({"anchor": anchor, "content": content, "n": n, "spans": [{"a": int(x), "b": int(y)} for x, y in zip(a, b, strict=True)]})
            at += len(data) + 1
        kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
        return pa.RecordBatch.from_pylist(out, schema=pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("n", pa.int32()), ("spans", kind)]))

    for batch in batches:
        for row in zip(*[batch[c].to_pylist() for c in (*STRING, "copies", "bytes")], strict=True):
            if size >= EXPANSION_BYTES and row[0] != held[-1][0]:
                yield results()
                held, size = [], 0
            held.append(row)
            size += len(row[-1])
    if held:
        yield results()


def expand(strings: DataFrame, minimum: int) -> DataFrame:
    """``anchor, content, n, spans``: the repeated windows of each string among those of its anchor.

    Strings with one anchor meet in one task; a task works on ``EXPANSION_BYTES`` at a time.
    """
    placed = strings.repartition("anchor").sortWithinPartitions("anchor")
    return placed.mapInArrow(lambda batches: _expand(batches, minimum), f"anchor long, content long, n int, spans {SPANS}")


def _judged(strings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Strings that are decided, with spans, and those to compare, with the number of their anchor's strings."""
    anchors = strings.groupBy("anchor").agg(F.count(F.lit(1)).alias("strings"))
    judged = strings.join(anchors, "anchor")
    # However short, a segment may repeat itself: windows that overlap can be equal.
    alone = (F.col("strings") == 1) & ~F.col("again")
    whole = F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b"))).cast(SPANS)
    decided = judged.where(alone & (F.col("copies") > 1)).select(*STRING, whole.alias("spans"))
    return decided, judged.where(~alone)


def _own_strings(links: DataFrame) -> DataFrame:
    """Parts as strings, equal ones once."""
    return links.groupBy(
        F.col("part_anchor").alias("anchor"), F.col("part").alias("content"), F.col("part_n").alias("n")
    ).agg(F.sum("copies").alias("copies"), F.max("again").alias("again"), F.first("bytes").alias("bytes"))


def _back(links: DataFrame, spans: DataFrame) -> DataFrame:
    """Spans of parts as spans of the strings they were cut from."""
    named = spans.select(F.col("anchor").alias("part_anchor"), F.col("content").alias("part"), F.col("n").alias("part_n"), "spans")
    found = links.drop("bytes", "copies", "again").join(named, ["part_anchor", "part", "part_n"])
    moved = F.transform("spans", lambda s: F.struct((s.a + F.col("offset")).alias("a"), (s.b + F.col("offset")).alias("b")))
    return found.groupBy(*STRING).agg(F.flatten(F.collect_list(moved)).alias("spans"))


def repeated_strings(texts: DataFrame, found: DataFrame, minimum: int, gram: int) -> DataFrame:
    """Strings with their repeated windows: ``anchor, content, n, spans``."""
    # Hash aggregates of fixed width; place and row are those of one occurrence.
    strings = found.groupBy(*STRING).agg(
        F.count(F.lit(1)).alias("copies"),
        F.max("again").alias("again"),
        F.min("row_hash").alias("row_hash"),
        F.min_by("doc_id", "row_hash").alias("doc_id"),
        F.min_by("start", "row_hash").alias("start"),
    )
    decided, wanted = _judged(materialise(strings, "strings"))
    by_row = wanted.groupBy("doc_id", "row_hash").agg(
        F.collect_list(F.struct(*STRING, "copies", "strings", "start")).alias("wanted")
    )
    cut = by_batch(
        join_texts(texts, by_row, "inner"),
        lambda batch: _cut(batch, minimum),
        "anchor long, content long, n int, copies long, strings long, bytes binary",
    )
    pool = materialise(cut.dropDuplicates(STRING), "strings-bytes")

    # Levels of splitting: what is decided at each, what is compared, and how parts lead back.
    settled, compared, links = [decided], [], []
    for level in range(1, LEVELS + 1):
        compared.append(pool.where(F.col("strings") <= MANY_STRINGS).select(*STRING, "copies", "bytes"))
        crowded = pool.where(F.col("strings") > MANY_STRINGS).select(*STRING, "copies", "bytes")
        cuts = by_batch(crowded, lambda batch, salt=level: _split(batch, minimum, gram, salt), PART)
        links.append(materialise(cuts, f"strings-parts-{level}"))
        decided, pool = _judged(_own_strings(links[-1]))
        pool = materialise(pool, f"strings-level-{level}")
        settled.append(decided)
    compared.append(pool.where(F.col("strings") <= MANY_STRINGS).select(*STRING, "copies", "bytes"))

    # Windows of anchors that are crowded still: only those whose hash occurs twice are compared.
    crowded = pool.where(F.col("strings") > MANY_STRINGS).select(*STRING, "copies", "strings", "bytes")
    shares = by_batch(crowded, lambda batch: _shares(batch, minimum), SHARE)
    dealt = shares.repartition("anchor", "bucket").sortWithinPartitions("anchor", "bucket")
    twice = dealt.mapInArrow(_twice, "anchor long, content long, n int, places array<int>")
    places = twice.groupBy(*STRING).agg(F.flatten(F.collect_list("places")).alias("places"))
    trimmed = materialise(by_batch(crowded.join(places, STRING), lambda batch: _trim(batch, minimum), PART), "strings-trimmed")

    everything = _own_strings(trimmed).drop("again")
    for strings in compared:
        everything = everything.unionByName(strings)
    expanded = materialise(expand(everything, minimum), "strings-expanded")
    spans = _back(trimmed, expanded)
    for level in range(LEVELS, -1, -1):
        own = expanded.join(compared[level].select(*STRING), STRING, "left_semi")
        spans = settled[level].unionByName(own).unionByName(spans).where(F.size("spans") > 0)
        if level:
            spans = _back(links[level - 1], materialise(spans, f"strings-spans-{level}"))
    return spans


def repeated_spans(docs: DataFrame, minimum: int = MINIMUM, gram: int = GRAM) -> DataFrame:
    """``doc_id, row_hash, spans``: byte spans of a text covered by strings of ``minimum`` bytes that
    also start elsewhere. Texts without any are left out. Spans may overlap and come in any order."""
    texts = keyed_texts(docs)
    found = materialise(segments(texts, minimum, gram), "segments")
    strings = repeated_strings(texts, found, minimum, gram)
    placed = found.join(strings, STRING).select("doc_id", "row_hash", "start", F.explode("spans").alias("s"))
    spans = placed.select(
        "doc_id",
        "row_hash",
        F.struct((F.col("start") + F.col("s.a")).alias("a"), (F.col("start") + F.col("s.b") + minimum - 1).alias("b")).alias("span"),
    )
    return spans.groupBy("doc_id", "row_hash").agg(F.collect_list("span").alias("spans"))


def _cut_out(text: bytes, spans: list[dict] | None) -> tuple[bytes, int, int]:
    """What is left of a text, and the number of removed bytes and of their runs."""
    if not spans:
        return text, 0, 0
    data = np.frombuffer(text, np.uint8)
    gone = kernels.covered(np.array([s["a"] for s in spans]), np.array([s["b"] for s in spans]), len(data))
    return data[~gone].tobytes(), int(gone.sum()), len(kernels.runs(gone)[0])


def _remove(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    out = []
    for doc_id, packed, spans in zip(*[batch[c].to_pylist() for c in ("doc_id", "packed", "spans")], strict=True):
        text = unpack(packed)
        kept, removed, n = _cut_out(text, spans)
        out.append({"doc_id": doc_id, "n_bytes": len(text), "n_removed": removed, "n_spans": n, "kept": kept, "kept_sha256": hashlib.sha256(kept).hexdigest()})
    kind = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("kept_sha256", pa.string())]
    yield pa.RecordBatch.from_pylist(out, schema=pa.schema(kind))


def remove_repeats(docs: DataFrame, minimum: int = MINIMUM, gram: int = GRAM) -> DataFrame:
    """Every document without the bytes that repeated strings cover.

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept (binary), kept_sha256``, one row per input
    row. Null and empty texts have no bytes; texts shorter than ``minimum`` stay whole; repeated
    rows are documents of their own, so both lose what they share; other columns are ignored.
    """
    texts = keyed_texts(docs)
    joined = join_texts(texts, repeated_spans(docs, minimum, gram), "left")
    return by_batch(
        joined.select("doc_id", "packed", "spans"),
        _remove,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string",
    )


def shortened_documents(docs: DataFrame, minimum: int = MINIMUM, gram: int = GRAM) -> DataFrame:
    """All rows and columns, with the remaining text in place of the text.

    A character of several bytes that a span cuts through is dropped whole; a null text stays null. Other
    columns may have any names.
    """
    rows, spans = held_rows(docs), repeated_spans(docs, minimum, gram)
    spans = spans.select(F.col("doc_id").alias("span_id"), F.col("row_hash").alias("span_hash"), "spans")
    same = (rows["held_hash"] == spans["span_hash"]) & rows["held_id"].eqNullSafe(spans["span_id"])
    names = [f"c{i}" for i in range(len(docs.columns))]
    joined = rows.join(spans, same, "left").select(*names, "spans")
    schema = joined.drop("spans").schema
    place = docs.columns.index("text")

    def shorten(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column(place).to_pylist()
        for k, found in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
            if found:
                texts[k] = _cut_out(texts[k].encode(), found)[0].decode(errors="ignore")
        columns = [batch.column(i) for i in range(batch.num_columns - 1)]
        columns[place] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays(columns, names=names)

    return by_batch(joined, shorten, schema).toDF(*docs.columns)
