"""Document fingerprints from prefix polynomial hashes.

A prefix array of a text holds, for every prefix, the sum of ``code * base**i`` modulo a prime. The
hash of any span is a difference of two entries, so two spans are compared in constant time, and the
longest common extension of two places is found by binary search. Two primes' worth of bits (two
bases modulo 2**31 - 1) are used together.

A fingerprint is the hash of the whole text and the ``SPANS`` least hashes among all its spans of
``WIDTH`` code points, each read off the prefix arrays. The likeness of two fingerprints is the Dice
coefficient of the sets of spans that these samples estimate.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.frames import keyed_texts, unpack
from reviewmill.llm.kernels import PRIME, mix
from reviewmill.sources.workspace import materialise

BASES = (911382323, 972663749)
WIDTH = 16
SPANS = 64
#: text bytes of a part, and what a row counts beside its text
PART_BYTES = 64 << 20
ROW_BYTES = 64
#: room of the power tables that a worker keeps; a longer text makes its own
KEPT_POWERS = 1 << 17

_tables: dict[int, np.ndarray] = {}


def _power_table(base: int, size: int) -> np.ndarray:
    """Powers of a base modulo the prime, by doubling."""
    held = _tables.get(base)
    if held is not None and len(held) >= size:
        return held
    table, room = np.ones(1, np.int64), max(size, KEPT_POWERS)
    while len(table) < room:
        table = np.concatenate([table, table * pow(base, len(table), PRIME) % PRIME])
    if size <= KEPT_POWERS:
        _tables[base] = table
    return table


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) + 1


class PrefixArrays:
    """Prefix hashes of one text."""

    def __init__(self, codes: np.ndarray):
        self.size = n = len(codes)
        self.sums, self.back = [], []
        for base in BASES:
            sums = np.zeros(n + 1, np.int64)
            np.cumsum(codes * _power_table(base, n + 1)[:n] % PRIME, out=sums[1:])
            self.sums.append(sums % PRIME)
            self.back.append(_power_table(pow(base, -1, PRIME), n + 1))

    def span(self, start: int, end: int) -> tuple[int, ...]:
        return tuple(int((s[end] - s[start]) % PRIME * b[start] % PRIME) for s, b in zip(self.sums, self.back, strict=True))

    def spans(self, width: int) -> np.ndarray:
        """Hashes of all spans of one width as 32 well-mixed bits."""
        first, second = (
            (s[width:] - s[: self.size - width + 1]) % PRIME * b[: self.size - width + 1] % PRIME
            for s, b in zip(self.sums, self.back, strict=True)
        )
        return (mix((first << 31 | second).astype(np.uint64)) >> np.uint64(32)).astype(np.int64)


def common_extension(a: PrefixArrays, i: int, b: PrefixArrays, j: int) -> int:
    """Length of the longest common prefix of two texts from places ``i`` and ``j``."""
    low, high = 0, min(a.size - i, b.size - j)
    while low < high:
        middle = (low + high + 1) // 2
        if a.span(i, i + middle) == b.span(j, j + middle):
            low = middle
        else:
            high = middle - 1
    return low


def sample(arrays: PrefixArrays, width: int = WIDTH, spans: int = SPANS) -> np.ndarray:
    """The least hashes of the spans, ascending; a text shorter than a span is one span."""
    if arrays.size == 0:
        return np.zeros(0, np.int64)
    hashes = arrays.spans(min(width, arrays.size))
    limit = max(1, (1 << 34) * spans // len(hashes))
    while True:
        least = np.unique(hashes[hashes < limit])
        if len(least) >= spans or limit >= 1 << 32:
            return least[:spans]
        limit *= 8


class Fingerprint:
    """Whole-text hash and span sample; ``str`` gives the stored form."""

    def __init__(self, text: str):
        self.arrays = PrefixArrays(code_points(text))
        self.sample = sample(self.arrays)
        self.whole = "{:08x}".format(self.arrays.size) + "".join(f"{h:08x}" for h in self.arrays.span(0, self.arrays.size))

    def __str__(self) -> str:
        return self.whole + "-" + self.sample.astype(">u4").tobytes().hex()

    def likeness(self, other: Fingerprint) -> float:
        """Between 0 and 1; 1 just for equal whole-text hashes."""
        if self.whole == other.whole:
            return 1.0
        a, b = self.sample, other.sample
        if not len(a) or not len(b):
            return 0.0
        least = np.unique(np.concatenate([a, b]))[:SPANS]
        shared = int((np.isin(least, a) & np.isin(least, b)).sum())
        jaccard = min(shared / len(least), 1 - 1 / (2 * SPANS))
        return 2 * jaccard / (1 + jaccard)


def edited_text(text: str, following: str) -> str:
    """The last half of a text's code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, prefix_edited long, prefix_next long"
)
_FIELDS = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
     ("prefix_edited", pa.int64()), ("prefix_next", pa.int64())]
)


def _compare(doc_id: int | None, text: str, own: Fingerprint, following: str, theirs: Fingerprint) -> dict:
    edited = edited_text(text, following)
    changed = Fingerprint(edited)
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
        "fingerprint": str(own),
        "edited_fingerprint": str(changed),
        "near_edited": own.likeness(changed),
        "near_next": own.likeness(theirs),
        "prefix_edited": common_extension(own.arrays, 0, changed.arrays, 0),
        "prefix_next": common_extension(own.arrays, 0, theirs.arrays, 0),
    }


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a part in order, and after them the first row of the next part, marked ``ahead``."""
    part = before = None
    for batch in batches:
        out = []
        for number, ahead, doc_id, packed in zip(*[batch[c].to_pylist() for c in ("part", "ahead", "doc_id", "packed")], strict=True):
            if number != part:
                part, before = number, None
            elif before is None:
                continue  # another copy of the row ahead
            text = unpack(packed).decode()
            mark = Fingerprint(text)
            if before is not None:
                out.append(_compare(*before, text, mark))
            before = None if ahead else (doc_id, text, mark)
            if len(out) >= 512:
                yield pa.RecordBatch.from_pylist(out, schema=_FIELDS)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_FIELDS)


def part_starts(texts: DataFrame, *, part_bytes: int = PART_BYTES) -> list[tuple[bool, int, int]]:
    """Key of the first row of each part, ascending: whether it has an id, the id (0 if none), the row hash.

    Rows in order of their keys are cut where the bytes before them pass a multiple of a part's size:
    ``part_bytes``, or less where that gives fewer parts than shuffle partitions. So parts have about
    equal bytes whatever the ids and lengths are, and one start for each reaches the driver. Rows of
    equal key stay together. Only keys and lengths are shuffled.
    """
    least = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES
    keys = texts.select("doc_id", "row_hash", size.alias("bytes"))
    # With a number, since adaptive execution would put a few megabytes of keys into one range.
    ranged = keys.repartitionByRange(least, "doc_id", "row_hash")
    rows = materialise(ranged.select(F.spark_partition_id().alias("range"), "*"), "fingerprint-keys")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("range").agg(F.sum("bytes").alias("total"))
    sums = sums.select(  # one row for each range
        "range",
        F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start"),
        F.least(F.lit(part_bytes), F.ceil(F.sum("total").over(Window.partitionBy()) / least)).alias("width"),
    )
    inside = Window.partitionBy("range").orderBy("doc_id", "row_hash").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("local", F.coalesce(F.sum("bytes").over(inside), F.lit(0))).join(sums, "range")
    key = F.struct(F.col("doc_id").isNotNull().alias("held"), F.coalesce("doc_id", F.lit(0)).alias("id"), "row_hash")
    part = F.floor((F.col("start") + F.col("local")) / F.col("width"))
    starts = placed.groupBy(part.alias("part")).agg(F.min(key).alias("key")).select("key.*").distinct()
    return sorted(map(tuple, starts.collect()))


def neighbour_fingerprints(docs: DataFrame, *, part_bytes: int = PART_BYTES) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness; one row for each row.

    Rows follow each other by ``doc_id`` (null first), rows with one id by a hash of their text; the
    last is followed by the first, and a single row by itself. Null and empty texts have no code
    points; their fingerprints are equal to each other and unlike any other. Other columns are
    ignored. ``prefix_*`` are the common prefixes that binary search finds on the prefix arrays.

    Texts are shuffled once, compressed, to the part that holds their key, one task for each part; the
    first row of a part goes to the part before as well.
    """
    texts = keyed_texts(docs)
    starts = part_starts(texts, part_bytes=part_bytes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            squeeze = zstandard.ZstdCompressor(level=3).compress
            packed = [squeeze((t or "").encode()) for t in batch["text"].to_pylist()]
            rows = []
            for k, (i, h) in enumerate(zip(batch["doc_id"].to_pylist(), batch["row_hash"].to_pylist(), strict=True)):
                key = (i is not None, i or 0, h)
                part = bisect_right(starts, key) - 1
                rows.append((part, False, k))
                if key == starts[part]:
                    rows.append(((part - 1) % len(starts), True, k))
            take = pa.array([k for _, _, k in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p for p, _, _ in rows], pa.int32()),
                    pa.array([a for _, a, _ in rows], pa.bool_()),
                    batch["doc_id"].take(take),
                    batch["row_hash"].take(take),
                    pa.array(packed, pa.binary()).take(take),
                ],
                names=["part", "ahead", "doc_id", "row_hash", "packed"],
            )

    placed = texts.mapInArrow(place, "part int, ahead boolean, doc_id long, row_hash long, packed binary")
    ordered = placed.repartitionById(max(1, len(starts)), "part").sortWithinPartitions("part", "ahead", "doc_id", "row_hash")
    return ordered.mapInArrow(_neighbours, SCHEMA)
