"""Source divergence audit: how far the term distributions of a language's sources lie apart.

1. One pass counts terms inside tasks: for each (lang, source) the occurrences of a term and the
   documents that hold it. Only these counts are shuffled, never tokens.
2. A language keeps the terms that enough of its documents hold. Kept terms get a *bucket* by hash, so
   that a bucket has about ``ENTRIES`` counts of all sources together, and a place in it, most frequent
   first. 64 neighbouring places are a *chunk*.
3. Count-level bitmaps: for each (group, count) and chunk, a 64-bit set of the terms that have this
   count in this group. A smoothed probability depends on a term through its count alone.
4. For two sources, AND and popcount of their sets give the number of terms in each joint cell
   (count here, count there), which is multiplied by the difference of the two probabilities. The
   sets of count zero are not stored: their cells are what the others leave of a set, of the kept terms.

Probabilities are integers (parts of ``SCALE``), so every sum is exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.frames import pick
from reviewmill.llm.kernels import change_points
from reviewmill.sources.workspace import materialise

LEAST_DOCUMENTS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
PRIOR = 5
#: counts of one bucket, all sources together; a bucket is the work of one task
ENTRIES = 1 << 17
#: distinct (group, term) pairs that a task holds before it passes its counts on
HELD = 200_000
#: bytes of a text that are split into terms at a time
PIECE = 1 << 20
#: cells of a joint table that are computed at a time
CELLS = 1 << 20
WORD = 64

#: letters a-z and everything beyond ASCII stay, A-Z are lowered, all else ends a term
_TABLE = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about ``PIECE`` bytes that end between terms."""
    start = 0
    while start < len(text):
        end = text.find(b" ", start + PIECE)
        end = len(text) if end < 0 else end
        yield text[start:end]
        start = end


def _count(batches: Iterator[pa.RecordBatch], held_most: int) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    entries = 0

    def results() -> Iterator[pa.RecordBatch]:
        for (lang, source), (occurrences, documents) in held.items():
            terms = [None, *occurrences]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()),
                    pa.array([0, *occurrences.values()], pa.int64()),
                    pa.array([0, *(documents[t] for t in terms[1:])], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )

    for batch in batches:
        texts = batch["text"].cast(pa.binary())
        for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), texts, strict=True):
            occurrences, documents = held.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(occurrences), set()
            for piece in _pieces(text.as_py().translate(_TABLE)):
                terms = piece.split()
                occurrences.update(terms)
                seen.update(terms)
            documents.update(seen)
            entries += len(occurrences) - before
            if entries >= held_most:
                yield from results()
                held, entries = {}, 0
    yield from results()


def term_counts(docs: DataFrame, *, held: int = HELD) -> DataFrame:
    """``lang, source, term, n, docs`` of all documents; a null ``term`` stands for the group itself."""
    rows = pick(docs, "lang", "source", "text")
    rows = rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counted = rows.mapInArrow(lambda batches: _count(batches, held), "lang string, source string, term binary, n long, docs long")
    summed = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return summed.withColumn("term", F.col("term").cast("string"))


def parts_of(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * terms))``, exact; null without terms."""
    base = (total + PRIOR * terms).cast("decimal(19,0)")
    above = (n + PRIOR).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.when(base > 0, F.lit(1) + F.call_function("div", above, base)).cast("long")


@dataclass(frozen=True)
class Audit:
    """Written tables of one audit.

    ``groups``: ``lang, source, total, terms, lang_total, buckets, zero``, one row for each (lang, source),
    with ``zero`` the parts of a term that is absent. ``entries``: ``lang, source, term, n, lang_n,
    bucket, chunk, bit`` of the kept terms with a count above zero.
    """

    groups: DataFrame
    entries: DataFrame

    def bitmaps(self) -> DataFrame:
        """``lang, bucket, chunk, source, n, bits``: the terms of a chunk with count ``n``."""
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
        return self.entries.groupBy("lang", "bucket", "chunk", "source", "n").agg(F.bit_or(bit).alias("bits"))

    def pairs(self) -> DataFrame:
        """``lang, source, item, value``: each other source of the language, both ways.

        The rows are as many as pairs of sources, which is the report itself.
        """
        of_group = self.groups.select("lang", "source", "total", "terms", "zero", "buckets")
        levels = self.bitmaps().join(of_group, ["lang", "source"])
        levels = levels.select("lang", "bucket", "chunk", "source", "bits", parts_of(F.col("n"), F.col("total"), F.col("terms")).alias("parts"), "zero")
        # every group is in every bucket, also without a term there
        bucket = F.explode(F.sequence(F.lit(0), F.col("buckets") - 1)).alias("bucket")
        empty = of_group.select("lang", bucket, F.lit(-1).alias("chunk"), "source", F.lit(0).cast("long").alias("bits"), F.lit(0).cast("long").alias("parts"), "zero")
        found = levels.unionByName(empty).groupBy("lang", "bucket").applyInArrow(
            _bucket_pairs, "lang string, a string, b string, value long, either long, a_zero long, b_zero long"
        )
        sums = found.groupBy("lang", "a", "b", "a_zero", "b_zero").agg(F.sum("value").alias("value"), F.sum("either").alias("either"))
        langs = self.groups.groupBy("lang").agg(F.max("terms").alias("terms"))
        absent = (F.col("terms") - F.col("either")) * F.abs(F.col("a_zero") - F.col("b_zero"))
        summed = sums.join(langs, "lang").select("lang", "a", "b", (F.col("value") + absent).alias("value"))
        both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
        return summed.select("lang", "value", F.inline(both)).select("lang", "source", "item", "value")

    def excess_terms(self) -> DataFrame:
        """``lang, source, item, value``: terms that a source holds and uses more than its language does."""
        rows = self.entries.join(self.groups, ["lang", "source"])
        own = parts_of(F.col("n"), F.col("total"), F.col("terms"))
        whole = parts_of(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
        return rows.select("lang", "source", F.col("term").alias("item"), (own - whole).alias("value")).where("value > 0")

    def report(self, top: int = TOP_TERMS) -> DataFrame:
        """``lang, source, part, item, value, rank``."""
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        ranked = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
        return ranked(self.pairs(), "pair").unionByName(ranked(self.excess_terms(), "term").where(F.col("rank") <= top))


def audit(docs: DataFrame, *, least_documents: int = LEAST_DOCUMENTS, entries: int = ENTRIES, held: int = HELD) -> Audit:
    """Counts and kept terms of ``docs`` (columns ``lang``, ``source``, ``text``; others are ignored).

    Null text, lang and source are read as ``''``. Every row is a document, repeated ones too. A term is a
    run of ASCII letters, lowered, and of characters beyond ASCII, unchanged. A group whose texts are
    empty has no counts and takes part in all pairs; a language without kept terms has pairs of value 0 and
    no terms; an empty table gives an empty report. Equal values rank by the UTF-8 bytes of the item.
    """
    counts = materialise(term_counts(docs, held=held), "term-counts")
    kept = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"), F.count(F.lit(1)).alias("sources")
    )
    kept = materialise(kept.where(F.col("docs") >= least_documents).drop("docs"), "kept-terms")
    langs = kept.groupBy("lang").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"), F.ceil(F.sum("sources") / F.lit(float(entries))).cast("int").alias("buckets")
    )
    langs = materialise(langs, "kept-languages")
    placed = kept.join(langs.select("lang", "buckets"), "lang").withColumn("bucket", F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int"))
    place = F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(F.desc("lang_n"), "term")) - 1
    placed = placed.withColumn("place", place).select(
        "lang", "term", "lang_n", "bucket", F.floor(F.col("place") / WORD).cast("int").alias("chunk"), (F.col("place") % WORD).alias("bit")
    )
    known = counts.where("term IS NOT NULL").select("lang", "source", "term", "n").join(placed, ["lang", "term"])
    known = materialise(known, "kept-counts")
    totals = known.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term IS NULL").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    zero = F.lit(0).cast("long")
    groups = groups.select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "terms", "lang_total")], F.coalesce("buckets", F.lit(1)).alias("buckets")
    )
    groups = groups.withColumn("zero", F.coalesce(parts_of(zero, F.col("total"), F.col("terms")), zero))
    return Audit(materialise(groups, "divergence-groups"), known)


def _joint(values: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Sums over the levels of each row source and each column source."""
    return np.add.reduceat(np.add.reduceat(values, columns, axis=1), rows, axis=0)


def _bucket_pairs(table: pa.Table) -> pa.Table:
    """Joint cells of all pairs of sources over the chunks of one bucket.

    ``value`` sums the cells in which one source at least has a count, ``either`` counts their terms.
    """
    names, code = np.unique(np.array(table["source"].to_pylist(), object), return_inverse=True)
    chunk, parts = table["chunk"].to_numpy(), table["parts"].to_numpy()
    bits = table["bits"].to_numpy().view(np.uint64)
    zero = np.zeros(len(names), np.int64)
    zero[code] = table["zero"].to_numpy()
    order = np.lexsort((code, chunk))
    order = order[chunk[order] >= 0]
    chunk, code, parts, bits = chunk[order], code[order], parts[order], bits[order]
    value = np.zeros((len(names), len(names)), np.int64)
    joint, own = np.zeros_like(value), np.zeros(len(names), np.int64)
    edges = [*change_points(chunk), len(chunk)]
    for low, high in zip(edges, edges[1:]):
        s, p, b = code[low:high], parts[low:high], bits[low:high]
        size = np.bitwise_count(b).astype(np.int64)
        np.add.at(own, s, size)
        starts = change_points(s)
        there = s[starts]
        step = max(1, CELLS // max(len(s), len(names)))
        for top in range(0, len(s), step):
            end = min(top + step, len(s))
            begin = change_points(s[top:end])
            here = s[top:end][begin]
            cells = np.bitwise_count(b[top:end, None] & b[None, :]).astype(np.int64)
            joint[np.ix_(here, there)] += _joint(cells, begin, starts)
            value[np.ix_(here, there)] += _joint(cells * np.abs(p[top:end, None] - p[None, :]), begin, starts)
            left = np.repeat(size[top:end, None], len(names), axis=1)
            left[:, there] -= np.add.reduceat(cells, starts, axis=1)
            alone = np.add.reduceat(left * np.abs(p[top:end, None] - zero[None, :]), begin, axis=0)
            value[here] += alone
            value[:, here] += alone.T
    a, b = np.triu_indices(len(names), 1)
    either = own[a] + own[b] - joint[a, b]
    return pa.table(
        {
            "lang": pa.repeat(table["lang"][0].as_py(), len(a)).cast(pa.string()),
            "a": pa.array(names[a], pa.string()),
            "b": pa.array(names[b], pa.string()),
            "value": value[a, b],
            "either": either,
            "a_zero": zero[a],
            "b_zero": zero[b],
        }
    )


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PARTS = f"CAST(1 + ({SCALE}::HUGEINT * ({{n}} + {PRIOR})) // ({{total}} + {PRIOR} * {{terms}}) AS BIGINT)"

SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, coalesce(lang,'') AS lang, coalesce(source,'') AS source, coalesce(text,'') AS text FROM documents),
tokens AS (
  SELECT k, lang, source, unnest(regexp_extract_all(translate(text,'{_LETTERS}','{_LETTERS.lower()}'),'[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS lang_n FROM tokens GROUP BY lang, term HAVING count(DISTINCT k) >= {LEAST_DOCUMENTS}),
langs AS (SELECT lang, count(*) AS terms, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT lang, source, sum(n) AS total FROM counted GROUP BY lang, source),
sources AS (SELECT DISTINCT lang, source FROM d),
p AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n,0) AS n,
    {_PARTS.format(n="coalesce(c.n,0)", total="coalesce(t.total,0)", terms="l.terms")} AS parts,
    {_PARTS.format(n="k.lang_n", total="l.lang_total", terms="l.terms")} AS whole
  FROM sources s JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN totals t ON t.lang=s.lang AND t.source=s.source
  LEFT JOIN counted c ON c.lang=s.lang AND c.source=s.source AND c.term=k.term),
gaps AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.parts-b.parts)) AS value
  FROM p a JOIN p b ON a.lang=b.lang AND a.term=b.term AND a.source<>b.source GROUP BY a.lang, a.source, b.source),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(g.value,0) AS BIGINT) AS value
  FROM sources a JOIN sources b ON a.lang=b.lang AND a.source<>b.source
  LEFT JOIN gaps g ON g.lang=a.lang AND g.source=a.source AND g.item=b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(parts-whole AS BIGINT) FROM p WHERE n>0 AND parts>whole)
SELECT lang, source, part, item, value, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
WHERE part='pair' OR rank <= {TOP_TERMS}
"""
