"""Near-duplicate join on the Jaccard similarity of word n-grams, by MinHash banding.

1. Every text gets its set of n-grams, a MinHash signature and a hash of the set. Texts with equal
   sets form one *text class*, by partial aggregation; from here on copies are a count.
2. Signatures are cut into bands of ``rows`` minima; the number of bands follows from the similarity
   and the recall that is wanted at it. Classes are shuffled on the hash of a band, and every class
   is linked to the least class with the same band, so a bucket of any size gives a link for each row.
   Classes that share a band are in one component of these links.
3. Within a component all pairs are verified on their full n-gram sets, in blocks of ``BLOCK`` by
   ``BLOCK`` classes. Pairs exist only inside a block's matrix product; what leaves it is one row for
   each class: its number of links there, and the least class it is connected to.
4. Components of the verified links are the near-duplicate groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm import kernels
from reviewmill.llm.components import connected_components
from reviewmill.llm.frames import by_batch, held_rows, join_texts, keyed_texts, unpack
from reviewmill.sources.workspace import materialise

NGRAM = 5
#: similarity as a fraction, so that the comparison is exact
SIMILARITY = (4, 5)
RECALL = 0.99999
ROWS = 6
BLOCK = 256
#: columns of a block's incidence matrix that are multiplied at a time
COLUMNS = 4096


def band_count(similarity: float, rows: int, recall: float) -> int:
    """Bands with which two sets of this similarity share one with at least this probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def _factors(count: int) -> tuple[np.ndarray, np.ndarray]:
    draws = kernels.mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(kernels.BASE))
    return draws[:count] | np.uint64(1), draws[count:]


def ngram_sets(data: np.ndarray, offsets: np.ndarray, size: int = NGRAM) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of every text, text after text, and their number. A text of fewer words
    has one n-gram, of all its words; a text without words has none."""
    start, end, first = kernels.words(data, offsets)
    prefix = kernels.PrefixHash(kernels.PrefixHash(data.astype(np.uint64) + np.uint64(1)).span(start, end))
    counts = np.diff(first)
    grams = np.where(counts > 0, np.maximum(counts - size + 1, 1), 0)
    row = np.repeat(np.arange(len(counts)), grams)
    at = np.arange(len(row)) - np.repeat(np.cumsum(grams) - grams, grams) + np.repeat(first[:-1], grams)
    hashes = prefix.span(at, np.minimum(at + size, first[1:][row]))
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    keep = kernels.change_points(row, hashes)
    return hashes[keep], np.bincount(row[keep], minlength=len(counts))


SIGNATURE = "doc_id long, row_hash long, set_a long, set_b long, grams int, bands array<long>"


def _signatures(batch: pa.RecordBatch, size: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    factors, shifts = _factors(bands * rows)
    data, offsets = kernels.text_bytes(batch["text"])
    for low, high in kernels.chunks(offsets):
        hashes, counts = ngram_sets(data[offsets[low] : offsets[high]], offsets[low : high + 1], size)
        some = np.flatnonzero(counts)
        begin = (np.cumsum(counts) - counts)[some]
        found = np.zeros((high - low, bands), np.uint64)
        for band in range(bands if len(some) else 0):
            key = np.full(len(some), band + 1, np.uint64)
            for k in range(band * rows, (band + 1) * rows):
                key = kernels.mix(key * np.uint64(kernels.BASE) + np.minimum.reduceat(hashes * factors[k] + shifts[k], begin))
            found[some, band] = key
        sums = np.zeros((2, high - low), np.uint64)
        if len(some):
            sums[0, some] = np.add.reduceat(kernels.mix(hashes), begin)
            sums[1, some] = np.add.reduceat(kernels.mix(hashes ^ np.uint64(kernels.BASE)), begin)
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"][low:high],
                batch["row_hash"][low:high],
                pa.array(sums[0].view(np.int64)),
                pa.array(sums[1].view(np.int64)),
                pa.array(counts.astype(np.int32)),
                kernels.list_array(pa.array(found[some].reshape(-1).view(np.int64)), np.where(counts > 0, bands, 0)),
            ],
            names=["doc_id", "row_hash", "set_a", "set_b", "grams", "bands"],
        )


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    sets = []
    for packed in batch["packed"].to_pylist():
        data = np.frombuffer(unpack(packed), np.uint8)
        sets.append(ngram_sets(data, np.array([0, len(data)]), size)[0].tobytes())
    names = ["class", "copies", "component", "chunks", "chunk"]
    yield pa.RecordBatch.from_arrays([*[batch[c] for c in names], pa.array(sets, pa.binary())], names=[*names, "grams"])


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of every two sets."""
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    joint = times > 1
    kept = joint[column]
    owner, column = owner[kept], (np.cumsum(joint) - 1)[column[kept]]
    out = np.zeros((len(sets), len(sets)), np.float64)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int(joint.sum()), COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        held = np.zeros((len(sets), min(COLUMNS, int(joint.sum()) - low)), np.float32)
        held[owner[a:b], column[a:b] - low] = 1
        out += held @ held.T
    return out


def _least_connected(linked: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The least label of the connected component of every row of a link matrix."""
    while True:
        around = np.where(linked, labels[None, :], np.iinfo(np.int64).max).min(axis=1)
        least = np.minimum(labels, around)
        if np.array_equal(least, labels):
            return labels
        labels = least


def _verify(batches: Iterator[pa.RecordBatch], similarity: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Blocks arrive one after the other; the rows of a block are compared with each other."""
    names = ["component", "low", "high", "class", "copies", "chunk", "grams"]
    upper, lower = similarity
    held: list[tuple] = []

    def results() -> pa.RecordBatch:
        classes = np.array([h[3] for h in held], np.int64)
        copies, chunk = np.array([h[4] for h in held]), np.array([h[5] for h in held])
        sets = [np.frombuffer(h[6], np.uint64) for h in held]
        sizes = np.array([len(s) for s in sets], np.float64)
        shared = shared_counts(sets)
        linked = lower * shared >= upper * (sizes[:, None] + sizes[None, :] - shared)
        np.fill_diagonal(linked, False)
        if held[0][1] != held[0][2]:
            linked &= chunk[:, None] != chunk[None, :]
        return pa.RecordBatch.from_arrays(
            [pa.array(classes), pa.array((linked * copies[None, :]).sum(axis=1).astype(np.int64)), pa.array(_least_connected(linked, classes.copy()))],
            names=["class", "links", "least"],
        )

    for batch in batches:
        for row in zip(*[batch[c].to_pylist() for c in names], strict=True):
            if held and row[:3] != held[0][:3]:
                if len(held) > 1:
                    yield results()
                held = []
            held.append(row)
    if len(held) > 1:
        yield results()


def text_classes(signatures: DataFrame) -> DataFrame:
    """Texts with equal n-gram sets: ``class, copies, first_id, first (a row's key), bands``."""
    first = F.struct("doc_id", "row_hash")
    return signatures.groupBy(class_key().alias("class")).agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id"), F.min(first).alias("first"), F.first("bands").alias("bands")
    )


def class_key() -> Column:
    """Texts without n-grams are similar to nothing, so each row key is a class of its own."""
    return F.when(F.col("grams") > 0, F.xxhash64("set_a", "set_b", "grams")).otherwise(F.xxhash64("doc_id", "row_hash", F.lit("none")))


def candidate_components(classes: DataFrame) -> DataFrame:
    """``node, root`` of the classes that share a band with another one."""
    rows = classes.select("class", F.posexplode("bands").alias("band", "value"))
    rows = rows.select("class", F.xxhash64("band", "value").alias("bucket"))
    buckets = rows.groupBy("bucket").agg(F.min("class").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1")
    links = rows.join(buckets, "bucket").select(F.col("class").alias("u"), "v").where("u != v").distinct()
    return connected_components(links, "candidate-links")


def near_duplicates(
    docs: DataFrame, *, size: int = NGRAM, similarity: tuple[int, int] = SIMILARITY, rows: int = ROWS, recall: float = RECALL, block: int = BLOCK
) -> DataFrame:
    """``doc_id, row_hash, class_id, n_links, text_class, copies, near_group``, one row for each row.

    ``class_id`` is the least id of the near-duplicate group, ``n_links`` the number of other rows
    whose similarity reaches the threshold, copies among them. Words are runs of characters other
    than space and tab to carriage return, unchanged. Null, empty and blank texts have no n-grams
    and no links, and are a group by themselves (rows with equal id and text share it); texts of
    fewer than ``size`` words are one n-gram. A group of rows without ids has a null ``class_id``.
    Other columns are ignored.
    """
    bands = band_count(similarity[0] / similarity[1], rows, recall)
    texts = keyed_texts(docs)
    signatures = materialise(by_batch(texts, lambda batch: _signatures(batch, size, bands, rows), SIGNATURE), "signatures")
    classes = materialise(text_classes(signatures), "text-classes")
    components = materialise(candidate_components(classes), "candidate-components")

    sizes = components.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(block))).cast("int").alias("chunks"))
    members = components.join(sizes, "root").select(F.col("node").alias("class"), F.col("root").alias("component"), "chunks")
    members = members.withColumn("chunk", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"))
    wanted = classes.select("class", "copies", "first.*").join(members, "class")
    sets = by_batch(
        join_texts(texts, wanted, "inner"),
        lambda batch: _sets(batch, size),
        "class long, copies long, component long, chunks int, chunk int, grams binary",
    )
    sets = materialise(sets.dropDuplicates(["class"]), "ngram-sets")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    blocks = sets.select("class", "copies", "component", "chunk", "grams", other).select(
        "component", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "class", "copies", "chunk", "grams"
    )
    key = ["component", "low", "high"]
    compared = blocks.repartition(*key).sortWithinPartitions(*key).mapInArrow(
        lambda batches: _verify(batches, similarity), "class long, links long, least long"
    )
    compared = materialise(compared, "verified")
    links = compared.groupBy("class").agg(F.sum("links").alias("links"))
    groups = connected_components(compared.select(F.col("class").alias("u"), F.col("least").alias("v")), "verified-links")

    grouped = classes.select("class", "copies", "first_id").join(groups.withColumnRenamed("node", "class"), "class", "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "class"))
    ids = grouped.groupBy("root").agg(F.min("first_id").alias("class_id"))
    labelled = grouped.join(ids, "root").join(links, "class", "left")
    labelled = labelled.select("class", "class_id", "copies", "root", F.coalesce("links", F.lit(0)).alias("links"))
    rows_ = signatures.select("doc_id", "row_hash", "grams", class_key().alias("class"))
    own = F.when(F.col("grams") > 0, F.col("copies") - 1).otherwise(F.lit(0))
    return rows_.join(labelled, "class").select(
        "doc_id", "row_hash", "class_id", (F.col("links") + own).alias("n_links"), F.col("class").alias("text_class"), "copies",
        F.col("root").alias("near_group"),
    )


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """The row with the least id of every near-duplicate group, with all its columns, whatever their names.

    Texts without n-grams are similar to nothing and stay, repeated rows of them once. Of rows with equal id
    and text the one with the least hash of all columns stays.
    """
    found = near_duplicates(docs, **options)
    first = found.groupBy("near_group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_hash")).alias("r")).select("r.*")
    kept = first.select(F.col("doc_id").alias("kept_id"), F.col("row_hash").alias("kept_hash"))
    rows = held_rows(docs)
    same = (rows["held_hash"] == kept["kept_hash"]) & rows["held_id"].eqNullSafe(kept["kept_id"])
    names = [f"c{i}" for i in range(len(docs.columns))]
    turn = F.row_number().over(Window.partitionBy("held_id", "held_hash").orderBy(F.xxhash64(*names)))
    single = rows.join(kept, same, "left_semi").withColumn("turn", turn).where(F.col("turn") == 1)
    return single.select(*names).toDF(*docs.columns)
