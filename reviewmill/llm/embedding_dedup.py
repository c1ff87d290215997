"""Embedding near-dedup on an inverted multi-index.

1. Vectors are scaled to unit length. Equal vectors of one label are one *class* with a count of copies.
2. Two codebooks, one for each half of the vector, are fitted on a bounded sample. Their product is a
   grid of cells; every class is put into the cell of its two nearest codewords.
3. The cells of a label, in order of the grid, are laid into blocks of about ``BLOCK`` classes; a cell that
   holds more is spread over several blocks by hash.
4. Every class visits cells in order of its distance from them: the distance from a cell is bounded by
   the planes between its codewords and the class's own, half by half, and two sorted lists of bounds are
   walked as in multi-sequence search. The walk ends where the wanted share of linked pairs is reached;
   at a share of 1 that is where no vector of a later cell can be near enough, so no link is lost.
5. A class travels once to each block that holds a visited cell and is not before its own. Blocks are
   verified by one matrix product each. A pair meets in one block only and never leaves it: what leaves
   is, for each class, its number of links and the least class it is connected to.
6. Components of those are the groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.components import connected_components
from reviewmill.llm.frames import pick
from reviewmill.llm.vectors import finite, least_connected, least_connected_sides, matrix, packed
from reviewmill.sources.workspace import materialise

COSINE = 0.93
#: share of linked pairs that the walk over the cells is to reach
RECALL = 1.0
CODEWORDS = 12
#: vectors that the codebooks are fitted on
SAMPLE = 4096
ROUNDS = 12
#: classes of a block; a block is verified in one matrix product
BLOCK = 1024
#: rows of a block whose cells are walked at a time
WALK = 256
SLACK = 1e-9


def _codebook(points: np.ndarray, size: int, rounds: int) -> np.ndarray:
    """Centres of ``size`` groups of points at most: farthest-first start, then rounds of means."""
    centres = points[:1]
    near = ((points - centres[0]) ** 2).sum(axis=1)
    while len(centres) < size and near.max() > 0:
        centres = np.vstack([centres, points[near.argmax()]])
        near = np.minimum(near, ((points - centres[-1]) ** 2).sum(axis=1))
    for _ in range(rounds):
        own = _distances(points, centres).argmin(axis=1)
        count = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return np.unique(centres, axis=0)


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    squares = (points**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None, :]
    return np.maximum(squares - 2 * points @ centres.T, 0)


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks of the two halves, and the squared distance at which a walk ends."""

    first: np.ndarray
    second: np.ndarray
    stop: float = 0.0

    @property
    def half(self) -> int:
        return self.first.shape[1]

    def cells(self, units: np.ndarray) -> np.ndarray:
        own = [_distances(units[:, : self.half], self.first).argmin(axis=1), _distances(units[:, self.half :], self.second).argmin(axis=1)]
        return (own[0] * len(self.second) + own[1]).astype(np.int32)

    def bounds(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each half, at most the squared distance from a vector to any vector of a codeword's part.

        Between its own codeword and another one lies a plane; a vector of the other's part is beyond it.
        """
        out = []
        for points, words in ((units[:, : self.half], self.first), (units[:, self.half :], self.second)):
            far = _distances(points, words)
            own = far.argmin(axis=1)
            apart = np.sqrt(_distances(words, words))[own]
            gap = np.divide(far - far.min(axis=1)[:, None], 2 * apart, out=np.zeros_like(far), where=apart > 0)
            out.append(gap**2)
        return out[0], out[1]

    def visited(self, units: np.ndarray) -> np.ndarray:
        """Which cells each vector visits: both lists of bounds are sorted, and for every codeword of the
        first half the second list is walked up to where their sum passes ``stop``."""
        one, two = self.bounds(units)
        seen = np.zeros((len(units), len(self.first), len(self.second)), bool)
        by_one, by_two = one.argsort(axis=1), two.argsort(axis=1)
        low = np.take_along_axis(one, by_one, 1)
        high = np.take_along_axis(two, by_two, 1)
        row = np.arange(len(units))
        reach = np.full(len(units), len(self.second))
        for i in range(len(self.first)):
            # the walk along the second list can only become shorter
            while True:
                over = (reach > 0) & (low[:, i] + high[row, np.maximum(reach - 1, 0)] > self.stop)
                if not over.any():
                    break
                reach = reach - over
            for j in range(int(reach.max(initial=0))):
                r = np.flatnonzero(reach > j)
                seen[r, by_one[r, i], by_two[r, j]] = True
        return seen.reshape(len(units), -1)


def fit_index(sample: np.ndarray, *, cosine: float = COSINE, recall: float = RECALL, codewords: int = CODEWORDS, rounds: int = ROUNDS) -> MultiIndex:
    """Codebooks of a sample of unit vectors.

    At a recall of 1 a walk ends at the distance of the least linked pair, which loses nothing. Below,
    it ends at the distance within which that share of simulated partners lies in the visited cells; a
    partner is a sample vector turned by the largest angle of a link in a random direction.
    """
    half = (sample.shape[1] + 1) // 2
    index = MultiIndex(_codebook(sample[:, :half], codewords, rounds), _codebook(sample[:, half:], codewords, rounds))
    stop = 2 - 2 * cosine
    if recall < 1:
        turn = np.random.default_rng(7).standard_normal(sample.shape)
        turn -= (turn * sample).sum(axis=1)[:, None] * sample
        turn /= np.maximum(np.linalg.norm(turn, axis=1), 1e-300)[:, None]
        cells = index.cells(cosine * sample + np.sqrt(1 - cosine**2) * turn)
        one, two = index.bounds(sample)
        sums = one[np.arange(len(sample)), cells // len(index.second)] + two[np.arange(len(sample)), cells % len(index.second)]
        stop = min(stop, float(np.quantile(sums, recall, method="higher")))
    return MultiIndex(index.first, index.second, stop + SLACK)


def _units(column: pa.Array, width: int) -> np.ndarray:
    values = matrix(column, width)
    values /= np.maximum(np.abs(values).max(axis=1), 1e-300)[:, None]  # squares stay in range
    return values / np.linalg.norm(values, axis=1)[:, None]


def _place(batches: Iterator[pa.RecordBatch], index: MultiIndex, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cells = index.cells(_units(batch["vector"], width)) if batch.num_rows else np.zeros(0, np.int32)
        yield pa.RecordBatch.from_arrays([*[batch[c] for c in ("class", "label", "copies", "first_id", "vector")], pa.array(cells)], names=["class", "label", "copies", "first_id", "vector", "cell"])


PACKED = "classes binary, copies binary, cells binary, units binary"


def _pack(table: pa.Table, width: int) -> pa.Table:
    """The classes of one block as one row."""
    return pa.table(
        {
            "label": table["label"][:1],
            "block": table["block"][:1],
            "classes": pa.array([packed(table["class"].to_numpy())], pa.binary()),
            "copies": pa.array([packed(table["copies"].to_numpy())], pa.binary()),
            "cells": pa.array([packed(table["cell"].to_numpy())], pa.binary()),
            "units": pa.array([packed(_units(table["vector"], width))], pa.binary()),
        }
    )


def _visits(batches: Iterator[pa.RecordBatch], index: MultiIndex, width: int) -> Iterator[pa.RecordBatch]:
    """For each block, its classes once for every block of the label that they have to meet in."""
    for batch in batches:
        for k in range(batch.num_rows):
            label, block = batch["label"][k].as_py(), batch["block"][k].as_py()
            classes, copies = (np.frombuffer(batch[c][k].as_py(), np.int64) for c in ("classes", "copies"))
            units = np.frombuffer(batch["units"][k].as_py(), np.float64).reshape(-1, max(width, 1))
            cell, first, last = (np.array(batch["places"][k].as_py()[c]) for c in ("cell", "first", "last"))
            seen = np.concatenate([index.visited(units[i : i + WALK])[:, cell] for i in range(0, len(units), WALK)])
            for target in range(block, int(last.max()) + 1):
                held = (first <= target) & (target <= last)
                rows = np.flatnonzero(seen[:, held].any(axis=1))
                if len(rows) or target == block:
                    rows = np.arange(len(units)) if target == block else rows
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([label], pa.string()),
                            pa.array([target], pa.int32()),
                            pa.array([block], pa.int32()),
                            pa.array([packed(classes[rows])], pa.binary()),
                            pa.array([packed(copies[rows])], pa.binary()),
                            pa.array([packed(units[rows])], pa.binary()),
                        ],
                        names=["label", "block", "origin", "guests", "guest_copies", "guest_units"],
                    )


def _verify(batches: Iterator[pa.RecordBatch], cosine: float, width: int) -> Iterator[pa.RecordBatch]:
    def units(value: pa.Scalar) -> np.ndarray:
        return np.frombuffer(value.as_py(), np.float64).reshape(-1, max(width, 1))

    def result(classes: np.ndarray, links: np.ndarray, least: np.ndarray) -> pa.RecordBatch:
        some = links > 0
        return pa.RecordBatch.from_arrays([pa.array(classes[some]), pa.array(links[some]), pa.array(least[some])], names=["class", "links", "least"])

    for batch in batches:
        for k in range(batch.num_rows):
            classes, copies, guests, guest_copies = (np.frombuffer(batch[c][k].as_py(), np.int64) for c in ("classes", "copies", "guests", "guest_copies"))
            own = batch["origin"][k].as_py() == batch["block"][k].as_py()
            linked = units(batch["guest_units"][k]) @ units(batch["units"][k]).T >= cosine
            if own:
                np.fill_diagonal(linked, False)
                yield result(classes, linked @ copies, least_connected(linked, classes))
            elif linked.any():
                left, right = least_connected_sides(linked, guests, classes)
                yield result(guests, linked @ copies, left)
                yield result(classes, guest_copies @ linked, right)


def near_duplicates(
    rows: DataFrame, *, cosine: float = COSINE, recall: float = RECALL, codewords: int = CODEWORDS, sample: int = SAMPLE, block: int = BLOCK
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row for each row of ``vec_id, embedding, label``.

    Rows are compared if their labels are equal and not null; two are linked if their cosine in double
    precision is ``cosine`` or more. A vector that is null, empty, zero, or has a null or non-finite
    component, and one without a label, links with nothing: 0 links, its own id as component, kept. A
    shorter vector counts as filled up with zeros. Repeated rows and equal vectors are rows of their own
    that link with each other; of rows that share an id, all are kept or none. Rows without an id count as
    partners, but name no component; a group of such rows only has a null ``component_id`` and is
    kept. An empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    given = pick(rows, "vec_id", "embedding", "label")
    given = given.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vector"), F.col("label").cast("string"))
    valid = F.col("label").isNotNull() & finite("vector") & F.exists("vector", lambda x: x != 0)
    given = given.withColumn("class", F.when(valid, F.xxhash64("label", "vector")))
    classes = given.where(F.col("class").isNotNull()).groupBy("class").agg(
        F.first("label").alias("label"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"), F.first("vector").alias("vector")
    )
    classes = materialise(classes, "vector-classes")
    width = classes.agg(F.max(F.size("vector"))).first()[0] or 0
    # bounded by the parameter ``sample``
    drawn = classes.orderBy(F.xxhash64("class", F.lit(7)), "class").limit(sample).select("vector").toArrow()["vector"]
    units = _units(drawn.combine_chunks(), width) if len(drawn) else np.zeros((1, 1))
    index = fit_index(np.pad(units, ((0, 0), (0, max(0, 2 - units.shape[1])))), cosine=cosine, recall=recall, codewords=codewords)
    width = max(width, 2) if len(drawn) else 2

    placed = classes.mapInArrow(
        lambda batches: _place(batches, index, width), "class long, label string, copies long, first_id long, vector array<double>, cell int"
    )
    placed = materialise(placed, "placed-vectors")
    cells = placed.groupBy("label", "cell").agg(F.count(F.lit(1)).alias("n"))
    # one row for each cell of the label's grid
    before = F.sum("n").over(Window.partitionBy("label").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    cells = cells.select("label", "cell", "n", before.alias("before")).select(
        "label", "cell", F.floor(F.col("before") / block).cast("int").alias("first"), F.floor((F.col("before") + F.col("n") - 1) / block).cast("int").alias("last")
    )
    cells = materialise(cells, "grid-cells")
    at = F.col("first") + F.pmod(F.xxhash64("class"), F.col("last") - F.col("first") + 1).cast("int")
    dealt = placed.join(cells, ["label", "cell"]).select("label", at.alias("block"), "class", "copies", "cell", "vector")
    blocks = dealt.groupBy("label", "block").applyInArrow(lambda table: _pack(table, width), f"label string, block int, {PACKED}")
    blocks = materialise(blocks, "vector-blocks")
    lists = [F.collect_list(c).alias(c) for c in ("cell", "first", "last")]
    places = cells.groupBy("label").agg(*lists).select("label", F.struct("cell", "first", "last").alias("places"))
    guests = blocks.join(places, "label").mapInArrow(
        lambda batches: _visits(batches, index, width), "label string, block int, origin int, guests binary, guest_copies binary, guest_units binary"
    )
    # the size of packed arrays cannot be estimated, so neither side may be taken for a small one
    met = guests.hint("merge").join(blocks.drop("cells"), ["label", "block"])
    compared = materialise(met.mapInArrow(lambda batches: _verify(batches, cosine, width), "class long, links long, least long"), "verified-vectors")

    links = compared.groupBy("class").agg(F.sum("links").alias("links"))
    groups = connected_components(compared.select(F.col("class").alias("u"), F.col("least").alias("v")), "vector-links")
    named = placed.select("class", "copies", "first_id").join(groups.withColumnRenamed("node", "class"), "class", "left")
    named = named.withColumn("root", F.coalesce("root", "class"))
    ids = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = named.join(ids, "root").join(links, "class", "left").select(
        "class", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    found = given.select("vec_id", "class").join(named, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    found = found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


SQL = f"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS k, vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
    label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS valid
  FROM embeddings),
links AS (
  SELECT a.k, b.k AS other FROM v a JOIN v b ON a.label=b.label AND a.k<>b.k AND a.valid AND b.valid
  WHERE list_cosine_similarity(a.e, b.e) >= {COSINE}),
reached AS (SELECT k, k AS other FROM v UNION SELECT r.k, l.other FROM reached r JOIN links l ON r.other=l.k),
least AS (SELECT r.k, min(v.vec_id) AS component_id FROM reached r JOIN v ON v.k=r.other GROUP BY r.k)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.k=v.k) AS n_links, component_id, vec_id=component_id AS kept
FROM v JOIN least USING (k)
"""
