"""Hard-negative mining on a multiway hyperplane tree.

1. Components become integers, so every score is an exact integer inner product.
2. A tree is grown on a bounded sample: a node has several split points far from each other, and a
   vector belongs to the subtree of the nearest one. Every row of the table is then sent down to its leaf.
3. Each split point stores, for each subtree beside it, the least and the largest distance of that subtree's
   rows, and each subtree the range of its rows' squared lengths; these come from all rows, by an aggregate.
4. A window of scores around an anchor is an annulus of distances (its radii follow from the lengths). A
   subtree goes if for one split point the range of its distances misses the anchor's distance plus or
   minus the annulus. What survives is a list of leaves.
5. Leaves are exact: anchors travel in packs to every block of a surviving leaf, where all scores of the pack
   and the block come from one matrix product. The best rows of each block are merged by an aggregate.

The search runs twice: for the positives of each anchor, then for the window of each positive.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.frames import pick
from reviewmill.llm.vectors import finite, matrix, packed
from reviewmill.sources.workspace import materialise

SCALE = 256
EVERY_ANCHOR, EVERY_RELABELLED, LABELS = 50, 7, 10
POSITIVES, NEGATIVES = 5, 3
#: a negative's score in percent of the positive's
LOW, HIGH = 50, 95
#: rows that the tree is grown on
SAMPLE = 4096
#: split points of a node, and sample rows of a leaf
DEGREE, LEAF = 8, 64
#: rows of a block of a leaf, anchors of a pack
BLOCK, PACK = 4096, 256
#: largest magnitude of an integer component
LARGEST = 1 << 26
#: slack of a squared distance against rounding, as a share of the squared lengths
ROUNDING = 1e-12
FAR = np.int64(1) << 62


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _lengths(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.float64) ** 2).sum(axis=1)


def _distances(x: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest distance of each row and point, given rounding."""
    both = _lengths(x)[:, None] + _lengths(points)[None, :]
    squared = both - 2.0 * _scores(x, points)
    slack = ROUNDING * both + 1e-9
    return np.sqrt(np.maximum(squared - slack, 0)), np.sqrt(np.maximum(squared, 0) + slack)


@dataclass(frozen=True)
class Node:
    """Split points, and for each of them a child: a node's number, or ``~leaf``."""

    points: np.ndarray
    children: tuple[int, ...]


@dataclass(frozen=True)
class Tree:
    nodes: list[Node]
    leaves: int

    def walk(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(node, rows in it, number of the subtree of each)`` from the root down."""
        pending = [(0, np.arange(len(x)))] if len(x) else []
        while pending:
            number, rows = pending.pop()
            node = self.nodes[number]
            # the earlier point wins a tie, for every row alike
            nearest = (_lengths(node.points)[None, :] - 2.0 * _scores(x[rows], node.points)).argmin(axis=1)
            yield number, rows, nearest
            pending += [(c, rows[nearest == j]) for j, c in enumerate(node.children) if c >= 0 and (nearest == j).any()]

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int32)
        for number, rows, nearest in self.walk(x):
            child = np.array(self.nodes[number].children)[nearest]
            out[rows[child < 0]] = ~child[child < 0]
        return out


def _spread(points: np.ndarray, degree: int) -> np.ndarray:
    """Up to ``degree`` different points, each the farthest from those before it."""
    chosen = [0]
    near = _distances(points, points[:1])[0][:, 0]
    while len(chosen) < degree and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, _distances(points, points[chosen[-1:]])[0][:, 0])
    return points[chosen]


def grow_tree(sample: np.ndarray, degree: int = DEGREE, leaf: int = LEAF) -> Tree:
    nodes: list[Node] = []
    leaves = 0
    pending = [(sample, -1, 0)]
    while pending:
        rows, parent, place = pending.pop()
        number = len(nodes)
        if parent >= 0:
            children = list(nodes[parent].children)
            children[place] = number
            nodes[parent] = Node(nodes[parent].points, tuple(children))
        points = _spread(rows, degree)
        nearest = (_lengths(points)[None, :] - 2.0 * _scores(rows, points)).argmin(axis=1)
        children = []
        for j in range(len(points)):
            part = rows[nearest == j]
            if len(part) > leaf and len(part) < len(rows):
                pending.append((part, number, j))
                children.append(0)
            else:
                children.append(~leaves)
                leaves += 1
        nodes.append(Node(points, tuple(children)))
    return Tree(nodes, leaves)


@dataclass(frozen=True)
class Index:
    """Tree, ranges from all rows, sample, and the number of blocks of each leaf.

    ``low[node][i, j]`` and ``high``: distances of split point ``i`` from the rows below child ``j``;
    ``least[node][j]`` and ``most``: their squared lengths. A child without rows has an empty range.
    """

    tree: Tree
    low: list[np.ndarray]
    high: list[np.ndarray]
    least: list[np.ndarray]
    most: list[np.ndarray]
    blocks: np.ndarray
    sample: np.ndarray
    sample_labels: np.ndarray
    sample_keys: np.ndarray

    def survivors(self, x: np.ndarray, floor: np.ndarray, ceiling: np.ndarray) -> np.ndarray:
        """Which leaves may hold a row whose score with ``x`` lies in one of its windows (inclusive)."""
        out = np.zeros((len(x), self.tree.leaves), bool)
        length = _lengths(x)
        pending = [(0, np.arange(len(x)))]
        while pending:
            number, rows = pending.pop()
            node = self.tree.nodes[number]
            near, far = _distances(x[rows], node.points)
            kept = np.zeros((len(rows), len(node.points)), bool)
            slack = ROUNDING * (length[rows, None] + np.where(np.isfinite(self.most[number]), self.most[number], 0)[None, :]) + 1e-9
            for w in range(floor.shape[1]):
                outer = length[rows, None] + self.most[number][None, :] - 2.0 * floor[rows, w][:, None] + slack
                inner = length[rows, None] + self.least[number][None, :] - 2.0 * ceiling[rows, w][:, None] - slack
                reach, hole = np.sqrt(np.maximum(outer, 0)), np.sqrt(np.maximum(inner, 0))
                fits = (outer >= 0) & (floor[rows, w] <= ceiling[rows, w])[:, None]
                for i in range(len(node.points)):
                    nearest = np.maximum(near[:, i, None] - reach, hole - far[:, i, None])
                    fits &= (self.high[number][i][None, :] >= nearest) & (self.low[number][i][None, :] <= far[:, i, None] + reach)
                kept |= fits
            for j, child in enumerate(node.children):
                those = rows[kept[:, j]]
                if child < 0:
                    out[those, ~child] = True
                elif len(those):
                    pending.append((child, those))
        return out

    def raised(self, x: np.ndarray, labels: np.ndarray, keys: np.ndarray, floor: np.ndarray, ceiling: np.ndarray, same: bool, k: int) -> np.ndarray:
        """Floors raised to the ``k``-th best score that the sample has in a window: no better row is lost."""
        scores = _scores(x, self.sample)
        usable = (labels[:, None] == self.sample_labels[None, :]) == same
        usable &= keys[:, None] != self.sample_keys[None, :]
        out = floor.copy()
        if scores.shape[1] >= k:
            for w in range(floor.shape[1]):
                inside = usable & (scores >= floor[:, w, None]) & (scores <= ceiling[:, w, None])
                best = np.partition(np.where(inside, scores, -FAR), -k, axis=1)[:, -k]
                out[:, w] = np.maximum(out[:, w], best)
        return out


ROW = "key long, vec_id long, label long, vector array<int>"


def prepared(rows: DataFrame) -> DataFrame:
    """``key, vec_id, label, vector``: rows that take part, with moved labels and integer components.

    Rows equal in all three count once; the key tells others apart that share an id.
    """
    given = pick(rows, "vec_id", "embedding", "label")
    given = given.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>").alias("vector"))
    given = given.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("vector"))
    moved = F.when(F.col("vec_id") % EVERY_RELABELLED == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    steps = F.transform("vector", lambda x: F.floor(F.greatest(F.least(x, F.lit(1e12)), F.lit(-1e12)) * SCALE))
    whole = given.select("vec_id", moved.alias("label"), steps.alias("vector"))
    whole = whole.where(~F.exists("vector", lambda x: F.abs(x) > LARGEST)).withColumn("vector", F.col("vector").cast("array<int>"))
    keyed = whole.select(F.xxhash64("vec_id", "label", "vector").alias("key"), "vec_id", "label", "vector")
    return keyed.dropDuplicates(["key"])


def _sent_down(batches: Iterator[pa.RecordBatch], tree: Tree, width: int) -> Iterator[pa.RecordBatch]:
    names = ["key", "vec_id", "label", "vector"]
    for batch in batches:
        leaf = tree.leaf_of(matrix(batch["vector"], width, np.int64))
        yield pa.RecordBatch.from_arrays([*[batch[c] for c in names], pa.array(leaf)], names=[*names, "leaf"])


def _ranges(batches: Iterator[pa.RecordBatch], tree: Tree, width: int) -> Iterator[pa.RecordBatch]:
    """Per task: for each node, child and split point the range of distances; ``point = -1`` has the
    squared lengths and the number of rows."""
    size = [len(n.points) for n in tree.nodes]
    low = [np.full((m + 1, m), np.inf) for m in size]
    high = [np.full((m + 1, m), -np.inf) for m in size]
    count = [np.zeros(m, np.int64) for m in size]
    for batch in batches:
        x = matrix(batch["vector"], width, np.int64)
        for number, rows, nearest in tree.walk(x):
            near, far = _distances(x[rows], tree.nodes[number].points)
            length = _lengths(x[rows])
            for j in np.unique(nearest):
                own = nearest == j
                count[number][j] += own.sum()
                low[number][:-1, j] = np.minimum(low[number][:-1, j], near[own].min(axis=0))
                high[number][:-1, j] = np.maximum(high[number][:-1, j], far[own].max(axis=0))
                low[number][-1, j] = min(low[number][-1, j], length[own].min())
                high[number][-1, j] = max(high[number][-1, j], length[own].max())
    for number, m in enumerate(size):
        point, child = np.indices((m + 1, m)).reshape(2, -1)
        some = count[number][child] > 0
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(some.sum(), number, np.int32)),
                pa.array(np.where(point == m, -1, point)[some].astype(np.int32)),
                pa.array(child[some].astype(np.int32)),
                pa.array(low[number].reshape(-1)[some]),
                pa.array(high[number].reshape(-1)[some]),
                pa.array(np.where(point == m, count[number][child], 0)[some]),
            ],
            names=["node", "point", "child", "low", "high", "n"],
        )


def build_index(rows: DataFrame, *, sample: int = SAMPLE, degree: int = DEGREE, leaf: int = LEAF, block: int = BLOCK) -> tuple[Index, DataFrame, int]:
    """Index, the blocks of all leaves (``leaf, block`` and one row of arrays), and the vectors' length.

    The driver holds the sample, and the ranges, whose number follows from the sample.
    """
    width = max(rows.agg(F.max(F.size("vector"))).first()[0] or 0, 1)
    drawn = rows.orderBy(F.xxhash64("key", F.lit(11)), "key").limit(sample).select("key", "label", "vector").toArrow()
    points = matrix(drawn["vector"], width, np.int64) if drawn.num_rows else np.zeros((0, width), np.int64)
    tree = grow_tree(points if len(points) else np.zeros((1, width), np.int64), degree, leaf)
    placed = materialise(rows.mapInArrow(lambda b: _sent_down(b, tree, width), f"{ROW}, leaf int"), "tree-rows")
    found = placed.select("vector").mapInArrow(lambda b: _ranges(b, tree, width), "node int, point int, child int, low double, high double, n long")
    found = found.groupBy("node", "point", "child").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    size = [len(n.points) for n in tree.nodes]
    low, high = ([np.full((m, m), v) for m in size] for v in (np.inf, -np.inf))
    least, most = ([np.full(m, v) for m in size] for v in (np.inf, -np.inf))
    blocks = np.zeros(tree.leaves, np.int64)
    for r in found.collect():
        if r.point >= 0:
            low[r.node][r.point, r.child], high[r.node][r.point, r.child] = r.low, r.high
        else:
            least[r.node][r.child], most[r.node][r.child] = r.low, r.high
            child = tree.nodes[r.node].children[r.child]
            if child < 0:
                blocks[~child] = -(-r.n // block)
    index = Index(tree, low, high, least, most, blocks, points, drawn["label"].to_numpy(), drawn["key"].to_numpy())
    counts = F.array(*[F.lit(int(b)) for b in blocks])
    number = F.pmod(F.xxhash64("key"), F.get(counts, F.col("leaf"))).cast("int")
    dealt = placed.withColumn("block", number).groupBy("leaf", "block")
    made = dealt.applyInArrow(lambda t: _pack_rows(t, width), "leaf int, block int, keys binary, ids binary, labels binary, vectors binary")
    return index, materialise(made, "tree-blocks"), width


def _pack_rows(table: pa.Table, width: int) -> pa.Table:
    """The rows of a block in order of id, so that an earlier place wins a tie."""
    ids, keys = table["vec_id"].to_numpy(), table["key"].to_numpy()
    order = np.lexsort((keys, ids))
    columns = {"keys": keys[order], "ids": ids[order], "labels": table["label"].to_numpy()[order], "vectors": matrix(table["vector"], width, np.int32)[order]}
    return pa.table({"leaf": table["leaf"][:1], "block": table["block"][:1], **{k: pa.array([packed(v)], pa.binary()) for k, v in columns.items()}})


QUERY = "key long, vec_id long, label long, vector array<int>, floors array<long>, ceilings array<long>"
PACKS = "leaf int, block int, a_keys binary, a_labels binary, a_vectors binary, floors binary, ceilings binary"


def _send(table: pa.Table, index: Index, width: int, same: bool, k: int) -> pa.Table:
    """One pack of anchors, once for every block of a leaf that may hold a row for some of them."""
    keys, labels = table["key"].to_numpy(), table["label"].to_numpy()
    x = matrix(table["vector"], width, np.int64)
    windows = max((len(v) for v in table["floors"].to_pylist()), default=1)
    floor, ceiling = np.full((len(x), windows), FAR), np.full((len(x), windows), -FAR)
    for r, (lows, highs) in enumerate(zip(table["floors"].to_pylist(), table["ceilings"].to_pylist(), strict=True)):
        floor[r, : len(lows)], ceiling[r, : len(highs)] = lows, highs
    floor = index.raised(x, labels, keys, floor, ceiling, same, k)
    kept = index.survivors(x, floor, ceiling) & (index.blocks > 0)[None, :]
    out: dict[str, list] = {c: [] for c in ("leaf", "block", "a_keys", "a_labels", "a_vectors", "floors", "ceilings")}
    for leaf in np.flatnonzero(kept.any(axis=0)):
        rows = kept[:, leaf]
        blobs = [packed(v[rows]) for v in (keys, labels, x.astype(np.int32), floor, ceiling)]
        for block in range(index.blocks[leaf]):
            for name, value in zip(out, [leaf, block, *blobs], strict=True):
                out[name].append(value)
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
    return pa.table({c: pa.array(v, kind) for (c, v), kind in zip(out.items(), kinds, strict=True)})


def _best(batches: Iterator[pa.RecordBatch], width: int, same: bool, k: int) -> Iterator[pa.RecordBatch]:
    """The best ``k`` rows of a block for each anchor and window of a pack."""
    for batch in batches:
        for n in range(batch.num_rows):
            held = lambda c, kind=np.int64: np.frombuffer(batch[c][n].as_py(), kind)  # noqa: B023, E731
            keys, labels, b_keys, b_labels, ids = (held(c) for c in ("a_keys", "a_labels", "keys", "labels", "ids"))
            floor, ceiling = (held(c).reshape(len(keys), -1) for c in ("floors", "ceilings"))
            x, b = (held(c, np.int32).reshape(-1, width).astype(np.int64) for c in ("a_vectors", "vectors"))
            scores = _scores(x, b)
            usable = (labels[:, None] == b_labels[None, :]) == same
            usable &= keys[:, None] != b_keys[None, :]
            for w in range(floor.shape[1]):
                inside = usable & (scores >= floor[:, w, None]) & (scores <= ceiling[:, w, None])
                row, place = np.nonzero(inside)
                # rows are in order of anchor; within one, higher scores and then earlier places come first
                value = scores[row, place]
                order = np.lexsort((place, -value, row))
                row, place, value = row[order], place[order], value[order]
                rank = np.arange(len(row)) - np.searchsorted(row, row)
                top = rank < k
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys[row[top]]),
                        pa.array(np.full(top.sum(), w, np.int32)),
                        pa.array(ids[place[top]]),
                        pa.array(b_keys[place[top]]),
                        pa.array(value[top]),
                    ],
                    names=["anchor", "window", "id", "key", "score"],
                )


def search(index: Index, blocks: DataFrame, queries: DataFrame, width: int, *, same: bool, k: int, pack: int = PACK) -> DataFrame:
    """``anchor, window, id, key, score, rank``: for each window of each query (columns ``QUERY``) its best
    ``k`` rows of the same label, or of another one. Windows are inclusive; ``anchor`` is the query's key."""
    packs = -(-queries.count() // pack)
    dealt = queries.withColumn("pack", F.pmod(F.xxhash64("key"), F.lit(max(packs, 1)))).groupBy("pack")
    sent = dealt.applyInArrow(lambda t: _send(t.drop_columns(["pack"]), index, width, same, k), PACKS)
    # the size of packed arrays cannot be estimated, so neither side may be taken for a small one
    met = sent.hint("merge").join(blocks, ["leaf", "block"])
    found = met.mapInArrow(lambda b: _best(b, width, same, k), "anchor long, window int, id long, key long, score long")
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id", "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _share(score: Column, percent: int) -> Column:
    """``floor(score * percent / 100)``, exact."""
    whole = score.cast("decimal(19,0)") * F.lit(percent).cast("decimal(3,0)")
    return F.floor(whole / F.lit(100).cast("decimal(3,0)")).cast("long")


def mine(
    rows: DataFrame, *, positives: int = POSITIVES, negatives: int = NEGATIVES, sample: int = SAMPLE, degree: int = DEGREE, leaf: int = LEAF,
    block: int = BLOCK, pack: int = PACK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of ``vec_id, embedding, label``.

    Takes no part: a row without an id or a label, one whose vector is null or has a null or non-finite
    component, and one with a component beyond 2**18 in magnitude (scores of up to 2,048 components
    then fit a long). A shorter or empty vector counts as filled up with zeros. Rows equal in id, label and
    integer vector count once; rows that only share an id are different rows, and their results stand side by
    side. A positive whose score is negative has an empty window; at zero only negatives of score zero fit.
    Anchors without positives, and positives without negatives, give no row; an empty table gives none.
    Other columns are ignored, whatever their names.
    """
    kept = materialise(prepared(rows), "integer-vectors")
    index, blocks, width = build_index(kept, sample=sample, degree=degree, leaf=leaf, block=block)
    anchors = materialise(kept.where(F.col("vec_id") % EVERY_ANCHOR == 0), "anchors")
    anything = F.array(F.lit(-int(FAR))), F.array(F.lit(int(FAR)))
    asked = anchors.select("*", anything[0].alias("floors"), anything[1].alias("ceilings"))
    near = search(index, blocks, asked, width, same=True, k=positives, pack=pack)
    near = materialise(near.select("anchor", "rank", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    lower = -_share(-F.col("positive_score"), LOW)
    window = F.struct("rank", lower.alias("floor"), _share(F.col("positive_score"), HIGH).alias("ceiling"))
    windows = near.where("positive_score >= 0").groupBy("anchor").agg(F.sort_array(F.collect_list(window)).alias("windows"))
    asked = anchors.join(windows, anchors["key"] == windows["anchor"]).select(
        *[anchors[c] for c in anchors.columns], F.col("windows.floor").alias("floors"), F.col("windows.ceiling").alias("ceilings"), "windows"
    )
    asked = materialise(asked, "windows")
    hard = search(index, blocks, asked.drop("windows"), width, same=False, k=negatives, pack=pack)
    # windows are in order of the positives' ranks; those left out above are the last
    places = asked.select(F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.posexplode("windows").alias("window", "w"))
    named = places.select("anchor", "anchor_id", "window", F.col("w.rank").alias("place")).join(
        near.select("anchor", F.col("rank").alias("place"), "positive_id", "positive_score"), ["anchor", "place"]
    )
    hard = hard.select("anchor", "window", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    found = named.join(hard, ["anchor", "window"])
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL = f"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % {EVERY_RELABELLED} = 0 THEN (label+1) % {LABELS} ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE}*CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label=b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % {EVERY_ANCHOR} = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {POSITIVES})
SELECT p.anchor_id, p.other AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
  n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id=p.anchor_id AND NOT n.same
  AND {LOW}*p.score <= 100*n.score AND 100*n.score <= {HIGH}*p.score
QUALIFY rank <= {NEGATIVES}
"""
