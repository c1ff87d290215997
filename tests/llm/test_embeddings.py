"""Ops 11 and 13 against brute force."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest

from reviewmill.llm import embedding_dedup, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, Label string, class string, key long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 3) for r in rows], SCHEMA).repartition(3)


def vectors(seed, n=160, width=6, labels=3):
    """Random vectors, a third of them near or exact copies of others; halves of floats are exact."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        vector = [float(np.float32(rnd.gauss(0, 1))) for _ in range(width)]
        label = rnd.randrange(labels)
        if rows and rnd.random() < 0.4:
            _, near, label = rows[rnd.randrange(min(len(rows), 5))]
            vector = [float(np.float32(x + rnd.choice([0, 0.05, 0.2]) * rnd.gauss(0, 1))) for x in near]
        rows.append((i, vector, label))
    return rows


ODD = [
    (900, None, 1),
    (901, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1),
    (902, [float("nan")] * 6, 1),
    (903, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0], 1),
    (904, [0.0] * 6, 1),
    (905, [], 1),
    (906, [1.0, 0.5], 1),
    (950, [1.0, 0.5], None),
    (907, [-0.0, 0.5], 1),
    (908, [0.0, 0.5], 1),
    (909, [1e30, 1e30, 0.0, 0.0, 0.0, 0.0], 2),
]


def links(spark, rows, **options):
    found = embedding_dedup.near_duplicates(table(spark, rows), **options)
    return sorted((tuple(r) for r in found.select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"block": 7, "codewords": 3, "sample": 20}), (3, {"block": 1, "codewords": 5})])
def test_links_equal_brute_force(spark, seed, options):
    rows = vectors(seed) + ODD
    rows += [rows[3], rows[3], (None, *rows[4][1:]), (None, [9.0, -9.0, 9.0, 1.0, 1.0, 1.0], 7)]
    want = [(i, n, c, i == c) for i, n, c, _ in brute.embedding_links(rows)]
    assert links(spark, rows, **options) == want


def test_links_of_nothing(spark):
    assert links(spark, vectors(1)[:0]) == []
    assert links(spark, [(5, None, 1), (6, [1.0], None)]) == [(5, 0, 5, True), (6, 0, 6, True)]
    assert links(spark, [(5, [2.0], 1), (6, [1.0], 1)]) == [(5, 1, 5, True), (6, 1, 5, False)]


def test_hot_group_of_near_copies(spark):
    rnd = np.random.default_rng(5)
    base = rnd.standard_normal(6)
    rows = [(i, [float(np.float32(x)) for x in base + 0.02 * rnd.standard_normal(6)], 1) for i in range(120)] + [(500 + i, v, 1) for i, v, _ in vectors(6, 40)]
    assert links(spark, rows, block=16, codewords=4) == brute.embedding_links(rows)


def test_bounds_hold_and_recall_is_reached():
    rnd = np.random.default_rng(3)
    units = rnd.standard_normal((2500, 16))
    units[1250:] = units[:1250] + 0.09 * rnd.standard_normal((1250, 16))
    units /= np.linalg.norm(units, axis=1)[:, None]
    linked = np.argwhere(np.triu(units @ units.T >= 0.93, 1))
    assert len(linked) > 500
    for recall, least in ((1.0, 1.0), (0.95, 0.9)):
        index = embedding_dedup.fit_index(units[::2], recall=recall, codewords=10)
        seen, cells = index.visited(units), index.cells(units)
        assert seen[np.arange(len(units)), cells].all()
        share = seen[linked[:, 0], cells[linked[:, 1]]].mean()
        assert share >= least
    assert seen.mean() < 0.7
    one, two = index.bounds(units)
    sums = (one[:, :, None] + two[:, None, :]).reshape(len(units), -1)
    assert np.array_equal(seen, sums <= index.stop)


def mined(spark, rows, **options):
    found = hard_negatives.mine(table(spark, rows), **options)
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r) for r in found.select(*names).collect())


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"sample": 40, "degree": 3, "leaf": 4, "block": 9, "pack": 2}), (3, {"sample": 5, "degree": 2, "leaf": 2, "block": 3})])
def test_hard_negatives_equal_brute_force(spark, seed, options):
    rows = vectors(seed, n=230) + [r for r in ODD if r[0] != 909]
    # ties, rows that share an id, repeated rows, an anchor of another scale and one of zeros
    rows += [(1000 + i, rows[50][1], i % 3) for i in range(12)] + [rows[100], rows[100], (100, rows[7][1], 2), (1050, [0.0] * 6, 1)]
    rows += [(1100, [100.0, -80.0, 7.0, 0.0, 0.0, 1.0], 1), (None, rows[5][1], 1)]
    assert mined(spark, rows, **options) == brute.hard_negatives(rows)


def test_no_negatives_and_empty_table(spark):
    assert mined(spark, vectors(1)[:0]) == []
    assert mined(spark, [(50, [1.0], 1), (51, [1.0], 1)]) == []


def test_components_beyond_the_range_take_no_part(spark):
    rows = [(50, [1.0, 0.0], 1), (51, [1.0, 0.0], 1), (52, [0.7, 0.0], 2)]
    assert mined(spark, [*rows, (53, [3e5, 0.0], 2), (54, [-1e38, 0.0], 1)]) == mined(spark, rows) == [(50, 51, 1, 52, 65536, 45824)]


def test_tree_eliminates_and_loses_nothing():
    rnd = np.random.default_rng(8)
    centres = rnd.integers(-200, 200, (12, 8))
    x = (centres[rnd.integers(0, 12, 3000)] + rnd.integers(-9, 9, (3000, 8))).astype(np.int64)
    tree = hard_negatives.grow_tree(x[:600], degree=4, leaf=20)
    leaf = tree.leaf_of(x)
    low, high = ([np.full((len(n.points),) * 2, v) for n in tree.nodes] for v in (np.inf, -np.inf))
    least, most = ([np.full(len(n.points), v) for n in tree.nodes] for v in (np.inf, -np.inf))
    for number, rows, nearest in tree.walk(x):
        near, far = hard_negatives._distances(x[rows], tree.nodes[number].points)
        for j in np.unique(nearest):
            low[number][:, j], high[number][:, j] = near[nearest == j].min(axis=0), far[nearest == j].max(axis=0)
            size = (x[rows][nearest == j] ** 2).sum(axis=1)
            least[number][j], most[number][j] = size.min(), size.max()
    index = hard_negatives.Index(tree, low, high, least, most, np.ones(tree.leaves), x[:0], np.zeros(0), np.zeros(0))
    anchors = x[:50]
    scores = anchors @ x.T
    floor = np.sort(scores, axis=1)[:, -20:-19]
    ceiling = np.sort(scores, axis=1)[:, -5:-4]
    kept = index.survivors(anchors, floor, ceiling)
    row, place = np.nonzero((scores >= floor) & (scores <= ceiling))
    assert kept[row, leaf[place]].all()
    assert kept.mean() < 0.5
