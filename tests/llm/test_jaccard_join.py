from __future__ import annotations

import random

import brute
import pytest
from conftest import EDGES

from reviewmill.llm import jaccard_join as jj
from reviewmill.llm.components import connected_components


def result(docs, **options):
    return sorted(tuple(r) for r in jj.near_duplicates(docs, **options).select("doc_id", "class_id", "n_links").collect())


def near_rows(seed, groups=6, size=9, length=120):
    rnd = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rnd.randrange(400)}" for _ in range(length)]
        for _ in range(rnd.randint(1, size)):
            text = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                text[rnd.randrange(len(text))] = f"x{rnd.randrange(400)}"
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("seed,block", [(1, 256), (2, 3)])
def test_equals_brute_force(make_docs, seed, block):
    rows = near_rows(seed) + [(i + 500, t) for i, t in EDGES if i is not None and i != 12] + [(900, "same text here and there again")]
    assert result(make_docs(rows), block=block) == brute.near_duplicates(rows)


def test_short_texts(make_docs, corpus):
    rows = [(i, t) for i, t in corpus(11, n=50)]
    assert result(make_docs(rows)) == brute.near_duplicates(rows)


def test_null_ids_and_repeated_rows(make_docs):
    got = jj.near_duplicates(make_docs(EDGES)).collect()
    found = sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in got if r["doc_id"] is not None)
    assert found == [(7, 7, 0), (8, 8, 0), (9, 9, 0), (10, 10, 0), (11, 11, 0), (12, 12, 2), (12, 12, 2), (13, 12, 2)]
    assert [r["class_id"] for r in got if r["doc_id"] is None] == [None]
    assert jj.near_duplicates(make_docs(EDGES).where("doc_id < 0")).collect() == []


def test_bands_reach_the_recall():
    bands = jj.band_count(0.8, jj.ROWS, jj.RECALL)
    assert 1 - (1 - 0.8**jj.ROWS) ** bands >= jj.RECALL > 1 - (1 - 0.8**jj.ROWS) ** (bands - 1)


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(140)] + [(k, k + 1) for k in range(400, 460)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        parent[b] = a
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "u long, v long"), "test").collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
