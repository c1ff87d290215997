from __future__ import annotations

from collections import Counter, defaultdict

import brute
import pytest
from conftest import EDGES
from pyspark.sql import functions as F

from reviewmill.llm import mixing


def targets(sizes):
    """Resharing until nobody is above, as stated."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    open_, left, out = set(order), 1.5 * sum(sizes.values()), {}
    while open_:
        total = sum(weight[s] for s in open_)
        level = {s: left * weight[s] / total for s in open_}
        over = [s for s in open_ if level[s] > 2 * sizes[s] + 1e-9]
        if not over:
            return out | level
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


@pytest.fixture
def rows(corpus):
    found = [(i, t * 3, f"s{i % 5}") for i, t in corpus(6, n=120, length=200)]
    return found + [(i, t, None if i == 12 else "z") for i, t in EDGES]


def build(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, 2) for i, t, s in rows], "doc_id long, text string, source string, size long, rank long").repartition(3)


def test_contract(spark, rows):
    docs = build(spark, rows)
    got = mixing.Mix(docs, block_words=16).taken().collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(brute.words(t))
    want, taken = targets(sizes), Counter()
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in got) == Counter((i, len(brute.words(t)), s) for i, t, s in rows)
    for r in got:
        taken[r["source"]] += r["taken"]
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * 16
    again = mixing.Mix(docs.repartition(5), block_words=16).taken().collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_permutation(spark):
    for n in (1, 2, 7, 100):
        out = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(3)).alias("x")).collect()
        assert sorted(r["x"] for r in out) == list(range(n))


def test_slots_and_texts_agree_with_taken(spark, rows):
    mix = mixing.Mix(build(spark, rows), block_words=16, slots_per_shard=32)
    slots = mix.slots.collect()
    assert sorted(r["slot"] for r in slots) == list(range(len(slots)))
    used = Counter((r["rank"], r["block"]) for r in slots)
    blocks = {r["rank"]: r["blocks"] for r in mix.sources.collect()}
    for rank in {r["rank"] for r in slots}:
        counts = [used.get((rank, b), 0) for b in range(blocks[rank])]
        assert max(counts) - min(counts) <= 1 and max(counts) <= 2
    shards = defaultdict(int)
    drawn = Counter()
    for r in mix.shards.collect():
        shards[r["shard"]] += r["drawn"]
        drawn[r["shard"], r["rank"]] += r["drawn"]
    assert all(n == 32 for s, n in shards.items() if s < max(shards))
    assert drawn == Counter((r["shard"], r["rank"]) for r in slots)
    assert all(r["slot"] // 32 == r["shard"] for r in slots)
    assert sum(p["words"] for r in mix.blocks().collect() for p in r["parts"]) == sum(r["taken"] for r in mix.taken().collect())
    words = Counter()
    texts = defaultdict(set)
    for i, t, _ in rows:
        texts[i].add((t or "").strip())
    for r in mix.texts().collect():
        words[r["doc_id"]] += len(brute.words(r["text"]))
        whole = [t for t in texts[r["doc_id"]] if len(brute.words(t)) == len(brute.words(r["text"]))]
        assert not whole or any(r["text"].strip() == t.strip() for t in whole)
    taken = Counter()
    for r in mix.taken().collect():
        taken[r["doc_id"]] += r["taken"]
    assert +words == +taken


def test_shard_draw_is_multinomial_given_the_totals(spark):
    """Chi-square of the counts against independence of shard and source, and of its spread over seeds."""
    draws = [3000, 900, 2100]
    rows = [(k, 50, n, sum(draws[:k]), sum(draws)) for k, n in enumerate(draws)]
    sources = spark.createDataFrame(rows, "rank long, blocks long, draws long, first_ticket long, slots long")
    found = []
    for seed in range(6):
        counts = {(r["shard"], r["rank"]): r["drawn"] for r in mixing.shard_counts(sources, slots_per_shard=200, seed=seed).collect()}
        for k, n in enumerate(draws):
            assert sum(v for (_, r), v in counts.items() if r == k) == n
        assert all(sum(counts.get((s, k), 0) for k in range(3)) == 200 for s in range(30))
        expected = [200 * n / sum(draws) for n in draws]
        found.append(sum((counts.get((s, k), 0) - expected[k]) ** 2 / expected[k] for s in range(30) for k in range(3)))
    # 29 * 2 degrees of freedom, standard deviation 10.8 for one seed
    assert 58 - 4 * 10.8 < min(found) and max(found) < 58 + 4 * 10.8 and abs(sum(found) / 6 - 58) < 4 * 10.8 / 6**0.5


def test_documents_name_the_shards_that_hold_them(spark, rows):
    mix = mixing.Mix(build(spark, rows), block_words=16, slots_per_shard=32)
    held = defaultdict(set)
    for r in mix.blocks().collect():
        for p in r["parts"]:
            held[r["rank"], p["offset"]].add(r["shard"])
    ids = defaultdict(list)
    for r in mix.placed.where("size > 0").collect():
        shards = held.get((r["rank"], r["offset"]))
        ids[r["doc_id"], r["source"]].append((min(shards), max(shards)) if shards else (None, None))
    for r in mix.taken().where("size > 0").collect():
        assert (r["first_shard"], r["last_shard"]) in ids[r["doc_id"], r["source"]]
    assert len({s for found in held.values() for s in found}) > 1
    plan = mix.taken()._jdf.queryExecution().optimizedPlan().toString()
    assert "drawn#" in plan and "shard#" in plan


def test_empty_table_and_plan(spark, rows):
    docs = build(spark, rows)
    assert mixing.Mix(docs.where("doc_id < 0")).taken().collect() == []
    plan = mixing.Mix(docs).taken()._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
