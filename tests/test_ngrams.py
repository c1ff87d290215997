"""N-gram counts against plain loops, and the size of their tasks."""

from __future__ import annotations

from collections import Counter

import pytest

from reviewmill.operators import ngrams
from reviewmill.schema import BRANCH, TEXT
from reviewmill.sources import workspace

TEXTS = ["red green blue", "red green red green", "", None, "x", "solo", "green blue", "red green blue"]


@pytest.mark.parametrize("span", [(1, 1), (2, 2), (1, 3), (2, 4)])
def test_counts_equal_a_plain_loop(make_reviews, span):
    rows = [{TEXT: t, BRANCH: f"b{i % 2}"} for i, t in enumerate(TEXTS)]
    found = {(r[BRANCH], r["ngram"]): r["count"] for r in ngrams.ngram_counts(make_reviews(rows), span, None, by=[BRANCH]).collect()}
    expected = Counter()
    for row in rows:
        words = [w for w in (row[TEXT] or "").split() if len(w) > 1]
        expected.update((row[BRANCH], " ".join(words[i : i + n])) for n in range(span[0], span[1] + 1) for i in range(len(words) - n + 1))
    assert found == expected


def test_tasks_are_bounded_by_bytes_of_files(spark, make_reviews, monkeypatch, tmp_path):
    path = f"{tmp_path}/with space"
    make_reviews([{TEXT: f"red green {i}{i} blue{i}"} for i in range(500)], partitions=1).write.parquet(path)
    stored = spark.read.parquet(path)
    assert workspace.in_small_parts(stored).rdd.getNumPartitions() == stored.rdd.getNumPartitions()
    whole = sorted(map(tuple, ngrams.ngram_counts(stored, (1, 3), None).collect()))
    size = workspace.file_bytes(stored)
    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(workspace, "PART_BYTES", -(-size // (cores + 1)))
    assert workspace.in_small_parts(stored).rdd.getNumPartitions() == stored.rdd.getNumPartitions()
    monkeypatch.setattr(workspace, "PART_BYTES", size // 40)
    counts = ngrams.ngram_counts(stored, (1, 3), None)
    parts = workspace.in_small_parts(stored.select(TEXT)).rdd.getNumPartitions()
    assert parts >= 40
    assert f"RoundRobinPartitioning({parts})" in counts._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, counts.collect())) == whole
