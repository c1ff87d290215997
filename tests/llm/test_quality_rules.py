from __future__ import annotations

import math

import brute
import numpy as np
import pytest
from conftest import EDGES

from reviewmill.llm import quality_rules

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
JUNK = "zz## qq$$ " * 3 + "vv%% " + " ".join(f"{i}&&" for i in range(40))


@pytest.fixture
def tables(spark, make_docs, corpus):
    prose = "the cat sat on a mat and saw one more dog run to its own red house over there by noon {}\nthe end\nthe end"
    rows = [(i, prose.format(i % 7)) for i in range(100, 130)] + [(i, f"{JUNK} {i}") for i in range(200, 215)]
    rows += [(i + 1000, t) for i, t in corpus(4)] + EDGES
    labels = [(i, 1, 0) for i in range(100, 125)] + [(200, 0, 0), (101, 1, 1), (None, 1, 0), (102, None, 0)]
    return rows, make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_base_counts_equal_brute_force(tables):
    rows, docs, labels = tables
    got = quality_rules.quality_rules(docs, labels).collect()
    assert sorted(((r["doc_id"], *[r[c] for c in BASE]) for r in got), key=repr) == sorted(
        ((i, *brute.base_counts(t)) for i, t in rows), key=repr
    )
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_trusted_like_texts_are_kept_and_junk_is_not(tables):
    _, docs, labels = tables
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(docs, labels).collect()}
    assert all(kept[i] for i in range(101, 130)) and not any(kept[i] for i in range(200, 215))


def test_weights_equal_brute_force(spark, tables):
    rows, docs, labels = tables
    trusted = {r["doc_id"] for r in quality_rules.trusted_ids(labels).collect()}
    assert trusted == set(range(100, 125))
    buckets = 64
    grams = spark.createDataFrame([(t,) for _, t in rows], "text string").select(quality_rules.text_words(quality_rules.F.col("text")).alias("words"))
    per_row = [r[0] for r in grams.select(quality_rules.gram_buckets("words", buckets)).collect()]
    raw, target = [1.0] * buckets, [1.0] * buckets
    for (i, _), found in zip(rows, per_row, strict=True):
        for b in found:
            raw[b] += 1
            target[b] += i in trusted
    want = [math.log(t / sum(target)) - math.log(r / sum(raw)) for t, r in zip(target, raw, strict=True)]
    assert quality_rules.weights(quality_rules.pick(docs, "doc_id", "text"), quality_rules.trusted_ids(labels), buckets) == pytest.approx(want)


def test_no_labels_and_no_documents(tables):
    _, docs, labels = tables
    got = quality_rules.quality_rules(docs, labels.where("doc_id < 0")).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in got)
    assert quality_rules.quality_rules(docs.where("doc_id < 0"), labels).collect() == []


def test_no_python_in_the_plan(tables):
    _, docs, labels = tables
    plan = quality_rules.quality_rules(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hash" not in plan


def test_every_label_counts(spark, tables):
    _, docs, labels = tables
    assert quality_rules.trusted_ids(spark.range(20_050).selectExpr("id doc_id", "1 quality")).count() == 20_050
    got = quality_rules.quality_rules(docs, labels, trusted_below=0.4).collect()
    threshold = np.quantile([r["log_ratio"] for r in got if r["doc_id"] in range(100, 125)], 0.4)
    for r in got:
        near = r["log_ratio"] is not None and abs(r["log_ratio"] - threshold) < 1e-9
        assert near or r["kept"] == (not r["base_failed"] and r["log_ratio"] >= threshold)


def test_ratio_threshold_and_verdict_equal_brute_force(spark, tables):
    rows, docs, labels = tables
    buckets = 512
    trusted = {r["doc_id"] for r in quality_rules.trusted_ids(labels).collect()}
    weight = quality_rules.weights(quality_rules.pick(docs, "doc_id", "text"), quality_rules.trusted_ids(labels), buckets)
    grams = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], "k int, text string")
    grams = grams.select("k", quality_rules.text_words(quality_rules.F.col("text")).alias("words"))
    found = {r["k"]: r["b"] for r in grams.select("k", quality_rules.gram_buckets("words", buckets).alias("b")).collect()}
    ratio = {k: sum(weight[x] for x in b) / len(b) if b else None for k, b in found.items()}
    known = [v for k, v in ratio.items() if rows[k][0] in trusted and v is not None]
    threshold = np.quantile(known, 0.2)
    want = []
    for k, (i, text) in enumerate(rows):
        n_words, *_, n_repeat = brute.base_counts(text)
        failed = n_words < 20 or 100 * n_repeat > 30 * n_words
        want.append((i, ratio[k], failed, not failed and ratio[k] >= threshold))
    got = [(r["doc_id"], r["log_ratio"], r["base_failed"], r["kept"]) for r in quality_rules.quality_rules(docs, labels, buckets=buckets, trusted_below=0.2).collect()]
    order = lambda r: (str(r[0]), r[1] or 0.0)
    for a, b in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert a[0] == b[0] and a[1] == pytest.approx(b[1]) and a[2] == b[2]
        near = b[1] is not None and abs(b[1] - threshold) < 1e-9
        assert near or a[3] == b[3]


def test_words_are_hashed_and_lowered_once(spark, tables):
    """Neither a slice of words for each window nor a word by its place in each pair is made."""
    _, docs, _ = tables
    rows = quality_rules.with_counts(quality_rules.pick(docs, "doc_id", "text"))
    plan = rows.withColumn("r", quality_rules.mean_ratio("words", [0.5, 1.0]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1
    assert "slice(words" not in plan and "get(words" not in plan
