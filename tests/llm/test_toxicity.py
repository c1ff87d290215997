from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import EDGES

from reviewmill.llm import toxicity

BAD = ["grot", "flek", "snarl", "vuil"]


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(4)
    vocab = ["".join(rnd.choice("abcdefg") for _ in range(4)) for _ in range(300)]
    rows, labels = [], []
    for i in range(600):
        text = [rnd.choice(vocab) for _ in range(rnd.randint(5, 80))]
        toxic = i % 4 == 0
        for _ in range(rnd.choice([2, 5, 9]) if toxic else 0):
            text.insert(rnd.randrange(len(text)), rnd.choice(BAD).upper() + ",")
        rows.append((i, " ".join(text)))
        if i < 400:
            labels.append((i, 1, int(toxic)))
    rows += [(i if i is None else i + 1000, t) for i, t in EDGES]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return docs, spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")


def test_held_out_documents(tables):
    docs, labels = tables
    out = {r["doc_id"]: r for r in toxicity.severity(docs, toxicity.fit(docs, labels)).collect()}
    assert all(out[i]["toxic"] == (i % 4 == 0) for i in range(400, 600))
    assert not any(r["toxic"] for i, r in out.items() if i is None or i >= 1000)
    assert all(0 <= r["expected_severity"] <= toxicity.GRADES for r in out.values())
    many = [r["expected_severity"] for i, r in out.items() if i is not None and i < 600 and i % 4 == 0]
    assert max(many) - min(many) > 0.5  # grades differ, not just the decision


def test_gradient_and_thresholds():
    rnd = np.random.default_rng(1)
    n, x = 2000, rnd.normal(size=2000)
    latent = 2 * x + rnd.logistic(size=n)
    grade = (latent > 0).astype(int) + (latent > 2) + (latent > 4)
    w, t = toxicity.fit_ordinal(np.arange(n), np.zeros(n, int), x, grade, 1, 3, penalty=0, epochs=60)
    assert w[0] == pytest.approx(2, abs=0.2) and t == pytest.approx([0, 2, 4], abs=0.35)


def test_features_equal_brute_force():
    texts = ["The the, cat9dog abcdefghi É é", None, "", "a-b A"]
    got = {}
    for low, _, row, hashes in toxicity.chunk_features(pa.array(texts)):
        for r, _, v in zip(*toxicity.log_counts(row, hashes), strict=True):
            got.setdefault(low + r, []).append(round(np.expm1(v)))
    want = {}
    for k, t in enumerate(texts):
        words = re.findall("[a-zé]+", (t or "").lower())
        found = Counter(words) + Counter(("prefix", w[:n]) for w in words for n in toxicity.PREFIXES if len(w) > n)
        if found:
            want[k] = sorted(found.values())
    assert {k: sorted(v) for k, v in got.items()} == want


def test_without_labels_or_documents(tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels.where("doc_id < 0"))
    assert not any(r["toxic"] for r in toxicity.severity(docs, model).collect())
    assert toxicity.severity(docs.where("doc_id < 0"), model).collect() == []


def test_mislabelled_clean_rows_do_not_move_the_decision(spark, tables):
    docs, labels = tables
    strong = [(5000 + i, " ".join(BAD * 10)) for i in range(3)]
    labelled = labels.union(spark.createDataFrame([(i, 1, 0) for i, _ in strong], labels.schema))
    more = docs.union(spark.createDataFrame(strong, docs.schema))
    model = toxicity.fit(more, labelled)
    out = {r["doc_id"]: r["toxic"] for r in toxicity.severity(more, model).collect()}
    assert all(out[i] == (i % 4 == 0) for i in range(400, 600))  # mild ones have two words of evidence
    assert model.clean_lost == pytest.approx(3 / 303)


def test_only_toxic_labels_reject_nothing_without_evidence(tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels.where("toxic = 1"))
    assert not any(r["toxic"] for r in toxicity.severity(docs, model).collect() if r["doc_id"] is None or r["doc_id"] >= 1000)
