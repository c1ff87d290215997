from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from conftest import EDGES

from reviewmill.llm import language

SOUNDS = {"xa": ["the", "ing", "er", "th"], "xb": ["que", "eau", "é", "ou"], "xc": ["sch", "ung", "ö", "ei"]}


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(600):
        lang = rnd.choice(list(SOUNDS))
        text = " ".join("".join(rnd.choice(SOUNDS[lang]) for _ in range(rnd.randint(1, 4))) for _ in range(rnd.randint(2, 40)))
        rows.append((i, text, lang if i % 50 else None))
    rows += [(None if i is None else i + 1000, t, "xa") for i, t in EDGES] + [(1100, "12 34!", "xb")]
    return spark.createDataFrame([(*r, "s", 3) for r in rows], "doc_id long, text string, lang string, source string, score int").repartition(3)


def test_held_out_accuracy_and_contract(docs):
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in docs.collect()}
    out = language.identify(docs, language.fit(docs)).collect()
    assert len(out) == docs.count()
    right = total = 0
    for r in out:
        lang, text = truth[r["doc_id"]]
        fold = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
        assert r["held_out"] == fold and 0 <= r["score"] <= 1
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
        if fold and r["doc_id"] < 600 and lang:
            total, right = total + 1, right + (r["lang_pred"] == lang)
    assert total > 100 and right / total > 0.97


def test_held_out_rows_do_not_matter(docs):
    hidden = docs.withColumn("lang", language.F.when(~language.held_out(language.F.col("doc_id")), language.F.col("lang")))
    a, b = language.fit(docs), language.fit(hidden)
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.idf, b.idf) and a.temperature == b.temperature


def test_grams_and_temperature():
    at, counts = language.gram_counts("abab")
    assert counts.sum() == 4 + 3 + 2 and sorted(counts) == [1, 1, 1, 2, 2, 2]
    rnd = np.random.default_rng(0)
    logits = rnd.normal(size=(4000, 3))
    labels = np.array([rnd.choice(3, p=p) for p in language.softmax(logits)])
    assert language.best_temperature(logits * 4, labels) == pytest.approx(4, rel=0.15)


def test_nothing_to_learn(docs):
    model = language.fit(docs.where("lang is null"))
    assert {r["lang_pred"] for r in language.identify(docs, model).collect()} == {"und"}
    assert language.identify(docs.where("doc_id < 0"), model).collect() == []
