"""Bootstrap replicates and decision thresholds against plain loops."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewmill.operators import bootstrap, metrics, thresholds
from reviewmill.schema import LABELS, ROW_ID


def predictions(spark, n=300, seed=1, partitions=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        chances = [rnd.choice([1, 1, 2, 5, 9]) for _ in LABELS]
        chances = [c / sum(chances) for c in chances]
        true = rnd.choices(LABELS, [0.1 + chances[0], 0.1 + chances[1], 1.0])[0]
        rows.append((i, true, LABELS[int(np.argmax(chances))], chances))
    schema = f"{ROW_ID} long, sentiment string, prediction string, probability array<double>"
    return spark.createDataFrame(rows, schema).repartition(partitions), rows


def macro_f1(pairs):
    scores = []
    for c in LABELS:
        hit = sum(n for t, p, n in pairs if t == p == c)
        base = sum(n for t, p, n in pairs if t == c) + sum(n for t, p, n in pairs if p == c)
        scores.append(2 * hit / base if base else 0.0)
    return sum(scores) / len(scores)


def copies(row_id, replicate, seed=42):
    digest = hashlib.sha256(f"{row_id}:{replicate // 8}:{seed}".encode()).hexdigest()
    place = replicate % 8
    bits = int(digest[8 * place : 8 * place + 8], 16)
    return sum(bits >= s for s in bootstrap.STEPS)


@pytest.mark.parametrize("replicates,partitions", [(20, 1), (13, 7)])
def test_replicates_equal_a_loop(spark, replicates, partitions):
    df, rows = predictions(spark, 80, partitions=partitions)
    got = {r["replicate"]: r["macro_f1"] for r in bootstrap.replicate_scores(bootstrap.bootstrap_counts(df, replicates=replicates)).collect()}
    assert sorted(got) == list(range(replicates))
    for b in range(replicates):
        assert got[b] == pytest.approx(macro_f1([(t, p, copies(i, b)) for i, t, p, _ in rows]))


def test_draws_are_poisson():
    assert len(bootstrap.STEPS) == len(set(bootstrap.STEPS)) == 12
    draws = np.array([copies(i, b) for i in range(300) for b in range(40)])
    assert draws.mean() == pytest.approx(1, abs=0.03) and draws.var() == pytest.approx(1, abs=0.05)
    assert (draws == 0).mean() == pytest.approx(np.exp(-1), abs=0.02)


def test_interval_covers_the_score_and_matches_the_normal_width(spark):
    df, rows = predictions(spark, 600)
    r = bootstrap.macro_f1_interval(df.withColumn("model", F.lit("m")), ["model"], replicates=400).first()
    assert r["low"] < r["macro_f1"] < r["high"] and r["replicates"] == 400
    rnd = np.random.default_rng(0)
    plain = [macro_f1([(*rows[i][1:3], 1) for i in rnd.integers(0, 600, 600)]) for _ in range(200)]
    assert r["high"] - r["low"] == pytest.approx(np.quantile(plain, 0.975) - np.quantile(plain, 0.025), rel=0.25)


def test_cut_points_equal_a_sweep(spark):
    df, rows = predictions(spark)
    df = df.unionByName(df.limit(1).withColumn("probability", F.lit(None).cast("array<double>")))
    got = {(r["label"], r["threshold"]): r for r in thresholds.cut_points(df).collect()}
    for i, c in enumerate(LABELS):
        scores = sorted({row[3][i] for row in rows})
        assert sorted(t for label, t in got if label == c) == scores
        for t in scores:
            hits = sum(row[1] == c and row[3][i] >= t for row in rows)
            predicted = sum(row[3][i] >= t for row in rows)
            support = sum(row[1] == c for row in rows)
            r = got[c, t]
            assert (r["hits"], r["predicted"], r["support"]) == (hits, predicted, support)
            assert r["f1"] == pytest.approx(2 * hits / (predicted + support))
    best = {r["label"]: r for r in thresholds.best_thresholds(thresholds.cut_points(df)).collect()}
    for c in LABELS:
        assert best[c]["f1"] == max(r["f1"] for (label, _), r in got.items() if label == c)


def test_thresholds_mend_a_classifier_that_favours_the_majority(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(400):
        true = rnd.choices(LABELS, [0.1, 0.1, 0.8])[0]
        small = [0.05 + 0.2 * (true == c) + rnd.random() * 0.1 for c in LABELS[:2]]
        rows.append((i, true, "positive", [*small, 1 - sum(small)]))
    df = spark.createDataFrame(rows, f"{ROW_ID} long, sentiment string, prediction string, probability array<double>")
    chosen = thresholds.threshold_map(thresholds.best_thresholds(thresholds.cut_points(df)))
    after = thresholds.apply_thresholds(df, chosen)
    score = lambda d: metrics.confusion_counts(d).select(metrics.macro_f1_of().alias("f")).first()["f"]
    assert score(df) < 0.35 and score(after) > 0.9


def test_decision_without_a_class_or_probabilities(spark):
    df, _ = predictions(spark, 5)
    got = thresholds.apply_thresholds(df, {"neutral": 0.0}).collect()
    assert {r["prediction"] for r in got} == {"neutral"}
    bare = df.withColumn("probability", F.lit(None).cast("array<double>"))
    assert [r["prediction"] for r in thresholds.apply_thresholds(bare, {"neutral": 0.5}).orderBy(ROW_ID).collect()] == [r["prediction"] for r in df.orderBy(ROW_ID).collect()]
