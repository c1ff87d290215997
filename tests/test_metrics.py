from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import groups, metrics
from reviewmill.schema import LABELS


@pytest.fixture
def predictions(spark):
    pairs = [("negative", "negative"), ("negative", "positive"), ("positive", "positive"), ("positive", "positive"), ("neutral", "positive")]
    return spark.createDataFrame(pairs, "sentiment string, prediction string")


def test_absent_class_keeps_its_cells(predictions):
    counts = metrics.confusion_counts(predictions)
    cells = metrics.confusion_matrix(counts).collect()
    assert len(cells) == 9 and sum(c["n"] for c in cells) == 5
    report = {r["label"]: r for r in metrics.class_report(counts).collect()}
    assert report["neutral"]["precision"] == report["neutral"]["recall"] == report["neutral"]["f1"] == 0.0
    assert report["positive"]["precision"] == 0.5 and report["positive"]["recall"] == 1.0
    assert [report[c]["support"] for c in LABELS] == [2, 1, 2]
    lines = {r["average"]: r for r in metrics.average_report(counts).collect()}
    assert lines["accuracy"]["f1"] == pytest.approx(3 / 5)
    assert lines["macro avg"]["f1"] == pytest.approx((2 / 3 + 0 + 2 / 3) / 3)
    assert lines["weighted avg"]["recall"] == pytest.approx(3 / 5)


def test_constant_model_has_auc_one_half(spark):
    rows = [(c, "positive", [0.0, 0.0, 1.0]) for c in LABELS for _ in range(4)]
    df = spark.createDataFrame(rows, "sentiment string, prediction string, probability array<double>")
    df = df.withColumn("model", F.lit("majority"))
    best = metrics.leaderboard(df).first()
    assert best["auc_roc"] == 0.5 and best["accuracy"] == pytest.approx(1 / 3)
    assert metrics.off_majority(df, "positive").first()["off_majority"] == 0


def test_group_shares(spark):
    rows = [("a", "positive"), ("a", "negative"), ("b", "positive")]
    df = spark.createDataFrame(rows, "Branch string, sentiment string")
    shares = {r["Branch"]: r for r in groups.sentiment_by_branch(df).collect()}
    assert (shares["a"]["negative"], shares["b"]["negative"], shares["a"]["neutral"]) == (50.0, 0.0, None)
    balance = groups.sentiment_distribution(df).orderBy("position").collect()
    assert [r["count"] for r in balance] == [1, None, 2]
