"""Queries that name a whole method run all of it."""

from __future__ import annotations

from checks import queries
from reviewmill.plans import baselines


def test_train_and_evaluate_ranks_all_four_baselines(spark, monkeypatch):
    rows = [(i, label, [float(label == c) for c in ("negative", "neutral", "positive")]) for i, label in enumerate(["negative", "neutral", "positive"] * 2)]

    def scored(silver, splits, *_, models=baselines.MODELS, **__):
        made = [(name, i, label, label, p) for name in models for i, label, p in rows]
        return spark.createDataFrame(made, "model string, row_id long, sentiment string, prediction string, probability array<double>")

    monkeypatch.setattr(queries, "gold", lambda *_: (None, None))
    monkeypatch.setattr(baselines, "train_and_predict", scored)
    board = queries.REGISTRY["m6_train_and_evaluate"](spark, "").collect()
    assert {r["model"] for r in board} == set(baselines.MODELS) and len(board) == 4
