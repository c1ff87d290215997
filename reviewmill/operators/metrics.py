"""Scores of a three-class classifier from a table of predictions.

Input: one line per scored row with the true ``label``, the ``prediction`` and, for the area under
the curve, ``probability`` in label order; ``by`` names the columns that tell models apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.numeric import ratio
from reviewmill.operators.distribution import running_totals
from reviewmill.schema import LABELS, SENTIMENT


def _cell(true: int, pred: int) -> str:
    return f"cell_{true}_{pred}"


def confusion_counts(
    predictions: DataFrame, by: Sequence[str] = (), *, label: str = SENTIMENT, labels: Sequence[str] = LABELS
) -> DataFrame:
    """One line per model with a counter for each cell of the matrix; zero cells come for free."""
    cells = [
        F.count_if((F.col(label) == t) & (F.col("prediction") == p)).alias(_cell(i, j))
        for i, t in enumerate(labels)
        for j, p in enumerate(labels)
    ]
    return predictions.groupBy(*by).agg(*cells)


def confusion_matrix(counts: DataFrame, by: Sequence[str] = (), *, labels: Sequence[str] = LABELS) -> DataFrame:
    """``(*by, true, pred, n, share)`` for all label pairs; ``share`` is within the true class, 0 if empty."""
    cells = []
    for i, t in enumerate(labels):
        support = sum((F.col(_cell(i, j)) for j in range(len(labels))), F.lit(0))
        for j, p in enumerate(labels):
            n = F.col(_cell(i, j))
            share = F.coalesce(ratio(n, support), F.lit(0.0))
            cells.append(F.struct(F.lit(t).alias("true"), F.lit(p).alias("pred"), n.alias("n"), share.alias("share")))
    return counts.select(*by, F.inline(F.array(*cells)))


def _class_scores(i: int, size: int) -> dict[str, Column]:
    hit = F.col(_cell(i, i))
    predicted = sum((F.col(_cell(t, i)) for t in range(size)), F.lit(0))
    support = sum((F.col(_cell(i, p)) for p in range(size)), F.lit(0))
    zero = F.lit(0.0)
    return {
        "precision": F.coalesce(ratio(hit, predicted), zero),
        "recall": F.coalesce(ratio(hit, support), zero),
        "f1": F.coalesce(ratio(2 * hit, predicted + support), zero),
        "support": support,
    }


SCORES = ("precision", "recall", "f1")


def class_report(counts: DataFrame, by: Sequence[str] = (), *, labels: Sequence[str] = LABELS) -> DataFrame:
    """``(*by, label, precision, recall, f1, support)``; a score without a base is 0."""
    cells = [
        F.struct(F.lit(c).alias("label"), *[v.alias(k) for k, v in _class_scores(i, len(labels)).items()])
        for i, c in enumerate(labels)
    ]
    return counts.select(*by, F.inline(F.array(*cells)))


def average_report(counts: DataFrame, by: Sequence[str] = (), *, labels: Sequence[str] = LABELS) -> DataFrame:
    """Accuracy, macro and weighted lines of the report; the accuracy line carries it in ``f1`` only."""
    scores = [_class_scores(i, len(labels)) for i in range(len(labels))]
    support = sum((s["support"] for s in scores), F.lit(0))
    null = F.lit(None).cast("double")

    def line(name: str, values: dict[str, Column]) -> Column:
        return F.struct(F.lit(name).alias("average"), *[values[k].alias(k) for k in SCORES], support.alias("support"))

    macro = {k: sum((s[k] for s in scores), F.lit(0.0)) / F.lit(float(len(labels))) for k in SCORES}
    weighted = {k: ratio(sum((s[k] * s["support"] for s in scores), F.lit(0.0)), support) for k in SCORES}
    lines = [
        line("accuracy", {"precision": null, "recall": null, "f1": accuracy_of(labels)}),
        line("macro avg", macro),
        line("weighted avg", weighted),
    ]
    return counts.select(*by, F.inline(F.array(*lines)))


def accuracy_of(labels: Sequence[str] = LABELS) -> Column:
    size = range(len(labels))
    hits = sum((F.col(_cell(i, i)) for i in size), F.lit(0))
    return ratio(hits, sum((F.col(_cell(i, j)) for i in size for j in size), F.lit(0)))


def macro_f1_of(labels: Sequence[str] = LABELS) -> Column:
    scores = [_class_scores(i, len(labels))["f1"] for i in range(len(labels))]
    return sum(scores, F.lit(0.0)) / F.lit(float(len(labels)))


def recall_table(counts: DataFrame, by: Sequence[str] = (), *, labels: Sequence[str] = LABELS) -> DataFrame:
    """Recall of each class as a column, one line per model."""
    return counts.select(*by, *[_class_scores(i, len(labels))["recall"].alias(c) for i, c in enumerate(labels)])


def off_majority(predictions: DataFrame, majority: str, by: Sequence[str] = ()) -> DataFrame:
    """Predictions that are not the majority class, and all predictions."""
    return predictions.groupBy(*by).agg(
        F.count_if(~F.col("prediction").eqNullSafe(F.lit(majority))).alias("off_majority"),
        F.count(F.lit(1)).alias("predictions"),
    )


def auc_one_vs_rest(
    predictions: DataFrame,
    by: Sequence[str] = (),
    *,
    label: str = SENTIMENT,
    labels: Sequence[str] = LABELS,
) -> DataFrame:
    """Area under the ROC curve of each class against the rest: ``(*by, label, auc)``.

    The area is the rank sum of the positive rows with average ranks for equal scores. Rows are
    counted per distinct score; ranks are running totals over those. NULL without both sides, and
    rows without probabilities are not counted.
    """
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("class"),
                F.col("probability")[i].alias("score"),
                (F.col(label) == c).cast("long").alias("positive"),
            )
            for i, c in enumerate(labels)
        ]
    )
    scored = predictions.where(F.col("probability").isNotNull() & F.col(label).isNotNull())
    long = scored.select(*by, F.inline(cells))
    keys = [*by, "class"]
    hist = long.groupBy(*keys, "score").agg(F.count(F.lit(1)).alias("n"), F.sum("positive").alias("pos"))
    ranked = running_totals(hist, keys, "score", ["n"])
    rank = F.col("before_n") + (F.col("n") + 1) / 2.0
    sums = ranked.groupBy(*keys).agg(
        F.sum(F.col("pos") * rank).alias("rank_sum"),
        F.sum("pos").cast("double").alias("p"),
        F.sum(F.col("n") - F.col("pos")).cast("double").alias("q"),
    )
    area = F.try_divide(F.col("rank_sum") - F.col("p") * (F.col("p") + 1) / 2.0, F.col("p") * F.col("q"))
    return sums.select(*by, F.col("class").alias("label"), area.alias("auc"))


def macro_auc(areas: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Plain mean over the classes; NULL if any class has no area."""
    complete = F.count("auc") == F.count(F.lit(1))
    return areas.groupBy(*by).agg(F.when(complete, F.avg("auc")).alias("auc_roc"))


def rank_models(
    counts: DataFrame, areas: DataFrame, by: str = "model", *, labels: Sequence[str] = LABELS
) -> DataFrame:
    """``(model, accuracy, auc_roc, macro_f1)`` from confusion counts and areas, best macro-F1 first.

    A model without probabilities has a NULL area.
    """
    scored = counts.select(by, accuracy_of(labels).alias("accuracy"), macro_f1_of(labels).alias("macro_f1"))
    ranked = scored.join(macro_auc(areas, [by]), by, "left").select(by, "accuracy", "auc_roc", "macro_f1")
    return ranked.orderBy(F.desc("macro_f1"), by)


def leaderboard(
    predictions: DataFrame, by: str = "model", *, label: str = SENTIMENT, labels: Sequence[str] = LABELS
) -> DataFrame:
    """``rank_models`` of a predictions table."""
    counts = confusion_counts(predictions, [by], label=label, labels=labels)
    areas = auc_one_vs_rest(predictions, [by], label=label, labels=labels)
    return rank_models(counts, areas, by, labels=labels)
