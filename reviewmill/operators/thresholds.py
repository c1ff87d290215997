"""Decision thresholds for classifiers that rank well and decide badly.

A row goes to the class whose score exceeds its threshold by the largest factor. The threshold of a
class is the cut with the best F1 of that class against the rest. All cuts of all classes come from
one pass: rows are counted per distinct score, and the counts above each score are running totals.
Choose thresholds on out-of-fold predictions of training rows, and judge them on others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.operators.distribution import running_totals
from reviewmill.schema import LABELS, SENTIMENT

#: least threshold that a decision divides by
LEAST = 1e-9


def cut_points(
    predictions: DataFrame, by: Sequence[str] = (), *, label: str = SENTIMENT, labels: Sequence[str] = LABELS
) -> DataFrame:
    """``(*by, label, threshold, hits, predicted, support, f1)`` for every distinct score of a class.

    ``predicted`` rows reach the threshold, ``hits`` of them are of the class. Rows without
    probabilities or label are not counted.
    """
    cells = [
        F.struct(F.lit(c).alias("class"), F.col("probability")[i].alias("threshold"), (F.col(label) == c).cast("long").alias("hit"))
        for i, c in enumerate(labels)
    ]
    scored = predictions.where(F.col("probability").isNotNull() & F.col(label).isNotNull())
    keys = [*by, "class"]
    histogram = scored.select(*by, F.inline(F.array(*cells))).groupBy(*keys, "threshold").agg(
        F.count(F.lit(1)).alias("n"), F.sum("hit").alias("own")
    )
    ranked = running_totals(histogram, keys, "threshold", ["n", "own"])
    hits, predicted = F.col("total_own") - F.col("before_own"), F.col("total_n") - F.col("before_n")
    f1 = F.lit(2.0) * hits / (predicted + F.col("total_own"))
    return ranked.select(
        *by, F.col("class").alias("label"), "threshold", hits.alias("hits"), predicted.alias("predicted"),
        F.col("total_own").alias("support"), f1.alias("f1"),
    )


def best_thresholds(cuts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, label, threshold, f1)``: the best cut of each class, the highest of equal ones."""
    best = F.max(F.struct("f1", "threshold")).alias("best")
    return cuts.groupBy(*by, "label").agg(best).select(*by, "label", "best.threshold", "best.f1")


def threshold_map(thresholds: DataFrame) -> dict[str, float]:
    """Thresholds of one model on the driver; one number per class."""
    return {r["label"]: r["threshold"] for r in thresholds.collect()}


def decide(probability: Column, thresholds: dict[str, float], labels: Sequence[str] = LABELS) -> Column:
    """The class with the largest score over threshold; the earlier label wins a tie. A class without a
    threshold (it had no rows) is not chosen."""
    kept = [(i, c) for i, c in enumerate(labels) if c in thresholds]
    ratios = F.array(*[probability[i] / F.lit(max(thresholds[c], LEAST)) for i, c in kept])
    names = F.array(*[F.lit(c) for _, c in kept])
    return F.element_at(names, F.array_position(ratios, F.array_max(ratios)).cast("int"))


def apply_thresholds(predictions: DataFrame, thresholds: dict[str, float], labels: Sequence[str] = LABELS) -> DataFrame:
    """Predictions by threshold; rows without probabilities keep theirs."""
    decided = decide(F.col("probability"), thresholds, labels)
    return predictions.withColumn("prediction", F.when(F.col("probability").isNotNull(), decided).otherwise(F.col("prediction")))
