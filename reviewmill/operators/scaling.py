"""Scalers of the ten numeric features and class weights, fitted on training rows only.

A fitted scaler is two numbers per feature. They are kept on the driver and become literals of the
transforming expression, which needs no join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.numeric import ratio
from reviewmill.schema import NUMERIC_FEATURES, SENTIMENT


def filled(name: str) -> Column:
    """A numeric feature as a double; a ratio without a base (no words, no tokens) counts as 0."""
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


@dataclass(frozen=True)
class LinearScaler:
    """``(x - shift) / scale`` for each feature."""

    shift: dict[str, float]
    scale: dict[str, float]

    def expression(self, name: str) -> Column:
        return (filled(name) - F.lit(self.shift[name])) / F.lit(self.scale[name])

    def transform(self, df: DataFrame) -> DataFrame:
        """Replace the features by their scaled values; the other columns stay."""
        return df.withColumns({name: self.expression(name) for name in self.shift})

    def table(self, df: DataFrame) -> DataFrame:
        """The fitted numbers as ``(feature, shift, scale)`` rows in the session of ``df``."""
        rows = [(name, self.shift[name], self.scale[name]) for name in self.shift]
        return df.sparkSession.createDataFrame(rows, "feature string, shift double, scale double")


def _fit(train: DataFrame, columns: Sequence[str], shift, scale) -> LinearScaler:
    seen = train.agg(
        *[shift(filled(c)).alias(f"shift_{c}") for c in columns],
        *[scale(filled(c)).alias(f"scale_{c}") for c in columns],
    ).first()
    return LinearScaler(
        {c: seen[f"shift_{c}"] for c in columns},
        {c: seen[f"scale_{c}"] or 1.0 for c in columns},
    )


def fit_standard(train: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES) -> LinearScaler:
    """Centre and divide by the population deviation; a constant feature is only centred."""
    return _fit(train, columns, F.avg, F.stddev_pop)


def fit_min_max(train: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES) -> LinearScaler:
    """Map the training range to [0, 1]; rows outside it are not clipped."""
    return _fit(train, columns, F.min, lambda c: F.max(c) - F.min(c))


def class_weights(train: DataFrame, label: str = SENTIMENT) -> DataFrame:
    """Balanced weights ``rows / (classes * rows of the class)``: ``(label, n, weight)``."""
    counts = train.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    rows = counts.agg(F.sum("n")).scalar()
    classes = counts.agg(F.count(F.lit(1))).scalar()
    return counts.select(label, "n", ratio(rows, classes * F.col("n")).alias("weight"))


def class_weight_map(train: DataFrame, label: str = SENTIMENT) -> dict[str, float]:
    """Class weights on the driver; one number per class."""
    return {row[label]: row["weight"] for row in class_weights(train, label).collect()}


def long_numeric(df: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES, *keep: str) -> DataFrame:
    """Numeric features as matrix entries ``(*keep, feature, value)``."""
    cells = [F.struct(F.lit(c).alias("feature"), filled(c).alias("value")) for c in columns]
    return df.select(*keep, F.inline(F.array(*cells)))
