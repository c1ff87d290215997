"""Reports by branch, class and month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.numeric import half_even, percent, ratio
from reviewmill.functions.text import strip_prefix
from reviewmill.operators.cleaning import with_period
from reviewmill.operators.distribution import exact_quantiles
from reviewmill.schema import BRANCH, LABELS, PERIOD, RATING, SENTIMENT


def _label_counts(labels: Sequence[str]) -> list[Column]:
    return [F.count_if(F.col(SENTIMENT) == label).alias(label) for label in labels]


def branch_report(metrics: DataFrame) -> DataFrame:
    """Reviews, mean and median rating, median words and corpus share per branch."""
    rows = metrics.agg(F.count(F.lit(1))).scalar()
    sizes = metrics.where(F.col(BRANCH).isNotNull()).groupBy(BRANCH).agg(
        F.count(F.lit(1)).alias("reviews"), F.avg(RATING).alias("mean_rating")
    )
    medians = exact_quantiles(metrics, [RATING, "n_words"], {"median": 0.5}, [BRANCH])
    wide = medians.groupBy(BRANCH).agg(
        *[F.max(F.when(F.col("metric") == c, F.col("median"))).alias(f"median_{c}") for c in (RATING, "n_words")]
    )
    return sizes.join(wide, BRANCH, "left").select(
        BRANCH,
        "reviews",
        half_even(F.col("mean_rating"), 3).alias("mean_rating"),
        half_even(F.col(f"median_{RATING}"), 3).alias("median_rating"),
        half_even(F.col("median_n_words"), 3).alias("median_words"),
        percent(F.col("reviews"), rows, 1).alias("pct_of_corpus"),
    )


def mean_rating_by_branch(df: DataFrame, prefix: str = "") -> DataFrame:
    """Mean rating and size per branch in ascending order; ``prefix`` is cut from the names."""
    means = df.where(F.col(BRANCH).isNotNull()).groupBy(BRANCH).agg(
        F.avg(RATING).alias("mean"), F.count(F.lit(1)).alias("size")
    )
    name = strip_prefix(F.col(BRANCH), prefix) if prefix else F.col(BRANCH)
    return means.select(name.alias("branch"), "mean", "size").orderBy("mean", "branch")


def sentiment_by_branch(df: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Percentage of each class per branch; NULL for a class that no row of the table has."""
    counts = df.where(F.col(BRANCH).isNotNull() & F.col(SENTIMENT).isNotNull()).groupBy(BRANCH).agg(
        F.count(F.lit(1)).alias("rows"), *_label_counts(labels)
    )
    totals = {label: counts.agg(F.sum(label)).scalar() for label in labels}
    return counts.select(
        BRANCH,
        *[
            F.when(totals[label] > 0, ratio(F.col(label), F.col("rows")) * F.lit(100.0)).alias(label)
            for label in labels
        ],
    )


def sentiment_distribution(df: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Rows and share per class in the fixed class order; a class without rows has NULLs.

    One aggregate with a counter per class: the fixed domain needs no join.
    """
    wide = df.agg(*_label_counts(labels))
    cells = [
        F.struct(F.lit(i).alias("position"), F.lit(label).alias(SENTIMENT), F.nullif(F.col(label), F.lit(0)).alias("count"))
        for i, label in enumerate(labels)
    ]
    total = sum((F.col(label) for label in labels), F.lit(0))
    long = wide.select(total.alias("total"), F.inline(F.array(*cells)))
    return long.select("position", SENTIMENT, "count", (ratio(F.col("count"), F.col("total")) * 100.0).alias("pct"))


def monthly_volume(df: DataFrame) -> DataFrame:
    return with_period(df).groupBy(PERIOD).agg(F.count(F.lit(1)).alias("reviews")).orderBy(PERIOD)


def monthly_rating(df: DataFrame, min_reviews: int = 30) -> DataFrame:
    """Mean rating of the months that hold at least ``min_reviews`` reviews."""
    months = with_period(df).groupBy(PERIOD).agg(
        F.avg(RATING).alias("mean_rating"), F.count(F.lit(1)).alias("reviews")
    )
    return months.where(F.col("reviews") >= min_reviews).select(PERIOD, "mean_rating").orderBy(PERIOD)


def yearly_report(df: DataFrame) -> DataFrame:
    years = with_period(df).groupBy(F.year(PERIOD).alias("year"))
    return years.agg(
        F.count(F.lit(1)).alias("reviews"), half_even(F.avg(RATING), 3).alias("mean_rating")
    ).orderBy("year")


def period_range(df: DataFrame) -> DataFrame:
    """Rows with and without a month, and the first and last month."""
    return df.agg(
        F.count(PERIOD).alias("parseable"),
        F.count_if(F.col(PERIOD).isNull()).alias("unparseable"),
        F.min(PERIOD).alias("first_period"),
        F.max(PERIOD).alias("last_period"),
    )


def median_words_by_rating(metrics: DataFrame) -> DataFrame:
    rated = metrics.where(F.col(RATING).isNotNull())
    return exact_quantiles(rated, ["n_words"], {"median_words": 0.5}, [RATING]).select(
        RATING, F.col("n").alias("reviews"), "median_words"
    )
