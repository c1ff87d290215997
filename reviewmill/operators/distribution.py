"""Order statistics from value histograms.

Quantiles, ranks and areas under curves all need "how many rows have a smaller value". Sorting
the rows for that would put a large group into one task. Instead the rows are first counted per
distinct value, which combines before the shuffle, and only the distinct values are accumulated:
inside ranges of neighbouring values, each a task's work, and over the totals of the ranges.

A range is a function of the value alone, its power of two and the next ``RANGE_BITS`` bits, so the
ranges need no sample, no count and no cut points. Each holds less than one part in
``2 ** RANGE_BITS`` of the values between two powers of two, and their number depends on how far the
values reach, not on how many rows there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions.numeric import half_even, percent

RANGE_BITS = 10


def value_histogram(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows per group, column and value: ``(*by, metric, value, n)``. NULLs are left out."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    long = df.select(*by, F.explode(cells).alias("cell")).select(*by, "cell.metric", "cell.value")
    return long.where("value is not null").groupBy(*by, "metric", "value").agg(F.count(F.lit(1)).alias("n"))


def value_range(value: Column) -> Column:
    """The range of a double as a number that never falls when the value rises; NaN is highest."""
    size = F.abs(value)
    power = F.floor(F.log2(size))
    place = F.floor(size / F.pow(F.lit(2.0), power) * F.lit(float(1 << RANGE_BITS)))
    # Powers start above -1,100; twice the places of a power, as rounding may reach the next one.
    key = ((power + 1100) * F.lit(1 << (RANGE_BITS + 1)) + place).cast("long")
    limit = F.lit(1 << 40)
    signed = F.when(size == float("inf"), limit).otherwise(key) * F.signum(value).cast("long")
    return F.when(F.isnan(value), limit + 1).when(size == 0, F.lit(0)).otherwise(signed)


def running_totals(table: DataFrame, by: Sequence[str], value: str, totals: Sequence[str]) -> DataFrame:
    """Add ``before_x`` (sum of x over smaller values) and ``total_x`` (sum over the group).

    ``table`` has one row per group and value, and ``by`` is a short fixed list of groups. Rows are
    accumulated inside their value range and shifted by the totals of lower ranges.
    """
    placed = table.withColumn("value_range", value_range(F.col(value).cast("double")))
    group = Window.partitionBy(*by)
    per_range = placed.groupBy(*by, "value_range").agg(*[F.sum(t).alias(t) for t in totals])
    lower = group.orderBy("value_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = per_range.select(
        *by, "value_range", *_sums(totals, "shift", lower), *_sums(totals, "total", group)
    )
    inside = Window.partitionBy(*by, "value_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.select("*", *_sums(totals, "inside", inside))
    joined = local.join(shifts, [*by, "value_range"])
    return joined.select(
        *table.columns,
        *[(F.col(f"shift_{t}") + F.col(f"inside_{t}")).alias(f"before_{t}") for t in totals],
        *[f"total_{t}" for t in totals],
    )


def _sums(totals: Sequence[str], prefix: str, window: Window) -> list[Column]:
    return [F.coalesce(F.sum(t).over(window), F.lit(0)).alias(f"{prefix}_{t}") for t in totals]


def quantile_of_ranked(probability: float) -> Column:
    """Aggregate over ``running_totals`` rows: the linearly interpolated quantile."""
    position = F.lit(float(probability)) * (F.col("total_n") - 1)
    low, high = F.floor(position), F.ceil(position)

    def value_at(index: Column) -> Column:
        inside = (F.col("before_n") <= index) & (index < F.col("before_n") + F.col("n"))
        return F.max(F.when(inside, F.col("value")))

    weight = F.max(position - low)
    return value_at(low) + (value_at(high) - value_at(low)) * weight


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: dict[str, float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Exact quantiles per group and column: ``(*by, metric, n, <names of probabilities>)``."""
    keys = [*by, "metric"]
    ranked = running_totals(value_histogram(df, columns, by), keys, "value", ["n"])
    return ranked.groupBy(*keys).agg(
        F.max("total_n").alias("n"),
        *[quantile_of_ranked(p).alias(name) for name, p in probabilities.items()],
    )


def describe_numbers(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), *, digits: int = 3
) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of numeric columns.

    All eight come from one histogram, so the rows are scanned once.
    """
    keys = [*by, "metric"]
    hist = value_histogram(df, columns, by).withColumn("s", F.col("value") * F.col("n"))
    ranked = running_totals(hist, keys, "value", ["n", "s"])
    mean = F.col("total_s") / F.col("total_n")
    spread = F.col("n") * (F.col("value") - mean) * (F.col("value") - mean)
    out = ranked.groupBy(*keys).agg(
        F.max("total_n").alias("count"),
        F.max(mean).alias("mean"),
        F.sqrt(F.try_divide(F.sum(spread), F.max("total_n") - 1)).alias("std"),
        F.min("value").alias("min"),
        quantile_of_ranked(0.25).alias("q25"),
        quantile_of_ranked(0.5).alias("q50"),
        quantile_of_ranked(0.75).alias("q75"),
        F.max("value").alias("max"),
    )
    rounded = ("mean", "std", "min", "q25", "q50", "q75", "max")
    return out.select(*keys, "count", *[half_even(F.col(c), digits).alias(c) for c in rounded])


def box_statistics(df: DataFrame, column: str, by: str) -> DataFrame:
    """Quartiles and whiskers per group; a whisker ends at the last value within 1.5 times the
    quartile distance, and no further in than its quartile."""
    keys = [by, "metric"]
    hist = value_histogram(df, [column], [by])
    ranked = running_totals(hist, keys, "value", ["n"])
    quartiles = ranked.groupBy(*keys).agg(
        F.max("total_n").alias("total"),
        quantile_of_ranked(0.25).alias("q1"),
        quantile_of_ranked(0.5).alias("median"),
        quantile_of_ranked(0.75).alias("q3"),
    )
    q1, q3, value = F.col("q1"), F.col("q3"), F.col("value")
    low_fence, high_fence = q1 - F.lit(1.5) * (q3 - q1), q3 + F.lit(1.5) * (q3 - q1)
    return (
        hist.join(quartiles, keys)
        .groupBy(*keys)
        .agg(
            F.max("total").alias("n"),
            F.least(F.min(F.when(value >= low_fence, value)), F.max(q1)).alias("whisker_low"),
            F.max(q1).alias("q1"),
            F.max("median").alias("median"),
            F.max(q3).alias("q3"),
            F.greatest(F.max(F.when(value <= high_fence, value)), F.max(q3)).alias("whisker_high"),
        )
        .drop("metric")
    )


def iqr_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Upper fence ``Q3 + 1.5 IQR`` per column, the rows above it, their share and the maximum."""
    hist = value_histogram(df, columns)
    ranked = running_totals(hist, ["metric"], "value", ["n"])
    q1, q3 = quantile_of_ranked(0.25), quantile_of_ranked(0.75)
    fences = ranked.groupBy("metric").agg((q3 + F.lit(1.5) * (q3 - q1)).alias("upper"))
    rows = df.agg(F.count(F.lit(1))).scalar()
    above = F.coalesce(F.sum(F.when(F.col("value") > F.col("upper"), F.col("n"))), F.lit(0))
    counted = hist.join(fences, "metric").groupBy("metric").agg(
        F.max("upper").alias("upper"), above.alias("above"), F.max("value").alias("max")
    )
    return counted.select(
        "metric",
        F.rint("upper").alias("iqr_upper_bound"),
        "above",
        percent(F.col("above"), rows).alias("pct"),
        "max",
    )


def clipped_histogram(df: DataFrame, column: str, *, clip: float = 600, bins: int = 60) -> DataFrame:
    """Equal-width bins of a column clipped from above: ``(bin, lower, upper, n, median)``.

    The last bin holds its upper edge, empty bins are listed, and ``median`` is that of the
    unclipped column. Equal values everywhere give bins of total width one around the value.
    """
    ranked = running_totals(value_histogram(df, [column]), ["metric"], "value", ["n"])
    median = ranked.agg(quantile_of_ranked(0.5)).scalar()
    clipped = ranked.select(F.least(F.col("value"), F.lit(float(clip))).alias("value"), "n")
    limits = clipped.agg(F.min("value").alias("a"), F.max("value").alias("b")).where("a is not null")
    half = F.when(F.col("a") == F.col("b"), F.lit(0.5)).otherwise(F.lit(0.0))
    edges = limits.select((F.col("a") - half).alias("lo"), (F.col("b") + half).alias("hi"))
    lo, hi = edges.select("lo").scalar(), edges.select("hi").scalar()
    bin_of = F.floor((F.col("value") - lo) * F.lit(float(bins)) / (hi - lo)).cast("int") + 1
    counts = clipped.groupBy(F.least(bin_of, F.lit(bins)).alias("bin")).agg(F.sum("n").alias("n"))
    grid = edges.select("*", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return grid.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * width).alias("lower"),
        (F.col("lo") + F.col("bin") * width).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
        median.alias("median"),
    )
