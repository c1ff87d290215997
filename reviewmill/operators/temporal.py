"""Temporal split: train on the past, validate and test on what came later.

Rows are ordered by month, undated rows by where their id lies among the dated ones: an undated row takes
the month of the dated row with the nearest lower id, the first month if there is none. Within a month the
id decides. The two cut positions are found exactly without sorting the table in one task: rows are counted
per month and id range, totals of the ranges locate the one that holds a cut, and only its rows are ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.operators.splitting import leading_shares
from reviewmill.schema import PERIOD, REVIEW_ID, ROW_ID, SPLIT, SPLITS
from reviewmill.sources.workspace import materialise

#: ids of one range; a range is the work of one task
RANGE_IDS = 100_000
MONTH = "order_month"


def imputed_months(rows: DataFrame, *, order: str = REVIEW_ID, range_ids: int = RANGE_IDS) -> DataFrame:
    """Add ``order_month``: the row's month, or that of the dated row with the nearest lower ``order``.

    Of several dated rows with that order value the latest month counts. Ranges of ``order`` are filled
    each in its own task, and carry over to the next by one line for each range.
    """
    place = F.floor(F.col(order) / range_ids)
    ranged = rows.withColumn("order_range", place)
    last = F.max(F.when(F.col(PERIOD).isNotNull(), F.struct(order, PERIOD)))
    ends = ranged.groupBy("order_range").agg(last.alias("last"))
    # one line for each range
    before = F.max("last").over(Window.orderBy("order_range").rowsBetween(Window.unboundedPreceding, -1))
    carried = ends.select("order_range", before[PERIOD].alias("carried"))
    first = rows.agg(F.min(PERIOD)).first()[0]
    if first is None and rows.take(1):
        raise ValueError("a temporal split needs one dated row at least")
    dated = F.max(F.when(F.col(PERIOD).isNotNull(), F.struct(order, PERIOD)))
    lower = dated.over(Window.partitionBy("order_range").orderBy(order).rangeBetween(Window.unboundedPreceding, -1))
    filled = ranged.withColumn("lower", lower[PERIOD]).join(carried, "order_range", "left")
    month = F.coalesce(F.col(PERIOD), F.col("lower"), F.col("carried"), F.lit(first).cast("date"))
    return filled.select(*rows.columns, month.alias(MONTH))


def temporal_cuts(ordered: DataFrame, shares: Sequence[float], *, order: str = REVIEW_ID, range_ids: int = RANGE_IDS) -> list[tuple | None]:
    """``(month, order value, row id)`` of the last row of each leading share; None for an empty share."""
    ranged = ordered.select(MONTH, order, ROW_ID, F.floor(F.col(order) / range_ids).alias("order_range"))
    sizes = ranged.groupBy(MONTH, "order_range").agg(F.count(F.lit(1)).alias("n"))
    # totals of months first, so that the ranges are accumulated inside their month
    months = sizes.groupBy(MONTH).agg(F.sum("n").alias("month_n"))
    past = Window.orderBy(MONTH).rowsBetween(Window.unboundedPreceding, -1)  # one line for each month
    months = months.select(MONTH, F.coalesce(F.sum("month_n").over(past), F.lit(0)).alias("month_before"))
    inside = Window.partitionBy(MONTH).orderBy("order_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sizes.join(months, MONTH).select(
        MONTH, "order_range", "n", (F.col("month_before") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("before")
    )
    ranges = materialise(ranges, "month-ranges")
    total = ranges.agg(F.sum("n")).first()[0] or 0
    cuts: list[tuple | None] = []
    for share in shares:
        position = int(total * share + 0.5)
        held = ranges.where((F.col("before") < position) & (position <= F.col("before") + F.col("n"))).first() if position else None
        if held is None:
            cuts.append(None)
            continue
        near = ranged.where((F.col(MONTH) == F.lit(held[MONTH])) & (F.col("order_range") == held["order_range"]))
        rank = F.row_number().over(Window.orderBy(order, ROW_ID))  # the rows of one range of one month
        found = near.withColumn("rank", rank).where(F.col("rank") == position - held["before"]).first()
        cuts.append((found[MONTH], found[order], found[ROW_ID]))
    return cuts


def _not_after(cut: tuple | None, order: str) -> Column:
    if cut is None:
        return F.lit(False)
    month, value, row_id = cut
    key = F.struct(F.col(MONTH), F.col(order).cast("long"), F.col(ROW_ID).cast("long"))
    return key <= F.struct(F.lit(month), F.lit(value).cast("long"), F.lit(row_id).cast("long"))


def temporal_split(
    rows: DataFrame, *, test_size: float = 0.15, val_size: float = 0.15, order: str = REVIEW_ID, range_ids: int = RANGE_IDS
) -> DataFrame:
    """``rows`` with ``order_month`` and ``split``: the earliest share trains, the latest tests.

    ``rows`` is a written table with ``row_id``, ``period`` and an id (``order``) that follows time and is
    not null. A table without any month is an error, as it has no order in time.
    """
    ordered = materialise(imputed_months(rows, order=order, range_ids=range_ids), "ordered")
    first, second = temporal_cuts(ordered, leading_shares(test_size, val_size), order=order, range_ids=range_ids)
    train, validation, test = SPLITS
    name = F.when(_not_after(first, order), train).when(_not_after(second, order), validation).otherwise(test)
    return ordered.withColumn(SPLIT, name)
