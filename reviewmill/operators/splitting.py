"""Stratified train, validation and test split without moving the table.

Rows of a class are ordered by a hash of their id and cut at fixed shares. The two cut positions
of each class are found exactly from narrow columns: count per hash prefix, locate the prefix that
holds the cut, rank only the rows of that prefix. Every row is then placed by comparing its hash
with the cut of its class.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import floor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions.numeric import percent
from reviewmill.operators.distribution import running_totals
from reviewmill.schema import LABELS, ROW_ID, SEED, SENTIMENT, SPLIT, SPLITS


def split_hash(row_id: Column, seed: int) -> Column:
    return F.md5(F.concat(row_id.cast("string"), F.lit(f":{seed}")))


def split_cuts(
    labelled: DataFrame,
    shares: Sequence[float],
    *,
    seed: int = SEED,
    label: str = SENTIMENT,
    prefix: int = 4,
) -> DataFrame:
    """Per class the ``(hash, row id)`` of the last row of each leading share.

    ``prefix`` hex digits give ``16 ** prefix`` hash ranges; the rows ranked in one task are those
    of one range of one class.
    """
    keyed = labelled.select(label, ROW_ID, split_hash(F.col(ROW_ID), seed).alias("hash")).withColumn(
        "range", F.conv(F.substring("hash", 1, prefix), 16, 10).cast("long")
    )
    sizes = keyed.groupBy(label, "range").agg(F.count(F.lit(1)).alias("n"))
    ranges = running_totals(sizes, [label], "range", ["n"])
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("cut"), F.floor(F.col("total_n") * F.lit(share) + F.lit(0.5)).alias("position"))
            for i, share in enumerate(shares)
        ]
    )
    edges = (
        ranges.select(label, "range", "n", "before_n", F.inline(cells))
        .where((F.col("before_n") < F.col("position")) & (F.col("position") <= F.col("before_n") + F.col("n")))
        .select(label, "range", "cut", (F.col("position") - F.col("before_n")).alias("offset"))
    )
    # At most one row per class and cut, whatever the size of the table.
    near = keyed.join(F.broadcast(edges), [label, "range"])
    order = Window.partitionBy(label, "cut").orderBy("hash", ROW_ID)
    found = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == F.col("offset"))
    key = F.struct("hash", ROW_ID)
    return found.groupBy(label).agg(
        *[F.max(F.when(F.col("cut") == i, key)).alias(f"cut{i}") for i in range(len(shares))]
    )


def leading_shares(test_size: float, val_size: float) -> list[float]:
    """Cumulative shares after train and after validation."""
    if not (0 <= test_size and 0 <= val_size and test_size + val_size < 1):
        raise ValueError("test_size and val_size must be non-negative and leave rows for training")
    return [round(1 - test_size - val_size, 10), round(1 - test_size, 10)]


def assign_splits(
    labelled: DataFrame,
    *,
    test_size: float = 0.15,
    val_size: float = 0.15,
    seed: int = SEED,
    label: str = SENTIMENT,
    labels: Sequence[str] = LABELS,
    prefix: int = 4,
) -> DataFrame:
    """Add ``split`` to a table of ``row_id`` and label; rows outside the label domain are dropped.

    ``labelled`` is read three times, so pass a written table (the silver layer).
    """
    known = labelled.where(F.col(label).isin(*labels))
    cuts = split_cuts(known, leading_shares(test_size, val_size), seed=seed, label=label, prefix=prefix)
    return place_rows(known, cuts, seed=seed, label=label)


def place_rows(rows: DataFrame, cuts: DataFrame, *, seed: int = SEED, label: str = SENTIMENT) -> DataFrame:
    """Add ``split`` by comparing each row's hash with the cuts of its class: no row is moved."""
    key = F.struct(split_hash(F.col(ROW_ID), seed).alias("hash"), F.col(ROW_ID))
    # One row per class of the fixed label domain.
    placed = rows.join(F.broadcast(cuts), label, "left")
    train, validation, test = SPLITS
    name = F.when(key <= F.col("cut0"), train).when(key <= F.col("cut1"), validation).otherwise(test)
    return placed.select(*rows.columns, name.alias(SPLIT))


FOLD = "fold"


def assign_folds(
    labelled: DataFrame,
    folds: int,
    *,
    seed: int = SEED + 1,
    label: str = SENTIMENT,
    labels: Sequence[str] = LABELS,
    prefix: int = 4,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Add ``fold``, 0 to ``folds - 1``: equal shares of every class, by the rule of the split.

    ``labelled`` is read three times, so pass a written table, or its ids and labels as a written table
    ``keys``; its other columns stay, and no row is moved. Rows outside the label domain are dropped. The
    hash is not the one of the split.
    """
    if folds < 2:
        raise ValueError("cross-validation needs two folds at least")
    known = labelled.where(F.col(label).isin(*labels))
    cut_by = known if keys is None else keys.where(F.col(label).isin(*labels))
    cuts = split_cuts(cut_by, [i / folds for i in range(1, folds)], seed=seed, label=label, prefix=prefix)
    key = F.struct(split_hash(F.col(ROW_ID), seed).alias("hash"), F.col(ROW_ID))
    # One row per class of the fixed label domain. A class with fewer rows than folds lacks early cuts.
    placed = known.join(F.broadcast(cuts), label, "left")
    passed = [F.coalesce(key > F.col(f"cut{i}"), F.lit(True)).cast("int") for i in range(folds - 1)]
    return placed.select(*known.columns, sum(passed[1:], passed[0]).alias(FOLD))


def expected_sizes(rows: int, test_size: float = 0.15, val_size: float = 0.15) -> dict[str, int]:
    """Rows of one class that each split receives."""
    first, second = (floor(rows * share + 0.5) for share in leading_shares(test_size, val_size))
    return dict(zip(SPLITS, (first, second - first, rows - second)))


def features_and_target(rows: DataFrame, target: str = SENTIMENT) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Per split the table without its target, and the target by ``row_id``."""
    parts = {name: rows.where(F.col(SPLIT) == name).drop(SPLIT) for name in SPLITS}
    return {name: (part.drop(target), part.select(ROW_ID, target)) for name, part in parts.items()}


def split_summary(rows: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Rows, share of the table and class percentages of each split."""
    counts = rows.groupBy(SPLIT).agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(SENTIMENT) == c).alias(c) for c in labels]
    )
    total = counts.agg(F.sum("rows")).scalar()
    return counts.select(
        SPLIT,
        "rows",
        percent(F.col("rows"), total, 1).alias("pct"),
        *[percent(F.col(c), F.col("rows"), 1).alias(c) for c in labels],
    )
