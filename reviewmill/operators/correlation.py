"""Spearman rank correlation with average ranks and pairwise removal of NULLs."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.operators.distribution import running_totals
from reviewmill.sources.workspace import materialise, materialise_by


def rank_inputs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles ``v0, v1, ...``, written once: the histogram and the joins read these
    few numbers, not the texts behind them."""
    return materialise(df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)]), "rank-inputs")


def spearman_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Spearman's rho of column pairs: ``(left, right, rho)``, computed from all rows at once.

    Rank means position among the rows where *both* columns of the pair are present, so a value
    has one rank per partner column. The rows are counted per column, value and set of present
    columns; ranks come from running totals over the distinct values and are joined back. A
    value shared by most rows is one row of the rank table, and each rank table is read with its
    own size, so Catalyst broadcasts short ones and shuffles long ones (with AQE splitting
    skewed values).
    """
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    return _correlations(rank_inputs(df, columns), columns, pairs)


def _correlations(values: DataFrame, columns: Sequence[str], pairs: Sequence[tuple[str, str]]) -> DataFrame:
    place = {c: i for i, c in enumerate(columns)}
    present = F.array(*[F.col(f"v{i}").isNotNull() for i in place.values()])
    cells = F.array(*[F.struct(F.lit(i).alias("metric"), F.col(f"v{i}").alias("value")) for i in place.values()])
    counted = (
        values.select(present.alias("present"), F.explode(cells).alias("cell"))
        .select("present", "cell.metric", "cell.value")
        .where("value is not null")
        .groupBy("metric", "value", "present")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = [f"n{i}" for i in place.values()]
    shared = [
        F.sum(F.when(F.col("present")[i], F.col("n")).otherwise(F.lit(0))).alias(f"n{i}") for i in place.values()
    ]
    distinct = counted.groupBy("metric", "value").agg(*shared)
    ranked = running_totals(distinct, ["metric"], "value", totals)
    ranks = ranked.select(
        "metric", "value", *[(F.col(f"before_{t}") + (F.col(t) + 1) / 2.0).alias(f"r{t[1:]}") for t in totals]
    )
    tables = materialise_by(ranks, "ranks", "metric", list(place.values()), spread_by="value")

    joined = values
    for i in place.values():
        partners = sorted({place[b] if place[a] == i else place[a] for a, b in pairs if i in (place[a], place[b])})
        table = tables[i].select(F.col("value").alias(f"v{i}"), *[F.col(f"r{j}").alias(f"rank_{i}_{j}") for j in partners])
        joined = joined.join(table, f"v{i}", "left")

    def rho(a: str, b: str):
        i, j = place[a], place[b]
        return F.corr(
            F.when(F.col(f"v{j}").isNotNull(), F.col(f"rank_{i}_{j}")),
            F.when(F.col(f"v{i}").isNotNull(), F.col(f"rank_{j}_{i}")),
        )

    wide = joined.agg(*[rho(a, b).alias(f"p{k}") for k, (a, b) in enumerate(pairs)])
    rows = [
        F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"p{k}").alias("rho"))
        for k, (a, b) in enumerate(pairs)
    ]
    return wide.select(F.inline(F.array(*rows)))


def spearman_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full symmetric matrix in long form: ``(left, right, rho)`` for every ordered pair."""
    values = rank_inputs(df, columns)
    upper = _correlations(values, columns, [*combinations(columns, 2)])
    mirrored = F.array(F.struct("left", "right", "rho"), F.struct(F.col("right").alias("left"), F.col("left").alias("right"), "rho"))
    off_diagonal = upper.select(F.inline(mirrored))
    # The diagonal is 1 for a column that varies, as its correlation with itself.
    same = values.agg(*[(F.min(f"v{i}") < F.max(f"v{i}")).alias(f"d{i}") for i in range(len(columns))])
    cells = [
        F.struct(F.lit(c).alias("left"), F.lit(c).alias("right"), F.when(F.col(f"d{i}"), F.lit(1.0)).alias("rho"))
        for i, c in enumerate(columns)
    ]
    return off_diagonal.unionByName(same.select(F.inline(F.array(*cells))))
