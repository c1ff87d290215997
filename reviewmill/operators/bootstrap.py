"""Bootstrap intervals of macro-F1 by Poisson resampling.

A resampled table of the same expected size gives each row a Poisson(1) number of copies, drawn for each
replicate from a hash of row and replicate: no row is moved, reruns agree, and any engine can repeat
it. One hash serves eight replicates. Weighted confusion cells are summed inside tasks, so what is
shuffled is nine cells for each replicate and task.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from math import exp, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.operators import metrics
from reviewmill.schema import LABELS, ROW_ID, SEED, SENTIMENT

REPLICATES = 1000
#: 32-bit draws in one SHA-256
DRAWS = 8
#: a draw is the number of these that it reaches: the distribution of a Poisson(1) variable in 32 bits
STEPS = [int(exp(-1) * float(sum(Fraction(1, factorial(i)) for i in range(k + 1))) * 2**32) for k in range(12)]


def draw(digest: Column, place: int) -> Column:
    """Poisson(1) number from the ``place``-th 32 bits of a hexadecimal digest."""
    bits = F.conv(F.substring(digest, 8 * place + 1, 8), 16, 10).cast("long")
    return sum(((bits >= step).cast("long") for step in STEPS[1:]), (bits >= STEPS[0]).cast("long"))


def bootstrap_counts(
    predictions: DataFrame,
    by: Sequence[str] = (),
    *,
    replicates: int = REPLICATES,
    seed: int = SEED,
    label: str = SENTIMENT,
    labels: Sequence[str] = LABELS,
) -> DataFrame:
    """``(*by, replicate)`` with the weighted confusion cells of ``metrics.confusion_counts``.

    The draws follow from ``row_id``, so all models of a table are resampled alike. Rows with a label
    outside the domain count in no cell.
    """
    blocks = -(-replicates // DRAWS)
    rows = predictions.where(F.col(label).isin(*labels) & F.col("prediction").isin(*labels))
    hashed = rows.select(
        *by, F.col(label).alias("true"), "prediction", ROW_ID, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    )
    digest = F.sha2(F.concat_ws(":", F.col(ROW_ID).cast("string"), F.col("block").cast("string"), F.lit(str(seed))), 256)
    hashed = hashed.select(*by, "true", "prediction", "block", digest.alias("digest"))
    cells = hashed.groupBy(*by, "block", "true", "prediction").agg(*[F.sum(draw(F.col("digest"), i)).alias(f"n_{i}") for i in range(DRAWS)])
    long = cells.select(*by, "true", "prediction", F.inline(F.array(*[
        F.struct((F.col("block") * DRAWS + i).alias("replicate"), F.col(f"n_{i}").alias("n")) for i in range(DRAWS)
    ]))).where(F.col("replicate") < replicates)
    wide = [
        F.coalesce(F.sum(F.when((F.col("true") == t) & (F.col("prediction") == p), F.col("n"))), F.lit(0)).alias(f"cell_{i}_{j}")
        for i, t in enumerate(labels)
        for j, p in enumerate(labels)
    ]
    return long.groupBy(*by, "replicate").agg(*wide)


def replicate_scores(counts: DataFrame, by: Sequence[str] = (), *, labels: Sequence[str] = LABELS) -> DataFrame:
    """``(*by, replicate, macro_f1)``."""
    return counts.select(*by, "replicate", metrics.macro_f1_of(labels).alias("macro_f1"))


def macro_f1_interval(
    predictions: DataFrame, by: Sequence[str] = (), *, replicates: int = REPLICATES, level: float = 0.95, seed: int = SEED
) -> DataFrame:
    """``(*by, macro_f1, low, high, replicates)``: the score and the percentile interval of its replicates.

    The percentiles are exact, over ``replicates`` numbers for each model.
    """
    scores = replicate_scores(bootstrap_counts(predictions, by, replicates=replicates, seed=seed), by)
    ends = [(1 - level) / 2, (1 + level) / 2]
    limits = scores.groupBy(*by).agg(
        *[F.percentile("macro_f1", F.lit(end)).alias(name) for name, end in zip(("low", "high"), ends)],
        F.count(F.lit(1)).alias("replicates"),
    )
    whole = metrics.confusion_counts(predictions, by).select(*by, metrics.macro_f1_of().alias("macro_f1"))
    joined = whole.join(limits, list(by)) if by else whole.crossJoin(limits)  # one line each
    return joined.select(*by, "macro_f1", "low", "high", "replicates")
