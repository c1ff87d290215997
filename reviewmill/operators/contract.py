"""Data contract of the review table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.schema import RATING, RATING_MAX, RATING_MIN, REVIEW_COLUMNS


class ContractError(ValueError):
    """The table does not have the assumed columns or rating scale."""


def rating_in_scale(rating: Column) -> Column:
    return rating.between(RATING_MIN, RATING_MAX)


def rating_violations(df: DataFrame) -> DataFrame:
    """One row: ratings present, ratings off the scale, and the lowest and highest one seen."""
    rating = F.col(RATING)
    return df.agg(
        F.count(rating).alias("rated"),
        F.count_if(~rating_in_scale(rating)).alias("violations"),
        F.min(rating).alias("lowest"),
        F.max(rating).alias("highest"),
    )


def check_contract(df: DataFrame, *, ratings: bool = True) -> None:
    """Raise unless every review column exists and every non-NULL rating is on the scale."""
    absent = [name for name in REVIEW_COLUMNS if name not in df.columns]
    if absent:
        raise ContractError(f"columns {absent} are absent; the table has {df.columns}")
    if not ratings:
        return
    seen = rating_violations(df).first()
    if seen["violations"]:
        raise ContractError(
            f"{seen['violations']} ratings lie outside {RATING_MIN} to {RATING_MAX}; "
            f"observed {seen['lowest']} to {seen['highest']}"
        )
