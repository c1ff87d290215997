"""Sentiment labels and visit months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmill.schema import MISSING_PERIOD

# The label of each rating, by scheme.
SCHEMES = {
    "three_class": {1: "negative", 2: "negative", 3: "neutral", 4: "positive", 5: "positive"},
    "binary": {1: "negative", 2: "negative", 3: "negative", 4: "positive", 5: "positive"},
}


def scheme_labels(scheme: str) -> list[str]:
    """Sorted label domain of a scheme; an unknown scheme is an error."""
    if scheme not in SCHEMES:
        raise ValueError(f"unknown label scheme {scheme!r}; known: {sorted(SCHEMES)}")
    return sorted(set(SCHEMES[scheme].values()))


def sentiment(rating: Column, scheme: str = "three_class") -> Column:
    """Label of a rating; NULL for a rating outside the scale."""
    labels = scheme_labels(scheme)
    chosen = SCHEMES[scheme]
    out = F.lit(None).cast("string")
    for label in labels:
        ratings = [level for level, name in chosen.items() if name == label]
        out = F.when(rating.isin(*ratings), F.lit(label)).otherwise(out)
    return out


def period_month(year_month: Column) -> Column:
    """First day of the month of ``YYYY-M`` text; NULL for the marker and for anything else."""
    return F.try_to_date(F.nullif(year_month, F.lit(MISSING_PERIOD)), "yyyy-M")


def month_index(period: Column) -> Column:
    """Months since year zero, to order months as numbers."""
    return F.year(period) * F.lit(12) + F.month(period)
