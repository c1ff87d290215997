"""Corpus reports made of several tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from reviewmill.functions.text import add_text_metrics
from reviewmill.operators.cleaning import clean_reviews
from reviewmill.operators.profiling import (
    class_balance,
    column_inventory,
    column_types,
    corpus_summary,
    feature_ranges,
    rating_distribution,
)
from reviewmill.schema import SENTIMENT
from reviewmill.sources.files import file_inventory
from reviewmill.sources.workspace import materialise

# The metrics whose ranges are reported.
RANGE_METRICS = ("n_words", "n_chars", "n_sentences", "unique_ratio")


def corpus_report(
    raw: DataFrame, *, bronze_folder: str | None = None, expected_sha256: str | None = None
) -> dict[str, DataFrame]:
    """One table per section: files, summary, columns, ratings, classes, ranges, types."""
    metrics = add_text_metrics(materialise(clean_reviews(raw), "clean"))
    sections = {
        "summary": corpus_summary(raw),
        "columns": column_inventory(raw),
        "ratings": rating_distribution(raw),
        "classes": class_balance(metrics, SENTIMENT),
        "ranges": feature_ranges(metrics, RANGE_METRICS),
        "types": column_types(metrics),
    }
    if bronze_folder:
        sections["files"] = file_inventory(raw.sparkSession, bronze_folder, expected_sha256=expected_sha256)
    return sections
