"""Duplicate removal, labelling and row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.labels import period_month, sentiment
from reviewmill.schema import PERIOD, RATING, REVIEW_COLUMNS, ROW_ID, SENTIMENT, TEXT, YEAR_MONTH


def keep_first(df: DataFrame, keys: Sequence[str], order: str = ROW_ID) -> DataFrame:
    """Keep the row with the lowest ``order`` of every group of equal ``keys`` (NULLs are equal).

    ``order`` is unique. The rows are counted by digest, which combines before the shuffle, so a
    group holding a large part of the table leaves each task as one short row; the table itself is
    then filtered by the surviving ``order`` values.
    """
    digest = text_digest(keys[0]) if len(keys) == 1 else row_digest(keys)
    firsts = df.groupBy(digest.alias("digest")).agg(F.min(order).alias(order)).select(order)
    return df.join(firsts, order, "left_semi")


def drop_full_duplicates(df: DataFrame) -> DataFrame:
    """Drop rows equal to an earlier one in all six review columns."""
    return keep_first(df, REVIEW_COLUMNS)


def drop_duplicate_texts(df: DataFrame) -> DataFrame:
    """Drop rows whose text occurred in an earlier row."""
    return keep_first(df, [TEXT])


def add_period(df: DataFrame) -> DataFrame:
    return df.withColumn(PERIOD, period_month(F.col(YEAR_MONTH)))


def add_sentiment(df: DataFrame, scheme: str = "three_class") -> DataFrame:
    return df.withColumn(SENTIMENT, sentiment(F.col(RATING), scheme))


def drop_unusable(df: DataFrame) -> DataFrame:
    """Drop rows without a label or without text."""
    return df.dropna(subset=[SENTIMENT, TEXT])


def clean_reviews(df: DataFrame, scheme: str = "three_class") -> DataFrame:
    """Cleaned table: first row of each text, with ``period`` and ``sentiment``.

    A full duplicate is also a duplicate text, and the earliest row survives both tests, so one
    shuffle on the text gives the same rows as removing full duplicates before duplicate texts.
    """
    return drop_unusable(add_sentiment(add_period(drop_duplicate_texts(df)), scheme))


def with_sentiment(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(SENTIMENT) == label)


def with_period(df: DataFrame) -> DataFrame:
    return df.where(F.col(PERIOD).isNotNull())


def preview(df: DataFrame, rows: int = 3) -> DataFrame:
    """The first rows by ``row_id``."""
    return df.orderBy(ROW_ID).limit(rows)


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of several columns; NULL and text cannot be confused in the JSON form."""
    record = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return F.sha2(record, 256)


def text_digest(text: str = TEXT) -> Column:
    """SHA-256 of a text; NULL for NULL."""
    return F.sha2(F.col(text), 256)


def surplus_rows(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """For each named key, the rows beyond the first of its group: ``(key, surplus, rows)``.

    All keys share one scan and one shuffle of short digests. Counts combine before the shuffle,
    so a group with many copies is a handful of rows on the wire.
    """
    named = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("digest")) for k, v in keys.items()])
    groups = df.select(F.explode(named).alias("g")).groupBy("g.key", "g.digest").agg(F.count(F.lit(1)).alias("n"))
    return groups.groupBy("key").agg(F.sum(F.col("n") - 1).alias("surplus"), F.sum("n").alias("rows"))


def cleaning_funnel(df: DataFrame) -> DataFrame:
    """One row: rows in, full duplicates, further duplicate texts, rows without label or text, rows out."""
    usable = sentiment(F.col(RATING)).isNotNull() & F.col(TEXT).isNotNull()
    by_row = df.groupBy(row_digest(REVIEW_COLUMNS).alias("row"), text_digest().alias("body")).agg(
        F.count(F.lit(1)).alias("copies"),
        # Row id and usability packed in one number, so the minimum stays a hash aggregate.
        F.min(F.shiftleft(ROW_ID, 1) + usable.cast("long")).alias("first"),
    )
    by_text = by_row.groupBy("body").agg(
        F.sum("copies").alias("rows"),
        F.sum(F.col("copies") - 1).alias("full"),
        F.sum(F.lit(1)).alias("variants"),
        F.min("first").alias("first"),
    )
    return by_text.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum("full"), F.lit(0)).alias("full_duplicates"),
        F.coalesce(F.sum(F.col("variants") - 1), F.lit(0)).alias("further_duplicate_texts"),
        F.count_if(F.col("first") % 2 == 0).alias("unusable"),
        F.count_if(F.col("first") % 2 != 0).alias("rows_out"),
    )
