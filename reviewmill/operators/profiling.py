"""Column inventory, descriptions and corpus summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.numeric import half_even, percent, ratio
from reviewmill.functions.text import word_count
from reviewmill.operators.cleaning import surplus_rows, text_digest
from reviewmill.operators.distribution import exact_quantiles, running_totals, quantile_of_ranked, value_histogram
from reviewmill.schema import (
    BRANCH,
    MISSING_PERIOD,
    RATING,
    REVIEW_COLUMNS,
    REVIEW_ID,
    TEXT,
    YEAR_MONTH,
)


# A column of at most so many distinct values is one of categories.
MOST_CATEGORIES = 50


def short_key(column: Column) -> Column:
    """SHA-256 of a value as text, so that counting moves few bytes."""
    return F.sha2(column.cast("string"), 256)


def value_counts(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Rows per column and value, NULL included: ``(column, value, n)``, one scan for all columns."""
    cells = F.array(*[F.struct(F.lit(k).alias("column"), v.alias("value")) for k, v in columns.items()])
    long = df.select(F.explode(cells).alias("c"))
    return long.groupBy("c.column", "c.value").agg(F.count(F.lit(1)).alias("n"))


#: precision of a distinct sketch: 2 ** SKETCH_BITS registers, a relative error of about 1.04 / sqrt of that
SKETCH_BITS = 14
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def column_sketches(df: DataFrame, columns: Sequence[str] = REVIEW_COLUMNS) -> DataFrame:
    """``(column, dtype, rows, nulls, sketch)``: state for an approximate inventory, from one scan without
    a shuffle of values. Store it for each load and merge the loads with ``merged_sketches``."""
    types = dict(df.dtypes)
    cells = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(SKETCH_BITS)).alias(f"s_{i}") for i, c in enumerate(columns)],
    )
    lines = [
        F.struct(
            F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"), F.col("rows"), (F.col("rows") - F.col(f"n_{i}")).alias("nulls"), F.col(f"s_{i}").alias("sketch")
        )
        for i, c in enumerate(columns)
    ]
    return cells.select(F.inline(F.array(*lines)))


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One line per column from the stored sketches of any number of loads."""
    return sketches.groupBy("column").agg(
        F.max("dtype").alias("dtype"), F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.hll_union_agg("sketch").alias("sketch")
    )


def approximate_inventory(sketches: DataFrame, roles: Mapping[str, str] | None = None) -> DataFrame:
    """``column_inventory`` from sketches. ``unique`` is an estimate, so a column counts as a key if the
    estimate is within three errors of the number of rows; NULLs are exact."""
    per_column = sketches.select("column", "dtype", F.hll_sketch_estimate("sketch").alias("unique"), "nulls", "rows")
    near = F.abs(F.col("unique") - F.col("rows")) <= F.lit(3 * SKETCH_ERROR) * F.col("rows")
    return _inventory(per_column, (F.col("nulls") == 0) & near & (F.col("rows") > 0), roles)


def column_inventory(
    df: DataFrame,
    columns: Sequence[str] = REVIEW_COLUMNS,
    roles: Mapping[str, str] | None = None,
    *,
    approximate: bool = False,
) -> DataFrame:
    """One row per column: type, distinct values, NULLs, whether constant or a key, and its role.

    A role that ``roles`` does not give follows from the profile: ``constant``, ``key``, ``category``
    (few values), ``free`` (over half of the rows have a value of their own) or ``repeated``.
    ``approximate`` estimates distinct values from sketches, which are bounded in size.
    """
    if approximate:
        return approximate_inventory(column_sketches(df, columns), roles)
    counts = value_counts(df, {c: short_key(F.col(c)) for c in columns})
    per_column = counts.groupBy("column").agg(
        F.count("value").alias("unique"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.sum("n").alias("rows"),
    )
    types = dict(df.dtypes)
    pairs = [F.lit(x) for name in columns for x in (name, types.get(name, "unmapped"))]
    per_column = per_column.withColumn("dtype", F.create_map(*pairs)[F.col("column")])
    return _inventory(per_column, F.col("unique") == F.col("rows"), roles)


def _inventory(per_column: DataFrame, key: Column, roles: Mapping[str, str] | None) -> DataFrame:
    given = roles or {}
    known = F.create_map(*[F.lit(x) for pair in given.items() for x in pair])[F.col("column")] if given else F.lit(None)
    role = (
        F.when(F.col("unique") <= 1, "constant")
        .when(key, "key")
        .when(F.col("unique") <= MOST_CATEGORIES, "category")
        .when(2 * F.col("unique") > F.col("rows"), "free")
        .otherwise("repeated")
    )
    return per_column.select(
        "column",
        "dtype",
        "unique",
        "nulls",
        percent(F.col("nulls"), F.col("rows")).alias("pct_null"),
        (F.col("unique") <= 1).alias("constant"),
        key.alias("unique_key"),
        F.coalesce(known, role).alias("role"),
    )


def describe_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency; ties go to the lesser value."""
    counts = value_counts(df, {c: F.col(c).cast("string") for c in columns}).where("value is not null")
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def column_types(df: DataFrame) -> DataFrame:
    """Name, type and number of non-NULL values of every column, from one scan."""
    row = df.agg(*[F.count(name).alias(f"n{i}") for i, name in enumerate(df.columns)])
    cells = [
        F.struct(F.lit(name).alias("column"), F.lit(kind).alias("dtype"), F.col(f"n{i}").alias("non_null"))
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return row.select(F.inline(F.array(*cells)))


def rating_statistics(df: DataFrame) -> DataFrame:
    """Mean, median, mode, sample deviation and quartiles of the rating; the lesser mode wins a tie."""
    ranked = running_totals(value_histogram(df, [RATING]), ["metric"], "value", ["n"])
    mean = F.sum(F.col("value") * F.col("n")) / F.sum("n")
    squares = F.sum(F.col("value") * F.col("value") * F.col("n"))
    total = F.sum("n")
    return ranked.agg(
        half_even(mean, 3).alias("mean"),
        quantile_of_ranked(0.5).alias("median"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).cast("int").alias("mode"),
        # The rating has five small levels, so the sum of squares loses nothing.
        half_even(F.sqrt(F.try_divide(squares - total * mean * mean, total - 1)), 3).alias("std"),
        quantile_of_ranked(0.25).alias("q1"),
        quantile_of_ranked(0.75).alias("q3"),
    )


def rating_distribution(df: DataFrame) -> DataFrame:
    """Reviews per rating and their share of all rows, unrated rows included in the base."""
    counts = df.groupBy(RATING).agg(F.count(F.lit(1)).alias("count"))
    rows = counts.agg(F.sum("count")).scalar()
    return counts.where(F.col(RATING).isNotNull()).select(
        RATING, "count", percent(F.col("count"), rows).alias("pct")
    )


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows per class, share of all rows, and size relative to the smallest class."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    rows = counts.agg(F.sum("count")).scalar()
    present = counts.where("label is not null")
    smallest = present.agg(F.min("count")).scalar()
    return present.select(
        "label",
        "count",
        percent(F.col("count"), rows).alias("pct"),
        half_even(ratio(F.col("count"), smallest), 1).alias("ratio_vs_smallest"),
    )


def feature_ranges(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Minimum, mean and maximum of numeric columns: ``(metric, min, mean, max)``."""
    row = df.agg(
        *[f(F.col(c).cast("double")).alias(f"{name}_{c}") for c in columns for name, f in _RANGE.items()]
    )
    cells = [
        F.struct(
            F.lit(c).alias("metric"), *[half_even(F.col(f"{name}_{c}"), digits).alias(name) for name in _RANGE]
        )
        for c in columns
    ]
    return row.select(F.inline(F.array(*cells)))


_RANGE = {"min": F.min, "mean": F.avg, "max": F.max}

# The limits behind the spam and shouting flags.
CAPS_LIMIT, EXCLAIM_LIMIT, REPETITION_LIMIT = 0.30, 10, 0.30


# The names of the flags are fixed values.
def spam_flags(metrics: DataFrame) -> DataFrame:
    """Reviews per warning sign: ``(flag, reviews)``; expects the text metrics."""
    signs = {
        "caps_ratio > 0.30": F.col("caps_ratio") > CAPS_LIMIT,
        "more than 10 '!'": F.col("n_exclaim") > EXCLAIM_LIMIT,
        "unique_ratio < 0.30 (repetitive)": F.col("unique_ratio") < REPETITION_LIMIT,
        "contains a URL": F.col("has_url"),
        "contains an emoji": F.col("has_emoji"),
    }
    row = metrics.agg(*[F.count_if(test).alias(f"s{i}") for i, test in enumerate(signs.values())])
    cells = [F.struct(F.lit(s).alias("flag"), F.col(f"s{i}").alias("reviews")) for i, s in enumerate(signs)]
    return row.select(F.inline(F.array(*cells)))


def corpus_summary(df: DataFrame) -> DataFrame:
    """Headline facts as ``(measure, item, value)`` rows."""
    words = df.withColumn("n_words", word_count(F.col(TEXT)))
    facts = {
        ("rows", ""): F.count(F.lit(1)),
        ("columns", ""): F.lit(len(REVIEW_COLUMNS)),
        ("missing periods", ""): F.count_if(F.col(YEAR_MONTH) == MISSING_PERIOD),
        ("max words", ""): F.max("n_words"),
        **{("nulls", c): F.count_if(F.col(c).isNull()) for c in REVIEW_COLUMNS},
    }
    row = words.agg(*[f.cast("double").alias(f"f{i}") for i, f in enumerate(facts.values())])
    cells = [
        F.struct(F.lit(m).alias("measure"), F.lit(item).alias("item"), F.col(f"f{i}").alias("value"))
        for i, (m, item) in enumerate(facts)
    ]
    headline = row.select(F.inline(F.array(*cells)))

    counts = value_counts(df, {RATING: F.col(RATING).cast("string"), BRANCH: F.col(BRANCH)})
    per_level = counts.where("value is not null").select(
        F.when(F.col("column") == RATING, "rating").otherwise("branch").alias("measure"),
        F.col("value").alias("item"),
        F.col("n").cast("double").alias("value"),
    )
    of_rating = counts.where(F.col("column") == RATING)
    largest = F.max(F.when(F.col("value").isNotNull(), F.col("n")))
    share = of_rating.agg(ratio(largest, F.sum("n")).alias("value")).select(
        F.lit("majority share").alias("measure"), F.lit("").alias("item"), half_even(F.col("value"), 6).alias("value")
    )
    copies = surplus_rows(df, {REVIEW_ID: F.col(REVIEW_ID), TEXT: text_digest()}).select(
        F.lit("duplicates").alias("measure"), F.col("key").alias("item"), F.col("surplus").cast("double").alias("value")
    )
    median = exact_quantiles(words, ["n_words"], {"value": 0.5}).select(
        F.lit("median words").alias("measure"), F.lit("").alias("item"), "value"
    )
    return headline.unionByName(per_level).unionByName(share).unionByName(copies).unionByName(median)


def vocabulary_size(df: DataFrame) -> DataFrame:
    """Total lexical tokens and distinct words of the normalised text: ``(total_tokens, vocabulary)``.

    Distinct words per document come first, so repeats inside a document are never shuffled.
    """
    from reviewmill.functions.text import frequency_text, lexical_tokens, whitespace_split

    words = F.array_distinct(whitespace_split(frequency_text(F.col(TEXT))))
    vocabulary = df.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    size = vocabulary.agg(F.count(F.lit(1))).scalar()
    return df.agg(F.coalesce(F.sum(F.size(lexical_tokens(F.col(TEXT)))), F.lit(0)).alias("total_tokens")).select(
        "total_tokens", size.alias("vocabulary")
    )
