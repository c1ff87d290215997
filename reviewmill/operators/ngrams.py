"""Most frequent n-grams, over the table and per group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions.stopwords import resolve_stop_words
from reviewmill.functions.text import model_tokens, without_stop_words
from reviewmill.schema import TEXT
from reviewmill.sources.workspace import in_small_parts


def ngram_counts(
    df: DataFrame,
    ngram_range: tuple[int, int] = (1, 1),
    stop_words: str | Sequence[str] | None = "english",
    *,
    text: str = TEXT,
    by: Sequence[str] = (),
) -> DataFrame:
    """Occurrences of every n-gram: ``(*by, ngram, count)``.

    Stop words go before n-grams are formed. Counts combine inside each task, so a frequent
    n-gram reaches the shuffle once per task; a task has few enough texts to hold the counts of its n-grams,
    which are several for each word, in memory.
    """
    kept = without_stop_words(model_tokens(F.col(text)), resolve_stop_words(stop_words))
    texts = df.where(F.col(text).isNotNull()).select(*by, text)
    low, high = ngram_range
    tokens = (in_small_parts(texts) if high > 1 else texts).select(*by, kept.alias("tokens"))
    # one row for each token with its followers; runs that reach over the end are NULL
    names = [f"_word_{i}" for i in range(high)]
    followed = F.arrays_zip(*[F.slice("tokens", i + 1, F.size("tokens")).alias(name) if i else F.col("tokens").alias(name) for i, name in enumerate(names)])
    words = tokens.where(F.size("tokens") >= low).select(*by, F.inline(followed).alias(*names))
    runs = [reduce(lambda left, right: F.concat(left, F.lit(" "), right), map(F.col, names[:size])) for size in range(low, high + 1)]
    found = words.select(*by, F.explode(F.array(*runs)).alias("ngram")).where(F.col("ngram").isNotNull())
    return found.groupBy(*by, "ngram").agg(F.count(F.lit(1)).alias("count"))


def top_ngrams(
    df: DataFrame,
    ngram_range: tuple[int, int] = (1, 1),
    top_n: int = 20,
    stop_words: str | Sequence[str] | None = "english",
    *,
    text: str = TEXT,
) -> DataFrame:
    """The ``top_n`` most frequent n-grams; ties go to the lesser n-gram."""
    counts = ngram_counts(df, ngram_range, stop_words, text=text)
    return counts.orderBy(F.desc("count"), "ngram").limit(top_n)


def top_ngrams_by(
    df: DataFrame,
    by: str,
    ngram_range: tuple[int, int] = (2, 2),
    top_n: int = 8,
    stop_words: str | Sequence[str] | None = "english",
    *,
    text: str = TEXT,
) -> DataFrame:
    """The ``top_n`` n-grams of every group in one pass: ``(by, rank, ngram, count)``.

    The rank limit is applied in each task before the shuffle to the groups.
    """
    counts = ngram_counts(df.where(F.col(by).isNotNull()), ngram_range, stop_words, text=text, by=[by])
    order = Window.partitionBy(by).orderBy(F.desc("count"), "ngram")
    ranked = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_n)
    return ranked.select(by, "rank", "ngram", "count")
