"""Text expressions. Everything here stays on the JVM; there is no Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.numeric import half_even, ratio
from reviewmill.schema import TEXT

# The patterns that define each metric.
WORD = r"\S+"
LEXICAL_TOKEN = r"[a-z']+"
SENTENCE_END = r"[.!?]+(?:\s|\z)"
UPPERCASE = r"[A-Z]"
URL = r"(?i)https?://|www\."
EMOJI = r"[\x{1F300}-\x{1F9FF}\x{2600}-\x{27BF}\x{1FA70}-\x{1FAFF}]"
NON_ASCII = r"[^\x00-\x7F]"
LETTER = r"[A-Za-z]"
BLANK = r"^\s*\z"
MODEL_URL = r"http\S+|www\.\S+"
FREQUENCY_URL = r"https?://\S+"
MODEL_TOKEN = r"[\p{L}\p{N}_]{2,}"

TEXT_METRICS = (
    "n_chars",
    "n_words",
    "n_sentences",
    "n_tokens",
    "n_unique_words",
    "unique_ratio",
    "mean_word_len",
    "n_upper",
    "caps_ratio",
    "n_exclaim",
    "n_question",
    "has_url",
    "has_emoji",
)


def count_matches(text: Column, pattern: str) -> Column:
    """Number of matches of ``pattern``; NULL for NULL text."""
    return F.regexp_count(text, F.lit(pattern))


def count_char(text: Column, char: str) -> Column:
    """Occurrences of one literal character, as a difference of lengths."""
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def contains_pattern(text: Column, pattern: str) -> Column:
    """Pattern test that is false, not NULL, for NULL text."""
    return F.coalesce(F.regexp_like(text, F.lit(pattern)), F.lit(False))


def word_count(text: Column) -> Column:
    return count_matches(text, WORD)


def sentence_count(text: Column) -> Column:
    """Sentence endings, at least one; NULL for NULL text (``greatest`` alone would give 1)."""
    return F.when(text.isNotNull(), F.greatest(count_matches(text, SENTENCE_END), F.lit(1)))


def lexical_tokens(text: Column) -> Column:
    """Lower-case letter runs; an empty array for NULL text."""
    found = F.regexp_extract_all(F.lower(text), F.lit(LEXICAL_TOKEN), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def add_text_metrics(df: DataFrame, text: str = TEXT) -> DataFrame:
    """Append the thirteen text metrics; the input columns stay as they are."""
    body = F.col(text)
    counted = df.select(
        "*",
        F.length(body).alias("n_chars"),
        word_count(body).alias("n_words"),
        sentence_count(body).alias("n_sentences"),
        lexical_tokens(body).alias("_lexical"),
        count_matches(body, UPPERCASE).alias("n_upper"),
    )
    sized = counted.select(
        "*",
        F.size("_lexical").alias("n_tokens"),
        F.size(F.array_distinct("_lexical")).alias("n_unique_words"),
    )
    c = F.col
    return sized.select(
        *[c(name) for name in df.columns],
        c("n_chars"),
        c("n_words"),
        c("n_sentences"),
        c("n_tokens"),
        c("n_unique_words"),
        half_even(ratio(c("n_unique_words"), c("n_tokens")), 4).alias("unique_ratio"),
        half_even(ratio(c("n_chars"), c("n_words")), 2).alias("mean_word_len"),
        c("n_upper"),
        half_even(ratio(c("n_upper"), c("n_chars")), 4).alias("caps_ratio"),
        count_char(body, "!").alias("n_exclaim"),
        count_char(body, "?").alias("n_question"),
        contains_pattern(body, URL).alias("has_url"),
        contains_pattern(body, EMOJI).alias("has_emoji"),
    )


def model_text(text: Column) -> Column:
    """Text as the vectoriser sees it: NULL becomes empty, lower case, URLs deleted.

    The pattern is matched only in texts that hold how a match begins.
    """
    lower = F.lower(F.coalesce(text, F.lit("")))
    begun = F.contains(lower, F.lit("http")) | F.contains(lower, F.lit("www."))
    return F.when(begun, F.regexp_replace(lower, MODEL_URL, "")).otherwise(lower)


def frequency_text(text: Column) -> Column:
    """Text for word counting: lower case, URLs and other signs to spaces, spaces squeezed."""
    spaced = F.regexp_replace(F.lower(text), FREQUENCY_URL, " ")
    letters = F.regexp_replace(spaced, r"[^a-z\s']", " ")
    return F.trim(F.regexp_replace(letters, r"\s+", " "))


def model_tokens(text: Column) -> Column:
    """Runs of two or more word characters of the lower-case text."""
    return F.regexp_extract_all(F.lower(text), F.lit(MODEL_TOKEN), F.lit(0))


def whitespace_split(text: Column) -> Column:
    """Whitespace-separated pieces; an empty array for blank text."""
    pieces = F.split(F.trim(text), r"\s+")
    return F.filter(pieces, lambda piece: piece != F.lit(""))


def without_stop_words(tokens: Column, stop_words: Sequence[str] | None) -> Column:
    """Drop stop words but keep repeats of the other tokens, in order."""
    if not stop_words:
        return tokens
    return F.filter(tokens, lambda token: ~token.isin(*stop_words))


def ngrams(tokens: Column, size: int) -> Column:
    """Space-joined runs of ``size`` neighbouring tokens; empty where there are too few.

    The token list is zipped with itself, shifted by one for each further token.
    """
    if size == 1:
        return tokens
    runs = F.greatest(F.size(tokens) - F.lit(size - 1), F.lit(0))
    joined = F.slice(tokens, F.lit(1), runs)
    for shift in range(1, size):
        shifted = F.slice(tokens, F.lit(shift + 1), runs)
        joined = F.zip_with(joined, shifted, lambda left, right: F.concat(left, F.lit(" "), right))
    return joined


def strip_prefix(text: Column, prefix: str) -> Column:
    """Remove every occurrence of a literal, as for shortening branch names."""
    return F.replace(text, F.lit(prefix), F.lit(""))
