"""Quality rules: counts of a text, and the log-likelihood ratio of its hashed n-grams.

Two multinomials over ``buckets`` hash buckets of lower-cased words and word pairs are counted, one
from all documents and one from all documents labelled as good. A text's score is the mean over its
n-grams of ``log p_trusted - log p_raw``; the threshold is a low quantile of the trusted texts'
own scores. Everything is built from DataFrame functions. Labels are of any number, so texts meet
them in a join, which shuffles the texts once if the labels are too many for a broadcast; the
threshold's join and the scoring pass move none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.frames import BREAK_CLASS, pick
from reviewmill.operators.distribution import exact_quantiles
from reviewmill.sources.workspace import materialise

BUCKETS = 1 << 14
SMOOTHING = 1.0
#: share of the trusted documents that may score below the threshold
TRUSTED_BELOW = 0.002
SYMBOLS = "#*$%&|<>"
#: words of a window, a power of two
WINDOW = 8


def text_words(text: Column) -> Column:
    """Words of a text in order; none of a null."""
    split = F.array_remove(F.split(text, f"[{BREAK_CLASS}]+"), "")
    return F.coalesce(split, F.array().cast("array<string>"))


def _shifted(items: Column, by: int) -> Column:
    """The items from place ``by`` on, 0 being the first."""
    return F.slice(items, F.lit(by + 1), F.greatest(F.size(items) - F.lit(by), F.lit(0)))


def _with_windows(rows: DataFrame) -> DataFrame:
    """Add ``windows``, a hash of the ``WINDOW`` words that start at each place.

    Each word is hashed once, and hashes of 1, 2, 4 words make those of twice as many. Every step is a column,
    as Catalyst would write out a step that is used twice in one expression.
    """
    rows = rows.withColumn("windows", F.transform("words", lambda w: F.xxhash64(w)))
    size = 1
    while size < WINDOW:
        last = F.greatest(F.size("windows") - F.lit(size), F.lit(0))
        both = F.zip_with(F.slice("windows", F.lit(1), last), _shifted(F.col("windows"), size), lambda a, b: F.xxhash64(a, b))
        rows, size = rows.withColumn("windows", both), 2 * size
    return rows


def with_counts(rows: DataFrame) -> DataFrame:
    """Add ``words`` and the base counts to rows with a ``text``."""
    text = F.coalesce("text", F.lit(""))
    rows = rows.withColumn("words", text_words(F.col("text")))
    rows = rows.withColumn("n_words", F.size("words").cast("long"))
    rows = _with_windows(rows)
    # Only a text in which some window is there twice goes on to sort its windows.
    ordered = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = F.size("windows") > F.size(F.array_distinct("windows"))
    rows = rows.withColumn("ordered", F.when(some, ordered))

    def again(x: Column, j: Column) -> Column:
        below, above = F.get("ordered", j - 1), F.get("ordered", j + 1)
        return F.coalesce(below.getField("h") == x.getField("h"), F.lit(False)) | F.coalesce(
            above.getField("h") == x.getField("h"), F.lit(False)
        )

    twice = F.sort_array(F.transform(F.filter("ordered", again), lambda x: x.getField("i")))
    covered = F.aggregate(
        twice,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, p: F.struct(
            (a.getField("n") + p + WINDOW - F.greatest(p, a.getField("end"))).alias("n"), (p + WINDOW).alias("end")
        ),
    )
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{BREAK_CLASS}]"))
    return rows.select(
        *[c for c in rows.columns if c not in ("windows", "ordered")],
        F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered.getField("n"), F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def gram_buckets(words: str, buckets: int) -> Column:
    """Buckets of a word array's lower-cased words and neighbouring pairs."""

    def bucket(*gram: Column) -> Column:
        return F.pmod(F.xxhash64(*gram), F.lit(buckets)).cast("int")

    def grams(lowered: Column) -> Column:
        first = F.slice(lowered, F.lit(1), F.greatest(F.size(lowered) - F.lit(1), F.lit(0)))
        pairs = F.zip_with(first, _shifted(lowered, 1), lambda a, b: bucket(a, b))
        return F.concat(F.transform(lowered, lambda w: bucket(w)), pairs)

    # The argument of a lambda is worked out once, so each word is lower-cased once.
    return F.get(F.transform(F.array(F.transform(words, F.lower)), grams), F.lit(0))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids whose every non-null quality label is 1, once each."""
    rows = pick(labels, "doc_id", "quality").select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
    good = rows.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("q"))
    return good.where("q = 1").select("doc_id")


def bucket_counts(texts: DataFrame, buckets: int) -> list[int]:
    """How often each bucket occurs; ``buckets`` numbers, however large the corpus."""
    grams = texts.select(text_words(F.col("text")).alias("words"))
    counted = grams.select(F.explode(gram_buckets("words", buckets)).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    found = {r["bucket"]: r["n"] for r in counted.collect()}
    return [found.get(b, 0) for b in range(buckets)]


def weights(rows: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> list[float]:
    """``log p_trusted - log p_raw`` of each bucket.

    All texts are counted where they are scanned. Those of trusted documents are joined with their ids
    by merging, at every size, so that the plan does not change with the input.
    """
    chosen = rows.where("doc_id is not null").select("doc_id", "text").hint("merge").join(trusted, "doc_id")
    raw, target = ([n + smoothing for n in bucket_counts(texts, buckets)] for texts in (rows, chosen))
    all_raw, all_target = sum(raw), sum(target)
    return [math.log(t / all_target) - math.log(r / all_raw) for t, r in zip(target, raw, strict=True)]


def mean_ratio(words: str, weight: list[float]) -> Column:
    """Mean weight of a text's n-grams; null without any."""
    # A foldable expression: Catalyst turns it into one array literal.
    table = F.split(F.lit(",".join(map(repr, weight))), ",").cast("array<double>")
    total = F.aggregate(
        gram_buckets(words, len(weight)), F.lit(0.0), lambda acc, b: acc + F.get(table, b)
    )
    return total / F.nullif(F.size(words) + F.greatest(F.size(words) - 1, F.lit(0)), F.lit(0))


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    *,
    buckets: int = BUCKETS,
    trusted_below: float = TRUSTED_BELOW,
) -> DataFrame:
    """``doc_id``, the base counts, ``log_ratio``, ``base_failed`` and ``kept``, a row for each row.

    Null and empty texts have no words and fail the base rule. Without trusted labels every bucket
    has weight near zero and no threshold exists, so the base rule alone decides. Repeated rows and
    ties get equal results; other columns are ignored.
    """
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    trusted = materialise(trusted_ids(labels), "trusted")
    weight = weights(rows, trusted, buckets)
    # Every row is scored once; the narrow result gives the threshold and the answer.
    scored = with_counts(rows).withColumn("log_ratio", mean_ratio("words", weight)).drop("words", "text")
    scored = materialise(scored, "quality-scores")
    known = scored.where("doc_id is not null and log_ratio is not null").select("doc_id", "log_ratio").hint("merge").join(trusted, "doc_id")
    found = exact_quantiles(known, ["log_ratio"], {"t": trusted_below}).first()
    threshold = found["t"] if found else None
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    passes = F.lit(True) if threshold is None else F.col("log_ratio") >= F.lit(threshold)
    return scored.withColumns({"base_failed": failed, "kept": ~failed & F.coalesce(passes, F.lit(False))})
