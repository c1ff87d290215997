"""TF-IDF as a sparse matrix in table form, with the vocabulary fitted on training rows only.

The matrix is a table ``(row_id, term, weight)``. It has no driver-side vocabulary, so neither
the number of documents nor the number of terms is bounded by one machine.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions.text import model_text, model_tokens
from reviewmill.schema import ROW_ID, TEXT
from reviewmill.sources.workspace import file_bytes, materialise


TOKENS = "tokens"
#: noted on a column of tokens that are runs of word characters, so that they can be held as one string
WORDS_ONLY = {"content": "word characters"}
SEPARATOR = "\x1f"
#: most terms that a join by term broadcasts
FREQUENT = 65_536
#: bytes of files for one task that explodes tokens by row
ROW_BYTES = 8 << 20


def with_tokens(df: DataFrame, text: str = TEXT) -> DataFrame:
    """Add the ``tokens`` of the normalised text, unless the table carries them already."""
    if TOKENS in df.columns:
        return df
    return df.withColumn(TOKENS, model_tokens(model_text(F.col(text)))).withMetadata(TOKENS, WORDS_ONLY)


def _words_only(df: DataFrame) -> bool:
    return df.schema[TOKENS].metadata == WORDS_ONLY


def _joined() -> Column:
    return F.array_join(TOKENS, SEPARATOR)


def _parted() -> Column:
    none = F.array().cast("array<string>")
    return F.when(F.col(TOKENS) == "", none).otherwise(F.split(TOKENS, SEPARATOR))


def write_rows(df: DataFrame, name: str) -> DataFrame:
    """``materialise`` for rows with tokens: those of a row are written as one string, a fraction of the work and of the
    bytes of an array. Tokens that a caller made in another way are written as they are."""
    if not _words_only(df):
        return materialise(df, name)
    stored = materialise(df.withColumn(TOKENS, _joined()), name)
    return stored.withColumn(TOKENS, _parted()).withMetadata(TOKENS, WORDS_ONLY)


def tokenised(df: DataFrame, text: str = TEXT, keep: Sequence[str] = ()) -> DataFrame:
    """``(row_id, *keep, tokens)``."""
    return with_tokens(df, text).select(ROW_ID, *keep, TOKENS)


def _tokens_by_row(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """``(row_id, *keep, term)`` for every token. The documents are partitioned by row before they are exploded,
    so counting, and later the norm of each row, need no further shuffle."""
    rows, tokens = tokenised(df, text, keep), F.col(TOKENS)
    if _words_only(rows):  # one string takes half the shuffle of an array
        rows, tokens = rows.withColumn(TOKENS, _joined()), _parted()
    return rows.repartition(_partitions(df), ROW_ID).select(ROW_ID, *keep, F.explode(tokens).alias("term"))


def _partitions(df: DataFrame) -> int:
    """A stated number of partitions is the same for all that is put together by row. It follows the files of a written
    table, so that a task holds its rows' terms in memory whatever the setting."""
    setting = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(setting, -(-file_bytes(df) // ROW_BYTES))


def _counted(tokens: DataFrame, *keys: str) -> DataFrame:
    return tokens.groupBy(*keys).agg(F.count(F.lit(1)).alias("tf"))


def term_counts(df: DataFrame, text: str = TEXT, keep: Sequence[str] = ()) -> DataFrame:
    """``(row_id, *keep, term, tf)``; ``keep`` are columns of the row, such as its label."""
    return _counted(_tokens_by_row(df, text, keep), ROW_ID, *keep, "term")


def row_terms(df: DataFrame, text: str = TEXT, keep: Sequence[str] = ()) -> DataFrame:
    """``(row_id, *keep, term)``, each once. Rows are put together only if an id repeats, which is found from the ids."""
    rows = tokenised(df, text, keep)
    again = rows.groupBy(ROW_ID).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not again.isEmpty():
        return term_counts(df, text, keep).drop("tf")
    return rows.select(ROW_ID, *keep, F.explode(F.array_distinct(TOKENS)).alias("term"))


def frequent_above(vocabulary: DataFrame, most: int = FREQUENT) -> int:
    """The ``df`` above which a written vocabulary has ``most`` terms at most."""
    top = vocabulary.select("df").orderBy(F.desc("df")).limit(most + 1)
    line = top.agg(F.count(F.lit(1)).alias("n"), F.min("df").alias("df")).first()
    return line["df"] if line["n"] > most else 0


def met_by_term(entries: DataFrame, table: DataFrame, above: int) -> tuple[DataFrame, DataFrame]:
    """Entries joined with a written table ``(term, df, ...)``: those of frequent terms, which are most entries, stay
    where they are; only the others are shuffled by term."""
    frequent = F.broadcast(table.where(F.col("df") > above).drop("df"))
    rest = entries.join(F.broadcast(frequent.select("term")), "term", "left_anti")
    return entries.join(frequent, "term"), rest.join(table.where(F.col("df") <= above).drop("df"), "term")


def counts_met_by_term(df: DataFrame, table: DataFrame, above: int, text: str = TEXT, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """``term_counts`` joined with a written table ``(term, df, ...)``, as frequent and other terms; the
    first part is partitioned by row."""
    tokens = _tokens_by_row(df, text, keep)
    values = [c for c in table.columns if c not in ("term", "df")]
    frequent = F.broadcast(table.where(F.col("df") > above))
    counted = _counted(tokens, ROW_ID, *keep, "term")  # by few and short keys
    here = counted.join(frequent.drop("df"), "term").select(ROW_ID, *keep, "term", *values, "tf")
    other = _counted(tokens.join(F.broadcast(frequent.select("term")), "term", "left_anti"), ROW_ID, *keep, "term")
    return here, other.join(table.where(F.col("df") <= above).drop("df"), "term").select(*here.columns)


def together_by_row(df: DataFrame, parts: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Both parts of ``counts_met_by_term`` of ``df`` with each row in one partition; only the second is shuffled."""
    here, other = parts
    return here.unionByName(other.repartition(_partitions(df), ROW_ID))


def document_frequencies(df: DataFrame, text: str = TEXT, min_df: int = 1) -> DataFrame:
    """``(term, df)``: documents holding each term; repeats inside a document go before the shuffle."""
    terms = tokenised(df, text).select(F.explode(F.array_distinct(TOKENS)).alias("term"))
    counts = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return counts.where(F.col("df") >= min_df) if min_df > 1 else counts


@dataclass(frozen=True)
class TfidfModel:
    """Fitted vocabulary ``(term, df, idf)`` as a written table, and the number of training rows.

    Terms in more than ``above`` rows are frequent: few enough to be broadcast.
    """

    vocabulary: DataFrame
    documents: int
    min_df: int = 1
    above: int = 0

    def transform(self, df: DataFrame, text: str = TEXT, keep: Sequence[str] = ()) -> DataFrame:
        """``(row_id, *keep, term, weight)`` with rows of unit length; terms outside the vocabulary are dropped.

        Most entries are of few terms, which are broadcast; the entries of the others are shuffled to the
        vocabulary and back to their rows.
        """
        known = together_by_row(df, counts_met_by_term(df, self.vocabulary, self.above, text, keep))
        raw = known.select(ROW_ID, *keep, "term", (F.col("tf") * F.col("idf")).alias("raw"))
        norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(ROW_ID)))
        return raw.select(ROW_ID, *keep, "term", (F.col("raw") / norm).alias("weight"))


def fit_tfidf(train: DataFrame, text: str = TEXT, *, min_df: int = 1) -> TfidfModel:
    """Learn the vocabulary and ``idf = ln((1 + n) / (1 + df)) + 1``."""
    documents = train.count()
    idf = F.log(F.lit(1.0 + documents) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    vocabulary = document_frequencies(train, text, min_df).withColumn("idf", idf)
    vocabulary = materialise(vocabulary, "vocabulary")
    return TfidfModel(vocabulary, documents, min_df, frequent_above(vocabulary))


def largest_weight() -> Column:
    """Aggregate over one column of the matrix: its largest magnitude, 1 for an all-zero column."""
    largest = F.max(F.abs("weight"))
    return F.when(largest == 0, F.lit(1.0)).otherwise(largest)


def max_abs_scales(matrix: DataFrame) -> DataFrame:
    """``(term, scale)``: the largest magnitude of each column."""
    return matrix.groupBy("term").agg(largest_weight().alias("scale"))


def apply_max_abs(matrix: DataFrame, scales: DataFrame) -> DataFrame:
    """Divide each weight by the scale of its column."""
    joined = matrix.join(scales.select("term", "scale"), "term")
    return joined.withColumn("weight", F.col("weight") / F.col("scale")).drop("scale")
