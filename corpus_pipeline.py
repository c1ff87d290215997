"""The corpus pipeline, and the queries of the ``llm`` subpackage.

Every stage takes the documents that the stage before kept, and is written as Parquet and read again.

All stages take any table with ``doc_id`` and ``text``; of the columns of ``documents`` an absent one becomes
null, and others are left out whatever their names. An empty table stays empty. Texts are processed whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm import jaccard_join, mixing, pieces, suffix_dedup, toxicity
from reviewmill.llm import queries as registered
from reviewmill.llm.frames import pick
from reviewmill.sources.workspace import materialise

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted on the labels, does not reject.

    Null and empty texts have no evidence and stay; repeated rows share their fate, and all stay or go.
    """
    docs = pick(docs, *COLUMNS)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every group of near-duplicates.

    Null and empty texts are no copies of each other and stay; of repeated rows one stays.
    """
    return jaccard_join.one_of_each_group(pick(docs, *COLUMNS))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that repeat; ``n_chars`` follows the text.

    Every row stays, with a text that may be empty; a null text stays null. Repeated rows of long texts
    repeat each other and lose them.
    """
    short = suffix_dedup.shortened_documents(pick(docs, *COLUMNS))
    return short.withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: a row for each document and pass, with the words taken in that pass.

    Null and empty texts have no words and are not taken; repeated rows are documents of their own.
    """
    taken = mixing.Mix(pick(docs, *COLUMNS)).texts()
    return taken.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every row's text; none for a null or an empty one."""
    return pieces.encode_documents(pick(docs, *COLUMNS))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeats),
    ("source_mixing", mix_sources),
    ("sentencepiece", encode),
]

#: the severity model, the hashed permutations and the encoder have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {**registered.QUERIES, "pipeline": run}
SQL = registered.SQL
