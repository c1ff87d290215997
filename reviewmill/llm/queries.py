"""Registered queries of the subpackage: thin calls of the operators with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewmill.llm import (
    divergence,
    embedding_dedup,
    fingerprints,
    graph_dedup,
    hard_negatives,
    jaccard_join,
    language,
    mixing,
    pieces,
    quality_rules,
    suffix_dedup,
    token_counts,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_suffix_array_dedup")
def _(spark, folder):
    found = suffix_dedup.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op5_quality_rules")
def _(spark, folder):
    judged = quality_rules.quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *base, "base_failed", "kept", "log_ratio")


@query("op10_source_mixing")
def _(spark, folder):
    taken = mixing.Mix(table(spark, folder, "documents")).taken()
    return taken.select("doc_id", "size", "source_size", "target", "taken", "source", "first_shard", "last_shard")


@query("op7_document_fingerprints")
def _(spark, folder):
    return fingerprints.neighbour_fingerprints(table(spark, folder, "documents"))


@query("op8_language_id")
def _(spark, folder):
    docs = table(spark, folder, "documents")
    return language.identify(docs, language.fit(docs))


@query("op9_toxicity")
def _(spark, folder):
    docs = table(spark, folder, "documents")
    return toxicity.severity(docs, toxicity.fit(docs, table(spark, folder, "labels")))


@query("op4_substring_dedup")
def _(spark, folder):
    found = graph_dedup.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op2_token_counts")
def _(spark, folder):
    return token_counts.document_token_counts(table(spark, folder, "documents"))


@query("op3_sentencepiece")
def _(spark, folder):
    return pieces.encode_documents(table(spark, folder, "documents")).select("doc_id", "n_ids", "ids_sha256", "round_trip")


@query("op6_ngram_jaccard_join")
def _(spark, folder):
    found = jaccard_join.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "class_id", "n_links", "text_class", "copies")


@query("op12_source_divergence")
def _(spark, folder):
    return divergence.audit(table(spark, folder, "documents")).report()


SQL["op12_source_divergence"] = divergence.SQL


@query("op13_embedding_near_dedup")
def _(spark, folder):
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


SQL["op13_embedding_near_dedup"] = embedding_dedup.SQL


@query("op11_hard_negatives")
def _(spark, folder):
    return hard_negatives.mine(table(spark, folder, "embeddings"))


SQL["op11_hard_negatives"] = hard_negatives.SQL
