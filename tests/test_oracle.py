"""One query of each family against DuckDB; ``python -m checks.run FOLDER`` runs all of them."""

from __future__ import annotations

import os

import pytest

import __spark_entry__
from checks.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
FAMILIES = [
    "s1_scan_csv",
    "s4_text_digests",
    "s9_build_splits_once",
    "s10_subset",
    "c1_drop_full_duplicates",
    "c9_clean",
    "c10_funnel",
    "t_all_text_metrics",
    "t16_frequency_text",
    "t18_whitespace_split",
    "t22_half_even",
    "p1_column_inventory",
    "p1_approximate_inventory",
    "p16_quality_report",
    "p17_corpus_summary",
    "p18_describe_numbers",
    "p19_describe_categories",
    "p22_class_balance",
    "p24_describe_text_metrics",
    "p26_vocabulary_size",
    "p30_split_summary",
    "g1_branch_report",
    "g3_sentiment_by_branch",
    "g9_length_histogram",
    "g10_length_boxes",
    "r1_leakage_checks",
    "r2_spearman_matrix",
    "n2_top_bigrams",
    "n3_ngram_range",
    "n4_top_bigrams_by_class",
    "l1_stratified_split",
    "l3_temporal_split",
    "l4_stratified_folds",
    "f4_feature_matrix",
    "f6_feature_vectors",
    "f8_min_max",
    "m4_naive_bayes",
    "m7_cross_validation",
    "m8_ablation",
    "e3_average_report",
    "e7_leaderboard",
    "e10_bootstrap_interval",
    "e11_thresholds",
    "e11_tuned_bayes",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.fixture(scope="module")
def expected():
    return __spark_entry__.oracle_sql()


@pytest.mark.parametrize("name", FAMILIES)
def test_query_equals_sql(spark, database, expected, name):
    result = __spark_entry__.queries()[name](spark, FOLDER).toArrow()
    assert differences(result, database.sql(expected[name]).to_arrow_table()) == []


def test_every_sql_belongs_to_a_query(expected):
    assert set(expected) <= set(__spark_entry__.queries())


def test_entry(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert {r["label"] for r in rows} == {"negative", "neutral", "positive"}


def test_expected_sql_reads_no_files(monkeypatch):
    """The SQL must not depend on how and where Spark is installed."""
    import builtins

    from checks import oracle

    def refuse(*_args, **_options):
        raise AssertionError("the oracle opened a file")

    monkeypatch.setattr(builtins, "open", refuse)
    assert len(oracle.oracle()) > 100
