"""Physical plans that have to hold at any size."""

from __future__ import annotations

import pytest

from reviewmill.functions.text import add_text_metrics
from reviewmill.operators import cleaning, correlation, ngrams, profiling, quality, splitting
from reviewmill.schema import ROW_ID, SENTIMENT


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(make_reviews, tmp_path):
    """A review table in Parquet, as the layers hold it."""
    df = make_reviews([{} for _ in range(20)])
    df.write.parquet(str(tmp_path / "reviews"))
    return df.sparkSession.read.parquet(str(tmp_path / "reviews"))


def test_only_needed_columns_are_read(stored):
    plan = plan_of(profiling.rating_distribution(stored))
    assert "ReadSchema: struct<Rating:int>" in plan
    assert "Review_Text" not in plan_of(cleaning.add_sentiment(stored).groupBy(SENTIMENT).count())


def test_filters_reach_the_scan(stored):
    plan = plan_of(stored.where("Branch = 'park_a'").select(ROW_ID))
    assert "EqualTo(Branch,park_a)" in plan


def test_text_metrics_need_no_shuffle_and_no_python(stored):
    plan = plan_of(add_text_metrics(stored))
    assert "Exchange" not in plan and "Python" not in plan


def test_cleaning_moves_digests_and_ids_only(stored):
    plan = plan_of(cleaning.clean_reviews(stored))
    assert plan.count("Exchange hashpartitioning") == 1  # of digests that are combined before it
    below = plan.split("Exchange hashpartitioning")[1]
    assert "partial_min(row_id" in below and "LeftSemi" in plan


def test_quality_report_scans_twice(stored):
    plan = plan_of(quality.quality_report(stored))
    assert plan.count("FileScan") == 2 and "Sort" not in plan


def test_top_ngrams_do_not_sort_everything(stored):
    assert "TakeOrderedAndProject" in plan_of(ngrams.top_ngrams(stored, (2, 2), 5))
    by_class = plan_of(ngrams.top_ngrams_by(cleaning.add_sentiment(stored), SENTIMENT))
    assert "WindowGroupLimit" in by_class


def test_split_does_not_move_the_table(stored):
    labelled = cleaning.add_sentiment(stored).select(ROW_ID, SENTIMENT)
    plan = plan_of(splitting.assign_splits(labelled))
    outer = plan.split("BroadcastExchange")[0]  # everything above the cut table is the table's own path
    assert "BroadcastHashJoin" in outer and "Exchange hashpartitioning" not in outer


def test_no_cartesian_products(stored):
    metrics = cleaning.add_sentiment(add_text_metrics(stored))
    for df in (
        profiling.corpus_summary(stored),
        profiling.class_balance(metrics, SENTIMENT),
        correlation.spearman_matrix(metrics, ["Rating", "n_words"]),
    ):
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
