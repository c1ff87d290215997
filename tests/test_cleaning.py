from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import cleaning, quality
from reviewmill.operators.contract import ContractError, check_contract
from reviewmill.schema import RATING, ROW_ID, SENTIMENT, TEXT

ROWS = [
    {TEXT: "same", RATING: 1, "Review_ID": 7},
    {TEXT: "same", RATING: 1, "Review_ID": 7},  # full duplicate
    {TEXT: "same", RATING: 5, "Review_ID": 8},  # same text, other rating
    {TEXT: None, RATING: 4},
    {TEXT: None, RATING: 3},
    {TEXT: "no rating", RATING: None},
    {TEXT: "zero", RATING: 0},
    {TEXT: "six", RATING: 6},
    {TEXT: "  \n", RATING: 3, "Year_Month": "missing"},
    {TEXT: "1234 !!", RATING: 2, "Year_Month": "2019-13"},
    {TEXT: "fine text here", RATING: 2, "Year_Month": "19-4"},
]


def ids(df):
    return sorted(r[ROW_ID] for r in df.select(ROW_ID).collect())


def test_first_row_of_each_group_stays(make_reviews):
    rows = make_reviews(ROWS)
    assert ids(cleaning.drop_full_duplicates(rows)) == [0, 2, 3, 4, 5, 6, 7, 8, 9, 10]
    assert ids(cleaning.drop_duplicate_texts(rows)) == [0, 3, 5, 6, 7, 8, 9, 10]
    assert ids(cleaning.clean_reviews(rows)) == [0, 8, 9, 10]


def test_one_shuffle_equals_two_deduplications(make_reviews):
    rows = make_reviews(ROWS)
    twice = cleaning.drop_duplicate_texts(cleaning.drop_full_duplicates(rows))
    assert ids(twice) == ids(cleaning.drop_duplicate_texts(rows))


@pytest.mark.parametrize("partitions", [1, 4, 64])
def test_result_does_not_depend_on_partitions(make_reviews, partitions):
    rows = make_reviews(ROWS, partitions)
    assert ids(cleaning.clean_reviews(rows)) == [0, 8, 9, 10]
    assert cleaning.cleaning_funnel(rows).first().asDict() == {
        "rows_in": 11,
        "full_duplicates": 1,
        "further_duplicate_texts": 2,
        "unusable": 4,
        "rows_out": 4,
    }


def test_group_with_a_third_of_all_rows(spark, make_reviews):
    n = 6000
    rows = make_reviews([{TEXT: "hot" if i % 3 == 0 else f"t{i}", "Review_ID": 1 if i % 3 == 0 else i} for i in range(n)], 16)
    kept = cleaning.drop_duplicate_texts(rows)
    assert kept.count() == n - n // 3 + 1
    assert kept.where(F.col(TEXT) == "hot").first()[ROW_ID] == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(row_id" in plan  # a row for each task and text before the shuffle


def test_quality_report(make_reviews):
    rows = make_reviews(ROWS)
    found = {r["issue"]: r["count"] for r in quality.quality_report(rows).collect()}
    assert found == {
        quality.NULLS: 3,
        quality.FULL_DUPLICATES: 1,
        quality.DUPLICATE_IDS: 3,  # 11 rows, 8 distinct ids: 7 three times, 8 twice
        quality.DUPLICATE_TEXTS: 3,
        quality.EMPTY: 1,
        quality.SHORT: 8,
        quality.LONG: 0,
        quality.SYMBOLS: 4,
        quality.HAS_URL: 0,
        quality.HAS_EMOJI: 0,
        quality.HAS_NON_ASCII: 0,
        quality.BAD_RATING: 3,
        quality.SENTINEL: 1,
        quality.BAD_PERIOD: 1,
    }


def test_contract(make_reviews):
    check_contract(make_reviews([{RATING: None}, {RATING: 1}, {RATING: 5}]))
    for bad in (0, 6):
        with pytest.raises(ContractError):
            check_contract(make_reviews([{RATING: bad}]))
    with pytest.raises(ContractError):
        check_contract(make_reviews([{}]).drop("Branch"))


def test_unknown_class_gives_no_rows(make_reviews):
    rows = cleaning.add_sentiment(make_reviews(ROWS))
    assert cleaning.with_sentiment(rows, "mixed").count() == 0
    assert {r[0] for r in rows.select(SENTIMENT).distinct().collect()} == {"negative", "neutral", "positive", None}
