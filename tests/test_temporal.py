from __future__ import annotations

import datetime
import random
from math import floor

import pytest

from reviewmill.operators import temporal
from reviewmill.schema import PERIOD, REVIEW_ID, ROW_ID, SPLIT

SCHEMA = f"{ROW_ID} long, {REVIEW_ID} long, {PERIOD} date"


def table(seed, n):
    """Ids that mostly follow time, with undated stretches, ties of month and of id."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        month = 2010 * 12 + i // 9 + rnd.choice([0, 0, 0, -3])
        dated = rnd.random() < 0.6 and not 20 < i < 45 and i > 2
        rows.append((1000 + i, i - i % 2 * rnd.randint(0, 1), datetime.date(month // 12, month % 12 + 1, 1) if dated else None))
    return rows


def plain(rows):
    dated = sorted((v, m) for _, v, m in rows if m)
    months = {r: m or max(((v2, m2) for v2, m2 in dated if v2 < v), default=(0, min(m2 for _, m2 in dated)))[1] for r, v, m in rows}
    order = sorted(rows, key=lambda r: (months[r[0]], r[1], r[0]))
    cuts = [floor(len(rows) * s + 0.5) for s in (0.7, 0.85)]
    return {r[0]: (months[r[0]], "train" if i < cuts[0] else "validation" if i < cuts[1] else "test") for i, r in enumerate(order)}


@pytest.mark.parametrize("seed,n,range_ids", [(1, 150, 10), (2, 150, 1000), (3, 7, 1), (4, 40, 7)])
def test_equals_a_full_sort(spark, seed, n, range_ids):
    rows = table(seed, n)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = {r[ROW_ID]: (r[temporal.MONTH], r[SPLIT]) for r in temporal.temporal_split(df, range_ids=range_ids).collect()}
    assert got == plain(rows)


def test_no_training_row_is_later_than_a_test_row(spark):
    out = temporal.temporal_split(spark.createDataFrame(table(5, 200), SCHEMA)).collect()
    latest = max(r[temporal.MONTH] for r in out if r[SPLIT] == "train")
    assert latest <= min(r[temporal.MONTH] for r in out if r[SPLIT] == "test")


def test_no_month_at_all(spark):
    with pytest.raises(ValueError):
        temporal.temporal_split(spark.createDataFrame([(1, 1, None)], SCHEMA))
    assert temporal.temporal_split(spark.createDataFrame([], SCHEMA)).collect() == []
