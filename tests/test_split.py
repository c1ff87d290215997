from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import splitting
from reviewmill.schema import RATING, ROW_ID, SENTIMENT, SPLIT, TEXT
from reviewmill.sources import layers


def labelled(spark, n, partitions=3):
    rows = [(i, "positive" if i % 10 < 7 else "neutral" if i % 10 < 9 else "negative") for i in range(n)]
    return spark.createDataFrame(rows, f"{ROW_ID} long, {SENTIMENT} string").repartition(partitions)


def plain_split(rows, seed=42):
    """The same rule with a full sort of each class."""
    out = {}
    for label in {r[1] for r in rows}:
        members = sorted((hashlib.md5(f"{i}:{seed}".encode()).hexdigest(), i) for i, c in rows if c == label)
        sizes = splitting.expected_sizes(len(members))
        names = [name for name, size in sizes.items() for _ in range(size)]
        out.update({i: name for (_, i), name in zip(members, names)})
    return out


@pytest.mark.parametrize("n,prefix,partitions", [(1, 4, 1), (3, 4, 1), (20, 1, 2), (997, 1, 4), (997, 4, 64), (3000, 2, 8)])
def test_split_equals_a_full_sort(spark, n, prefix, partitions):
    df = labelled(spark, n, partitions)
    got = {r[ROW_ID]: r[SPLIT] for r in splitting.assign_splits(df, prefix=prefix).collect()}
    assert got == plain_split([(r[ROW_ID], r[SENTIMENT]) for r in df.collect()])


def test_split_is_stratified(spark):
    rows = splitting.assign_splits(labelled(spark, 2000))
    for r in rows.groupBy(SPLIT, SENTIMENT).count().collect():
        share = {"train": 0.7, "validation": 0.15, "test": 0.15}[r[SPLIT]]
        total = {"positive": 1400, "neutral": 400, "negative": 200}[r[SENTIMENT]]
        assert abs(r["count"] - share * total) <= 1


def test_other_sizes_and_bad_sizes(spark):
    rows = splitting.assign_splits(labelled(spark, 1000), test_size=0.1, val_size=0.3)
    assert rows.groupBy(SPLIT).count().where(f"{SPLIT}='test'").first()["count"] == 100
    with pytest.raises(ValueError):
        splitting.leading_shares(0.6, 0.4)


def test_layers_are_written_once(spark, make_reviews, tmp_path):
    raw = make_reviews([{TEXT: f"t{i % 50}", RATING: 1 + i % 5} for i in range(100)])
    silver_path, gold_path = str(tmp_path / "silver"), str(tmp_path / "gold")
    silver = layers.build_splits(spark, silver_path, gold_path, raw=lambda: raw)
    first = sorted(map(tuple, layers.load_splits(spark, gold_path).collect()))
    layers.build_splits(spark, silver_path, gold_path, seed=1, raw=lambda: pytest.fail("silver exists"))
    assert sorted(map(tuple, layers.load_splits(spark, gold_path).collect())) == first
    assert silver.count() == len(first) == 50

    sizes = {s: layers.split_rows(silver, layers.load_splits(spark, gold_path), s) for s in ("train", "validation", "test")}
    texts = [{r[TEXT] for r in part.collect()} for part in sizes.values()]
    assert not (texts[0] & texts[1] or texts[0] & texts[2] or texts[1] & texts[2])
    assert sum(len(t) for t in texts) == 50
    with pytest.raises(ValueError):
        layers.split_rows(silver, layers.load_splits(spark, gold_path), "holdout")

    with pytest.raises(layers.SchemeError):
        layers.load_silver(spark, silver_path, scheme="binary")
    with pytest.raises(Exception, match="already exists"):
        layers.build_silver(raw, silver_path)
    with pytest.raises(FileNotFoundError):
        layers.load_silver(spark, str(tmp_path / "absent"))


def test_target_is_apart_from_features(spark):
    rows = splitting.assign_splits(labelled(spark, 100)).withColumn("x", F.lit(1))
    inputs, target = splitting.features_and_target(rows)["test"]
    assert SENTIMENT not in inputs.columns and target.columns == [ROW_ID, SENTIMENT]
    expected = sum(splitting.expected_sizes(n)["test"] for n in (70, 20, 10))
    assert inputs.count() == target.count() == expected
