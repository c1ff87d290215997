from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from reviewmill.operators import correlation, distribution, metrics
from reviewmill.schema import LABELS

RNG = np.random.default_rng(5)


def hot_values(n):
    """A third of the rows share one value, the rest are spread unevenly with ties."""
    values = np.round(RNG.exponential(50, n), 1)
    values[: n // 3] = 12.0
    return values


def test_value_ranges_never_fall(spark):
    values = np.sort(np.concatenate([RNG.normal(0, 1e6, 500), 2.0 ** np.arange(-60, 60), np.arange(-50, 50), np.nextafter(2.0 ** np.arange(1, 40), 0)]))
    values = [-np.inf, -1e308, *values.tolist(), 5e-324, 1e308, np.inf, np.nan]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = [tuple(r) for r in df.select("v", distribution.value_range(distribution.F.col("v")).alias("r")).orderBy("v").collect()]
    ranges = [r for _, r in got]
    assert ranges == sorted(ranges) and len(set(ranges)) > 300


@pytest.mark.parametrize("bits", [0, 3, 10])
def test_running_totals(spark, monkeypatch, bits):
    monkeypatch.setattr(distribution, "RANGE_BITS", bits)
    values = hot_values(3000) - 20
    frame = pd.DataFrame({"g": np.where(np.arange(3000) % 2, "a", "b"), "v": values})
    hist = frame.groupby(["g", "v"]).size().rename("n").reset_index()
    table = spark.createDataFrame(hist).repartition(7)
    got = distribution.running_totals(table, ["g"], "v", ["n"]).toPandas()
    hist["before_n"] = hist.groupby("g")["n"].cumsum() - hist["n"]
    hist["total_n"] = hist.groupby("g")["n"].transform("sum")
    both = got.sort_values(["g", "v"]).reset_index(drop=True)[hist.columns]
    pd.testing.assert_frame_equal(both, hist, check_dtype=False)


@pytest.mark.parametrize("size", [1, 2, 5, 1000])
def test_quantiles_match_numpy(spark, size):
    values = hot_values(size)
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    got = distribution.exact_quantiles(df, ["x"], {"a": 0.25, "b": 0.5, "c": 0.9}).first()
    assert [got["a"], got["b"], got["c"]] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.9]))


def test_describe_matches_pandas(spark):
    frame = pd.DataFrame({"x": hot_values(500), "id": np.arange(500) + 10**9})
    got = distribution.describe_numbers(spark.createDataFrame(frame), ["x", "id"], digits=6).toPandas().set_index("metric")
    want = frame.describe().T
    for name, key in {"mean": "mean", "std": "std", "min": "min", "q25": "25%", "q50": "50%", "q75": "75%", "max": "max"}.items():
        for column in frame:
            assert got.loc[column, name] == pytest.approx(want.loc[column, key], rel=1e-6)


def test_histogram_matches_numpy(spark):
    words = RNG.integers(1, 900, 700)
    got = distribution.clipped_histogram(spark.createDataFrame(pd.DataFrame({"w": words})), "w").orderBy("bin").toPandas()
    counts, edges = np.histogram(np.minimum(words, 600), bins=60)
    assert got["n"].sum() == 700 and len(got) == 60
    assert np.abs(got["n"].to_numpy() - counts).sum() <= 2  # a value on an edge may fall either side
    assert got["upper"].to_numpy() == pytest.approx(edges[1:])
    one = distribution.clipped_histogram(spark.createDataFrame([(7,), (7,)], "w int"), "w").toPandas()
    assert one["n"].sum() == 2


def test_boxes_and_fences(spark):
    values = [1, 2, 3, 4, 100]
    df = spark.createDataFrame([("g", v) for v in values], "k string, w int")
    box = distribution.box_statistics(df, "w", "k").first()
    assert (box["q1"], box["median"], box["q3"]) == (2, 3, 4)
    assert (box["whisker_low"], box["whisker_high"]) == (1, 4)
    fence = distribution.iqr_outliers(df, ["w"]).first()
    assert (fence["iqr_upper_bound"], fence["above"], fence["pct"], fence["max"]) == (7, 1, 20.0, 100)


def test_spearman_matches_pandas_with_nulls(spark):
    n = 400
    frame = pd.DataFrame({"a": hot_values(n), "b": RNG.integers(1, 6, n).astype(float), "c": np.arange(n, dtype=float)})
    frame.loc[::7, "a"] = np.nan
    frame.loc[::5, "c"] = np.nan
    rows = [tuple(None if pd.isna(x) else float(x) for x in r) for r in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    got = correlation.spearman_matrix(df, ["a", "b", "c"]).collect()
    for row in got:
        # Pearson of average ranks over the rows where both are present.
        pair = frame[[row["left"], row["right"]]].dropna()
        want = 1.0 if row["left"] == row["right"] else np.corrcoef(pair.rank().T)[0, 1]
        assert row["rho"] == pytest.approx(want, abs=1e-12)
    assert len(got) == 9


def brute_auc(scores, positive):
    above = [(p > q) + 0.5 * (p == q) for p in scores[positive] for q in scores[~positive]]
    return np.mean(above)


def test_auc_matches_pair_counting(spark):
    n = 300
    truth = RNG.choice(LABELS, n, p=[0.1, 0.2, 0.7])
    chances = np.round(RNG.dirichlet([1, 1, 1], n), 1)  # many ties
    chances[: n // 3] = [0.2, 0.3, 0.5]
    df = spark.createDataFrame([(str(t), [float(x) for x in c]) for t, c in zip(truth, chances)], "sentiment string, probability array<double>")
    got = {r["label"]: r["auc"] for r in metrics.auc_one_vs_rest(df).collect()}
    for i, label in enumerate(LABELS):
        assert got[label] == pytest.approx(brute_auc(chances[:, i], truth == label))
