from __future__ import annotations

import hashlib
from math import floor

import pytest
from pyspark.sql import functions as F
from test_models import corpus
from test_split import labelled

from reviewmill.operators import splitting
from reviewmill.operators.tfidf import term_counts
from reviewmill.plans import baselines, validation
from reviewmill.schema import LABELS, ROW_ID, SENTIMENT, TEXT


def plain_folds(rows, folds, seed=43):
    out = {}
    for label in {r[1] for r in rows}:
        members = sorted((hashlib.md5(f"{i}:{seed}".encode()).hexdigest(), i) for i, c in rows if c == label)
        cuts = [floor(len(members) * (k / folds) + 0.5) for k in range(1, folds)]
        out.update({i: sum(place > c for c in cuts) for place, (_, i) in enumerate(members, 1)})
    return out


@pytest.mark.parametrize("n,folds,prefix", [(3, 5, 4), (60, 2, 1), (997, 5, 1), (2000, 10, 4)])
def test_folds_equal_a_full_sort(spark, n, folds, prefix):
    df = labelled(spark, n)
    got = {r[ROW_ID]: r["fold"] for r in splitting.assign_folds(df, folds, prefix=prefix).collect()}
    assert got == plain_folds([(r[ROW_ID], r[SENTIMENT]) for r in df.collect()], folds)


def test_one_fold_is_refused(spark):
    with pytest.raises(ValueError):
        splitting.assign_folds(labelled(spark, 10), 1)


def reviews(make_reviews):
    """Every row has a word of its own, so each fold holds words that no other fold knows."""
    return corpus(make_reviews, 72).withColumn(TEXT, F.concat(TEXT, F.lit(" only"), F.col(ROW_ID).cast("string")))


def test_all_folds_at_once_equal_one_fit_per_fold(make_reviews):
    rows = validation.folded_rows(reviews(make_reviews), 3)
    got = {r[ROW_ID]: r for r in validation.cross_validated_bayes(rows, 3).collect()}
    assert len(got) == 72
    for j in range(3):
        train, held = (rows.where(c).drop("fold") for c in (F.col("fold") != j, F.col("fold") == j))
        want = baselines.fit_and_score(train, held, models=[baselines.BAYES]).collect()
        assert len(want) == 24
        for r in want:
            assert got[r[ROW_ID]]["fold"] == j
            assert got[r[ROW_ID]]["prediction"] == r["prediction"]
            assert got[r[ROW_ID]]["probability"] == pytest.approx(r["probability"])


def test_no_term_of_a_held_out_fold_enters_its_model(make_reviews):
    rows = validation.folded_rows(reviews(make_reviews), 3)
    counts = term_counts(rows, keep=[SENTIMENT, "fold"])
    vocabulary = {r["term"]: r for r in validation.fold_vocabulary(counts, [24, 24, 24]).collect()}
    fold_of = {r[ROW_ID]: r["fold"] for r in rows.collect()}
    for row_id, fold in fold_of.items():
        own = vocabulary[f"only{row_id}"]
        assert [own[f"idf_{j}"] is None for j in range(3)] == [j == fold for j in range(3)]
    # and a changed text of a held-out row changes nothing in the model that scores it
    changed = rows.withColumn("tokens", F.when(F.col("fold") == 1, F.array(F.lit("other"))).otherwise(F.col("tokens")))
    again = {r["term"]: r["idf_1"] for r in validation.fold_vocabulary(term_counts(changed, keep=[SENTIMENT, "fold"]), [24, 24, 24]).collect()}
    assert {t: r["idf_1"] for t, r in vocabulary.items() if r["idf_1"]} == {t: v for t, v in again.items() if v}


def test_class_absent_from_a_training_part(make_reviews):
    rows = validation.folded_rows(reviews(make_reviews), 2).withColumn("fold", (F.col(SENTIMENT) == "neutral").cast("int"))
    scored = validation.cross_validated_bayes(rows, 2).collect()
    assert {r["prediction"] for r in scored if r["fold"] == 1} <= {"negative", "positive"}
    assert all(r["probability"][1] == 0.0 for r in scored if r["fold"] == 1)


def test_summary(spark, make_reviews):
    rows = validation.folded_rows(reviews(make_reviews), 3)
    options = {"logistic": {"max_iter": 20}, "forest": {"trees": 5, "depth": 4}}
    predictions = validation.cross_validated(rows, baselines.MODELS, 3, **options)
    assert predictions.groupBy("model").count().where("count = 72").count() == 4
    scores = validation.fold_scores(predictions)
    means = {r["model"]: r for r in validation.cross_validation_summary(scores).collect()}
    assert means[baselines.MAJORITY]["mean"] == pytest.approx(2 / 9, abs=1e-6) and means[baselines.MAJORITY]["sigma"] == pytest.approx(0)
    assert means[baselines.LOGISTIC]["mean"] > 0.9 and set(LABELS) == {r[SENTIMENT] for r in predictions.select(SENTIMENT).distinct().collect()}


def test_ablation_configurations(make_reviews):
    rows = validation.folded_rows(reviews(make_reviews), 3)
    shared = validation.FoldedBayes(rows, 3)
    both = {r[ROW_ID]: r["probability"] for r in shared.predictions("both").collect()}
    assert both == {r[ROW_ID]: pytest.approx(r["probability"]) for r in validation.cross_validated_bayes(rows, 3).collect()}
    # the text block alone is a model without numeric columns, and the other way round
    text = validation.FoldedBayes(rows, 3, columns=()).predictions("text")
    assert {r[ROW_ID]: r["probability"] for r in shared.predictions("text", columns=()).collect()} == {
        r[ROW_ID]: pytest.approx(r["probability"]) for r in text.collect()
    }
    bare = rows.withColumn("tokens", F.array().cast("array<string>"))
    numbers = validation.FoldedBayes(bare, 3).predictions("numbers")
    assert {r[ROW_ID]: r["probability"] for r in shared.predictions("numbers", text=False).collect()} == {
        r[ROW_ID]: pytest.approx(r["probability"]) for r in numbers.collect()
    }
    table = {r["model"]: r for r in validation.ablation(rows, 3).collect()}
    assert set(table) == {n + t for n in validation.ABLATION for t in ("", ", thresholds")}
    assert table["text"]["mean"] > table["numbers"]["mean"]


def test_thresholds_of_a_fold_ignore_its_own_rows(make_reviews):
    rows = validation.folded_rows(reviews(make_reviews), 3)
    scored = validation.materialise(validation.cross_validated_bayes(rows, 3), "scored")
    other = F.when(F.col("fold") == 1, F.lit("neutral")).otherwise(F.col(SENTIMENT))
    changed = scored.withColumn(SENTIMENT, other)
    pick = lambda df: {r[ROW_ID]: r["prediction"] for r in validation.with_tuned_folds(df, 3).where("fold = 1").collect()}
    assert pick(scored) == pick(changed)


def test_terms_of_one_fold_are_not_scored_and_no_idf_is_written_by_entry(make_reviews):
    rows = validation.folded_rows(reviews(make_reviews), 3)
    shared = validation.FoldedBayes(rows, 3)
    assert not [c for c in shared.entries.columns if c.startswith("idf")]
    judged = {r["term"]: r["judged"] for r in shared.sums.collect()}
    fold_of = {r[ROW_ID]: r["fold"] for r in rows.collect()}
    assert fold_of and not any(judged[f"only{i}"] for i in fold_of) and judged["park"]
    unknown = shared.entries.where("not known").collect()
    assert {r["term"] for r in unknown} == {f"only{i}" for i in fold_of}


def test_repeated_rows_of_an_id_count_once_in_all_folds(make_reviews):
    rows = validation.folded_rows(reviews(make_reviews), 3)
    twice = rows.unionByName(rows.where(F.col(ROW_ID) % 7 == 0))
    plain, doubled = (validation.FoldedBayes(r, 3) for r in (rows, twice))
    dfs = [{r["term"]: r["df"] for r in shared.sums.collect()} for shared in (plain, doubled)]
    assert dfs[0] == dfs[1]


def test_rare_terms_with_a_least_frequency_equal_one_fit_per_fold(make_reviews):
    rows = validation.folded_rows(reviews(make_reviews), 3)
    got = {r[ROW_ID]: r for r in validation.cross_validated_bayes(rows, 3, min_df=12).collect()}
    for j in range(3):
        train, held = (rows.where(c).drop("fold") for c in (F.col("fold") != j, F.col("fold") == j))
        for r in baselines.fit_and_score(train, held, models=[baselines.BAYES], min_df=12).collect():
            assert got[r[ROW_ID]]["probability"] == pytest.approx(r["probability"])
