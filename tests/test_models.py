from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from reviewmill.operators import scaling, tfidf
from reviewmill.plans import baselines, features
from reviewmill.schema import LABELS, NUMERIC_FEATURES, RATING, ROW_ID, SENTIMENT, TEXT
from reviewmill.operators.cleaning import add_sentiment
from reviewmill.sources.workspace import file_bytes, materialise

WORDS = {1: "awful dirty queue", 3: "average fine okay", 5: "great magic lovely"}


def corpus(make_reviews, n=60, offset=0):
    rows = []
    for i in range(n):
        rating = (1, 3, 5, 5)[i % 4]
        rows.append({ROW_ID: offset + i, RATING: rating, TEXT: f"{WORDS[rating]} park day{i % 5} the the!" + "!" * (i % 3)})
    return add_sentiment(make_reviews(rows))


def by_hand(train_texts, texts):
    """TF-IDF from the formula."""
    import re

    tokens = [re.findall(r"\w{2,}", t.lower()) for t in train_texts]
    vocabulary = sorted({w for t in tokens for w in t})
    idf = {w: np.log((1 + len(tokens)) / (1 + sum(w in t for t in tokens))) + 1 for w in vocabulary}
    out = []
    for text in texts:
        counts = {}
        for w in re.findall(r"\w{2,}", text.lower()):
            if w in idf:
                counts[w] = counts.get(w, 0) + idf[w]
        norm = np.sqrt(sum(v * v for v in counts.values())) or 1.0
        out.append({w: v / norm for w, v in counts.items()})
    return vocabulary, out


def test_table_and_vector_forms_agree(spark, make_reviews):
    train, held = corpus(make_reviews), corpus(make_reviews, 8, 1000)
    held = held.withColumn(TEXT, F.concat(TEXT, F.lit(" unseen words")))
    model = features.fit_features(train)
    vocabulary, want = by_hand([r[TEXT] for r in train.collect()], [r[TEXT] for r in held.orderBy(ROW_ID).collect()])
    ids = [r[ROW_ID] for r in held.orderBy(ROW_ID).collect()]
    got = {}
    for r in model.tfidf.transform(held).collect():
        got.setdefault(r[ROW_ID], {})[r["term"]] = r["weight"]
    for row_id, weights in zip(ids, want):
        assert got[row_id] == pytest.approx(weights)

    vectoriser = model.vectoriser(train)
    assert sorted(vectoriser.terms) == vocabulary and vectoriser.size == len(vocabulary) + 10
    table = {}
    for r in model.matrix(held).collect():
        table.setdefault(r[ROW_ID], {})[r["feature"]] = r["value"]
    names = [f"term:{t}" for t in vectoriser.terms] + [f"number:{c}" for c in NUMERIC_FEATURES]
    for r in vectoriser.transform(held).select(ROW_ID, vector_to_array("features").alias("v")).collect():
        for name, value in zip(names, r["v"]):
            assert value == pytest.approx(table[r[ROW_ID]].get(name, 0.0), abs=1e-12)
    with pytest.raises(features.VocabularyTooLarge):
        model.vectoriser(train, max_terms=3)


def test_hashed_terms_need_no_vocabulary(make_reviews):
    train = corpus(make_reviews)
    model = features.fit_features(train)
    hashed = model.vectoriser(train, max_terms=3, hashed_terms=1 << 16)
    plain = model.vectoriser(train)
    assert hashed.size == (1 << 16) + len(NUMERIC_FEATURES)

    def values(vectoriser):
        rows = vectoriser.transform(train).select(ROW_ID, vector_to_array("features").alias("v")).collect()
        return {r[ROW_ID]: sorted(round(x, 9) for x in r["v"] if x) for r in rows}

    assert values(hashed) == values(plain)  # other places, the same weights: no two terms share one here


def test_min_df_is_the_same_in_both_forms(make_reviews):
    train = corpus(make_reviews)
    model = features.fit_features(train, min_df=13)
    terms = {r["term"] for r in model.tfidf.vocabulary.collect()}
    assert terms == set(model.vectoriser(train).terms) and "day1" not in terms


def test_state_depends_on_training_rows_only(make_reviews):
    train = corpus(make_reviews)
    model = features.fit_features(train)
    assert model.scaler == features.fit_features(train).scaler
    n_words = [len(r[TEXT].split()) for r in train.collect()]
    assert model.scaler.shift["n_words"] == pytest.approx(np.mean(n_words))
    assert model.scaler.scale["n_words"] == pytest.approx(np.std(n_words) or 1.0)  # population deviation
    assert model.weights == pytest.approx({"negative": 60 / 45, "neutral": 60 / 45, "positive": 60 / 90})
    constant = scaling.fit_standard(features.prepared_rows(train), ["n_question"])
    assert constant.scale["n_question"] == 1.0


def test_label_sources_are_not_features(make_reviews):
    prepared = features.prepared_rows(corpus(make_reviews))
    assert set(prepared.columns) == {ROW_ID, SENTIMENT, "tokens", *NUMERIC_FEATURES}
    assert not {"n_chars", "Rating", "Review_ID", "period", "Branch"} & set(prepared.columns)


def test_naive_bayes_matches_dense_arithmetic(make_reviews):
    train, held = corpus(make_reviews), corpus(make_reviews, 8, 1000)
    model = features.fit_features(train)
    unit = features.fit_unit_range(model, train)
    got = {r[ROW_ID]: r for r in features.fit_bayes(unit, train).score(unit.numbers(held)).collect()}

    def dense(df):
        table = unit.matrix(df).toPandas().pivot(index=ROW_ID, columns="feature", values="value").fillna(0.0)
        labels = df.select(ROW_ID, SENTIMENT).toPandas().set_index(ROW_ID).loc[table.index, SENTIMENT]
        return table, labels

    x, y = dense(train)
    assert x.min().min() >= 0 and x.max().max() <= 1 + 1e-12
    z, _ = dense(held)
    z = z.reindex(columns=x.columns, fill_value=0.0)
    mass = np.array([x[y == c].sum().to_numpy() + 1.0 for c in LABELS])
    log_p = np.log(mass / mass.sum(axis=1, keepdims=True))
    prior = np.log([np.mean(y == c) for c in LABELS])
    joint = z.to_numpy() @ log_p.T + prior
    chances = np.exp(joint - joint.max(axis=1, keepdims=True))
    chances /= chances.sum(axis=1, keepdims=True)
    for row_id, want in zip(z.index, chances):
        assert got[row_id]["probability"] == pytest.approx(want)
        assert got[row_id]["prediction"] == LABELS[int(np.argmax(want))]


def test_row_without_known_terms_is_scored(make_reviews):
    train = corpus(make_reviews)
    unit = features.fit_unit_range(features.fit_features(train), train)
    odd = add_sentiment(make_reviews([{ROW_ID: 1, TEXT: "zzz"}, {ROW_ID: 2, TEXT: ""}]))
    got = features.fit_bayes(unit, train).score(unit.numbers(odd)).collect()
    assert len(got) == 2 and all(sum(r["probability"]) == pytest.approx(1.0) for r in got)


def test_classifiers_learn_and_beat_the_majority(spark, make_reviews):
    silver = corpus(make_reviews, 120)
    half = F.when(F.col(ROW_ID) % 12 < 8, "train").otherwise("validation")
    splits = silver.select(ROW_ID, half.alias("split"), F.lit(42).alias("seed"))
    train, rows = (features.prepared_rows(silver.join(splits.where(F.col("split") == s).select(ROW_ID), ROW_ID)) for s in ("train", "validation"))
    model = features.fit_features(train)
    vectoriser = model.vectoriser(train)
    vectors = baselines.training_vectors(model, vectoriser, train)
    parts = [
        baselines.majority_predictions(train, rows),
        baselines.logistic_predictions(model, vectoriser, vectors, rows, max_iter=50),
        baselines.forest_predictions(vectoriser, vectors, rows, trees=20, depth=6),
        baselines.bayes_predictions(model, train, rows),
    ]
    predictions = parts[0]
    for part in parts[1:]:
        predictions = predictions.unionByName(part)
    board = {r["model"]: r for r in baselines.evaluate(predictions)["leaderboard"].collect()}
    assert board[baselines.MAJORITY]["auc_roc"] == 0.5
    for name in (baselines.LOGISTIC, baselines.FOREST, baselines.BAYES):
        assert board[name]["macro_f1"] > board[baselines.MAJORITY]["macro_f1"]
        assert board[name]["auc_roc"] > 0.9
    with pytest.raises(ValueError):
        baselines.train_and_predict(silver, splits, "train")


def test_table_models_and_the_reduced_forest_learn(make_reviews):
    silver = corpus(make_reviews, 96)
    train, rows = (materialise(features.prepared_rows(silver.where(c)), "part") for c in (F.col(ROW_ID) % 12 < 8, F.col(ROW_ID) % 12 >= 8))
    chosen = [baselines.MAJORITY, baselines.LOGISTIC, baselines.TABLE_LOGISTIC, baselines.SVC, baselines.SVD_FOREST]
    options = {"svd_forest": {"components": 6, "trees": 20, "depth": 6}, "linear": {"tolerance": 1e-4}}
    predictions = materialise(baselines.fit_and_score(train, rows, models=chosen, **options), "predictions")
    assert {r["model"]: r["count"] for r in predictions.groupBy("model").count().collect()} == {m: 32 for m in chosen}
    board = {r["model"]: r for r in baselines.evaluate(predictions)["leaderboard"].collect()}
    for name in chosen[1:]:
        assert board[name]["macro_f1"] > board[baselines.MAJORITY]["macro_f1"] + 0.4
    assert board[baselines.SVC]["auc_roc"] is None and board[baselines.TABLE_LOGISTIC]["auc_roc"] > 0.9
    both = predictions.where(F.col("model").isin(baselines.LOGISTIC, baselines.TABLE_LOGISTIC)).groupBy(ROW_ID).agg(F.collect_set("prediction").alias("p"))
    assert both.where(F.size("p") > 1).count() == 0


def test_majority_tie_goes_to_the_lesser_label(spark):
    df = spark.createDataFrame([("positive",), ("neutral",), (None,), (None,)], "sentiment string")
    assert baselines.majority_class(df).first()["prediction"] == "neutral"


def test_document_frequency_counts_documents(make_reviews):
    df = make_reviews([{TEXT: "dog dog dog"}, {TEXT: "dog cat"}, {TEXT: None}])
    assert {r["term"]: r["df"] for r in tfidf.document_frequencies(df).collect()} == {"dog": 2, "cat": 1}


def test_vectors_of_any_vocabulary_need_no_terms_on_the_driver(make_reviews):
    train, held = corpus(make_reviews), corpus(make_reviews, 8, 1000)
    odd = add_sentiment(make_reviews([{ROW_ID: 2000, TEXT: "zzz"}]))
    rows = held.unionByName(odd).withColumn(TEXT, F.concat(TEXT, F.lit(" unseen")))
    model = features.fit_features(train)
    plain, table = model.vectoriser(train), model.table_vectoriser()
    assert table.size == plain.size and not hasattr(table, "terms")
    places = sorted(r["place"] for r in table.names().collect())
    assert places == list(range(table.size))

    def entries(vectoriser):
        found = features.vector_entries(vectoriser.transform(rows), vectoriser).collect()
        return {(r[ROW_ID], r["feature"]): r["value"] for r in found}

    assert entries(table) == pytest.approx(entries(plain))


def test_logistic_by_term_needs_no_vectors(make_reviews, monkeypatch):
    silver = corpus(make_reviews, 48)
    train, rows = (materialise(features.prepared_rows(silver.where(c)), "part") for c in (F.col(ROW_ID) % 12 < 8, F.col(ROW_ID) % 12 >= 8))
    monkeypatch.setattr(features.FeatureModel, "vectoriser", lambda *_, **__: pytest.fail("the vocabulary went to the driver"))
    scored = baselines.fit_and_score(train, rows, models=[baselines.LOGISTIC], logistic={"max_iter": 8}).collect()
    assert len(scored) == 16 and {r["model"] for r in scored} == {baselines.LOGISTIC}
    assert all(sum(r["probability"]) == pytest.approx(1.0) for r in scored)


def test_frequent_terms_are_not_shuffled_to_the_vocabulary(spark, make_reviews):
    train = materialise(features.prepared_rows(corpus(make_reviews)), "train")
    twice = train.unionByName(train.where(F.col(ROW_ID) < 5))  # rows of one id count as one
    model = tfidf.fit_tfidf(train)
    above = tfidf.frequent_above(model.vocabulary, 4)
    frequent = model.vocabulary.where(F.col("df") > above).count()
    assert 0 < frequent <= 4 and tfidf.frequent_above(model.vocabulary, 1000) == 0
    split = tfidf.TfidfModel(model.vocabulary, model.documents, above=above)

    def weights(model):
        return {(r[ROW_ID], r["term"]): r["weight"] for r in model.transform(twice).collect()}

    plain = tfidf.term_counts(twice).join(model.vocabulary, "term").groupBy(ROW_ID).agg(F.sum((F.col("tf") * F.col("idf")) ** 2).alias("square"))
    norm = {r[ROW_ID]: r["square"] ** 0.5 for r in plain.collect()}
    want = {(r[ROW_ID], r["term"]): r["tf"] * r["idf"] / norm[r[ROW_ID]] for r in tfidf.term_counts(twice).join(model.vocabulary, "term").collect()}
    assert weights(split) == pytest.approx(want) and weights(model) == pytest.approx(want)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = split.transform(train)._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan
    assert "Window" in plan.split("Union")[0] and "Exchange" not in plan.split("Union")[0]  # rows are together before


def test_partitions_by_row_follow_the_files(make_reviews, monkeypatch):
    train = materialise(features.prepared_rows(corpus(make_reviews)), "train")
    model = tfidf.fit_tfidf(train)
    want = {(r[ROW_ID], r["term"]): r["weight"] for r in model.transform(train).collect()}
    monkeypatch.setattr(tfidf, "ROW_BYTES", 1 + file_bytes(train) // 23)
    found = model.transform(train)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert f"hashpartitioning({ROW_ID}" in plan and "), 23), REPARTITION_BY_NUM" in plan.replace("L, 23)", "), 23)")
    assert "Exchange" not in plan.split("Window")[1].split("Union")[0]  # rows stay together
    assert {(r[ROW_ID], r["term"]): r["weight"] for r in found.collect()} == pytest.approx(want)


def test_tokens_are_written_and_moved_as_one_string(spark, make_reviews):
    odd = add_sentiment(make_reviews([{ROW_ID: 900, TEXT: None}, {ROW_ID: 901, TEXT: "! a"}, {ROW_ID: 902, TEXT: "été ab_1 ab_1"}]))
    rows = features.prepared_rows(corpus(make_reviews).unionByName(odd))
    stored = tfidf.write_rows(rows, "rows")
    written = spark.read.parquet(stored.inputFiles()[0].rsplit("/", 1)[0])
    assert dict(written.dtypes)["tokens"] == "string" and stored.dtypes == rows.dtypes
    tokens = {r[ROW_ID]: r["tokens"] for r in stored.collect()}
    assert tokens == {r[ROW_ID]: r["tokens"] for r in rows.collect()} and tokens[900] == tokens[901] == []
    below = tfidf.term_counts(stored)._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning")[1]
    assert "array_join" in below
    assert {(r["term"], r["tf"]) for r in tfidf.term_counts(stored).where(f"{ROW_ID} >= 900").collect()} == {("été", 1), ("ab_1", 2)}


def test_tokens_of_a_caller_may_hold_anything(spark):
    rows = spark.createDataFrame([(1, ["a b", "a b", f"c{tfidf.SEPARATOR}d", ""]), (2, [])], f"{ROW_ID} long, tokens array<string>")
    want = {(1, "a b", 2), (1, f"c{tfidf.SEPARATOR}d", 1), (1, "", 1)}
    for table in (rows, tfidf.write_rows(rows, "rows")):
        assert {tuple(r) for r in tfidf.term_counts(table).collect()} == want


def test_terms_of_a_row_move_only_if_its_id_repeats(make_reviews):
    rows = tfidf.write_rows(features.prepared_rows(corpus(make_reviews)), "rows")
    plain = tfidf.row_terms(rows, keep=[SENTIMENT])
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    twice = rows.unionByName(rows.where(F.col(ROW_ID) < 5))
    want = sorted(map(tuple, tfidf.term_counts(rows, keep=[SENTIMENT]).drop("tf").collect()))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, tfidf.row_terms(twice, keep=[SENTIMENT]).collect())) == want
