"""Every operator as a query over the given tables: ``name -> callable(spark, folder)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions import text as tx
from reviewmill.functions.labels import month_index
from reviewmill.functions.numeric import half_even
from reviewmill.operators import (
    bootstrap,
    cleaning,
    contract,
    correlation,
    distribution,
    groups,
    metrics,
    naive_bayes,
    ngrams,
    profiling,
    quality,
    scaling,
    splitting,
    svd,
    temporal,
    tfidf,
    thresholds,
)
from reviewmill.operators.blockmatrix import block_matrix
from reviewmill.plans import baselines, features, reports, validation
from reviewmill.schema import (
    BRANCH,
    LABELS,
    NUMERIC_FEATURES,
    PERIOD,
    RATING,
    REVIEW_COLUMNS,
    REVIEW_ID,
    ROW_ID,
    SENTIMENT,
    SPLIT,
    TEXT,
    YEAR_MONTH,
)
from reviewmill.sources import files, layers, reviews_csv
from reviewmill.sources.driver_tables import reviews_from_documents
from reviewmill.sources.workspace import fresh_path, materialise, spread_small_scan

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

PLAIN = [c for c in (ROW_ID, *REVIEW_COLUMNS) if c != TEXT]


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        REGISTRY[name] = function
        return function

    return register


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    return reviews_from_documents(spark, folder)


def analysed(spark: SparkSession, folder: str) -> DataFrame:
    """Raw reviews with text metrics, label and month; unused columns are pruned by Catalyst."""
    return cleaning.add_sentiment(cleaning.add_period(tx.add_text_metrics(reviews(spark, folder))))


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.add_sentiment(cleaning.add_period(reviews(spark, folder)))


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round columns that the operators return unrounded, so that two engines can be compared."""
    return df.withColumns({c: half_even(F.col(c), digits) for c in columns})


# --- scans, sinks and layers -------------------------------------------------------------------


def csv_copy(spark: SparkSession, folder: str) -> str:
    path = fresh_path(spark, "bronze-csv")
    # a file cannot tell an empty text from an absent one
    reviews_csv.write_reviews_csv(reviews_from_documents(spark, folder, odd_rows=False), path)
    return path


@query("s1_scan_csv")
def _(spark, folder):
    return reviews_csv.scan_reviews(spark, csv_copy(spark, folder)).select(*REVIEW_COLUMNS)


@query("s2_largest_csv")
def _(spark, folder):
    found = reviews_csv.largest_csv(spark, csv_copy(spark, folder))
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "length")


@query("s3_contract")
def _(spark, folder):
    rows = reviews(spark, folder)
    contract.check_contract(rows, ratings=False)
    return contract.rating_violations(rows)


@query("s4_file_inventory")
def _(spark, folder):
    found = files.file_inventory(spark, folder)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "length", "md5", "sha256", "verified")


@query("s4_text_digests")
def _(spark, folder):
    rows = reviews(spark, folder)
    return rows.select(ROW_ID, F.md5(TEXT).alias("md5"), cleaning.text_digest().alias("sha256"))


@query("s5_write_silver")
def _(spark, folder):
    path = fresh_path(spark, "silver")
    layers.build_silver(reviews(spark, folder), path)
    return spark.read.parquet(path)


@query("s6_load_silver")
def _(spark, folder):
    path = fresh_path(spark, "silver")
    silver = layers.load_silver(spark, path, raw=lambda: reviews(spark, folder))
    return silver.select(ROW_ID, REVIEW_ID, PERIOD, SENTIMENT)


def gold(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Silver and its saved split, built as a user would build them."""
    silver_path, gold_path = fresh_path(spark, "silver"), fresh_path(spark, "gold")
    silver = layers.build_splits(spark, silver_path, gold_path, raw=lambda: reviews(spark, folder))
    return layers.with_saved_splits(silver, gold_path), layers.load_splits(spark, gold_path)


@query("s7_save_splits")
def _(spark, folder):
    return gold(spark, folder)[1].groupBy(SPLIT, "seed").agg(F.count(F.lit(1)).alias("rows"))


@query("s8_load_splits")
def _(spark, folder):
    return gold(spark, folder)[1]


@query("s9_build_splits_once")
def _(spark, folder):
    silver_path, gold_path = fresh_path(spark, "silver"), fresh_path(spark, "gold")
    for seed in (42, 7):  # the second call finds both layers and must not draw again
        layers.build_splits(spark, silver_path, gold_path, seed=seed, raw=lambda: reviews(spark, folder))
    return layers.load_splits(spark, gold_path)


@query("s10_subset")
def _(spark, folder):
    silver, splits = gold(spark, folder)
    return layers.split_rows(silver.drop(SPLIT), splits, "validation").select(ROW_ID, REVIEW_ID, SENTIMENT, TEXT)


@query("s11_export_overwrite")
def _(spark, folder):
    path = csv_copy(spark, folder)
    rows = reviews_from_documents(spark, folder, odd_rows=False)
    reviews_csv.write_reviews_csv(rows, path, overwrite=True)
    return reviews_csv.scan_reviews(spark, path).select(*REVIEW_COLUMNS)


# --- cleaning ----------------------------------------------------------------------------------


@query("c1_drop_full_duplicates")
def _(spark, folder):
    return cleaning.drop_full_duplicates(reviews(spark, folder))


@query("c2_drop_duplicate_texts")
def _(spark, folder):
    return cleaning.drop_duplicate_texts(reviews(spark, folder))


@query("c3_period")
def _(spark, folder):
    return cleaning.add_period(reviews(spark, folder)).select(ROW_ID, YEAR_MONTH, PERIOD)


@query("c4_sentiment_three_class")
def _(spark, folder):
    return cleaning.add_sentiment(reviews(spark, folder)).select(ROW_ID, RATING, SENTIMENT)


@query("c5_sentiment_binary")
def _(spark, folder):
    return cleaning.add_sentiment(reviews(spark, folder), "binary").select(ROW_ID, RATING, SENTIMENT)


@query("c6_unknown_scheme")
def _(spark, folder):
    rows = reviews(spark, folder)
    try:
        cleaning.add_sentiment(rows, "five_class")
    except ValueError as error:
        return rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("error", F.lit(type(error).__name__))
    raise AssertionError("an unknown scheme must be an error")


@query("c7_drop_unusable")
def _(spark, folder):
    return cleaning.drop_unusable(labelled(spark, folder)).select(*PLAIN, SENTIMENT)


@query("c9_clean")
def _(spark, folder):
    return cleaning.clean_reviews(reviews(spark, folder))


@query("c10_funnel")
def _(spark, folder):
    return cleaning.cleaning_funnel(reviews(spark, folder))


@query("c11_drop_target")
def _(spark, folder):
    return labelled(spark, folder).drop(SENTIMENT, TEXT)


@query("c13_class_filter")
def _(spark, folder):
    return cleaning.with_sentiment(labelled(spark, folder), "negative").select(*PLAIN, SENTIMENT)


@query("c14_dated_rows")
def _(spark, folder):
    return cleaning.with_period(labelled(spark, folder)).select(ROW_ID, PERIOD)


@query("c15_preview")
def _(spark, folder):
    return cleaning.preview(reviews(spark, folder))


# --- text metrics ------------------------------------------------------------------------------

METRIC_IDS = {
    "t1": "n_chars",
    "t2": "n_words",
    "t3": "n_sentences",
    "t4": "n_tokens",
    "t5": "n_unique_words",
    "t6": "unique_ratio",
    "t7": "mean_word_len",
    "t8": "n_upper",
    "t9": "caps_ratio",
    "t10": "n_exclaim",
    "t11": "n_question",
    "t12": "has_url",
    "t13": "has_emoji",
}


def _metric_query(metric: str) -> Query:
    return lambda spark, folder: tx.add_text_metrics(reviews(spark, folder)).select(ROW_ID, metric)


for _id, _metric in METRIC_IDS.items():
    REGISTRY[f"{_id}_{_metric}"] = _metric_query(_metric)


@query("t_all_text_metrics")
def _(spark, folder):
    return tx.add_text_metrics(reviews(spark, folder)).select(ROW_ID, *tx.TEXT_METRICS)


@query("t14_non_ascii")
def _(spark, folder):
    return reviews(spark, folder).select(ROW_ID, tx.contains_pattern(F.col(TEXT), tx.NON_ASCII).alias("non_ascii"))


@query("t15_model_text")
def _(spark, folder):
    return reviews(spark, folder).select(ROW_ID, tx.model_text(F.col(TEXT)).alias("normalised"))


@query("t16_frequency_text")
def _(spark, folder):
    return reviews(spark, folder).select(ROW_ID, tx.frequency_text(F.col(TEXT)).alias("normalised"))


@query("t17_model_tokens")
def _(spark, folder):
    tokens = tx.model_tokens(F.col(TEXT))
    return reviews(spark, folder).select(ROW_ID, F.posexplode(tokens).alias("position", "token"))


@query("t18_whitespace_split")
def _(spark, folder):
    words = tx.whitespace_split(tx.frequency_text(F.col(TEXT)))
    return reviews(spark, folder).select(ROW_ID, F.posexplode(words).alias("position", "word"))


@query("t19_strip_prefix")
def _(spark, folder):
    return reviews(spark, folder).select(ROW_ID, tx.strip_prefix(F.col(BRANCH), "park_").alias("branch"))


@query("t20_clip")
def _(spark, folder):
    return analysed(spark, folder).select(ROW_ID, F.least("n_words", F.lit(600)).alias("n_words_clipped"))


@query("t21_date_parts")
def _(spark, folder):
    dated = cleaning.with_period(labelled(spark, folder))
    return dated.select(
        ROW_ID, F.year(PERIOD).alias("year"), F.month(PERIOD).alias("month"), month_index(F.col(PERIOD)).alias("month_index")
    )


@query("t22_half_even")
def _(spark, folder):
    rows = reviews(spark, folder)
    eighths = F.col(REVIEW_ID) / F.lit(8.0)
    return rows.select(ROW_ID, half_even(eighths, 2).alias("two"), half_even(eighths, 0).alias("whole"))


# --- profiling ---------------------------------------------------------------------------------


@query("p1_column_inventory")
def _(spark, folder):
    return profiling.column_inventory(reviews(spark, folder))


@query("p1_approximate_inventory")
def _(spark, folder):
    """Two loads with a stored sketch each, merged; estimates are compared with exact counts by their error."""
    rows = reviews(spark, folder)
    loads = [profiling.column_sketches(rows.where(c)) for c in (F.col(REVIEW_ID) % 2 == 0, F.col(REVIEW_ID) % 2 == 1)]
    stored = materialise(loads[0].unionByName(loads[1]), "column-sketches")
    found = profiling.approximate_inventory(profiling.merged_sketches(stored))
    exact = profiling.column_inventory(rows).select("column", F.col("unique").alias("exact"))
    close = F.abs(F.col("unique") - F.col("exact")) <= F.lit(3 * profiling.SKETCH_ERROR) * F.col("exact")
    return found.join(exact, "column").select("column", "dtype", "nulls", "pct_null", "exact", close.alias("within_three_errors"))


ISSUE_IDS = dict(zip((f"p{i}" for i in range(2, 16)), quality.ISSUES))
ISSUE_NAMES = {
    "p2": "null_cells",
    "p3": "full_duplicates",
    "p4": "duplicate_ids",
    "p5": "duplicate_texts",
    "p6": "empty_texts",
    "p7": "short_texts",
    "p8": "long_texts",
    "p9": "symbols_only",
    "p10": "contains_url",
    "p11": "contains_emoji",
    "p12": "non_ascii",
    "p13": "bad_ratings",
    "p14": "missing_periods",
    "p15": "bad_periods",
}


def _issue_query(issue: str) -> Query:
    return lambda spark, folder: quality.quality_counts(reviews(spark, folder), (issue,)).select("issue", "count")


for _id, _issue in ISSUE_IDS.items():
    REGISTRY[f"{_id}_{ISSUE_NAMES[_id]}"] = _issue_query(_issue)


@query("p16_quality_report")
def _(spark, folder):
    return quality.quality_report(reviews(spark, folder))


@query("p17_corpus_summary")
def _(spark, folder):
    return profiling.corpus_summary(reviews(spark, folder))


@query("p18_describe_numbers")
def _(spark, folder):
    return distribution.describe_numbers(reviews(spark, folder), [REVIEW_ID, RATING])


@query("p19_describe_categories")
def _(spark, folder):
    return profiling.describe_categories(reviews(spark, folder), [YEAR_MONTH, "Reviewer_Location", BRANCH])


@query("p20_rating_statistics")
def _(spark, folder):
    return profiling.rating_statistics(reviews(spark, folder))


@query("p21_rating_distribution")
def _(spark, folder):
    return profiling.rating_distribution(reviews(spark, folder))


@query("p22_class_balance")
def _(spark, folder):
    return profiling.class_balance(labelled(spark, folder), SENTIMENT)


@query("p22_class_balance_binary")
def _(spark, folder):
    return profiling.class_balance(cleaning.add_sentiment(reviews(spark, folder), "binary"), SENTIMENT)


@query("p23_feature_ranges")
def _(spark, folder):
    clean = cleaning.clean_reviews(reviews(spark, folder))
    return profiling.feature_ranges(tx.add_text_metrics(clean), reports.RANGE_METRICS)


DESCRIBED = ["n_chars", "n_words", "n_sentences", "n_unique_words", "unique_ratio", "mean_word_len", "caps_ratio", "n_exclaim"]


@query("p24_describe_text_metrics")
def _(spark, folder):
    return distribution.describe_numbers(analysed(spark, folder), DESCRIBED)


@query("p25_spam_flags")
def _(spark, folder):
    return profiling.spam_flags(analysed(spark, folder))


@query("p26_vocabulary_size")
def _(spark, folder):
    return profiling.vocabulary_size(reviews(spark, folder))


@query("p27_iqr_outliers")
def _(spark, folder):
    return distribution.iqr_outliers(analysed(spark, folder), ["n_words", "n_chars", "n_sentences"])


@query("p28_column_types")
def _(spark, folder):
    return profiling.column_types(analysed(spark, folder))


@query("p29_corpus_report")
def _(spark, folder):
    out = None
    for name, table in reports.corpus_report(reviews(spark, folder), bronze_folder=folder).items():
        lines = table.select(F.lit(name).alias("section"), F.to_json(F.struct(*table.columns)).alias("line"))
        out = lines if out is None else out.unionByName(lines)
    return out


@query("p30_split_summary")
def _(spark, folder):
    silver, splits = gold(spark, folder)
    return splitting.split_summary(layers.all_split_rows(silver, splits))


# --- groups, time, distributions -----------------------------------------------------------------


@query("g1_branch_report")
def _(spark, folder):
    return groups.branch_report(analysed(spark, folder))


@query("g2_mean_rating_by_branch")
def _(spark, folder):
    return rounded(groups.mean_rating_by_branch(reviews(spark, folder), "park_"), 6, "mean")


@query("g3_sentiment_by_branch")
def _(spark, folder):
    return rounded(groups.sentiment_by_branch(labelled(spark, folder)), 6, *LABELS)


@query("g4_sentiment_distribution")
def _(spark, folder):
    return rounded(groups.sentiment_distribution(labelled(spark, folder)), 6, "pct")


@query("g5_monthly_volume")
def _(spark, folder):
    return groups.monthly_volume(labelled(spark, folder))


@query("g6_monthly_rating")
def _(spark, folder):
    return rounded(groups.monthly_rating(labelled(spark, folder)), 6, "mean_rating")


@query("g6_monthly_rating_from_8")
def _(spark, folder):
    return rounded(groups.monthly_rating(labelled(spark, folder), 8), 6, "mean_rating")


@query("g7_yearly_report")
def _(spark, folder):
    return groups.yearly_report(labelled(spark, folder))


@query("g8_period_range")
def _(spark, folder):
    return groups.period_range(labelled(spark, folder))


@query("g9_length_histogram")
def _(spark, folder):
    return rounded(distribution.clipped_histogram(analysed(spark, folder), "n_words"), 6, "lower", "upper")


@query("g10_length_boxes")
def _(spark, folder):
    return distribution.box_statistics(analysed(spark, folder), "n_words", RATING)


@query("g11_median_words_by_rating")
def _(spark, folder):
    return groups.median_words_by_rating(analysed(spark, folder))


# --- correlation -----------------------------------------------------------------------------------

MATRIX_COLUMNS = [RATING, "n_words", "n_chars", "n_sentences", "unique_ratio", "caps_ratio"]


@query("r1_leakage_checks")
def _(spark, folder):
    rows = analysed(spark, folder).withColumn("time_index", month_index(F.col(PERIOD)))
    pairs = [(REVIEW_ID, "time_index"), (REVIEW_ID, RATING), ("n_words", RATING), ("n_chars", "n_words")]
    return rounded(correlation.spearman_pairs(rows, pairs), 4, "rho")


@query("r2_spearman_matrix")
def _(spark, folder):
    matrix = correlation.spearman_matrix(analysed(spark, folder), MATRIX_COLUMNS)
    return rounded(matrix, 6, "rho")


# --- n-grams -----------------------------------------------------------------------------------------

# A short list that keeps negations, to exercise a caller's own stop words.
OWN_STOP_WORDS = ["the", "and", "of", "to", "in", "is", "was", "la", "le", "de", "der", "die", "el"]


@query("n1_top_unigrams")
def _(spark, folder):
    return ngrams.top_ngrams(reviews(spark, folder), (1, 1), 15)


@query("n2_top_bigrams")
def _(spark, folder):
    return ngrams.top_ngrams(reviews(spark, folder), (2, 2), 15)


@query("n3_ngram_range")
def _(spark, folder):
    return ngrams.ngram_counts(reviews(spark, folder), (1, 3), None)


@query("n4_top_bigrams_by_class")
def _(spark, folder):
    return ngrams.top_ngrams_by(labelled(spark, folder), SENTIMENT)


@query("n5_own_stop_words")
def _(spark, folder):
    return ngrams.top_ngrams(reviews(spark, folder), (1, 2), 20, OWN_STOP_WORDS)


# --- split -------------------------------------------------------------------------------------------


def silver_keys(spark: SparkSession, folder: str) -> DataFrame:
    return materialise(cleaning.clean_reviews(reviews(spark, folder)).select(ROW_ID, SENTIMENT), "silver-keys")


@query("l1_stratified_split")
def _(spark, folder):
    return splitting.assign_splits(silver_keys(spark, folder))


@query("l3_temporal_split")
def _(spark, folder):
    rows = cleaning.clean_reviews(reviews(spark, folder)).select(ROW_ID, REVIEW_ID, PERIOD, SENTIMENT)
    return temporal.temporal_split(materialise(rows, "silver-order"))


@query("l2_features_and_target")
def _(spark, folder):
    silver, splits = gold(spark, folder)
    parts = splitting.features_and_target(layers.all_split_rows(silver, splits))
    out = None
    for name, (inputs, target) in parts.items():
        both = inputs.select(ROW_ID, REVIEW_ID, YEAR_MONTH).join(target, ROW_ID).withColumn("part", F.lit(name))
        out = both if out is None else out.unionByName(both)
    return out


# --- learned features --------------------------------------------------------------------------------


def parts(spark: SparkSession, folder: str, split: str = "validation") -> tuple[DataFrame, DataFrame]:
    """Prepared training and held-out rows as written tables."""
    silver, splits = gold(spark, folder)

    def prepared(name: str) -> DataFrame:
        rows = features.prepared_rows(layers.split_rows(silver, splits, name))
        return spread_small_scan(tfidf.write_rows(rows, name), ROW_ID)

    return prepared("train"), prepared(split)


@query("f1_tfidf_vocabulary")
def _(spark, folder):
    train, _ = parts(spark, folder)
    return rounded(tfidf.fit_tfidf(train).vocabulary, 6, "idf")


@query("f2_tfidf_weights")
def _(spark, folder):
    train, held = parts(spark, folder)
    return rounded(tfidf.fit_tfidf(train).transform(held), 6, "weight")


@query("f3_standard_scaler")
def _(spark, folder):
    train, held = parts(spark, folder)
    scaled = scaling.fit_standard(train).transform(held).select(ROW_ID, *NUMERIC_FEATURES)
    return rounded(scaled, 6, *NUMERIC_FEATURES)


@query("f4_feature_matrix")
def _(spark, folder):
    train, held = parts(spark, folder)
    return rounded(features.fit_features(train).matrix(held), 6, "value")


@query("f5_class_weights")
def _(spark, folder):
    train, _ = parts(spark, folder)
    return rounded(scaling.class_weights(train), 6, "weight")


@query("f6_feature_vectors")
def _(spark, folder):
    """The entries of the vectors that an estimator reads, by the name of their place."""
    train, held = parts(spark, folder)
    vectoriser = features.fit_features(train).table_vectoriser()
    stored = materialise(vectoriser.transform(held), "vectors")
    return rounded(features.vector_entries(stored, vectoriser), 6, "value").where("value <> 0")


@query("f7_max_abs")
def _(spark, folder):
    train, held = parts(spark, folder)
    model = tfidf.fit_tfidf(train)
    scales = materialise(tfidf.max_abs_scales(model.transform(train)), "scales")
    return rounded(tfidf.apply_max_abs(model.transform(held), scales), 6, "weight")


@query("f8_min_max")
def _(spark, folder):
    train, held = parts(spark, folder)
    standard = scaling.fit_standard(train)
    unit = scaling.fit_min_max(standard.transform(train))
    scaled = unit.transform(standard.transform(held)).select(ROW_ID, *NUMERIC_FEATURES)
    return rounded(scaled, 6, *NUMERIC_FEATURES)


@query("f9_unit_range_matrix")
def _(spark, folder):
    train, held = parts(spark, folder)
    unit_range = features.fit_unit_range(features.fit_features(train), train)
    return rounded(unit_range.matrix(held), 6, "value")


@query("f10_feature_exclusion")
def _(spark, folder):
    train, held = parts(spark, folder)
    matrix = features.fit_features(train).matrix(held).where(F.col("feature").startswith("number:"))
    return matrix.groupBy("feature").agg(F.count(F.lit(1)).alias("rows"))


# --- models ------------------------------------------------------------------------------------------


@query("m1_majority")
def _(spark, folder):
    train, held = parts(spark, folder)
    return baselines.majority_predictions(train, held).select(ROW_ID, SENTIMENT, "prediction")


def model_scores(spark: SparkSession, folder: str, model: str) -> DataFrame:
    silver, splits = gold(spark, folder)
    predictions = baselines.train_and_predict(silver, splits, models=[model])
    return predictions.select(ROW_ID, SENTIMENT, "prediction", "probability")


@query("m2_logistic_regression")
def _(spark, folder):
    return model_scores(spark, folder, baselines.LOGISTIC)


@query("m3_random_forest")
def _(spark, folder):
    return model_scores(spark, folder, baselines.FOREST)


@query("m4_naive_bayes")
def _(spark, folder):
    scored = model_scores(spark, folder, baselines.BAYES)
    chances = {f"p_{c}": half_even(F.col("probability")[i], 6) for i, c in enumerate(LABELS)}
    return scored.select(ROW_ID, SENTIMENT, "prediction", *[v.alias(k) for k, v in chances.items()])


@query("m4_naive_bayes_test_split")
def _(spark, folder):
    silver, splits = gold(spark, folder)
    predictions = baselines.train_and_predict(silver, splits, "test", models=[baselines.BAYES])
    return predictions.select(ROW_ID, SENTIMENT, "prediction")


@query("m5_feature_splits")
def _(spark, folder):
    model, rows = features.feature_splits(*gold(spark, folder))
    out = None
    for name, part in rows.items():
        entries = model.matrix(part).groupBy(ROW_ID).agg(F.count(F.lit(1)).alias("entries"))
        entries = entries.withColumn("split", F.lit(name))
        out = entries if out is None else out.unionByName(entries)
    return out


@query("m6_train_and_evaluate")
def _(spark, folder):
    """All four baselines, ranked; two of them are iterative, so there is no SQL."""
    predictions = baselines.train_and_predict(*gold(spark, folder))
    return rounded(baselines.evaluate(predictions)["leaderboard"], 6, "accuracy", "auc_roc", "macro_f1")


@query("m6_closed_form_board")
def _(spark, folder):
    """The board of the two baselines that SQL can state."""
    silver, splits = gold(spark, folder)
    chosen = [baselines.MAJORITY, baselines.BAYES]
    predictions = baselines.train_and_predict(silver, splits, models=chosen)
    return rounded(baselines.evaluate(predictions)["leaderboard"], 6, "accuracy", "auc_roc", "macro_f1")


@query("m6_all_models")
def _(spark, folder):
    """All four baselines and the linear SVC, ranked."""
    chosen = [baselines.MAJORITY, baselines.TABLE_LOGISTIC, baselines.FOREST, baselines.BAYES, baselines.SVC]
    predictions = baselines.train_and_predict(*gold(spark, folder), models=chosen, linear={"tolerance": 1e-4})
    return rounded(baselines.evaluate(predictions)["leaderboard"], 6, "accuracy", "auc_roc", "macro_f1")


@query("m2_table_logistic")
def _(spark, folder):
    """Coefficients of the numbers and of every term, each with its label."""
    train, _ = parts(spark, folder)
    fitted = features.fit_features(train)
    entries = materialise(fitted.matrix(train), "entries")
    matrix = block_matrix(entries, row=ROW_ID, column="feature", value="value")
    return baselines.train_table_logistic(fitted, matrix, train, tolerance=1e-4).table()


@query("m9_truncated_svd")
def _(spark, folder):
    """Singular values of the TF-IDF matrix of the training rows, and how well each pair of vectors fits."""
    train, _ = parts(spark, folder)
    entries = materialise(tfidf.fit_tfidf(train).transform(train), "text-entries")
    matrix = block_matrix(entries, row=ROW_ID, column="term", value="weight")
    return svd.fit_svd(matrix, 50).checks()


@query("m9_svd_forest")
def _(spark, folder):
    return model_scores(spark, folder, baselines.SVD_FOREST)


# --- cross-validation --------------------------------------------------------------------------------


def folded(spark: SparkSession, folder: str) -> DataFrame:
    """Training rows with their fold."""
    return validation.folded_rows(layers.split_rows(*gold(spark, folder), "train"))


@query("l4_stratified_folds")
def _(spark, folder):
    return splitting.assign_folds(silver_keys(spark, folder), validation.FOLDS)


@query("m7_fold_scores")
def _(spark, folder):
    scores = validation.fold_scores(validation.cross_validated(folded(spark, folder), [baselines.BAYES]))
    return rounded(scores, 6, "accuracy", "macro_f1")


@query("m7_cross_validation")
def _(spark, folder):
    chosen = [baselines.MAJORITY, baselines.BAYES]
    scores = validation.fold_scores(validation.cross_validated(folded(spark, folder), chosen))
    return rounded(validation.cross_validation_summary(scores), 6, "mean", "sigma")


@query("m8_ablation")
def _(spark, folder):
    return rounded(validation.ablation(folded(spark, folder)), 6, "mean", "sigma")


# --- metrics -----------------------------------------------------------------------------------------


def rule_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Three rules that score every review from its own columns, so that two engines agree on
    predictions and on tied scores; the third rule gives no probabilities."""
    rows = cleaning.drop_unusable(analysed(spark, folder)).select(
        ROW_ID, SENTIMENT, F.col("n_words").cast("long").alias("w"), F.col("n_chars").cast("long").alias("c"), REVIEW_ID
    )
    length = F.array(1 + F.col("w") % 5, 1 + F.col("c") % 4, 2 + F.col("w") % 7)
    rating = F.array(1 + F.col(REVIEW_ID) % 3, 1 + F.col("c") % 3, 4 + F.col("w") % 2)

    def rule(name: str, scores: Column) -> Column:
        parts = F.transform(scores, lambda s: s.cast("double"))
        total = F.aggregate(parts, F.lit(0.0), lambda a, s: a + s)
        return F.struct(
            F.lit(name).alias("model"),
            naive_bayes.first_largest(scores, LABELS).alias("prediction"),
            F.transform(parts, lambda s: s / total).alias("probability"),
        )

    flat = F.struct(
        F.lit("always positive").alias("model"),
        F.lit("positive").alias("prediction"),
        F.lit(None).cast("array<double>").alias("probability"),
    )
    scored = rows.select(ROW_ID, SENTIMENT, F.inline(F.array(rule("length", length), rule("rating", rating), flat)))
    return materialise(scored, "predictions")


def rule_counts(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion_counts(rule_predictions(spark, folder), ["model"])


@query("g12_confusion_shares")
def _(spark, folder):
    return rounded(metrics.confusion_matrix(rule_counts(spark, folder), ["model"]), 6, "share").drop("n")


@query("e1_confusion_matrix")
def _(spark, folder):
    return metrics.confusion_matrix(rule_counts(spark, folder), ["model"]).drop("share")


@query("e2_class_report")
def _(spark, folder):
    return rounded(metrics.class_report(rule_counts(spark, folder), ["model"]), 6, *metrics.SCORES)


@query("e3_average_report")
def _(spark, folder):
    return rounded(metrics.average_report(rule_counts(spark, folder), ["model"]), 6, *metrics.SCORES)


@query("e4_macro_f1")
def _(spark, folder):
    return rule_counts(spark, folder).select("model", half_even(metrics.macro_f1_of(), 6).alias("macro_f1"))


@query("e5_accuracy")
def _(spark, folder):
    return rule_counts(spark, folder).select("model", half_even(metrics.accuracy_of(), 6).alias("accuracy"))


@query("e6_auc_one_vs_rest")
def _(spark, folder):
    return rounded(metrics.auc_one_vs_rest(rule_predictions(spark, folder), ["model"]), 6, "auc")


@query("e6_macro_auc")
def _(spark, folder):
    areas = metrics.auc_one_vs_rest(rule_predictions(spark, folder), ["model"])
    return rounded(metrics.macro_auc(areas, ["model"]), 6, "auc_roc")


@query("e7_leaderboard")
def _(spark, folder):
    return rounded(metrics.leaderboard(rule_predictions(spark, folder)), 6, "accuracy", "auc_roc", "macro_f1")


@query("e8_recall_by_model")
def _(spark, folder):
    return rounded(metrics.recall_table(rule_counts(spark, folder), ["model"]), 6, *LABELS)


@query("e9_off_majority")
def _(spark, folder):
    return metrics.off_majority(rule_predictions(spark, folder), "positive", ["model"])


@query("e10_bootstrap_replicates")
def _(spark, folder):
    counts = bootstrap.bootstrap_counts(rule_predictions(spark, folder), ["model"], replicates=200)
    return rounded(bootstrap.replicate_scores(counts, ["model"]), 6, "macro_f1")


@query("e10_bootstrap_interval")
def _(spark, folder):
    interval = bootstrap.macro_f1_interval(rule_predictions(spark, folder), ["model"], replicates=200)
    return rounded(interval, 6, "macro_f1", "low", "high")


@query("e11_cut_points")
def _(spark, folder):
    return rounded(thresholds.cut_points(rule_predictions(spark, folder), ["model"]), 6, "threshold", "f1")


@query("e11_thresholds")
def _(spark, folder):
    cuts = thresholds.cut_points(rule_predictions(spark, folder), ["model"])
    return rounded(thresholds.best_thresholds(cuts, ["model"]), 6, "threshold", "f1")


@query("e11_tuned_bayes")
def _(spark, folder):
    """Thresholds from out-of-fold predictions of the training rows, judged on the validation rows."""
    silver, splits = gold(spark, folder)
    rows = validation.folded_rows(layers.split_rows(silver, splits, "train"))
    chosen = validation.tuned_thresholds(validation.cross_validated(rows, [baselines.BAYES]))
    plain = baselines.train_and_predict(silver, splits, models=[baselines.BAYES])
    tuned = thresholds.apply_thresholds(plain, chosen[baselines.BAYES]).withColumn("model", F.lit("tuned"))
    both = plain.withColumn("model", F.lit("plain")).unionByName(tuned)
    return metrics.confusion_counts(both, ["model"]).select("model", half_even(metrics.macro_f1_of(), 6).alias("macro_f1"))


# The flagship: duplicates out, labels on, classes counted.
def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.class_balance(cleaning.clean_reviews(reviews(spark, folder)), SENTIMENT)


REGISTRY["flagship_clean_class_balance"] = flagship
