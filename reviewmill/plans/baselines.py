"""Baseline classifiers, trained on one split and scored on another.

Four are the plain baselines. Three more are the ones named next to them: logistic regression and a
linear SVC with coefficients as a table, which need no vocabulary on the driver, and a random forest on
the leading singular vectors of the text instead of its terms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.operators import metrics
from reviewmill.operators.blockmatrix import BlockMatrix, block_matrix
from reviewmill.operators.forest import dense_forest_shares, forest_shares
from reviewmill.operators.linear import LinearModel, Logistic, SquaredHinge, fit_linear
from reviewmill.operators.naive_bayes import first_largest, softmax
from reviewmill.operators.scaling import filled
from reviewmill.operators.svd import fit_svd
from reviewmill.operators.tfidf import write_rows
from reviewmill.plans.features import (
    FeatureModel,
    Vectoriser,
    fit_bayes,
    fit_features,
    fit_unit_range,
    prepared_rows,
)
from reviewmill.schema import LABELS, NUMERIC_FEATURES, ROW_ID, SEED, SENTIMENT
from reviewmill.sources.layers import split_rows
from reviewmill.sources.workspace import materialise, spread_small_scan

MAJORITY = "Majority class"
LOGISTIC = "Logistic regression"
FOREST = "Random forest"
BAYES = "Multinomial naive Bayes"
MODELS = (MAJORITY, LOGISTIC, FOREST, BAYES)
TABLE_LOGISTIC = "Logistic regression (table)"
SVC = "Linear SVC"
SVD_FOREST = "Random forest on SVD"
ALL_MODELS = (*MODELS, TABLE_LOGISTIC, SVC, SVD_FOREST)

# Model settings. Spark's trees are at most 30 deep.
LOGISTIC_C, LOGISTIC_ITERATIONS, LOGISTIC_TOLERANCE = 1.0, 1000, 1e-4
FOREST_TREES, FOREST_DEPTH = 400, 30
SVC_C = 1.0
SVD_COMPONENTS = 300

PREDICTION_COLUMNS = ("model", ROW_ID, SENTIMENT, "prediction", "probability")


def majority_class(train: DataFrame, label: str = SENTIMENT) -> DataFrame:
    """One row ``(prediction, n)``: the most frequent label, the lesser one on a tie."""
    counts = train.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    best = counts.agg(F.min_by(F.struct(label, "n"), F.struct(-F.col("n"), F.col(label))).alias("best"))
    return best.select(F.col(f"best.{label}").alias("prediction"), F.col("best.n").alias("n"))


def majority_predictions(train: DataFrame, rows: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Every row gets the majority label with probability one."""
    winner = majority_class(train).select("prediction").scalar()
    named = rows.select(F.lit(MAJORITY).alias("model"), ROW_ID, SENTIMENT, winner.alias("prediction"))
    hot = F.array(*[(F.col("prediction") == c).cast("double") for c in labels])
    return named.withColumn("probability", hot)


def _training_rows(vectors: DataFrame, features: FeatureModel, labels: Sequence[str] = LABELS) -> DataFrame:
    names = F.array(*[F.lit(c) for c in labels])
    return vectors.select(
        ROW_ID,
        "features",
        (F.array_position(names, F.col(SENTIMENT)) - 1).cast("double").alias("label"),
        features.weight_of(F.col(SENTIMENT)).alias("weight"),
    )


def _labelled(scored: DataFrame, model: str, labels: Sequence[str] = LABELS) -> DataFrame:
    names = F.array(*[F.lit(c) for c in labels])
    return scored.select(
        F.lit(model).alias("model"),
        ROW_ID,
        SENTIMENT,
        F.element_at(names, F.col("prediction").cast("int") + 1).alias("prediction"),
        vector_to_array("probability").alias("probability"),
    )


def train_logistic(train: DataFrame, rows: int, *, max_iter: int = LOGISTIC_ITERATIONS, tol: float = LOGISTIC_TOLERANCE):
    """Multinomial logistic regression with the L2 strength of ``C = 1``.

    Spark minimises the weighted mean loss, so the penalty is divided by the total weight, which
    for balanced weights is the number of rows.
    """
    return LogisticRegression(
        family="multinomial",
        weightCol="weight",
        standardization=False,
        elasticNetParam=0.0,
        regParam=1.0 / (LOGISTIC_C * rows),
        maxIter=max_iter,
        tol=tol,
    ).fit(train)


def train_forest(train: DataFrame, *, trees: int = FOREST_TREES, depth: int = FOREST_DEPTH, seed: int = SEED):
    """Random forest with Gini splits on a square-root sample of the columns."""
    return RandomForestClassifier(
        numTrees=trees,
        maxDepth=depth,
        impurity="gini",
        featureSubsetStrategy="sqrt",
        weightCol="weight",
        seed=seed,
        maxMemoryInMB=1024,
    ).fit(train)


def training_vectors(features: FeatureModel, vectoriser: Vectoriser, train: DataFrame) -> DataFrame:
    """``(row_id, features, label, weight)`` as a written table, shared by the estimators."""
    return materialise(_training_rows(vectoriser.transform(train), features), "vectors")


def logistic_predictions(
    features: FeatureModel, vectoriser: Vectoriser, vectors: DataFrame, rows: DataFrame, **options
) -> DataFrame:
    """Train on the splits of the written table: each partition returns one dense gradient per
    iteration, so partitions should hold many rows and are not spread thinner here."""
    model = train_logistic(vectors, features.tfidf.documents, **options)
    return _labelled(model.transform(vectoriser.transform(rows)), LOGISTIC)


def forest_predictions(vectoriser: Vectoriser, vectors: DataFrame, rows: DataFrame, **options) -> DataFrame:
    """Trees gain from every core, so a small table is spread over all of them."""
    model = train_forest(spread_small_scan(vectors, ROW_ID), **options)
    return _labelled(model.transform(vectoriser.transform(rows)), FOREST)


def sparse_forest_predictions(
    features: FeatureModel, fitted: BlockMatrix, held: BlockMatrix, train: DataFrame, rows: DataFrame, *, trees: int = FOREST_TREES, depth: int = FOREST_DEPTH, seed: int = SEED
) -> DataFrame:
    """The forest on every term, from the feature matrices in blocks: no vector, no vocabulary on the driver."""
    shares = forest_shares(
        fitted, train, held, rows, label=SENTIMENT, labels=LABELS, weights=[features.weights.get(c, 0.0) for c in LABELS], trees=trees, depth=depth, seed=seed
    )
    return _shared(rows, shares, FOREST)


def _shared(rows: DataFrame, shares: DataFrame, name: str) -> DataFrame:
    """Class of the largest share."""
    scored = rows.select(ROW_ID, SENTIMENT).join(shares, ROW_ID)
    return scored.select(F.lit(name).alias("model"), ROW_ID, SENTIMENT, first_largest(F.col("vector"), LABELS).alias("prediction"), F.col("vector").alias("probability"))


def feature_blocks(features: FeatureModel, train: DataFrame, rows: DataFrame) -> tuple[BlockMatrix, BlockMatrix]:
    """The feature matrices of training and scored rows in blocks over the same columns."""
    entries = [materialise(features.matrix(part), "entries") for part in (train, rows)]
    names = {"row": ROW_ID, "column": "feature", "value": "value"}
    fitted = block_matrix(entries[0], **names)
    return fitted, block_matrix(entries[1], **names, columns=fitted.columns)


def train_table_logistic(features: FeatureModel, matrix: BlockMatrix, train: DataFrame, **options) -> LinearModel:
    """The objective of ``train_logistic``, with coefficients as a table."""
    weighted = train.select(ROW_ID, SENTIMENT, features.weight_of(F.col(SENTIMENT)).alias("weight"))
    return fit_linear(matrix, weighted, Logistic, penalty=1.0 / (LOGISTIC_C * features.tfidf.documents), **options)


def train_svc(features: FeatureModel, matrix: BlockMatrix, train: DataFrame, **options) -> LinearModel:
    """One squared-hinge classifier for each class against the rest, balanced class weights, ``C = 1``; the
    intercept is penalised like a coefficient."""
    weighted = train.select(ROW_ID, SENTIMENT, features.weight_of(F.col(SENTIMENT)).alias("weight"))
    penalty = 1.0 / (SVC_C * features.tfidf.documents)
    return fit_linear(matrix, weighted, SquaredHinge, penalty=penalty, penalise_intercept=True, **options)


def linear_predictions(model: LinearModel, matrix: BlockMatrix, rows: DataFrame, name: str, *, chances: bool) -> DataFrame:
    """Class of the largest margin; probabilities only where the model has them."""
    scored = rows.select(ROW_ID, SENTIMENT).join(model.margins(matrix), ROW_ID)
    probability = softmax(F.col("vector")) if chances else F.lit(None).cast("array<double>")
    return scored.select(
        F.lit(name).alias("model"), ROW_ID, SENTIMENT, first_largest(F.col("vector"), model.labels).alias("prediction"), probability.alias("probability")
    )


def svd_forest_predictions(
    features: FeatureModel, train: DataFrame, rows: DataFrame, *, components: int = SVD_COMPONENTS, svd: dict | None = None,
    trees: int = FOREST_TREES, depth: int = FOREST_DEPTH, seed: int = SEED,
) -> DataFrame:
    """A forest on ``components`` coordinates of the text and the numbers: short dense rows, so no bin per
    term and no vocabulary on the driver. A row without a known term has coordinates of zero."""
    entries = [materialise(features.tfidf.transform(part), "text-entries") for part in (train, rows)]
    names = {"row": ROW_ID, "column": "term", "value": "weight"}
    fitted = block_matrix(entries[0], **names)
    reduced = fit_svd(fitted, components, **(svd or {}))
    zero = F.array_repeat(F.lit(0.0), reduced.size)

    def vectors(part: DataFrame, matrix: BlockMatrix) -> DataFrame:
        numbers = F.array(*[filled(c) for c in NUMERIC_FEATURES])
        both = features.scaler.transform(part).join(reduced.project(matrix), ROW_ID, "left")
        return materialise(both.select(ROW_ID, SENTIMENT, F.concat(F.coalesce("vector", zero), numbers).alias("vector")), "dense-rows")

    held = vectors(rows, block_matrix(entries[1], **names, columns=fitted.columns))
    shares = dense_forest_shares(
        vectors(train, fitted), held, row=ROW_ID, label=SENTIMENT, labels=LABELS, weights=[features.weights.get(c, 0.0) for c in LABELS], trees=trees, depth=depth, seed=seed
    )
    return _shared(rows, shares, SVD_FOREST)


def bayes_predictions(features: FeatureModel, train: DataFrame, rows: DataFrame) -> DataFrame:
    unit_range = fit_unit_range(features, train)
    scored = fit_bayes(unit_range, train).score(unit_range.numbers(rows))
    return scored.withColumn("model", F.lit(BAYES)).select(*PREDICTION_COLUMNS)


def fit_and_score(
    train: DataFrame,
    rows: DataFrame,
    *,
    models: Sequence[str] = MODELS,
    min_df: int = 1,
    hashed_terms: int | None = None,
    forest: dict | None = None,
    logistic: dict | None = None,
    svd_forest: dict | None = None,
    linear: dict | None = None,
) -> DataFrame:
    """Fit the chosen models on prepared rows and score others; pass written tables.

    ``forest``, ``logistic``, ``svd_forest`` and ``linear`` hold options, such as ``{"trees": 50}``. The logistic
    regression and the forest by term are fitted on blocks, where nothing as long as the vocabulary reaches the driver;
    with hashed terms they are those of ``pyspark.ml``.
    """
    parts = []
    if MAJORITY in models:
        parts.append(majority_predictions(train, rows))
    if set(models) - {MAJORITY}:
        features = fit_features(train, min_df=min_df)
        if {LOGISTIC, FOREST} & set(models) and hashed_terms:
            vectoriser = features.vectoriser(train, hashed_terms=hashed_terms)
            vectors = training_vectors(features, vectoriser, train)
        if {TABLE_LOGISTIC, SVC} & set(models) or ({LOGISTIC, FOREST} & set(models) and not hashed_terms):
            fitted, held = feature_blocks(features, train, rows)
        if LOGISTIC in models and not hashed_terms:
            model = train_table_logistic(features, fitted, train, **{"max_iter": LOGISTIC_ITERATIONS, **(logistic or {})})
            parts.append(linear_predictions(model, held, rows, LOGISTIC, chances=True))
        elif LOGISTIC in models:
            parts.append(logistic_predictions(features, vectoriser, vectors, rows, **(logistic or {})))
        if FOREST in models and not hashed_terms:
            parts.append(sparse_forest_predictions(features, fitted, held, train, rows, **(forest or {})))
        elif FOREST in models:
            parts.append(forest_predictions(vectoriser, vectors, rows, **(forest or {})))
        if BAYES in models:
            parts.append(bayes_predictions(features, train, rows))
        if TABLE_LOGISTIC in models:
            model = train_table_logistic(features, fitted, train, **(linear or {}))
            parts.append(linear_predictions(model, held, rows, TABLE_LOGISTIC, chances=True))
        if SVC in models:
            model = train_svc(features, fitted, train, **(linear or {}))
            parts.append(linear_predictions(model, held, rows, SVC, chances=False))
        if SVD_FOREST in models:
            parts.append(svd_forest_predictions(features, train, rows, **(svd_forest or {})))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def train_and_predict(
    silver: DataFrame,
    splits: DataFrame,
    split: str = "validation",
    *,
    models: Sequence[str] = MODELS,
    min_df: int = 1,
    hashed_terms: int | None = None,
    **options,
) -> DataFrame:
    """Predictions of the chosen models for one split, as a written table.

    ``hashed_terms`` lets the linear model and the forest work on any vocabulary (see ``features``).

    Only the rows that are scored are featurised; the other held-out split is not read.
    """
    if split not in ("validation", "test"):
        raise ValueError("models are scored on 'validation' or 'test'")
    train = spread_small_scan(write_rows(prepared_rows(split_rows(silver, splits, "train")), "train"), ROW_ID)
    rows = spread_small_scan(write_rows(prepared_rows(split_rows(silver, splits, split)), split), ROW_ID)
    return materialise(fit_and_score(train, rows, models=models, min_df=min_df, hashed_terms=hashed_terms, **options), "predictions")


def evaluate(predictions: DataFrame) -> dict[str, DataFrame]:
    """All score tables of a predictions table, by name; the predictions are read twice in all."""
    counts = materialise(metrics.confusion_counts(predictions, ["model"]), "confusion")
    areas = materialise(metrics.auc_one_vs_rest(predictions, ["model"]), "areas")
    return {
        "leaderboard": metrics.rank_models(counts, areas),
        "confusion": metrics.confusion_matrix(counts, ["model"]),
        "classes": metrics.class_report(counts, ["model"]),
        "averages": metrics.average_report(counts, ["model"]),
        "recall": metrics.recall_table(counts, ["model"]),
        "auc": areas,
    }
