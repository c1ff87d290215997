"""Cross-validation with everything refitted inside each fold.

Naive Bayes is validated on all folds at once. What a fold's model learns are sums over the rows of the
other folds, so one pass counts by fold and the model of fold ``j`` takes the total minus fold ``j``:

1. documents per term and fold give each model its own vocabulary and idf;
2. each row gets its norm under every model, one column for each;
3. one aggregate per term gives, for each model, the largest weight and the weights per class of its
   training rows (the idf is the same in all rows, so it multiplies the aggregates); the numbers' ranges and class sums come from one line per fold and class;
4. a row is scored by the model that has not seen it.

No pass is repeated for a fold and no row is copied. Other classifiers are fitted fold by fold.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import log
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.operators import metrics, thresholds
from reviewmill.operators.naive_bayes import first_largest, softmax
from reviewmill.operators.scaling import filled
from reviewmill.operators.splitting import FOLD, assign_folds
from reviewmill.operators.tfidf import counts_met_by_term, frequent_above, met_by_term, row_terms, together_by_row, write_rows
from reviewmill.plans import baselines
from reviewmill.plans.features import prepared_rows
from reviewmill.schema import LABELS, NUMERIC_FEATURES, ROW_ID, SEED, SENTIMENT
from reviewmill.sources.workspace import materialise, spread_small_scan

FOLDS = 5


def folded_rows(silver: DataFrame, folds: int = FOLDS, *, seed: int = SEED + 1) -> DataFrame:
    """Prepared rows with their ``fold``, as a written table."""
    rows = prepared_rows(silver)
    keys = materialise(rows.select(ROW_ID, SENTIMENT), "fold-keys")
    return spread_small_scan(write_rows(assign_folds(rows, folds, seed=seed, keys=keys), "folded"), ROW_ID)


def fold_vocabulary(counts: DataFrame, sizes: Sequence[int], min_df: int = 1) -> DataFrame:
    """``(term, df, idf_0, ..., judged)`` of ``(row_id, fold, term)``: the rows with the term, the idf under each fold's model, NULL where
    the term does not occur (``min_df`` times) outside the fold, and whether any row meets the term in its fold's model.
    ``sizes`` are the rows of each fold."""
    here = [F.count_if(F.col(FOLD) == j).alias(f"df_{j}") for j in range(len(sizes))]
    frequencies = counts.groupBy("term").agg(*here, F.count(F.lit(1)).alias("df"))
    rows = sum(sizes)

    def idf(j: int) -> Column:
        df = F.col("df") - F.col(f"df_{j}")
        return F.when(df >= min_df, F.log(F.lit(1.0 + rows - sizes[j]) / (F.lit(1.0) + df)) + F.lit(1.0))

    judged = [(F.col(f"df_{j}") > 0) & (F.col("df") - F.col(f"df_{j}") >= min_df) for j in range(len(sizes))]
    return frequencies.select(
        "term", "df", *[idf(j).alias(f"idf_{j}") for j in range(len(sizes))], reduce(or_, judged).alias("judged")
    )


def fold_entries(rows: DataFrame, vocabulary: DataFrame, above: int, folds: int) -> DataFrame:
    """``(row_id, sentiment, fold, term, tf, known, norm_0, ...)``: what ``fold_share`` needs of each entry, few
    different values that are written short, and whether the model of the row's fold knows the term."""
    known = together_by_row(rows, counts_met_by_term(rows, vocabulary.drop("judged"), above, keep=[SENTIMENT, FOLD]))
    row = Window.partitionBy(ROW_ID)
    norms = [F.sqrt(F.sum((F.col("tf") * F.col(f"idf_{j}")) * (F.col("tf") * F.col(f"idf_{j}"))).over(row)).alias(f"norm_{j}") for j in range(folds)]
    own = of_fold([F.col(f"idf_{j}") for j in range(folds)]).isNotNull().alias("known")
    return known.select(ROW_ID, SENTIMENT, FOLD, "term", "tf", own, *norms)


def fold_share(j: int) -> Column:
    """Weight of an entry in rows of unit length under a fold's model, over the idf of its term."""
    return F.col("tf") / F.col(f"norm_{j}")


def of_fold(values: Sequence[Column]) -> Column:
    """The value of the model that has not seen the row."""
    return F.coalesce(*[F.when(F.col(FOLD) == j, v) for j, v in enumerate(values)])


class _Numbers:
    """Per fold's model the log prior and, for each number, range and log probability by class.

    From one line per fold and class, whatever the number of rows.
    """

    def __init__(self, rows: DataFrame, folds: int, labels: Sequence[str], columns: Sequence[str]):
        cells = [
            *[F.sum(filled(c)).alias(f"sum_{c}") for c in columns],
            *[F.min(filled(c)).alias(f"min_{c}") for c in columns],
            *[F.max(filled(c)).alias(f"max_{c}") for c in columns],
        ]
        lines = rows.groupBy(FOLD, SENTIMENT).agg(F.count(F.lit(1)).alias("n"), *cells).collect()
        self.columns, self.lines, self.folds = columns, lines, folds
        self.sizes = [sum(r["n"] for r in lines if r[FOLD] == j) for j in range(folds)]
        self.training = [[r for r in lines if r[FOLD] != j] for j in range(folds)]
        self.seen = [[c for c in labels if any(r[SENTIMENT] == c for r in part)] for part in self.training]

    def count(self, j: int, label: str) -> int:
        return sum(r["n"] for r in self.training[j] if r[SENTIMENT] == label)

    def log_prior(self, j: int, label: str) -> float:
        return log(self.count(j, label) / sum(r["n"] for r in self.training[j]))

    def range(self, j: int, column: str) -> tuple[float, float]:
        low = min(r[f"min_{column}"] for r in self.training[j])
        return low, (max(r[f"max_{column}"] for r in self.training[j]) - low) or 1.0

    def mass(self, j: int, label: str, column: str) -> float:
        """Sum of the unit-range number over the training rows of a class."""
        low, span = self.range(j, column)
        total = sum(r[f"sum_{column}"] for r in self.training[j] if r[SENTIMENT] == label)
        return (total - self.count(j, label) * low) / span


class FoldedBayes:
    """What the naive Bayes models of all folds share: entries, and sums per term, as written tables.

    Models on other blocks of features differ in what they add up, so a table of them costs one scoring
    pass each.
    """

    def __init__(self, rows: DataFrame, folds: int = FOLDS, *, min_df: int = 1, labels: Sequence[str] = LABELS, columns: Sequence[str] = NUMERIC_FEATURES):
        self.rows, self.folds, self.labels, self.columns = rows, folds, labels, columns
        self.numbers = _Numbers(rows, folds, labels, columns)
        counts = row_terms(rows, keep=[SENTIMENT, FOLD])
        vocabulary = materialise(fold_vocabulary(counts, self.numbers.sizes, min_df), "fold-vocabulary")
        self.above = frequent_above(vocabulary)
        self.entries = materialise(fold_entries(rows, vocabulary, self.above, folds), "fold-entries")

        def training(j: int, value: Column) -> Column:
            return F.when(F.col(FOLD) != j, value)

        cells = []
        for j in range(folds):
            cells.append(F.max(training(j, fold_share(j))).alias(f"scale_{j}"))
            for c in self.numbers.seen[j]:
                cells.append(F.sum(training(j, F.when(F.col(SENTIMENT) == c, fold_share(j)))).alias(f"sum_{j}_{c}"))
        both = vocabulary.join(self.entries.groupBy("term").agg(*cells), "term")
        weighted = []
        for j in range(folds):
            idf = F.col(f"idf_{j}")
            weighted.append((idf * F.col(f"scale_{j}")).alias(f"scale_{j}"))
            weighted += [F.coalesce(idf * F.col(f"sum_{j}_{c}"), F.lit(0.0)).alias(f"sum_{j}_{c}") for c in self.numbers.seen[j]]
        self.sums = materialise(both.select("term", "df", "judged", *[f"idf_{j}" for j in range(folds)], *weighted), "fold-sums")

    def predictions(self, name: str, *, text: bool = True, columns: Sequence[str] | None = None, alpha: float = 1.0) -> DataFrame:
        """``(model, row_id, sentiment, fold, prediction, probability)`` of the models on the text, on some
        numbers, or on both."""
        columns = self.columns if columns is None else columns
        numbers, folds, labels = self.numbers, self.folds, self.labels

        def scale(j: int) -> Column:
            return F.when(F.col(f"scale_{j}") == 0, F.lit(1.0)).otherwise(F.col(f"scale_{j}"))

        pairs = [(j, c) for j in range(folds) for c in numbers.seen[j]]
        mass = {(j, c): F.col(f"sum_{j}_{c}") / scale(j) + F.lit(alpha) for j, c in pairs}  # NULL outside the vocabulary
        whole = {(j, c): sum(numbers.mass(j, c, f) + alpha for f in columns) for j, c in pairs}
        if text:
            totals = self.sums.agg(*[F.coalesce(F.sum(m), F.lit(0.0)).alias(f"{j}_{c}") for (j, c), m in mass.items()]).first()
            whole = {(j, c): v + totals[f"{j}_{c}"] for (j, c), v in whole.items()}

        def term_weight(j: int, label: str) -> Column:
            return F.col("weight") * F.col(f"w_{j}_{label}") if label in numbers.seen[j] else F.lit(None).cast("double")

        def joint(j: int, label: str) -> Column:
            if label not in numbers.seen[j]:
                return F.lit(float("-inf"))
            value = F.lit(numbers.log_prior(j, label))
            for f in columns:
                low, span = numbers.range(j, f)
                weight = log((numbers.mass(j, label, f) + alpha) / whole[j, label])
                value = value + (filled(f) - F.lit(low)) / F.lit(span) * F.lit(weight)
            return value + F.coalesce(f"text_{label}", F.lit(0.0)) if text else value

        scored = self.rows.select(ROW_ID, SENTIMENT, FOLD, *columns)
        if text:
            weights = [(F.log(m / F.lit(whole[j, c])) / scale(j) * F.col(f"idf_{j}")).alias(f"w_{j}_{c}") for (j, c), m in mass.items()]
            # a term that no row meets in its fold's model, as most rare ones, decides nothing
            terms = self.sums.where("judged").select("term", "df", *weights)
            own = self.entries.where("known").select(ROW_ID, FOLD, "term", of_fold([fold_share(j) for j in range(folds)]).alias("weight"))
            cells = [F.sum(of_fold([term_weight(j, c) for j in range(folds)])).alias(f"text_{c}") for c in labels]
            # frequent terms add up where the row is
            frequent, other = (part.groupBy(ROW_ID).agg(*cells) for part in met_by_term(own, terms, self.above))
            sums = frequent.unionByName(other).groupBy(ROW_ID).agg(*[F.sum(f"text_{c}").alias(f"text_{c}") for c in labels])
            scored = scored.join(sums, ROW_ID, "left")
        joints = F.array(*[of_fold([joint(j, c) for j in range(folds)]) for c in labels])
        scored = scored.select(ROW_ID, SENTIMENT, FOLD, joints.alias("joint"))
        return scored.select(
            F.lit(name).alias("model"),
            ROW_ID,
            SENTIMENT,
            FOLD,
            first_largest(F.col("joint"), labels).alias("prediction"),
            softmax(F.col("joint")).alias("probability"),
        )


def cross_validated_bayes(rows: DataFrame, folds: int = FOLDS, *, alpha: float = 1.0, **options) -> DataFrame:
    """``(model, row_id, sentiment, fold, prediction, probability)`` of ``folded_rows``.

    Each row is scored by a naive Bayes whose vocabulary, idf, scales, ranges and probabilities come from
    the other folds only. A row without a known term gets its score from numbers and prior; a class that
    is absent from a model's training rows has probability 0 there.
    """
    return FoldedBayes(rows, folds, **options).predictions(baselines.BAYES, alpha=alpha)


def with_tuned_folds(predictions: DataFrame, folds: int = FOLDS, *, labels: Sequence[str] = LABELS) -> DataFrame:
    """Out-of-fold predictions decided by thresholds; those of a fold come from the other folds' scores."""
    others = F.explode(F.filter(F.sequence(F.lit(0), F.lit(folds - 1)), lambda j: j != F.col(FOLD))).alias("judged")
    cuts = thresholds.cut_points(predictions.select("model", SENTIMENT, "probability", others), ["model", "judged"], labels=labels)
    best = thresholds.best_thresholds(cuts, ["model", "judged"])
    # one line for each model and fold
    chosen = {}
    for r in best.collect():
        chosen.setdefault((r["model"], r["judged"]), {})[r["label"]] = r["threshold"]
    decided = F.col("prediction")
    for (model, fold), found in chosen.items():
        own = (F.col("model") == model) & (F.col(FOLD) == fold) & F.col("probability").isNotNull()
        decided = F.when(own, thresholds.decide(F.col("probability"), found, labels)).otherwise(decided)
    return predictions.withColumn("prediction", decided)


ABLATION = {
    "text": {"columns": ()},
    "numbers": {"text": False},
    "text and numbers": {},
}


def ablation(rows: DataFrame, folds: int = FOLDS, configurations: dict[str, dict] | None = None, **options) -> DataFrame:
    """``(model, folds, mean, sigma)`` of cross-validated macro-F1, one line for each configuration of the
    naive Bayes features, and one for the same with decision thresholds.

    Rows are prepared once, and what the models of a fold learn is counted once for all configurations.
    """
    shared = FoldedBayes(rows, folds, **options)
    parts = [shared.predictions(name, **chosen) for name, chosen in (configurations or ABLATION).items()]
    plain = parts[0]
    for part in parts[1:]:
        plain = plain.unionByName(part)
    plain = materialise(plain, "ablation")
    tuned = with_tuned_folds(plain, folds).withColumn("model", F.concat("model", F.lit(", thresholds")))
    return cross_validation_summary(fold_scores(materialise(plain.unionByName(tuned), "ablation-tuned")))


def cross_validated(rows: DataFrame, models: Sequence[str], folds: int = FOLDS, **options) -> DataFrame:
    """Out-of-fold predictions of any baselines, as a written table; ``rows`` are ``folded_rows``.

    Each fold's models are fitted on the other folds from the tokens up (``options`` as for
    ``baselines.fit_and_score``).
    """
    parts = []
    if baselines.BAYES in models:
        parts.append(cross_validated_bayes(rows, folds, min_df=options.get("min_df", 1)))
    rest = [m for m in models if m != baselines.BAYES]
    for j in range(folds) if rest else []:
        train, held = (write_rows(rows.where(c).drop(FOLD), f"fold-{j}") for c in (F.col(FOLD) != j, F.col(FOLD) == j))
        scored = baselines.fit_and_score(train, held, models=rest, **options)
        parts.append(scored.select("model", ROW_ID, SENTIMENT, F.lit(j).alias(FOLD), "prediction", "probability"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return materialise(out, "out-of-fold")


def fold_scores(predictions: DataFrame) -> DataFrame:
    """``(model, fold, rows, accuracy, macro_f1)`` of out-of-fold predictions."""
    counts = metrics.confusion_counts(predictions, ["model", FOLD])
    sizes = predictions.groupBy("model", FOLD).agg(F.count(F.lit(1)).alias("rows"))
    scores = counts.select("model", FOLD, metrics.accuracy_of().alias("accuracy"), metrics.macro_f1_of().alias("macro_f1"))
    return sizes.join(scores, ["model", FOLD])


def cross_validation_summary(scores: DataFrame) -> DataFrame:
    """``(model, folds, mean, sigma)`` of the folds' macro-F1; sigma is the population deviation."""
    return scores.groupBy("model").agg(
        F.count(F.lit(1)).alias("folds"), F.avg("macro_f1").alias("mean"), F.stddev_pop("macro_f1").alias("sigma")
    )


def tuned_thresholds(predictions: DataFrame) -> dict[str, dict[str, float]]:
    """Decision thresholds of each model, chosen on its out-of-fold predictions; one number per class.

    Apply them with ``thresholds.apply_thresholds`` to rows that the models have not been fitted on.
    """
    best = thresholds.best_thresholds(thresholds.cut_points(predictions, ["model"]), ["model"])
    out: dict[str, dict[str, float]] = {}
    for r in best.collect():
        out.setdefault(r["model"], {})[r["label"]] = r["threshold"]
    return out
