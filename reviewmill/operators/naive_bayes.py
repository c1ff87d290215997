"""Multinomial naive Bayes on TF-IDF weights and numbers that are rescaled to [0, 1].

The model is a table with one row per term, so neither training nor scoring needs the vocabulary
on the driver. Two sums are folded to save passes over the matrix:

* training needs, per term, the largest weight and the weights per class; scaling by the former
  commutes with summing the latter, so one aggregation gives both;
* scoring needs ``sum(tf * idf / norm / scale * log p)`` with ``norm`` the length of the row, so one
  join and one aggregation per row give the sum and the norm together.

Class priors are the plain training shares, and scored numbers may lie outside [0, 1];
``pyspark.ml`` smooths the former and rejects the latter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.operators.scaling import LinearScaler, filled
from reviewmill.operators.tfidf import TfidfModel, counts_met_by_term, largest_weight
from reviewmill.schema import LABELS, NUMERIC_FEATURES, ROW_ID, SENTIMENT
from reviewmill.sources.workspace import materialise


def softmax(scores: Column) -> Column:
    shifted = F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))
    total = F.aggregate(shifted, F.lit(0.0), lambda a, s: a + s)
    return F.transform(shifted, lambda s: s / total)


def first_largest(scores: Column, labels: Sequence[str]) -> Column:
    """Label of the largest score; the earlier label wins a tie."""
    names = F.array(*[F.lit(c) for c in labels])
    return F.element_at(names, F.array_position(scores, F.array_max(scores)).cast("int"))


def class_weight_sums(matrix: DataFrame, labels: Sequence[str] = LABELS, label: str = SENTIMENT) -> DataFrame:
    """``(term, scale, sum_<label>...)`` of a training matrix ``(row_id, label, term, weight)``."""
    sums = [
        F.coalesce(F.sum(F.when(F.col(label) == c, F.col("weight"))), F.lit(0.0)).alias(f"sum_{c}") for c in labels
    ]
    return matrix.groupBy("term").agg(largest_weight().alias("scale"), *sums)


@dataclass(frozen=True)
class NaiveBayesModel:
    """``terms`` is a written table ``(term, df, idf, w_<label>...)`` with ``w = log p / scale``; terms in more than
    ``above`` rows are broadcast."""

    terms: DataFrame
    numbers: dict[str, dict[str, float]]
    log_prior: dict[str, float]
    above: int = 0

    @property
    def labels(self) -> list[str]:
        return list(self.log_prior)

    def score(self, rows: DataFrame) -> DataFrame:
        """Probabilities (in label order) and label of rows that hold tokens and unit-range numbers:
        ``(row_id, sentiment, prediction, probability)``. A row without a known term gets its
        score from the numbers and the prior."""
        raw = F.col("tf") * F.col("idf")
        frequent, other = counts_met_by_term(rows, self.terms, self.above)
        # frequent terms add up where the row is
        parts = [
            part.groupBy(ROW_ID).agg(F.sum(raw * raw).alias("square"), *[F.sum(raw * F.col(f"w_{c}")).alias(f"text_{c}") for c in self.labels])
            for part in (frequent, other)
        ]
        sums = parts[0].unionByName(parts[1]).groupBy(ROW_ID).agg(
            F.sqrt(F.sum("square")).alias("norm"), *[F.sum(f"text_{c}").alias(f"text_{c}") for c in self.labels]
        )
        both = rows.drop("tokens").join(sums, ROW_ID, "left")
        joint = F.array(*[self._joint(c) for c in self.labels])
        scored = both.select(ROW_ID, SENTIMENT, joint.alias("joint"))
        return scored.select(
            ROW_ID,
            SENTIMENT,
            first_largest(F.col("joint"), self.labels).alias("prediction"),
            softmax(F.col("joint")).alias("probability"),
        )

    def _joint(self, label: str) -> Column:
        text = F.coalesce(F.col(f"text_{label}") / F.col("norm"), F.lit(0.0))
        numbers = sum((filled(f) * F.lit(w[label]) for f, w in self.numbers.items()), F.lit(0.0))
        return text + numbers + F.lit(self.log_prior[label])


def fit_naive_bayes(
    tfidf: TfidfModel,
    sums: DataFrame,
    rows: DataFrame,
    *,
    columns: Sequence[str] = NUMERIC_FEATURES,
    labels: Sequence[str] = LABELS,
    alpha: float = 1.0,
) -> NaiveBayesModel:
    """Fit on the ``class_weight_sums`` of the text and on training rows with unit-range numbers."""
    per_class = rows.groupBy(SENTIMENT).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(filled(c)).alias(c) for c in columns]
    )
    # One line per class, and one per class of the text totals.
    classes = {r[SENTIMENT]: r for r in per_class.collect()}
    seen = [c for c in labels if c in classes]
    documents = sum(classes[c]["n"] for c in seen)

    mass = {c: F.col(f"sum_{c}") / F.col("scale") + F.lit(alpha) for c in seen}
    totals = sums.agg(*[F.sum(m).alias(c) for c, m in mass.items()]).first()
    whole = {c: (totals[c] or 0.0) + sum(classes[c][f] + alpha for f in columns) for c in seen}

    weights = [(F.log(m / F.lit(whole[c])) / F.col("scale")).alias(f"w_{c}") for c, m in mass.items()]
    terms = tfidf.vocabulary.select("term", "df", "idf").join(sums.select("term", *weights), "term")
    return NaiveBayesModel(
        terms=materialise(terms, "bayes-terms"),
        numbers={f: {c: log((classes[c][f] + alpha) / whole[c]) for c in seen} for f in columns},
        log_prior={c: log(classes[c]["n"] / documents) for c in seen},
        above=tfidf.above,
    )


def scale_numbers(rows: DataFrame, scalers: Sequence[LinearScaler]) -> DataFrame:
    """Apply scalers one after another."""
    for scaler in scalers:
        rows = scaler.transform(rows)
    return rows
