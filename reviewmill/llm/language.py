"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of lower-cased character n-grams of one to three code points, hashed to
``BUCKETS``. Document frequencies are counted over every learnable document. The weights are trained
with the follow-the-regularised-leader rule (a rate for each coordinate, L1 and L2 penalties) on a
bounded sample of labelled rows, ``ROWS_PER_LANGUAGE`` of each language with the least hash of their
id. Part of the sample is kept from training and sets the temperature that scales the scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.frames import pick
from reviewmill.llm.kernels import mix
from reviewmill.sources.workspace import materialise

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
ROWS_PER_LANGUAGE = 400
#: one sample row in so many calibrates
CALIBRATION = 5
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2e-4, 1e-5
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2


def held_out(doc_id: Column) -> Column:
    """Whether a document is outside the rows to learn from; a null id never is."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def gram_counts(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's n-grams in ascending order, and their counts."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    found, grams = [], np.zeros(len(codes), np.uint64)
    for order in ORDERS:
        if len(codes) < order:
            break
        grams = grams[: len(codes) - order + 1] * np.uint64(0x110000) + codes[order - 1 :] + np.uint64(1)
        found.append(mix(grams) & np.uint64(buckets - 1))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    counts = np.bincount(np.concatenate(found).astype(np.int64), minlength=buckets)
    at = np.flatnonzero(counts)
    return at, counts[at]


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float = 1.0

    def vector(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weighted = counts * self.idf[at]
        norm = np.sqrt((weighted**2).sum())
        return weighted / norm if norm else weighted

    def logits(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.vector(at, counts) @ self.weights[at] + self.weights[-1]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        chance = softmax(self.logits(*gram_counts(text, len(self.idf))) / self.temperature)
        best = int(np.argmax(chance))
        return self.languages[best], float(chance[best])


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]], buckets: int, classes: int,
    *, epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2,
) -> np.ndarray:
    """Weights by bucket and class, the bias last; the rows are visited in the given order."""
    z, n = np.zeros((buckets + 1, classes)), np.zeros((buckets + 1, classes))

    def current(at: np.ndarray) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(z[at]) <= l1, 0.0, w)

    for _ in range(epochs):
        for at, x, label in rows:
            at, x = np.append(at, buckets), np.append(x, 1.0)
            w = current(at)
            error = softmax(x @ w)
            error[label] -= 1
            gradient = x[:, None] * error[None, :]
            squares = n[at] + gradient**2
            z[at] += gradient - (np.sqrt(squares) - np.sqrt(n[at])) / alpha * w
            n[at] = squares
    return current(np.arange(buckets + 1))


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least negative log likelihood, by golden section on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        return -np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(labels)), labels], 1e-300)).mean()

    low, high, ratio = -3.0, 3.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(rows: DataFrame, buckets: int) -> tuple[int, np.ndarray]:
    """Number of documents, and of those that hold each bucket; ``buckets + 1`` numbers in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets + 1, np.int64)
        for batch in batches:
            for text in batch["text"].to_pylist():
                total[gram_counts(text or "", buckets)[0]] += 1
                total[-1] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    found = rows.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets + 1, np.int64)
    for r in found.collect():
        out[r["bucket"]] = r["n"]
    return int(out[-1]), out[:-1]


def learnable(docs: DataFrame) -> DataFrame:
    rows = pick(docs, "doc_id", "text", "lang").select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")
    )
    return rows.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))


def fit(docs: DataFrame, *, rows_per_language: int = ROWS_PER_LANGUAGE, buckets: int = BUCKETS) -> Model:
    rows = learnable(docs)
    documents, holding = document_frequencies(rows, buckets)
    idf = np.log((1 + documents) / (1 + holding)) + 1

    draw = F.xxhash64("doc_id", F.lit("language"))
    order = Window.partitionBy("lang").orderBy(draw, "doc_id")
    ids = rows.select("doc_id", "lang").where("doc_id is not null").select("*", F.row_number().over(order).alias("turn"))
    chosen = materialise(ids.where(F.col("turn") <= rows_per_language).select("doc_id", "turn").dropDuplicates(["doc_id"]), "language-sample")
    sample = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "turn", "lang", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [gram_counts(t or "", buckets) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["turn"], batch["lang"],
                 pa.array([a.astype(np.int32) for a, _ in grams], pa.list_(pa.int32())),
                 pa.array([c.astype(np.int32) for _, c in grams], pa.list_(pa.int32()))],
                names=["doc_id", "turn", "lang", "at", "counts"],
            )

    schema = "doc_id long, turn int, lang string, at array<int>, counts array<int>"
    found = sample.mapInArrow(features, schema).toArrow()
    taken = sorted(
        zip(*[found[c].to_pylist() for c in ("turn", "lang", "doc_id")], range(found.num_rows), strict=True)
    )
    languages = sorted({lang for _, lang, _, _ in taken})
    model = Model(languages, idf, np.zeros((buckets + 1, max(1, len(languages)))))
    train, check = [], []
    for turn, lang, _, k in taken:
        at, counts = found["at"][k].values.to_numpy(), found["counts"][k].values.to_numpy()
        (check if turn % CALIBRATION == 0 else train).append((at, model.vector(at, counts), languages.index(lang)))
    if languages:
        model.weights = train_ftrl(train, buckets, len(languages))
        logits = np.array([x @ model.weights[at] + model.weights[-1] for at, x, _ in check]).reshape(-1, len(languages))
        model.temperature = best_temperature(logits, np.array([y for _, _, y in check], int))
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``, one row for each row; only the text is looked at.

    Null texts and texts without a letter are ``und`` with score 0, as is every text if nothing
    could be learned. Equal texts get equal results; other columns are ignored.
    """

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")
