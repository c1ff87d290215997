"""Severity of toxic language by cumulative-link ordinal regression.

A text's features are the log counts of its lower-cased words and of the first ``PREFIXES`` bytes of
longer words, which stand for inflected and compound forms; each goes by a 64-bit hash. One weight
vector ``w`` is shared by all thresholds: ``P(grade >= j) = sigmoid(w.x - threshold_j)``, and the
expected severity is the sum of these probabilities. Features are screened first: only those that are
far more frequent in toxic documents than chance allows take part, with weights of zero or more, so
that a long text is not judged by the sum of thousands of accidental ones. An L1 penalty thins them out.

Labels say only whether a document is toxic, so grades are derived from the labelled sample: a toxic
document's grade is the third in which its number of screened features lies; grade 0 is clean.

A text is rejected by the model's own decision: it has evidence, and ``P(grade >= 1)`` is at least
``DECISION``. What share of the labelled clean sample that rejects is reported, and decides nothing.

The model is fitted on a bounded sample of labelled rows, ``TOXIC_ROWS`` and ``CLEAN_ROWS`` with the
least hash of their id. Every document is then scored in the scan; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import kernels
from reviewmill.llm.frames import by_batch, pick
from reviewmill.sources.workspace import materialise

TOXIC_ROWS, CLEAN_ROWS = 3000, 6000
GRADES = 3
#: a feature is in so many toxic documents, so many times oftener than in clean ones, and so many
#: standard deviations above chance
SUPPORT, RATIO, DEVIATIONS = 5, 4.0, 5.0
PENALTY, RATE, EPOCHS, BATCH = 2.0, 0.2, 12, 16
#: a text is rejected from this probability of being toxic on: the decision of least cost if a toxic
#: document kept is three times as bad as a clean one lost
DECISION = 0.25
PREFIXES = (4, 5, 6, 7)

#: letters of ASCII and every byte of a longer character are parts of words
NOT_LETTERS = np.ones(256, bool)
NOT_LETTERS[ord("a") : ord("z") + 1] = False
NOT_LETTERS[0x80:] = False


def chunk_features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each chunk of texts: its rows from and to, and row and hash of every word and prefix."""
    data, offsets = kernels.text_bytes(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    for low, high in kernels.chunks(offsets):
        part, ends = data[offsets[low] : offsets[high]], offsets[low : high + 1]
        start, end, first = kernels.words(part, ends, NOT_LETTERS)
        prefix = kernels.PrefixHash(part.astype(np.uint64) + np.uint64(1))
        row = np.repeat(np.arange(high - low), np.diff(first))
        rows, hashes = [row], [prefix.span(start, end)]
        for size in PREFIXES:
            longer = end - start > size
            rows.append(row[longer])
            hashes.append(prefix.span(start[longer], start[longer] + size) ^ np.uint64(kernels.BASE))
        yield low, high, np.concatenate(rows), np.concatenate(hashes).view(np.int64)


def log_counts(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and log count of every distinct feature of a row."""
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    at = kernels.change_points(row, hashes)
    return row[at], hashes[at], np.log1p(np.diff(np.append(at, len(row))))


@dataclass
class Model:
    """Feature hashes in ascending order with their weights, the ascending thresholds of the grades,
    and, as a report, the share of the clean sample that is rejected."""

    words: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    clean_lost: float = 0.0

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts))
        if not len(self.words):
            return out
        maybe = np.zeros(1 << 16, bool)  # by the last bits: most features are ruled out here
        maybe[self.words & 0xFFFF] = True
        for low, high, row, hashes in chunk_features(texts):
            some = np.flatnonzero(maybe[hashes & 0xFFFF])
            row, hashes = row[some], hashes[some]
            place = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            known = self.words[place] == hashes
            row, hashes, value = log_counts(row[known], hashes[known])
            out[low:high] = np.bincount(row, self.weights[np.searchsorted(self.words, hashes)] * value, high - low)
        return out

    def reach(self, scores: np.ndarray) -> np.ndarray:
        """Probability of each grade or a higher one, from grade 1 on."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -500, 500)))

    def rejected(self, scores: np.ndarray) -> np.ndarray:
        """Whether a text is toxic; never without evidence, whatever the share of toxic labels."""
        return (scores > 0) & (self.reach(scores)[:, 0] >= DECISION)


def fit_ordinal(
    row: np.ndarray, column: np.ndarray, value: np.ndarray, grade: np.ndarray, columns: int, grades: int,
    *, penalty: float = PENALTY, epochs: int = EPOCHS, rate: float = RATE,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights (none below zero) and thresholds that lower the negative log likelihood plus an L1 penalty.

    Sparse proximal steps on small batches in a fixed order, with a rate for each coordinate.
    ``row`` must ascend. Thresholds keep their order.
    """
    n = len(grade)
    reached = np.array([(grade >= j).sum() for j in range(1, grades + 1)])
    thresholds = -np.log((reached + 0.5) / (n - reached + 0.5)) + 1e-3 * np.arange(grades)
    z, seen, seen_t = np.zeros(columns), np.zeros(columns), np.full(grades, 1.0)
    first = np.searchsorted(row, np.arange(n + 1))
    order = np.argsort(kernels.mix(np.arange(n, dtype=np.uint64)))

    def current(at: np.ndarray) -> np.ndarray:
        w = -(z[at] + penalty) * rate / (1 + np.sqrt(seen[at]))
        return np.where(z[at] >= -penalty, 0.0, w)  # weights are not negative

    for _ in range(epochs):
        for low in range(0, n, BATCH):
            chosen = order[low : low + BATCH]
            size = first[chosen + 1] - first[chosen]
            place = np.arange(size.sum()) + np.repeat(first[chosen] - np.cumsum(size) + size, size)
            own = np.repeat(np.arange(len(chosen)), size)
            at, local = np.unique(column[place], return_inverse=True)
            x, g = value[place], grade[chosen]
            w = current(at)
            score = np.bincount(own, w[local] * x, len(chosen))
            edges = np.concatenate([np.full((len(chosen), 1), -np.inf), thresholds - score[:, None], np.full((len(chosen), 1), np.inf)], axis=1)
            below = 1 / (1 + np.exp(-np.clip(edges, -700, 700)))
            below[:, 0], below[:, -1] = 0, 1
            under, over = below[np.arange(len(chosen)), g], below[np.arange(len(chosen)), g + 1]
            gradient = np.bincount(local, (1 - under - over)[own] * x, len(at))
            total = seen[at] + gradient**2
            z[at] += gradient - (np.sqrt(total) - np.sqrt(seen[at])) / rate * w
            seen[at] = total
            chance = np.maximum(over - under, 1e-9)
            move = np.zeros(grades)
            np.add.at(move, g[g > 0] - 1, (under * (1 - under) / chance)[g > 0])
            np.add.at(move, g[g < grades], -(over * (1 - over) / chance)[g < grades])
            seen_t += move**2
            thresholds = np.maximum.accumulate(thresholds - rate * move / np.sqrt(seen_t))
    return current(np.arange(columns)), thresholds


def telling_features(sample: DataFrame) -> np.ndarray:
    """Hashes of the features that are far more frequent in toxic documents, counted on the executors."""
    row = sample.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    bad, every = max(1, row[0]), max(1, row[1])
    good = max(1, every - bad)
    counted = sample.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("toxic").alias("in_bad"), F.count(F.lit(1)).alias("n")
    )
    in_bad, expected = F.col("in_bad"), F.col("n") * F.lit(bad / (bad + good))
    often = (in_bad >= SUPPORT) & (in_bad / bad >= RATIO * (F.col("n") - in_bad) / good)
    found = counted.where(often & (in_bad - expected >= DEVIATIONS * F.sqrt(expected))).select("word").toArrow()
    return np.sort(found["word"].to_numpy())


def severity_grades(row: np.ndarray, value: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Grades 0 to 3 of the sample: thirds of the number of telling features among the toxic."""
    hits = np.bincount(row, np.expm1(value), len(toxic))
    found = hits[toxic & (hits > 0)]
    cuts = np.quantile(found, [1 / 3, 2 / 3]) if len(found) else np.array([np.inf, np.inf])
    return np.where(toxic, 1 + (hits > cuts[0]) + (hits > cuts[1]), 0)


def _chosen(labels: DataFrame, toxic: int, limit: int) -> DataFrame:
    rows = pick(labels, "doc_id", "toxic").select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    known = rows.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return known.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def fit(docs: DataFrame, labels: DataFrame, *, toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS) -> Model:
    """The model of the labelled documents; a document with any toxic label counts as toxic."""
    chosen = materialise(_chosen(labels, 1, toxic_rows).unionByName(_chosen(labels, 0, clean_rows)), "toxicity-sample")
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sample = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")

    def features(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for low, high, row, hashes in chunk_features(batch["text"]):
            row, hashes, value = log_counts(row, hashes)
            lengths = np.bincount(row, minlength=high - low)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"][low:high], batch["toxic"][low:high],
                 kernels.list_array(pa.array(hashes), lengths), kernels.list_array(pa.array(value.astype(np.float32)), lengths)],
                names=["doc_id", "toxic", "words", "logs"],
            )

    schema = "doc_id long, toxic int, words array<long>, logs array<float>"
    table = materialise(by_batch(sample, features, schema), "toxicity-features")
    words = telling_features(table)

    def telling(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lengths = pc.fill_null(pc.list_value_length(batch["words"]), 0).to_numpy()
        row = np.repeat(np.arange(batch.num_rows), lengths)
        kept = np.isin(pc.list_flatten(batch["words"]).to_numpy(), words)
        lengths = np.bincount(row[kept], minlength=batch.num_rows)
        flat = [pc.list_flatten(batch[c]).filter(pa.array(kept)) for c in ("words", "logs")]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["toxic"], *[kernels.list_array(f, lengths) for f in flat]],
            names=["doc_id", "toxic", "words", "logs"],
        )

    # Only the telling features of the sample come to the driver.
    rows = by_batch(table, telling, schema).toArrow()
    if rows.num_rows == 0:
        return Model(np.zeros(0, np.int64), np.zeros(0), np.full(GRADES, 50.0))
    rows = rows.sort_by("doc_id").combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(rows["words"]), 0).to_numpy()
    row = np.repeat(np.arange(rows.num_rows), lengths)
    value = pc.list_flatten(rows["logs"]).to_numpy().astype(float)
    column = np.searchsorted(words, pc.list_flatten(rows["words"]).to_numpy())
    toxic = rows["toxic"].to_numpy() == 1
    grade = severity_grades(row, value, toxic)
    weights, thresholds = fit_ordinal(row, column, value, grade, len(words), GRADES)
    used = weights != 0
    clean = np.bincount(row, weights[column] * value, len(toxic))[~toxic]
    model = Model(words[used], weights[used], thresholds)
    model.clean_lost = float(model.rejected(clean).mean()) if len(clean) else 0.0
    return model


def severity(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, severity (the likeliest grade), expected_severity, p_toxic, toxic``, one row for each row.

    A text is toxic (to be rejected) if it has evidence and ``p_toxic`` is at least ``DECISION``. Null and
    empty texts have no words and get the score of a text without evidence. Equal texts get equal
    results; other columns are ignored.
    """

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        scores = model.scores(batch["text"])
        reach = model.reach(scores)
        edges = np.concatenate([np.ones((len(reach), 1)), reach, np.zeros((len(reach), 1))], axis=1)
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                pa.array(np.argmax(edges[:, :-1] - edges[:, 1:], axis=1).astype(np.int32)),
                pa.array(reach.sum(axis=1)),
                pa.array(reach[:, 0]),
                pa.array(model.rejected(scores)),
            ],
            names=["doc_id", "severity", "expected_severity", "p_toxic", "toxic"],
        )

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return by_batch(rows, score, "doc_id long, severity int, expected_severity double, p_toxic double, toxic boolean")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows whose text is not rejected, with all their columns."""
    place = docs.columns.index("text")

    def keep(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield batch.filter(pa.array(~model.rejected(model.scores(batch.column(place)))))

    held = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return by_batch(held, keep, held.schema).toDF(*docs.columns)
