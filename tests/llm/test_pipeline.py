"""Every stage of the pipeline against a plain version, each on what the stage before kept."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import brute
import pytest
import sentencepiece

import corpus_pipeline
from reviewmill.llm import pieces

BAD = ["grot", "flek", "snarl", "vuil"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(3)
    vocab = ["".join(rnd.choice("abcdefé") for _ in range(rnd.randint(2, 6))) for _ in range(500)]
    line = lambda k: [rnd.choice(vocab) for _ in range(k)]
    passage, rows, labels = line(130), [], []
    for i in range(300):
        text = line(rnd.randint(5, 90))
        if i % 10 == 7:
            text = text + passage + line(40)
        if i % 10 == 3:
            text = rows[rnd.randrange(len(rows))][1].split(" ")
            if i % 20 == 3 and len(text) > 60:
                text[rnd.randrange(len(text))] = "changed"
        toxic = i % 6 == 0
        for _ in range(3 if toxic else 0):
            text.insert(rnd.randrange(len(text)), rnd.choice(BAD))
        rows.append((i, " ".join(text), "en", f"s{i % 4}", len(" ".join(text))))
        if i < 200:
            labels.append((i, 1, int(any(w in BAD for w in text))))
    rows += [(400, None, "en", "s1", 0), (401, "", None, None, 0)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, out[-1], folder).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns(stages):
    for df in stages[1:5]:
        assert dict(df.dtypes) == dict(stages[0].dtypes)


def test_toxicity(stages):
    before = texts(stages[0])
    assert set(texts(stages[1])) == {i for i, t in before.items() if not set(brute.words(t)) & set(BAD)}


def test_near_duplicates(stages):
    before = texts(stages[1])
    assert texts(stages[2]) == {c: before[c] for _, c, _ in brute.near_duplicates(sorted(before.items()))}


def test_repeats(stages):
    before, after = texts(stages[2]), texts(stages[3])
    rows = sorted(before.items())
    want = {i: removed for i, _, removed, _, _ in brute.suffix_dedup(rows, 400)}
    assert set(after) == set(before) and any(want.values())
    for i, t in rows:
        lost = len((t or "").encode()) - len((after[i] or "").encode())
        assert want[i] <= lost <= want[i] + 8


def test_mixing(stages):
    before, taken = texts(stages[3]), Counter()
    per_source, sources = Counter(), defaultdict(Counter)
    for r in stages[4].collect():
        assert set(brute.words(r["text"])) <= set(brute.words(before[r["doc_id"]])) and r["n_chars"] == len(r["text"])
        taken[r["doc_id"]] += len(brute.words(r["text"]))
        per_source[r["source"]] += len(brute.words(r["text"]))
    for r in stages[3].collect():
        sources[r["source"]]["size"] += len(brute.words(r["text"]))
        assert taken[r["doc_id"]] <= 2 * len(brute.words(r["text"]))
    assert abs(sum(per_source.values()) - 1.5 * sum(s["size"] for s in sources.values())) < 64 * len(sources)


def test_ids(stages):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    want = Counter((r["doc_id"], tuple(library.encode(r["text"]))) for r in stages[4].collect())
    got = stages[5].collect()
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want and all(r["round_trip"] for r in got)


def test_run(spark, folder, stages):
    want = Counter((r["doc_id"], tuple(r["ids"])) for r in stages[5].collect())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, folder).collect()) == want


def applied(spark, docs, folder, tmp_path_factory):
    """Every stage on what the stage before kept, as tables that are written and read again."""
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("odd") / "part")
        stage(spark, out[-1], folder).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_clashing_names_repeated_rows_and_a_very_long_text(spark, folder, tmp_path_factory):
    rnd = random.Random(9)
    long = " ".join(f"w{rnd.randrange(10**6)}" for _ in range(150_000))  # more than a megabyte
    rows = [(i, " ".join(f"v{rnd.randrange(10**5)}" for _ in range(40)), "en", f"s{i % 2}", 0, "T", 5, b"h", 1) for i in range(40)]
    rows += [(900, long, "en", "s1", 0, "T", 5, b"h", 1), rows[3], rows[3], (3, rows[3][1], "en", "other", 0, "T", 5, b"h", 1)]
    rows += [(901, None, None, None, None, None, None, None, None), (902, "", "en", "s1", 0, "T", 5, b"h", 1), (902, "", "en", "s1", 0, "T", 5, b"h", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, Text string, doc_ID int, own_hash binary, spans int"
    clean, single, short, mixed, encoded = applied(spark, spark.createDataFrame(rows, schema).repartition(3), folder, tmp_path_factory)[1:]
    for df in (clean, single, short):
        assert df.columns == list(corpus_pipeline.COLUMNS)
    assert clean.count() == len(rows)
    ids = sorted(r["doc_id"] for r in single.collect())
    assert ids == [*range(40), 900, 901, 902]
    assert texts(short)[900] == long and texts(short)[901] is None
    taken = {r["doc_id"] for r in mixed.collect()}
    assert 901 not in taken and 902 not in taken and 900 in taken
    assert encoded.where("round_trip").count() == mixed.count()


def test_empty_table(spark, folder, tmp_path_factory):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 0")
    assert [df.count() for df in applied(spark, docs, folder, tmp_path_factory)] == [0] * 6
