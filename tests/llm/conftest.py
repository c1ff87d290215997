from __future__ import annotations

import random

import pytest

#: null, empty, blank, ties, non-ASCII and one-word texts, repeated rows, null ids
EDGES = [
    (None, "a row without an id"),
    (7, None),
    (8, ""),
    (9, "  \n\t "),
    (10, "word"),
    (11, "é😀 ñ ü x"),
    (12, "same text here and there again"),
    (12, "same text here and there again"),
    (13, "same text here and there again"),
]


@pytest.fixture
def make_docs(spark):
    """A documents table from (doc_id, text) with clashing extra columns."""

    def build(rows, partitions=3):
        full = [(i, t, "en", f"s{k % 3}", len(t or ""), "x", "y") for k, (i, t) in enumerate(rows)]
        schema = "doc_id long, text string, lang string, source string, n_chars long, Text string, anchor string"
        return spark.createDataFrame(full, schema).repartition(partitions)

    return build


@pytest.fixture
def corpus():
    """Texts with shared passages, near and exact copies, and a very long repetitive one."""

    def build(seed, n=40, vocabulary=60, length=30):
        rnd = random.Random(seed)
        vocab = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6))) for _ in range(vocabulary)]
        line = lambda k: [rnd.choice(vocab) for _ in range(k)]
        passages = [line(25) for _ in range(3)]
        rows = []
        for i in range(n):
            kind = rnd.random()
            text = line(rnd.randint(0, length))
            if kind < 0.3:
                text = text[:5] + rnd.choice(passages) + text[5:]
            if kind > 0.7 and rows:
                text = (rnd.choice(rows)[1] or "").split(" ")
                if kind > 0.85 and len(text) > 3:
                    text[rnd.randrange(len(text))] = rnd.choice(vocab)
            rows.append((i, " ".join(text)))
        rows.append((n, "ab " * 700))
        return rows

    return build
