from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from conftest import EDGES

from reviewmill.llm import bwt, suffix_dedup

COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def result(docs, minimum, gram):
    return sorted((tuple(r) for r in suffix_dedup.remove_repeats(docs, minimum, gram).select(*COLUMNS).collect()), key=repr)


def test_expansion_equals_brute_force():
    rnd = random.Random(5)
    for _ in range(60):
        minimum, letters = rnd.choice([6, 9, 17]), rnd.choice(["ab", "abcdef"])
        strings = []
        for _ in range(rnd.randint(1, 6)):
            s = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 80)))
            strings.append(s + rnd.choice(strings)[5:40] if strings and rnd.random() < 0.6 else s)
        flags = bwt.repeated_starts(np.frombuffer(b"".join(s.encode() + b"\xff" for s in strings), np.uint8), minimum)
        windows = [s[p : p + minimum] for s in strings for p in range(len(s) - minimum + 1)]
        at = 0
        for s in strings:
            for p in range(len(s) - minimum + 1):
                assert flags[at + p] == (windows.count(s[p : p + minimum]) > 1)
            at += len(s) + 1


@pytest.mark.parametrize("seed,many", [(1, 64), (2, 1)])
def test_equals_brute_force(make_docs, corpus, monkeypatch, seed, many):
    monkeypatch.setattr(suffix_dedup, "MANY_STRINGS", many)  # the second run cuts every anchor down first
    rows = corpus(seed) + EDGES
    assert result(make_docs(rows), 40, 6) == brute.suffix_dedup(rows, 40)


def test_production_width(make_docs, corpus):
    rows = [(i, t * 6) for i, t in corpus(3, n=12, length=80)] + EDGES
    assert result(make_docs(rows), suffix_dedup.MINIMUM, suffix_dedup.GRAM) == brute.suffix_dedup(rows, suffix_dedup.MINIMUM)


def test_empty_table(make_docs):
    assert result(make_docs([(1, "x")]).where("doc_id < 0"), 40, 6) == []


@pytest.mark.parametrize("many", [64, 1])
def test_short_periodic_texts(make_docs, monkeypatch, many):
    """A stretch that repeats itself within one segment, which is alone with its anchor."""
    monkeypatch.setattr(suffix_dedup, "MANY_STRINGS", many)
    rnd = random.Random(8)
    line = lambda k: "".join(rnd.choice("abcdefghij ") for _ in range(k))
    rows = [(i, (line(50) * 16)[:size]) for i, size in enumerate([449, 450, 500, 600, 700, 776])]
    rows += [(20, "-" * 450), (21, "x " * 300), (22, line(300) + line(30) * 20 + line(300)), (23, line(776))]
    got = result(make_docs(rows), suffix_dedup.MINIMUM, suffix_dedup.GRAM)
    assert got == brute.suffix_dedup(rows, suffix_dedup.MINIMUM)
    assert [r[2] for r in got if r[0] < 6] == [0, 450, 500, 600, 700, 776]
