from __future__ import annotations

import brute
import pytest
from conftest import EDGES

from reviewmill.llm import graph_dedup


def result(docs, width, gram):
    found = graph_dedup.remove_repeats(docs, width, gram).select("doc_id", "n_words", "n_removed", "kept_sha256")
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(make_docs, corpus, seed):
    rows = corpus(seed, n=60, vocabulary=15 if seed == 3 else 60) + EDGES
    assert result(make_docs(rows), 8, 3) == brute.substring_dedup(rows, 8)


def test_production_width(make_docs, corpus):
    rows = [(i, t * 4) for i, t in corpus(5, n=25, length=120)] + EDGES
    assert result(make_docs(rows), graph_dedup.WIDTH, graph_dedup.GRAM) == brute.substring_dedup(rows, graph_dedup.WIDTH)


def test_sources_hold_the_span(make_docs, corpus):
    rows = [(i, t) for i, t in corpus(2, n=60)]
    words = {i: brute.words(t) for i, t in rows}
    spans = graph_dedup.repeated_spans(make_docs(rows), 8, 3).collect()
    assert spans
    for s in spans:
        size = s["b"] - s["a"]
        assert s["source_id"] < s["doc_id"]
        assert words[s["doc_id"]][s["a"] : s["b"]] == words[s["source_id"]][s["source_at"] : s["source_at"] + size]


def test_empty_table(make_docs):
    assert result(make_docs([(1, "x")]).where("doc_id < 0"), 8, 3) == []
