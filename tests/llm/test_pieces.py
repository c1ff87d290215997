from __future__ import annotations

import random

import numpy as np
import pytest
import sentencepiece
from conftest import EDGES

from reviewmill.llm import pieces as pc


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pc.model_path())


def test_equals_the_library(library):
    rnd, own = random.Random(3), pc.pieces(pc.model_path())
    letters = "aabbcetthhe  \n\tiéß😀中▁.,'xyzQU"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 50))) for _ in range(800)]
    texts += ["a" * 5000, "abcdefgh" * 900, "the" * 3000, " " * 300, "x" + " " * 40 + "y"]
    for text in texts:
        assert own.encode(text).tolist() == library.encode(text)


def test_ids_are_committed_before_the_text_ends():
    own = pc.Pieces(pc.model_path())
    text = "".join(random.Random(1).choice("etaoinshr") for _ in range(20000))
    stream = own.search(text)
    first = [next(stream) for _ in range(5)]
    assert "".join(first) == text[: sum(map(len, first))]
    kept = len(stream.gi_frame.f_locals["survivors"])
    assert kept <= 8 * own.longest


def test_round_trip(make_docs, corpus, library):
    rows = corpus(8, n=30) + EDGES
    docs = make_docs(rows)
    encoded = pc.encode_documents(docs)
    got = encoded.collect()
    assert all(r["round_trip"] for r in got)
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=repr) == sorted(((i, library.encode(t or "")) for i, t in rows), key=repr)
    back = pc.decode_documents(encoded).collect()
    assert sorted((tuple(r) for r in back), key=repr) == sorted(((i, t or "") for i, t in rows), key=repr)
    assert pc.encode_documents(docs.where("doc_id < 0")).collect() == []
    assert np.array_equal(pc.pieces(pc.model_path()).encode(""), [])


def test_a_remembered_stretch_is_not_searched_again(library, monkeypatch):
    own = pc.Pieces(pc.model_path())
    stretch = pc.SPACE + "remembered,"
    ids = tuple(library.encode("remembered,"))
    own.older = {stretch: ids}

    def fail(part):
        raise AssertionError(part)

    monkeypatch.setattr(own, "search", fail)
    assert own.encode("remembered, remembered,").tolist() == list(ids * 2)
    assert own.known[stretch] == ids


def test_decodes_parts_of_characters(library):
    own = pc.pieces(pc.model_path())
    for text in ("plain\n\tlines\r", "\U0001f600", "a \U0001f600\x00b\n", "  two  ", "\x7f\x80"):
        ids = np.array(library.encode(text), np.int32)
        assert own.decode(ids) == text
    broken = np.array([own.raw[0xE4], own.raw[0x0A], own.raw[0xB8]], np.int32)
    assert own.decode(broken) == b"\xe4\n\xb8".decode(errors="replace")
