from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import EDGES

from reviewmill.llm import token_counts as tc


@pytest.mark.parametrize("block", [3, 64])
def test_documents_equal_direct_counts(make_docs, corpus, block):
    rows = corpus(7, n=30) + EDGES + [(500, "a literal <|endoftext|> is ordinary text")]
    got = tc.document_token_counts(make_docs(rows, 4), block_tokens=block).collect()
    encode = tc.encoder(tc.TOKENIZERS).encode_ordinary
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in got), key=repr) == sorted(((i, len(encode(t or ""))) for i, t in rows), key=repr)
    for file in {r["file"] for r in got}:
        place = 0
        for r in sorted((r for r in got if r["file"] == file), key=lambda r: r["ordinal"]):
            assert r["start"] == place
            place += r["n_tokens"] + 1


def test_plain_files(spark, tmp_path):
    rnd, want = random.Random(1), set()
    for k in range(6):
        ids = [rnd.choice([9, 9, 9, 1, 2]) if k % 2 else rnd.randint(1, 40) for _ in range(rnd.randint(0, 50) if k else 0)]
        (tmp_path / f"f{k}.bin").write_bytes(np.array(ids, "<u2").tobytes())
        start = 0
        ends = [i for i, x in enumerate(ids) if x == 9]
        if ids and ids[-1] != 9:
            ends.append(len(ids))
        for n, e in enumerate(ends):
            want.add((f"f{k}.bin", n, start, e - start))
            start = e + 1
    blocks = tc.read_token_files(spark, str(tmp_path), block_tokens=4)
    got = {(r["file"].rsplit("/")[-1], *tuple(r)[1:]) for r in tc.count_tokens(blocks, end=9, block_tokens=4).collect()}
    assert got == want


def test_empty_table(make_docs):
    assert tc.document_token_counts(make_docs([(1, "x")]).where("doc_id < 0")).collect() == []
