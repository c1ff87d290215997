from __future__ import annotations

import hashlib
import random

import pytest
from conftest import EDGES

from reviewmill.llm import fingerprints as fp


def test_extensions_equal_brute_force():
    rnd = random.Random(2)
    for _ in range(40):
        a = "".join(rnd.choice("abé😀") for _ in range(rnd.randint(1, 60)))
        b = a[rnd.randrange(len(a)) :] + "".join(rnd.choice("ab") for _ in range(9))
        left, right = fp.PrefixArrays(fp.code_points(a)), fp.PrefixArrays(fp.code_points(b))
        for _ in range(10):
            i, j = rnd.randrange(len(a)), rnd.randrange(len(b))
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            assert fp.common_extension(left, i, right, j) == n


@pytest.mark.parametrize("rows", ["many", "edges", "one", "nulls", "skewed"])
def test_neighbours_equal_brute_force(spark, make_docs, corpus, rows):
    data = {
        "many": [(i * 3, t) for i, t in corpus(9, n=60, length=120)],
        "edges": [r for r in EDGES if r[0] is not None] + [(-5, "first of all, with a text that is longer than a span")],
        "one": [(5, "abcdefg")],
        "nulls": [(None, "alone without an id, but with a text"), (1, "another text, the first that has an id")],
        "skewed": [(None if i % 3 == 0 else i % 7, t * (200 if i % 10 == 0 else 1)) for i, t in corpus(4, n=90, length=40)] + [(2, "again")] * 3,
    }[rows]
    got = fp.neighbour_fingerprints(make_docs(data, 4), part_bytes=4096).collect()
    hashes = {(r["doc_id"], r["text"]): r["row_hash"] for r in fp.keyed_texts(make_docs(data)).collect()}
    order = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r]))
    want = []
    for k, (i, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        e = t[: len(t) - half] + n[:half]
        a, b, c = fp.Fingerprint(t), fp.Fingerprint(e), fp.Fingerprint(n)
        assert (str(a) == str(b)) == (t == e) and (a.likeness(b) == 1) == (t == e)
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), str(a), str(b), a.likeness(b), a.likeness(c)))
    assert sorted((tuple(r)[:7] for r in got), key=repr) == sorted(want, key=repr)


def test_parts_follow_bytes(spark, make_docs, corpus):
    """Null ids, one id held by a third of the rows, and skewed lengths are spread over parts of equal bytes."""
    texts = [t for _, t in corpus(8, n=900, length=60)]
    data = [(None if k % 3 == 0 else 5 if k % 3 == 1 else k, t * (20 if k % 50 == 0 else 1)) for k, t in enumerate(texts)]
    keyed = fp.keyed_texts(make_docs(data, 4))
    starts = fp.part_starts(keyed, part_bytes=1 << 14)
    assert starts == sorted(set(starts)) and sum(not s[0] for s in starts) > 5 and sum(s[:2] == (True, 5) for s in starts) > 5
    held = [0] * len(starts)
    for r in keyed.collect():
        part = fp.bisect_right(starts, (r["doc_id"] is not None, r["doc_id"] or 0, r["row_hash"])) - 1
        held[part] += len(r["text"].encode()) + fp.ROW_BYTES
    longest = max(len(t.encode()) for _, t in data) + fp.ROW_BYTES
    assert max(held) <= (1 << 14) + longest
    assert len(held) <= sum(held) / (1 << 14) + 1  # a row longer than a part leaves fewer


def test_every_part_has_a_task(spark, make_docs, corpus):
    data = [(i, t) for i, t in corpus(8, n=300, length=60)]
    starts = fp.part_starts(fp.keyed_texts(make_docs(data, 4)), part_bytes=8192)
    out = fp.neighbour_fingerprints(make_docs(data, 4), part_bytes=8192)
    found = out.select("doc_id", fp.F.spark_partition_id().alias("task")).collect()
    assert len(starts) > 8 and len({r["task"] for r in found}) == len(starts)


def test_likeness(make_docs, corpus):
    text = " ".join(t for _, t in corpus(3, n=30, length=80))
    near = fp.Fingerprint(text).likeness(fp.Fingerprint(text[:200] + "X" + text[201:]))
    far = fp.Fingerprint(text).likeness(fp.Fingerprint(text[::-1]))
    assert 0.9 < near < 1 and far < 0.2
    assert fp.Fingerprint("").likeness(fp.Fingerprint("")) == 1 and fp.Fingerprint("").likeness(fp.Fingerprint("a")) == 0


def test_empty_table(make_docs):
    assert fp.neighbour_fingerprints(make_docs([(1, "x")]).where("doc_id < 0")).collect() == []
