"""Plain single-process versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def runs(flags):
    return sum(1 for i, f in enumerate(flags) if f and (i == 0 or not flags[i - 1]))


def suffix_dedup(rows, minimum):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[p : p + minimum] for _, t in texts for p in range(len(t) - minimum + 1))
    out = []
    for i, t in texts:
        gone = [False] * len(t)
        for p in range(len(t) - minimum + 1):
            if seen[t[p : p + minimum]] > 1:
                gone[p : p + minimum] = [True] * minimum
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), runs(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def substring_dedup(rows, width):
    first = {}
    split = [(i, words(t)) for i, t in rows]
    for i, ws in split:
        for p in range(len(ws) - width + 1):
            key = tuple(ws[p : p + width])
            if i is not None and (key not in first or i < first[key]):
                first[key] = i
    out = []
    for i, ws in split:
        gone = [False] * len(ws)
        for p in range(len(ws) - width + 1):
            key = tuple(ws[p : p + width])
            if i is not None and first[key] < i:
                gone[p : p + width] = [True] * width
        kept = " ".join(w for w, g in zip(ws, gone, strict=True) if not g)
        out.append((i, len(ws), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def shingles(text, size=5):
    ws = words(text)
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[p : p + size]) for p in range(max(1, len(ws) - size + 1)))


def near_duplicates(rows, threshold=0.8):
    """(id, smallest id of the class, links) of each row; links count rows, copies among them."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and len(x & y) >= threshold * len(x | y):
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(rows[k][0])
    return sorted((rows[k][0], min(groups[find(k)]), links[k]) for k in range(len(rows)))


def base_counts(text):
    ws, text = words(text), text or ""
    windows = [tuple(ws[p : p + 8]) for p in range(len(ws) - 7)]
    seen = Counter(windows)
    hit = [False] * len(ws)
    for p, w in enumerate(windows):
        if seen[w] > 1:
            hit[p : p + 8] = [True] * 8
    lines = [line for line in text.split("\n") if words(line)]
    return len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), sum(hit)


def divergence(rows, least_documents=30, top=50):
    """Rows (lang, source, part, item, value, rank) of op 12 from (lang, source, text)."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")) for lang, source, text in rows]
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    docs = [(lang, source, [t.translate(lower) for t in terms]) for lang, source, terms in docs]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in held.items() if n >= least_documents)

        def parts(texts):
            n = Counter(t for d in texts for t in d[2])
            total = sum(n[t] for t in kept)
            return n, {t: 1 + 1000000000 * (n[t] + 5) // (total + 5 * len(kept)) for t in kept}

        _, whole = parts(own)
        groups = {source: parts([d for d in own if d[1] == source]) for source in {d[1] for d in own}}
        for source, (n, p) in groups.items():
            pairs = [(sum(abs(p[t] - q[t]) for t in kept), other) for other, (_, q) in groups.items() if other != source]
            terms = [(p[t] - whole[t], t) for t in kept if n[t] > 0 and p[t] > whole[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


def hard_negatives(rows, every=50):
    """Rows of op 11 from (vec_id, vector, label)."""
    held = {}
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        whole = tuple(math.floor(256 * x) for x in vector)
        held[(vec_id, label, whole)] = None
    held = list(held)
    out = []
    for anchor in held:
        if anchor[0] % every:
            continue
        scored = [(-sum(a * b for a, b in zip(anchor[2], row[2])), row[0], row) for row in held if row is not anchor]
        scored.sort(key=lambda x: x[:2])
        for p, p_id, _ in [s for s in scored if s[2][1] == anchor[1]][:5]:
            fits = [s for s in scored if s[2][1] != anchor[1] and 50 * -p <= 100 * -s[0] <= 95 * -p][:3]
            out += [(anchor[0], p_id, i + 1, s[1], -p, -s[0]) for i, s in enumerate(fits)]
    return sorted(out)


def embedding_links(rows, cosine=0.93):
    """Rows (vec_id, n_links, component_id, kept) of op 13 from (vec_id, vector, label)."""
    def unit(vector):
        if vector is None or any(x is None or not math.isfinite(x) for x in vector) or not any(vector):
            return None
        v = np.array(list(vector) + [0.0] * (8 - len(vector)))
        return v / np.linalg.norm(v)

    units = [unit(v) for _, v, _ in rows]
    near = [
        [j for j in range(len(rows)) if j != i and units[i] is not None and units[j] is not None and rows[i][2] is not None and rows[i][2] == rows[j][2] and units[i] @ units[j] >= cosine]
        for i in range(len(rows))
    ]
    out = []
    for i, row in enumerate(rows):
        seen, pending = {i}, [i]
        while pending:
            for j in near[pending.pop()]:
                if j not in seen:
                    seen.add(j)
                    pending.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((row[0], len(near[i]), least, row[0] == least))
    return sorted(out, key=repr)
