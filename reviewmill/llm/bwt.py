"""Repeated substrings of a bounded set of strings by interval expansion on a Burrows-Wheeler transform.

The suffixes are put in order, the transform is read off, and intervals of suffixes that share a
prefix are extended backwards by one byte, breadth first. Every level settles the boundaries whose
common prefix has just that length, so common prefixes appear by increasing value. The expansion
stops at the minimum length; boundaries that are still open then have at least that much in common.
"""

from __future__ import annotations

import numpy as np

#: ends every string; no byte of UTF-8
END = 0xFF
SEED_BYTES = 5


def sorting_order(keys: np.ndarray, key_bits: int) -> np.ndarray:
    """Stable order of non-negative keys. Where key and index fit one word they are sorted as one
    number, which is several times faster than an indirect sort and gives the same order."""
    index_bits = max(1, int(len(keys)).bit_length())
    if key_bits + index_bits > 63:
        return np.argsort(keys, kind="stable")
    joined = (keys.astype(np.int64, copy=False) << index_bits) | np.arange(len(keys))
    joined.sort()
    return joined & ((1 << index_bits) - 1)


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their next ``depth`` bytes or more, and the groups of equal first bytes.

    The first sort compares five bytes at once; each further one doubles the length that is
    settled, for the positions that are still tied. Ties beyond ``depth`` stay in any order.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(SEED_BYTES, np.uint8)])
    key = np.zeros(n, np.int64)
    for k in range(SEED_BYTES):
        key = (key << 8) | padded[k : k + n]
    order = sorting_order(key, 8 * SEED_BYTES)
    ranked = key[order]
    new = np.ones(n, bool)
    new[1:] = ranked[1:] != ranked[:-1]
    seeds = np.flatnonzero(new)
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[n] = 0
    rank[order] = first + 1
    alone = new & np.append(new[1:], True)
    slots = np.flatnonzero(~alone)
    length, bits = SEED_BYTES, (n + 1).bit_length()
    while length < depth and len(slots):
        tied = order[slots]
        pair = (rank[tied] << bits) | rank[np.minimum(tied + length, n)]
        by = sorting_order(pair, 2 * bits)
        tied, pair = tied[by], pair[by]
        order[slots] = tied
        new = np.ones(len(slots), bool)
        new[1:] = pair[1:] != pair[:-1]
        rank[tied] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))] + 1
        slots = slots[~(new & np.append(new[1:], True))]
        length *= 2
    return order, seeds


def repeated_starts(text: np.ndarray, minimum: int) -> np.ndarray:
    """Which positions start ``minimum`` bytes that also start at another position.

    ``text`` holds strings that end in ``END``. Starts whose bytes run past their string's end are
    not reported as such: the caller looks at whole windows only.
    """
    n = len(text)
    if n <= minimum:
        return np.zeros(n, bool)
    order, seeds = suffix_order(text, minimum)
    position = np.empty(n, np.int64)
    position[order] = np.arange(n)
    transform = text[order - 1]  # the byte before each suffix
    before = position[order - 1]  # where the suffix that starts there stands in the order

    settled = np.zeros(n + 1, bool)  # boundary i: between places i - 1 and i of the order
    settled[seeds] = settled[n] = True  # these share less than the seed's length
    low, high = seeds, np.append(seeds[1:], n)
    for _ in range(SEED_BYTES, minimum):
        if not len(low):
            break
        size = high - low
        interval = np.repeat(np.arange(len(low)), size)
        place = np.arange(len(interval)) + np.repeat(low - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        byte = transform[place]
        inner = byte != END
        interval, byte, target = interval[inner], byte[inner], before[place[inner]]
        if not len(target):
            break
        by = sorting_order(target, n.bit_length())
        target = target[by]
        group = interval[by] * 256 + byte[by]
        cut = np.flatnonzero(group[1:] != group[:-1]) + 1
        low, high = target[np.concatenate([[0], cut])], target[np.concatenate([cut - 1, [len(target) - 1]])] + 1
        fresh = ~settled[high]
        low, high = low[fresh], high[fresh]
        settled[high] = True
    flags = np.zeros(n, bool)
    flags[order] = ~settled[:-1] | ~settled[1:]
    return flags
