"""64-bit hashes of word shingles, computed on whole Arrow batches.

Words are runs of non-blank bytes after lower-casing A-Z. A word's hash is a
polynomial of its bytes modulo 2^64, taken from prefix sums (so there is no
Python loop over words), then mixed; a shingle's hash mixes its words' hashes
in order.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 20  # bytes hashed at a time; bounds the temporary arrays
BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_blank = np.zeros(256, bool)
_blank[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_value = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
_value[65:91] = _value[97:123]

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        inverse = np.uint64(pow(int(BASE), -1, 2**64))
        for k, p in (("up", BASE), ("down", inverse)):
            t = np.full(n, p, np.uint64)
            t[0] = 1
            _powers[k] = np.multiply.accumulate(t)
    return _powers["up"], _powers["down"]


def _block_words(raw: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of ``raw``; no word crosses a limit."""
    blank = _blank[raw]
    first = ~blank
    first[1:] &= blank[:-1] | np.isin(np.arange(1, len(raw)), limits, assume_unique=True) if len(limits) else blank[:-1]
    last = ~blank
    last[:-1] &= blank[1:] | first[1:]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _tables(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_value[raw] * up[:len(raw)], out=total[1:])
    h = (total[end] - total[start]) * down[start]
    return start, mix(h + (end - start).astype(np.uint64) * BASE)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a batch, and the n + 1 word offsets of its texts."""
    starts, hashes, at = [], [], 0
    while at < len(raw):
        end = min(at + BLOCK, len(raw))
        if end < len(raw):  # up to a text's end or a blank
            cut = offsets[np.searchsorted(offsets, end)]
            blank = np.flatnonzero(_blank[raw[at:end]])
            inner = offsets[np.searchsorted(offsets, end, "right") - 1]
            if inner > at:
                end = inner
            elif len(blank):
                end = at + blank[-1] + 1
            else:
                rest = np.flatnonzero(_blank[raw[end:cut]])
                end = end + rest[0] + 1 if len(rest) else cut
        inside = offsets[(offsets > at) & (offsets < end)] - at
        s, h = _block_words(raw[at:end], np.unique(inside))
        starts.append(s + at)
        hashes.append(h)
        at = end
    if not starts:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and
    the n + 1 offsets. A text of fewer than ``width`` words but at least one
    has the whole sequence as its shingle; one without words has none."""
    words, at = word_hashes(raw, offsets)
    n_words = np.diff(at)
    count = np.where(n_words >= width, n_words - width + 1, (n_words > 0).astype(np.int64))
    to = np.concatenate([[0], np.cumsum(count)])
    doc = np.repeat(np.arange(len(count)), count)
    first = at[:-1][doc] + (np.arange(to[-1]) - to[:-1][doc])
    stop = at[1:][doc]
    h = np.full(to[-1], width, np.uint64)
    for j in range(width):
        here = first + j
        inside = here < stop
        w = words[np.minimum(here, max(len(words) - 1, 0))] if len(words) else h
        h = np.where(inside, mix(h * BASE + w), h)
    for i in np.flatnonzero(count > 1):
        h[to[i]:to[i + 1]].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    sizes = np.bincount(doc[keep], minlength=len(count)) if len(doc) else np.zeros(len(count), np.int64)
    return h[keep], np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
