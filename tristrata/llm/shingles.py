"""Hashes of character and word shingles, for all texts of a slice at once."""

from functools import cache

import numpy as np

from tristrata.llm.rows import mix

FACTOR = np.uint64(0x9E3779B97F4A7C15)
HASH_BITS = np.uint64(44)  # two texts of 100,000 shingles share one by chance once in a thousand


@cache
def word_letters() -> np.ndarray:
    """Lower-case code point of every letter and digit, 0 for all else."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if chr(c).isalnum():
            low = chr(c).lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


@cache
def _powers(n: int) -> np.ndarray:
    out = np.full(n, FACTOR)
    out[0] = 1
    return np.cumprod(out)


def word_hashes(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word (run of letters and digits, case ignored) and the text it is in."""
    letters = word_letters()[points].astype(np.uint64)
    inside = letters != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = starts[:-1][starts[:-1] < len(points)]
    begins[edges] = inside[edges]
    at = np.flatnonzero(begins)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    place = np.zeros(len(points), np.int64)
    place[at[0] :] = np.arange(at[0], len(points)) - np.repeat(at, np.diff(np.append(at, len(points))))
    place[~inside] = 0
    size = 1 << int(place.max() + 1).bit_length()
    hashes = mix(np.add.reduceat(letters * _powers(size)[place], at), 1)
    return hashes, np.searchsorted(starts, at, side="right") - 1


def word_shingles(points: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every run of ``n`` words and its text; a text of fewer words is one shingle."""
    words, owner = word_hashes(points, starts)
    if not len(words):
        return words, owner
    m = max(0, len(words) - n + 1)
    joined = words[:m].copy()
    for k in range(1, n):
        joined = joined * FACTOR + words[k : m + k]
    whole = owner[:m] == owner[n - 1 : m + n - 1]
    hashes, texts = mix(joined[whole], 2), owner[:m][whole]
    first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    count = np.diff(np.append(first, len(words)))
    short = count < n
    if short.any():
        few = []
        for i, c in zip(first[short].tolist(), count[short].tolist()):
            h = np.uint64(c)
            for w in words[i : i + c]:
                h = np.uint64((int(h) * int(FACTOR) + int(w)) % 2**64)
            few.append(h)
        hashes = np.concatenate([hashes, mix(np.array(few, np.uint64), 3)])
        texts = np.concatenate([texts, owner[first[short]]])
        order = np.argsort(texts, kind="stable")
        hashes, texts = hashes[order], texts[order]
    return hashes, texts


def rolling(points: np.ndarray, n: int, kind: type = np.uint64) -> np.ndarray:
    """A polynomial of every run of ``n`` values, by doubling the runs' length; runs may span texts."""
    factor = int(FACTOR) % 2 ** (8 * np.dtype(kind).itemsize)
    power, run, size = factor, points.astype(kind), 1
    out, width = None, 0
    while True:
        if n & size:
            m = max(0, len(points) - width - size + 1)
            out = run[:m].copy() if out is None else out[:m] * kind(power) + run[width : width + m]
            width += size
        if width == n:
            return out
        m = max(0, len(run) - size)
        run = run[:m] * kind(power) + run[size:]
        power = power * power % 2 ** (8 * np.dtype(kind).itemsize)
        size *= 2


def char_shingles(points: np.ndarray, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every run of ``n`` characters and its text; a shorter text has none."""
    joined = rolling(points, n)
    m = len(joined)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    whole = owner[:m] == owner[n - 1 : m + n - 1]
    return mix(joined[whole], 4), owner[:m][whole]


def multisets(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of each text, how often each occurs, and the text; ordered by text and hash.

    Hashes are cut to ``HASH_BITS``, so that a text (below a million) and a hash are one sortable value.
    """
    keys = np.sort(owner.astype(np.uint64) << HASH_BITS | hashes >> (np.uint64(64) - HASH_BITS))
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    counts = np.diff(np.append(new, len(keys)))
    keys = keys[new]
    return keys & ((np.uint64(1) << HASH_BITS) - np.uint64(1)), counts, (keys >> HASH_BITS).astype(np.int64)
