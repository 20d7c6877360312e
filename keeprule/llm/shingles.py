"""Word shingles as 64-bit hashes, for many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from keeprule.llm.common import BLANKS, text_bytes

WINDOW = 5
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[ord(c) for c in BLANKS]] = True
LOWER = np.arange(256, dtype=np.uint64)
LOWER[ord("A") : ord("Z") + 1] += 32
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2 ** 64
INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    if n:
        steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word (A-Z in lower case) of all texts in order, and the number of words of each text.

    A word's hash comes from sums over the bytes up to its end and up to its start.
    """
    data, offsets = text_bytes(texts)
    inside = ~IS_BLANK[data]
    starts_here = offsets[:-1][np.diff(offsets) > 0]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[starts_here] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[starts_here[1:] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((LOWER[data] + np.uint64(1)) * _powers(BASE, len(data)), dtype=np.uint64, out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _powers(INVERSE, len(data))[starts])
    counts = np.diff(np.searchsorted(starts, offsets))
    return hashes, counts


def shingle_sets(texts: pa.Array, window: int = WINDOW) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: windows of words, or all words where they are fewer."""
    hashes, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    rolling = hashes[: max(0, len(hashes) - window + 1)].copy()
    for k in range(1, window):
        rolling = rolling * np.uint64(BASE) + hashes[k : k + len(rolling)]
    rolling = mix(rolling)
    sets = []
    for end, n in zip(ends.tolist(), counts.tolist(), strict=True):
        if n >= window:
            sets.append(np.unique(rolling[end - n : end - window + 1]))
        elif n:
            whole = np.uint64(n)
            for h in hashes[end - n : end]:
                whole = np.bitwise_xor(whole, h)
                whole = mix(np.array([whole]))[0]
            sets.append(np.array([whole], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """How many values two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())
