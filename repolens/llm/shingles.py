"""Word shingles of texts as 64-bit hashes.

Words are the maximal runs of ``[^\\x20\\x09-\\x0D]`` with A-Z lower-cased.  A
text with fewer than ``size`` words has one shingle, all its words; one
without words has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from repolens.llm.common import mix64, word_hashes

_STEP = np.uint64(0x9FB21C651E98DF25)


def shingle_sets(column: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """All rows' distinct shingles, sorted within a row, and the rows' offsets."""
    _, offsets, _, _, rows, hashes = word_hashes(column, lower=True)
    bounds = np.searchsorted(rows, np.arange(len(offsets)))
    with np.errstate(over="ignore"):
        if len(hashes) >= size:
            run = np.zeros(len(hashes) - size + 1, np.uint64)
            for k in range(size):
                run = run * _STEP + hashes[k:len(hashes) - size + 1 + k]
            run = mix64(run + np.uint64(size))
        else:
            run = np.zeros(0, np.uint64)
        sets, lengths = [], np.zeros(len(offsets) - 1, np.int64)
        for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            if b - a >= size:
                s = np.sort(run[a:b - size + 1])
                s = s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif b > a:
                s = np.zeros(1, np.uint64)
                for h in hashes[a:b]:
                    s = s * _STEP + h
                s = mix64(s + np.uint64(b - a))
            else:
                continue
            sets.append(s)
            lengths[i] = len(s)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.concatenate(([0], np.cumsum(lengths)))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())
