"""Repeated word windows by level-wise doubling.

Windows are compared at a short length first; only those that at least two
documents have are extended to twice the length, whose two halves must both
have survived, until the full window or until no candidate survives.  The
first level is sparse across the corpus: a window's anchor (see ``repeats``);
then, among the pieces around repeated anchors, every short window, its
double, and so on up to the full window.  Levels compare hashes, which never
part equal windows; full windows that are left are compared word by word.
What an earlier document has is removed, and a document never removes words
from itself.

Defined cases: null text has no words; texts with fewer words than the
window and empty tables lose nothing.  Windows are judged on the input.
Rows of one doc_id never remove words from each other; a null doc_id is the
smallest.  A very long text is read slice by slice and its pieces are spread
like any others; words of any length are compared whole.  Other columns are not
read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolens.llm.common import SpanHash, mix64, word_hashes, word_numbers
from repolens.llm.repeats import SPLIT, Pieces, identified, merged, repeated_spans, unpacked, with_spans, word_anchors

WINDOW = 50
GRAM = 13


def levels(gram: int, window: int) -> list[int]:
    out = [gram]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def least_document(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry, the smallest and the largest doc among those with its key."""
    order = np.lexsort((docs, keys))
    k, d = keys[order], docs[order]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    sizes = np.diff(np.append(first, len(k)))
    low, high = np.empty_like(docs), np.empty_like(docs)
    low[order] = np.repeat(d[first], sizes)
    high[order] = np.repeat(d[first + sizes - 1], sizes)
    return low, high


def same_windows(numbers: np.ndarray, at: np.ndarray, keys: np.ndarray, window: int, step: int = 1 << 16) -> np.ndarray:
    """``keys`` of the windows that start at ``at``, made exact: each window is compared
    with the first of its key by the words' numbers; if any differs, by all words."""
    _, first, same = np.unique(keys, return_index=True, return_inverse=True)
    lead, reach = at[first[same]], np.arange(window)
    for i in range(0, len(at), step):
        if (numbers[at[i:i + step, None] + reach] != numbers[lead[i:i + step, None] + reach]).any():
            exact = np.ascontiguousarray(numbers[at[:, None] + reach]).view(f"V{8 * window}").ravel()
            return np.unique(exact, return_inverse=True)[1].astype(np.uint64)
    return keys


def _method(window: int, gram: int):
    def run(some: Pieces):
        data, _, starts, ends, piece, units = word_hashes(pa.array(some.contents, pa.binary()), lower=False)
        bounds = np.searchsorted(piece, np.arange(len(some.contents) + 1))
        docs = some.docs[piece]
        place, spans = np.arange(len(units)) - bounds[piece], SpanHash(units)
        anchors = spans(bounds[:-1] + some.leads, bounds[:-1] + some.leads + gram)
        with np.errstate(over="ignore"):
            # equal windows have equal anchors at equal distances
            group = anchors[piece] ^ mix64((place - some.leads[piece]).astype(np.uint64) + np.uint64(1 << 40))
        room = bounds[piece + 1]
        alive, short = np.ones(len(units), bool), 0
        for length in levels(gram, window):
            hashes = spans.grams(length)
            at = np.flatnonzero(alive[:len(hashes)] & (np.arange(len(hashes)) + length <= room[:len(hashes)]))
            if short:
                at = at[alive[at + length - short]]
            keys = mix64(hashes[at] ^ group[at])
            low, high = least_document(keys, docs[at]) if len(at) else (at, at)
            if length == window and (low < high).any():
                keep = low < high
                at = at[keep]
                low, high = least_document(same_windows(word_numbers(data, starts, ends), at, keys[keep], window), docs[at])
            alive, short = np.zeros(len(units), bool), length
            alive[at[low < high]] = True
            if not alive.any():
                return (np.zeros(0, np.int64),) * 3
        gone = at[docs[at] > low]
        pieces, first, many = np.unique(piece[gone], return_index=True, return_counts=True)
        return pieces, place[gone][first], place[gone][first + many - 1] + window
    return run


def _kept(batches):
    for batch in unpacked(batches):
        data, _, starts, ends, rows, _ = word_hashes(batch.column(1), lower=False)
        bounds = np.searchsorted(rows, np.arange(batch.num_rows + 1))
        raw, out = data.tobytes(), []
        for i, blobs in enumerate(batch.column(2).to_pylist()):
            a, b = merged(blobs)
            keep = np.ones(bounds[i + 1] - bounds[i], bool)
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                keep[x:y] = False
            s, e = starts[bounds[i]:bounds[i + 1]][keep], ends[bounds[i]:bounds[i + 1]][keep]
            text = b" ".join([raw[x:y] for x, y in zip(s.tolist(), e.tolist(), strict=True)])
            out.append((len(keep), len(keep) - len(s), hashlib.sha256(text).hexdigest()))
        columns = list(zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in columns[:2]), pa.array(columns[2], pa.string())],
                                         ["doc_id", "n_words", "n_removed", "kept_sha256"])


def remove_repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, split: int = SPLIT) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    docs = identified(docs, id_col, text_col)
    spans = repeated_spans(docs, word_anchors(window, gram), window, gram, False, _method(window, gram), split)
    out = with_spans(docs, spans).mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")))
