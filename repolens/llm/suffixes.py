"""Repeated byte strings by column-wise construction over many documents.

Pieces of documents that may share a window (see ``repeats``) are ordered by
their suffixes, one column a round from the last to the first: the round's
symbols, read in the order of the suffixes that follow, are that column of
the collection's Burrows-Wheeler transform.  A stable sort by symbol inserts
one symbol of every piece and gives the next order; common prefixes grow by
one where symbols agree, to the least common prefix between the two in the
round before.  The columns lie in an external file that is read once, one
column after the other; a round holds the order and the common prefixes only.

Pieces are aligned at their anchors.  Equal windows have their anchor at the
same place, so only suffixes of one column are compared, and the transform
is kept column by column instead of merging all columns into one order.

Windows that share a prefix of the window's length are neighbours in the
order; all but the earliest by (doc_id, start) are removed.

Defined cases: null text counts as empty; texts shorter than the window and
empty tables lose nothing.  Windows are judged on the input; overlapping
repeats inside one document count.  Repeated rows are one document, answered
alike; a null doc_id comes first.  A very long text is read slice by slice and
its pieces are spread like any others.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolens.llm.repeats import SPLIT, Pieces, byte_anchors, identified, merged, repeated_spans, unpacked, with_spans

WINDOW = 100
GRAM = 24


def ranked(ids, texts, starts: np.ndarray) -> np.ndarray:
    """Dense ranks by (doc_id, text hash, start)."""
    order = np.lexsort((starts, texts, ids))
    i, t, s = ids[order], texts[order], starts[order]
    rank = np.zeros(len(order), np.int64)
    rank[order] = np.concatenate(([0], np.cumsum((i[1:] != i[:-1]) | (t[1:] != t[:-1]) | (s[1:] != s[:-1]))))
    return rank


def earliest_windows(contents: list[bytes], leads: np.ndarray, spans: np.ndarray, rank: np.ndarray, window: int, room: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each piece that an earlier piece has too (-1: none).
    ``room`` is the column of the anchors; all flagged windows of a piece overlap."""
    n, begin = len(contents), room - leads
    lengths = spans + window - 1
    end, width = begin + lengths, int((begin + lengths).max())
    table = np.zeros((n, width), np.uint8)
    for i, (x, y) in enumerate(zip(begin.tolist(), end.tolist(), strict=True)):
        table[i, x:y] = np.frombuffer(contents[i], np.uint8)
    low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    with tempfile.TemporaryFile() as columns:
        columns.write(np.ascontiguousarray(table.T[::-1]))
        del table
        columns.seek(0)
        order, common = np.arange(n), np.zeros(n, np.int32)
        for j in range(width - 1, -1, -1):
            column = np.frombuffer(columns.read(n), np.uint8)
            transform = np.where((begin <= j) & (j < end), column.astype(np.uint16) + 1, 0)[order]  # 0: no suffix here
            inserted = np.argsort(transform, kind="stable")
            symbols, longer = transform[inserted], np.zeros(n, np.int32)
            cuts = np.append(np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1]))), n)
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if b - a > 1 and symbols[a]:
                    at = inserted[a:b]
                    longer[a + 1:b] = np.minimum.reduceat(common[:at[-1] + 1], at[:-1] + 1) + 1
            order, common = order[inserted], longer
            if j > room:
                continue
            alike = common >= window
            if not alike.any():
                continue
            first = np.flatnonzero(~alike)
            least = np.repeat(np.minimum.reduceat(rank[order], first), np.diff(np.append(first, n)))
            later = order[rank[order] > least]
            low[later] = j - begin[later]
            high[later] = np.where(high[later] < 0, j - begin[later], high[later])
    return low, high


def _method(window: int, room: int):
    def run(some: Pieces):
        rank = ranked(some.docs, some.texts, np.array([x[0] for x in some.starts], np.int64))
        # equal pieces of several tasks: the earliest stands for all
        first: dict[tuple, int] = {}
        keys = list(zip(some.leads.tolist(), some.contents, strict=True))
        for i in np.argsort(rank, kind="stable").tolist():
            first.setdefault(keys[i], i)
        stands = np.array([first[k] for k in keys])
        copies = np.flatnonzero(rank > rank[stands])
        whole = np.array(sorted(first.values()))
        grams = [some.contents[i][some.leads[i]:some.leads[i] + window - room] for i in whole.tolist()]
        many = Counter(grams)
        whole = whole[np.array([many[g] > 1 for g in grams])]  # a piece that is alone at its anchor shares no window
        low, high = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(whole):
            low, high = earliest_windows([some.contents[i] for i in whole], some.leads[whole], some.spans[whole], rank[whole], window, room)
        hit = low >= 0
        return (np.concatenate([copies, whole[hit]]), np.concatenate([np.zeros(len(copies), np.int64), low[hit]]),
                np.concatenate([some.spans[copies] + window - 1, high[hit] + window]))
    return run


def _kept(batches):
    for batch in unpacked(batches):
        texts = batch.column(1).to_pylist()
        out = []
        for text, blobs in zip(texts, batch.column(2).to_pylist(), strict=True):
            a, b = merged(blobs)
            digest, at = hashlib.sha256(), 0
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                digest.update(text[at:x])
                at = y
            digest.update(text[at:])
            out.append((len(text), int((b - a).sum()), len(a), digest.hexdigest()))
        columns = list(zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in columns[:3]), pa.array(columns[3], pa.string())],
                                         ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, split: int = SPLIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    docs = identified(docs, id_col, text_col)
    spans = repeated_spans(docs, byte_anchors(window, gram), window, gram, True, _method(window, window - gram), split)
    out = with_spans(docs, spans).mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != -(1 << 63), F.col("doc_id")))
