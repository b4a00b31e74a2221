"""Passages that repeat: the distributed frame of the two substring operators.

A passage is a window of ``window`` units (bytes or words).  Every window has
an anchor, the gram of least hash among its grams (the leftmost of equals).
The anchor depends on the window's content alone, so equal windows have
equal anchors at equal distances from their starts, wherever they are.

A. ``repeated_anchors``: anchors are compared by hash across all documents.
   A task first compares those of its own slice and asks about one of each
   hash, so a very frequent anchor is one entry per slice, not one per row.
B. Pieces: around each repeated anchor, the units of all windows that it
   anchors.  Equal pieces of a task are settled there: only the first goes
   on.  The others are known to repeat it.
C. Pieces meet in many small parts, packed and compressed; an operator's own
   method compares their units and finds which windows occur earlier.
   A piece's windows differ in the distance from window start to anchor.  They
   are dealt in blocks of such distances, by what all windows of the block have
   in common, its core: equal windows are in equal blocks and have equal cores.
   The block of all distances has the anchor as core.  For each doubling of an
   anchor's occurrences beyond ``SPLIT`` (counted by slice in A) its blocks are
   half as wide, so their cores reach further beyond the anchor, and what many
   texts share only around the anchor meets in many parts instead of one.
D. ``with_spans``: spans join their documents.  Texts are compressed for the
   two joins.

Documents are known by (doc_id, hash of the text).  Rows that repeat both are
one document.  Of rows that repeat a doc_id with other texts, none is a
smaller doc_id than the other; where order within a document counts, they
follow each other by text hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolens.llm.common import SLICE_BYTES, SpanHash, byte_values, byte_view, long_column, mix64, slices, word_hashes, written

# Logical parts for each shuffle partition, of anchors and of pieces: they bound what a task holds at once.
PARTS, PIECE_PARTS = 4, 16
# Occurrences of an anchor for each further split of its windows' distances.
SPLIT = 512
# An ordinal's upper bits: how often the anchor's blocks are halved.
_LEVEL_BIT, _LEVELS = 29, 8
_LOW = np.uint64(0xFFFFFFFF)


@dataclass
class Anchored:
    """Anchors of a slice in reading order; positions are units of the slice."""

    data: np.ndarray    # bytes
    first: np.ndarray   # row -> its first unit
    rows: np.ndarray
    at: np.ndarray      # where the anchor starts
    low: np.ndarray     # first and last start of the windows that it anchors
    high: np.ndarray
    hashes: np.ndarray  # of the anchor
    starts: np.ndarray | None  # unit -> byte; None: units are bytes
    ends: np.ndarray | None
    values: Callable[[int, int], np.ndarray]  # units a to b as 64-bit values

    def ordinals(self) -> np.ndarray:
        return np.arange(len(self.rows)) - np.searchsorted(self.rows, self.rows)


def least_of_each(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every run of ``size`` values."""
    span = 1
    while 2 * span <= size:
        values, span = np.minimum(values[:-span], values[span:]), 2 * span
    return np.minimum(values[:len(values) - (size - span)], values[size - span:]) if size > span else values


def _anchors(values: Callable[[int, int], np.ndarray], bounds: np.ndarray, window: int, gram: int):
    """(at, low, high, hash, row) of all anchors; values(a, b) gives the units a to b."""
    found, step = [], 2 * SLICE_BYTES
    room = np.repeat(bounds[1:], np.diff(bounds)) if len(bounds) > 1 else np.zeros(0, np.int64)
    for a in range(0, len(room), step):
        b = min(a + step, len(room))
        starts = a + np.flatnonzero(room[a:b] - np.arange(a, b) >= window)
        if not len(starts):
            continue
        grams = SpanHash(values(a, min(b + window - 1, len(room)))).grams(gram)
        ranked = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
        at = (least_of_each(ranked, window - gram + 1)[starts - a] & _LOW).astype(np.int64)
        found.append((starts, at + a, mix64(grams[at])))  # least hashes crowd at 0, parts are ranges
    if not found:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    starts, at, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
    new = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.concatenate((new[1:], [len(at)])) - 1
    return at[new], starts[new], starts[last], hashes[new], np.searchsorted(bounds, starts[new], "right") - 1


def byte_anchors(window: int, gram: int) -> Callable[[pa.Array], Anchored]:
    def run(column):
        data, offsets = byte_view(column)
        values = lambda a, b: byte_values(data[a:b])
        at, low, high, hashes, rows = _anchors(values, offsets, window, gram)
        return Anchored(data, offsets[:-1], rows, at, low, high, hashes, None, None, values)
    return run


def word_anchors(window: int, gram: int) -> Callable[[pa.Array], Anchored]:
    def run(column):
        data, offsets, starts, ends, word_rows, units = word_hashes(column, lower=False)
        bounds = np.searchsorted(word_rows, np.arange(len(offsets)))
        values = lambda a, b: units[a:b]
        at, low, high, hashes, rows = _anchors(values, bounds, window, gram)
        return Anchored(data, bounds[:-1], rows, at, low, high, hashes, starts, ends, values)
    return run


def identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id (null: the smallest long), text_hash (32 bits, only ever compared
    among rows of one doc_id), text (null: empty)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc_id"), F.hash(text).cast("long").alias("text_hash"), text.alias("text"))


def _packed(batches):
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in slices(batches, "text"):
        texts = batch.column(2).cast(pa.large_binary()).to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(map(squeeze, texts), pa.binary())], ["doc_id", "text_hash", "packed"])


def packed(docs: DataFrame) -> DataFrame:
    """Compressed texts, for a shuffle."""
    return docs.mapInArrow(_packed, "doc_id long, text_hash long, packed binary")


def unpacked(batches):
    """Record batches with their texts as they were, about SLICE_BYTES at a time."""
    stretch = zstandard.ZstdDecompressor().decompress
    for batch in slices(batches, "packed", SLICE_BYTES // 3):
        at = batch.schema.get_field_index("packed")
        texts = [stretch(x) for x in batch.column(at).to_pylist()]
        yield batch.set_column(at, "text", pa.array(texts, pa.large_binary()))


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Ranges of the hash, numbered."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)


def _blob(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


_ASK = "kind int, part int, slice long, a binary, b binary, c binary, d binary"


def _ask(anchors, parts: int):
    """kind 0: hashes to compare (a hash, b row, c ordinal, d occurrences in the
    slice); -1: the slice's documents (a doc_id, b text_hash); 1 and up: anchors
    known to repeat (b, c), one more than their level.  The slice's own repeats are
    of kind 1 (d: how many have the same hash, the first being the one asked
    about, whose answer brings their level)."""
    def run(batches):
        task, n = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text"):
            found, slice_id, out = anchors(batch.column(2)), (task << 32) | n, []
            n += 1
            if not len(found.rows):
                continue
            order = np.argsort(found.hashes, kind="stable")
            sorted_, ordinals = found.hashes[order], found.ordinals().astype(np.uint32)
            new = np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1])))
            sizes = np.diff(np.append(new, len(order)))
            known, asked = order[np.repeat(sizes > 1, sizes)], order[new]
            part = _part(sorted_[new], parts)
            home, rows = slice_id % parts, found.rows.astype(np.uint32)
            out.append((-1, home, _blob(long_column(batch, "doc_id")), _blob(long_column(batch, "text_hash")), b"", b""))
            if len(known):
                out.append((1, home, b"", _blob(rows[known]), _blob(ordinals[known]), _blob(sizes[sizes > 1].astype(np.uint32))))
            cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                some = asked[x:y]
                out.append((0, int(part[x]), _blob(found.hashes[some]), _blob(rows[some]), _blob(ordinals[some]), _blob(sizes[x:y].astype(np.uint32))))
            kind, at, *blobs = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(at, pa.int32()), pa.array([slice_id] * len(out), pa.int64()), *(pa.array(x, pa.binary()) for x in blobs)],
                                             ["kind", "part", "slice", "a", "b", "c", "d"])
    return run


def by_part(batches, names: list[str]) -> Iterator[dict[str, list]]:
    """The columns of each part of a partition that is sorted by part."""
    held, now = {x: [] for x in names}, None
    for batch in batches:
        columns = {x: batch.column(batch.schema.get_field_index(x)) for x in names}
        part = batch.column(batch.schema.get_field_index("part")).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))) if len(part) else [0]
        for x, y in zip(cuts[:-1], cuts[1:], strict=True):
            if now is not None and part[x] != now:
                yield held
                held = {x: [] for x in names}
            now = part[x]
            for k in names:
                held[k].extend(columns[k].slice(x, y - x).to_pylist())
    if now is not None:
        yield held


def _level(total: np.ndarray, split: int) -> np.ndarray:
    """Halvings for so many occurrences: 0 below ``split``, one more for each doubling."""
    return np.minimum(np.ceil(np.log2(np.maximum(total // split, 0) + 1)), _LEVELS - 1).astype(np.int64)


def _answer(split: int):
    def run(batches):
        names = ["kind", "slice", "a", "b", "c", "d"]
        for held in by_part(batches, names):
            kind, slices_, a, b, c, d = (held[x] for x in names)
            out = [x for x in zip(kind, slices_, a, b, c, d, strict=True) if x[0]]
            asked = [i for i, k in enumerate(kind) if not k]
            if asked:
                hashes = np.frombuffer(b"".join(a[i] for i in asked), np.uint64)
                rows = np.frombuffer(b"".join(b[i] for i in asked), np.uint32)
                ordinals = np.frombuffer(b"".join(c[i] for i in asked), np.uint32)
                many = np.frombuffer(b"".join(d[i] for i in asked), np.uint32)
                origin = np.repeat(np.arange(len(asked)), [len(a[i]) // 8 for i in asked])
                order = np.argsort(hashes, kind="stable")
                first = np.flatnonzero(np.concatenate(([True], hashes[order][1:] != hashes[order][:-1])))
                sizes, total = np.diff(np.append(first, len(order))), np.add.reduceat(many[order].astype(np.int64), first)
                # 0: nowhere else; what a slice repeats itself is known there, but for its level
                tell, level = np.zeros(len(order), np.int8), _level(total, split)
                tell[order] = np.repeat(np.where((sizes > 1) | (level > 0), 1 + level, 0), sizes)
                for k in np.unique(tell[tell > 0]).tolist():
                    again = np.flatnonzero(tell == k)
                    cuts = np.searchsorted(origin[again], np.arange(len(asked) + 1))
                    for n, i in enumerate(asked):
                        some = again[cuts[n]:cuts[n + 1]]
                        if len(some):
                            out.append((k, slices_[i], b"", _blob(rows[some]), _blob(ordinals[some]), b""))
            if out:
                kind, slices_, *blobs = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array([0] * len(out), pa.int32()), pa.array(slices_, pa.int64()), *(pa.array(x, pa.binary()) for x in blobs)],
                                                 ["kind", "part", "slice", "a", "b", "c", "d"])
    return run


def _of_documents(group: pd.DataFrame) -> pd.DataFrame:
    """The repeated anchors of one slice, by document, with their levels."""
    keys_of = lambda some: (np.frombuffer(b"".join(some["b"]), np.uint32).astype(np.uint64) << np.uint64(32)) | np.frombuffer(b"".join(some["c"]), np.uint32)
    found = group[group["kind"] > 0]
    if not len(found):
        return pd.DataFrame({"doc_id": [], "text_hash": [], "ordinals": []})
    docs = group[group["kind"] == -1].iloc[0]
    ids, texts = np.frombuffer(docs["a"], np.int64), np.frombuffer(docs["b"], np.int64)
    is_own = found["d"].map(len) > 0  # the slice's own repeats: one row at most
    own, told = found[is_own], found[~is_own]
    keys = keys_of(told)
    levels = np.repeat(told["kind"].to_numpy(np.int64) - 1, np.array([len(x) // 4 for x in told["c"]], np.int64))
    order = np.argsort(keys)
    keys, levels = keys[order], levels[order]
    if len(own):
        sizes, mine = np.frombuffer(own.iloc[0]["d"], np.uint32), keys_of(own)
        asked = mine[np.cumsum(sizes) - sizes]
        at = np.searchsorted(keys, asked)
        known = (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == asked) if len(keys) else np.zeros(len(asked), bool)
        level = np.zeros(len(asked), np.int64)
        level[known] = levels[at[known]]
        keys, levels = np.concatenate([keys, mine]), np.concatenate([levels, np.repeat(level, sizes)])
        keys, first = np.unique(keys, return_index=True)
        levels = levels[first]  # what is told of a key and what its slice knows have one level
    rows = (keys >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1], [True])))
    ordinals = (keys & _LOW).astype(np.uint32) | (levels << _LEVEL_BIT).astype(np.uint32)
    return pd.DataFrame({"doc_id": ids[rows[cuts[:-1]]], "text_hash": texts[rows[cuts[:-1]]], "ordinals": [_blob(ordinals[x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]})


def _dealt(df: DataFrame) -> DataFrame:
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "part").sortWithinPartitions("part")


def part_count(df: DataFrame, each: int = PARTS) -> int:
    return each * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def repeated_anchors(docs: DataFrame, anchors, split: int = SPLIT) -> DataFrame:
    """doc_id, text_hash, ordinals: which of a document's anchors occur elsewhere too."""
    asked = _dealt(docs.mapInArrow(_ask(anchors, part_count(docs)), _ASK))
    answered = asked.mapInArrow(_answer(split), _ASK)
    found = answered.groupBy("slice").applyInPandas(_of_documents, "doc_id long, text_hash long, ordinals binary")
    return found.groupBy("doc_id", "text_hash").agg(F.max("ordinals").alias("ordinals"))


_PIECE = "kind int, part int, docs binary, texts binary, starts binary, many binary, leads binary, spans binary, sizes binary, content binary"
_NAMES = [x.split()[0] for x in _PIECE.split(", ")]


def _blocks(at: np.ndarray, low: np.ndarray, high: np.ndarray, level: np.ndarray, offsets: int, window: int):
    """Pieces cut into blocks of distances: (number of the piece, first and last window,
    start and end of the block's core)."""
    width = np.maximum(1, -(-offsets >> level))  # of the distances that a block holds
    least, most = (at - high) // width, (at - low) // width
    many = most - least + 1
    of = np.repeat(np.arange(len(at)), many)
    number = np.repeat(most, many) - (np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many))
    near, far = number * width[of], np.minimum((number + 1) * width[of], offsets) - 1
    first, last = np.maximum(low[of], at[of] - far), np.minimum(high[of], at[of] - near)
    return of, first, last, at[of] - near, at[of] - far + window


def _digests(data: memoryview, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """128-bit BLAKE2b of data[a:b] as two words a row."""
    blake2b = hashlib.blake2b
    out = b"".join([blake2b(data[x:y], digest_size=16).digest() for x, y in zip(a.tolist(), b.tolist(), strict=True)])
    return np.frombuffer(out, "<u8").reshape(-1, 2)


def _cut(anchors, window: int, gram: int, parts: int, within: bool):
    """Rows of packed pieces of a part (kind 1): documents, starts (many of them
    for a piece that a document repeats), units before the anchor, numbers of
    windows, sizes and bytes.  kind 0: spans (from, to) of documents that repeat
    an earlier piece of the task."""
    def run(batches):
        seen: dict[tuple, tuple] = {}
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in unpacked(batches):
            found, ids, texts = anchors(batch.column(2)), long_column(batch, "doc_id"), long_column(batch, "text_hash")
            marks = [np.frombuffer(x, np.uint32) for x in batch.column(3).to_pylist()]
            level = np.concatenate(marks).astype(np.int64) >> _LEVEL_BIT
            marks = [(x & np.uint32((1 << _LEVEL_BIT) - 1)).astype(np.int64) for x in marks]
            begin = np.searchsorted(found.rows, np.arange(batch.num_rows))
            some = np.concatenate([m + b for m, b in zip(marks, begin, strict=True)])
            of, low, high, core_from, core_to = _blocks(found.at[some], found.low[some], found.high[some], level, window - gram + 1, window)
            some, split = some[of], level[of] > 0
            rows, key = found.rows[some], found.hashes[some]
            lead, span = found.at[some] - low, high - low + 1
            a, b = low, high + window
            if found.starts is not None:
                a, b = found.starts[low], found.ends[high + window - 1]
                core_from, core_to = found.starts[core_from], found.ends[core_to - 1]
            raw = memoryview(np.ascontiguousarray(found.data)).cast("B")
            if split.any():
                key[split] = _digests(raw, core_from[split], core_to[split])[:, 0]
            digest = _digests(raw, a, b)
            hashed, check = digest[:, 0] ^ ((lead << 32) + span).astype(np.uint64), digest[:, 1]
            start = low - found.first[rows]
            order = np.lexsort((start, texts[rows], ids[rows], check, hashed))
            h, c, row, place = hashed[order], check[order], rows[order], start[order]
            new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1]))))
            sizes = np.diff(np.append(new, len(h)))
            # the earliest of each piece, here or in the task's slices before
            first = list(zip(ids[row[new]].tolist(), texts[row[new]].tolist(), place[new].tolist(), strict=True))
            for i, k in enumerate(zip(h[new].tolist(), c[new].tolist(), strict=True)):
                first[i] = seen[k] = min(first[i], seen.get(k, first[i]))
            best = [np.repeat(np.array([f[k] for f in first], np.int64), sizes) for k in range(3)]
            keep = ids[row] == best[0]
            if within:  # the same row given twice is one document
                keep &= (texts[row] == best[1]) & (place == best[2])
            gone = order[~keep]
            out = []
            if len(gone):
                gone_rows, gone_from, gone_to = rows[gone], start[gone], (start + span + window - 1)[gone]
                by = np.argsort(gone_rows, kind="stable")
                cuts = np.flatnonzero(np.concatenate(([True], gone_rows[by][1:] != gone_rows[by][:-1], [True])))
                for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                    i = by[x:y]
                    r = gone_rows[i[0]]
                    runs = np.stack(merged([_blob(np.stack([gone_from[i], gone_to[i]], 1).astype(np.int32))]), 1)
                    out.append((0, int(r) % parts, _blob(ids[r:r + 1]), _blob(texts[r:r + 1]), _blob(runs.astype(np.int32)), b"", b"", b"", b"", b""))
            kept = np.flatnonzero(keep)
            if len(kept):
                h, c, row = h[kept], c[kept], row[kept]
                cuts = np.append(np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1]) | (texts[row[1:]] != texts[row[:-1]]) | (ids[row[1:]] != ids[row[:-1]])))), len(kept))
                piece, many = order[kept[cuts[:-1]]], np.diff(cuts)
                begins = cuts[:-1]
                deal = _part(key[piece], parts)
                by = np.argsort(deal, kind="stable")
                edges = np.flatnonzero(np.concatenate(([True], deal[by][1:] != deal[by][:-1], [True])))
                for x, y in zip(edges[:-1], edges[1:], strict=True):
                    k = by[x:y]
                    j = piece[k]
                    held = np.concatenate([place[kept[m:m + n]] for m, n in zip(begins[k].tolist(), many[k].tolist(), strict=True)])
                    content = squeeze(b"".join([raw[m:n] for m, n in zip(a[j].tolist(), b[j].tolist(), strict=True)]))
                    out.append((1, int(deal[k[0]]), _blob(ids[rows[j]]), _blob(texts[rows[j]].astype(np.int32)), _blob(held.astype(np.int32)), _blob(many[k].astype(np.int32)),
                                _blob(lead[j].astype(np.int32)), _blob(span[j].astype(np.int32)), _blob((b[j] - a[j]).astype(np.int32)), content))
            for i in range(0, len(out), 10_000):
                columns = list(zip(*out[i:i + 10_000], strict=True))
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int32()) for x in columns[:2]), *(pa.array(x, pa.binary()) for x in columns[2:])], _NAMES)
    return run


@dataclass
class Pieces:
    """The pieces of a part."""

    docs: np.ndarray
    texts: np.ndarray
    starts: list[np.ndarray]  # one or more of each piece
    leads: np.ndarray
    spans: np.ndarray
    contents: list[bytes]


def _unpacked_pieces(held: dict[str, list], rows: list[int]) -> Pieces:
    stretch = zstandard.ZstdDecompressor().decompress

    def whole(name, dtype):
        return np.frombuffer(b"".join(held[name][i] for i in rows), dtype)

    sizes = whole("sizes", np.int32).astype(np.int64)
    data = b"".join(stretch(held["content"][i]) for i in rows)
    ends = np.cumsum(sizes)
    return Pieces(whole("docs", np.int64), whole("texts", np.int32).astype(np.int64), np.split(whole("starts", np.int32), np.cumsum(whole("many", np.int32))[:-1]),
                  whole("leads", np.int32).astype(np.int64), whole("spans", np.int32).astype(np.int64),
                  [data[e - n:e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)])


def _settle(method):
    """method(pieces) -> spans to add: piece numbers, from, to, counted from the piece's start."""
    def run(batches):
        for held in by_part(batches, [x for x in _NAMES if x != "part"]):
            known = [i for i, k in enumerate(held["kind"]) if not k]
            if known:
                yield _span_batch(np.frombuffer(b"".join(held["docs"][i] for i in known), np.int64), np.frombuffer(b"".join(held["texts"][i] for i in known), np.int64), [held["starts"][i] for i in known])
            rows = [i for i, k in enumerate(held["kind"]) if k == 1]
            if not rows:
                continue
            some = _unpacked_pieces(held, rows)
            n, low, high = method(some)
            starts = [some.starts[i] for i in n.tolist()]
            yield _span_batch(some.docs[n], some.texts[n], [_blob(np.stack([s + x, s + y], 1).astype(np.int32)) for s, x, y in zip(starts, low.tolist(), high.tolist(), strict=True)])
    return run


def _span_batch(docs, texts, spans: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(texts, pa.int64()), pa.array(spans, pa.binary())], ["doc_id", "text_hash", "spans"])


def repeated_spans(docs: DataFrame, anchors, window: int, gram: int, within: bool, method, split: int = SPLIT) -> DataFrame:
    """doc_id, text_hash, spans: the parts of documents that repeat earlier ones.
    within: an earlier start in the same document counts, too."""
    marked = packed(docs).join(repeated_anchors(docs, anchors, split), ["doc_id", "text_hash"]).select("doc_id", "text_hash", "packed", "ordinals")
    pieces = _dealt(marked.mapInArrow(_cut(anchors, window, gram, part_count(docs, PIECE_PARTS), within), _PIECE))
    spans = pieces.mapInArrow(_settle(method), "doc_id long, text_hash long, spans binary")
    return written(spans.groupBy("doc_id", "text_hash").agg(F.collect_list("spans").alias("spans")), "repeat-spans")


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, packed (the text, compressed), spans (null: none) for every row of docs."""
    return packed(docs).join(spans, ["doc_id", "text_hash"], "left").select("doc_id", "packed", "spans")


def merged(blobs: list[bytes] | None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal covered runs."""
    if not blobs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.frombuffer(b"".join(blobs), np.int32).reshape(-1, 2).astype(np.int64)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.concatenate(([True], pairs[1:, 0] > reach[:-1]))
    return pairs[new, 0], reach[np.append(np.flatnonzero(new)[1:], len(pairs)) - 1]
