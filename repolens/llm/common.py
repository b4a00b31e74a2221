"""Helpers shared by the operators: written intermediate tables, Arrow
batches as numpy byte arrays, words and rolling hashes.

Texts are handled in slices of about ``SLICE_BYTES``; a single longer text is
a slice of its own, so memory follows the longest text, not the table.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from repolens.session import checkpoint_dir

SLICE_BYTES = 1 << 20

# The six bytes that end a word: space and \x09-\x0D.
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True

# Lower-casing of A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back:
    cuts the lineage and survives the loss of any executor."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def giving_back(run):
    """``run`` for mapInArrow.  A worker that is reused keeps what Arrow freed, also
    while it waits and the executor's other side needs memory; so a task gives it back."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
    return task


def byte_view(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of an Arrow string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches, text: str, size: int = SLICE_BYTES):
    """Cut record batches so that the texts of each slice hold about ``size`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
        ends, at = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64)), 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(at, to - at)
            at = to


def long_column(batch, name: str) -> np.ndarray:
    """A bigint column; null becomes the smallest long, so it sorts first."""
    column = batch.column(batch.schema.get_field_index(name))
    return pc.fill_null(column.cast(pa.int64()), -(1 << 63)).to_numpy(zero_copy_only=False)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit words."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class SpanHash:
    """64-bit hashes of any spans of a sequence of 64-bit values, by prefix
    sums of a polynomial modulo 2^64.  Equal spans hash alike anywhere; unequal
    ones can be made to, so these hashes only propose what is compared after."""

    def __init__(self, values: np.ndarray):
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
            np.cumsum(values * _powers(_BASE, len(values))[:-1], out=self.sums[1:])
            self.back = _powers(_UNBASE, len(values))

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((self.sums[ends] - self.sums[starts]) * self.back[starts] + (ends - starts).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        """Hashes of all spans of ``size`` values."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            return mix64((self.sums[size:] - self.sums[:n]) * self.back[:n] + np.uint64(size))


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUE[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the maximal runs of non-separator bytes."""
    inside = ~SEPARATOR[data]
    before, after = np.zeros(len(data), dtype=bool), np.zeros(len(data), dtype=bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    before[edges], after[edges - 1] = False, False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


# Bytes of a word that are mixed eight at a time; longer words are hashed one by one.
_LONG_WORD = 64
_BLOCK_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end].

    Eight bytes at a time go through a bijective scramble of the hash so far, so
    words of one length that differ in one block never collide and no structure
    of the text cancels out; longer words take BLAKE2b."""
    lengths = ends - starts
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    blocks = np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))  # eight bytes from each place
    with np.errstate(over="ignore"):
        out = mix64(lengths.astype(np.uint64) * _BASE + np.uint64(0x2545F4914F6CDD1D))
        live = np.flatnonzero(lengths <= _LONG_WORD)
        for k in range(0, _LONG_WORD, 8):
            live = live[lengths[live] > k]
            if not len(live):
                break
            word = blocks[starts[live] + k] & _BLOCK_MASK[np.minimum(lengths[live] - k, 8)]
            out[live] = mix64((out[live] ^ word) * _BASE + np.uint64(k))
    for i in np.flatnonzero(lengths > _LONG_WORD).tolist():
        digest = hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8, key=b"words").digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def word_hashes(column, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, offsets, starts, ends, rows and 64-bit hashes of a text column's words."""
    data, offsets = byte_view(column)
    if lower:
        data = LOWER[data]
    starts, ends, rows = words(data, offsets)
    return data, offsets, starts, ends, rows, hash_words(data, starts, ends)


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Numbers of words: equal exactly for equal bytes."""
    if not len(starts):
        return np.zeros(0, np.int64)
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    letters = np.ascontiguousarray(data[np.cumsum(inside[:-1]) > 0])
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    words_ = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return words_.dictionary_encode().indices.to_numpy().astype(np.int64)
