"""Exact duplicates by two-pass Bloom filtering.

Texts are hashed once; the digests are cut into ranges of about ``range_rows``
by their leading bits, and each range has a Bloom filter of its own, of
``bits_per_row`` bits a row.  So filters are as full at any number of rows, and
the share of unique rows that they let through stays the same: with two probes
and 16 bits a row at most (1 - exp(-2 / 16)) ** 2, 1.4 %.

Pass one: tasks send the bits that their digests set, and which of them were
set twice, to the owners of segments of the filters; an owner finds the bits
that several digests set.  Pass two tests each digest against its range's bits:
one whose bits aren't all set twice occurs once, so its row passes straight
through; only the others shuffle and are grouped exactly.

Bounds: an owner holds one segment (``range_rows * bits_per_row / SEGMENTS``
bits and the places sent for it), a worker and the driver one range's filter
(``range_rows * bits_per_row / 8`` bytes, 16 MB) at a time.

Defined cases: null text counts as empty; equal means identical after
lower-casing A-Z.  A null doc_id sorts below all others.  Rows that repeat
both doc_id and text are one document: each shows the same decision, and
``drop_copies`` keeps one of them.  A very long text is one row's work.  Empty
tables give empty results.  Other columns are carried untouched, whatever their
names and types.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import giving_back, written
from repolens.llm.repeats import by_part

RANGE_ROWS = 1 << 23
BITS_PER_ROW = 16
PROBES = 2
SEGMENTS = 16      # of a filter, one owner each
HELD = 1 << 20     # rows that a task folds before it sends their bits


def digest(text: str | None) -> bytes:
    """SHA-256 of a text with A-Z lower-cased; bytes.lower() changes ASCII only."""
    return hashlib.sha256((text or "").encode("utf-8", "replace").lower()).digest()


def _digests(batches):
    for batch in batches:
        raw = batch.column(1).cast(pa.binary()).to_pylist()
        found = [hashlib.sha256((x or b"").lower()).digest() for x in raw]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([int.from_bytes(x[:2], "big") for x in found], pa.int32()), pa.array(found, pa.binary())], ["doc_id", "lead", "sha"])


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lead (the digest's first 16 bits), sha: one row per row, written in
    the order of ``lead``, so that a range is read without the others."""
    pair = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("doc_id", pair.schema[0].dataType), T.StructField("lead", T.IntegerType()), T.StructField("sha", T.BinaryType())])
    return written(pair.mapInArrow(giving_back(_digests), schema).sortWithinPartitions("lead"), "exact-digests")


def _probes(shas, bits: int) -> np.ndarray:
    """Bit positions of each digest, PROBES a row."""
    raw = np.frombuffer(b"".join(x[2:2 + 8 * PROBES] for x in shas), dtype="<u8").reshape(-1, PROBES)
    return (raw & np.uint64(bits - 1)).astype(np.int64)


def _has(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)


def _set(bitmap: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(bitmap, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))


_SENT = "part int, places binary, twice binary"


def _fold(bits: int, ranges: int):
    """Places of bits in their segment, sorted, and whether several digests set them."""
    step = bits // SEGMENTS

    def sent(leads, shas):
        squeeze = zstandard.ZstdCompressor(level=1).compress
        at = _probes(shas, bits) + (np.array(leads, np.int64) * ranges >> 16)[:, None] * bits
        keys, many = np.unique(at.ravel(), return_counts=True)
        part = keys // step
        cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
        rows = [(int(part[x]), squeeze(np.diff(keys[x:y] - part[x] * step, prepend=0).astype(np.uint32).tobytes()), squeeze(np.packbits(many[x:y] > 1).tobytes()))
                for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.binary(), pa.binary()), strict=True)], ["part", "places", "twice"])

    def run(batches):
        leads, shas = [], []
        for batch in batches:
            leads += batch.column(0).to_pylist()
            shas += batch.column(1).to_pylist()
            if len(shas) >= HELD:
                yield sent(leads, shas)
                leads, shas = [], []
        if shas:
            yield sent(leads, shas)
    return run


def _own(bits: int):
    """The bits of a segment that several digests set, here or in other tasks."""
    def run(batches):
        stretch, squeeze = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress
        for held in by_part(batches, ["part", "places", "twice"]):
            once, again = np.zeros(bits // SEGMENTS // 8, np.uint8), np.zeros(bits // SEGMENTS // 8, np.uint8)
            for places, twice in zip(held["places"], held["twice"], strict=True):
                at = np.cumsum(np.frombuffer(stretch(places), np.uint32), dtype=np.int64)
                many = np.unpackbits(np.frombuffer(stretch(twice), np.uint8), count=len(at)).astype(bool)
                _set(again, at[many | _has(once, at)])
                _set(once, at)
            yield pa.RecordBatch.from_arrays([pa.array([held["part"][0]], pa.int32()), pa.array([squeeze(again.tobytes())], pa.binary())], ["part", "again"])
    return run


def filters(rows: DataFrame, bits_per_row: int = BITS_PER_ROW, range_rows: int = RANGE_ROWS) -> tuple[DataFrame, int, int]:
    """(part, again: compressed bits) of all segments, bits of a filter, number of ranges."""
    n = rows.count()
    ranges = min(1 << 16, max(1, -(-n // range_rows)))
    bits = 1 << max(10, (min(n, range_rows) * bits_per_row - 1).bit_length())
    sent = rows.select("lead", "sha").mapInArrow(giving_back(_fold(bits, ranges)), _SENT)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owned = sent.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(giving_back(_own(bits)), "part int, again binary")
    return written(owned, "exact-filters"), bits, ranges


def _bitmap(owned: DataFrame, bits: int, k: int) -> np.ndarray:
    """One range's filter: at most range_rows * bits_per_row bits."""
    bitmap, size = np.zeros(bits // 8, np.uint8), bits // SEGMENTS // 8
    for row in owned.where(F.col("part").between(k * SEGMENTS, (k + 1) * SEGMENTS - 1)).collect():
        at = (row["part"] - k * SEGMENTS) * size
        bitmap[at:at + size] = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["again"]), np.uint8)
    return bitmap


def _maybe(spark: SparkSession, bitmap: np.ndarray):
    shared = spark.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def maybe(sha):
        import pandas as pd
        return pd.Series(_has(shared.value, _probes(sha.tolist(), 8 * len(shared.value))).all(axis=1) if len(sha) else [], dtype=bool)

    return maybe


def _in_range(lead: Column, k: int, ranges: int) -> Column:
    """The leads of range k, as bounds that the scan can use."""
    return lead.between(-(-(k << 16) // ranges), -(-((k + 1) << 16) // ranges) - 1)


def marked(rows: DataFrame, found: DataFrame, bits: int, ranges: int) -> DataFrame:
    """``rows`` (with lead and sha) with ``maybe``: the digest may occur again.  A range at a time."""
    out = None
    for k in range(ranges):
        some = rows.where(_in_range(F.col("lead"), k, ranges)).withColumn("maybe", _maybe(rows.sparkSession, _bitmap(found, bits, k))("sha"))
        out = some if out is None else out.unionByName(some)
    return out


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits_per_row: int = BITS_PER_ROW, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = digests(docs, id_col, text_col)
    rows = marked(rows, *filters(rows, bits_per_row, range_rows))
    alone = rows.where(~F.col("maybe")).select("doc_id", "sha", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    met = rows.where("maybe").select("doc_id", "sha")
    groups = met.groupBy("sha").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = written(groups, "exact-groups")  # a join by itself: a frequent digest's rows can be split
    return (alone.unionByName(met.join(groups, "sha"))
            .select("doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits_per_row: int = BITS_PER_ROW, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``docs`` without copies: of equal texts the row with the largest doc_id stays.

    Which digests repeat, and the doc_id that stays of each, is found on digests.
    Whole rows whose digest can't repeat pass straight through; only the others
    shuffle.  With several ranges the rows are first written in their order, so
    that each range reads its own."""
    rows = digests(docs, id_col, text_col)
    found, bits, ranges = filters(rows, bits_per_row, range_rows)
    met = marked(rows, found, bits, ranges).where("maybe")
    groups = met.groupBy("sha").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("size")).where("size > 1")
    groups = written(groups.select(F.col("sha").alias("of_sha"), "keep_id"), "exact-groups")

    @F.pandas_udf("binary")
    def sha(text):
        return text.map(digest)

    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), sha(F.col(text_col).cast("string")).alias("sha"))
    whole = whole.withColumn("lead", F.conv(F.hex(F.substring("sha", 1, 2)), 16, 10).cast("int"))
    if ranges > 1:
        whole = written(whole.sortWithinPartitions("lead"), "exact-rows")
    whole = marked(whole, found, bits, ranges)
    judged = whole.where("maybe").join(groups, F.col("sha") == F.col("of_sha"), "left").where("of_sha IS NULL OR id <=> keep_id")
    # equal digest and doc_id: any one of the rows, each kept group has one
    nth = F.row_number().over(Window.partitionBy("sha").orderBy(F.lit(1)))
    best = judged.where("of_sha IS NOT NULL").withColumn("nth", nth).where("nth = 1")
    parts = [whole.where(~F.col("maybe")), judged.where("of_sha IS NULL"), best]
    return parts[0].select("row.*").unionByName(parts[1].select("row.*")).unionByName(parts[2].select("row.*"))
