"""Interval (range) joins by decomposition over a segment tree.

Lines are numbered in buckets of ``width``, the leaves of a tree of fan-out
``FAN``.  A range is the few tree nodes that lie wholly inside it and whose
parent doesn't: at most ``2 * (FAN - 1)`` on each of ``LEVELS`` levels, so a
range of 2,000,000,000 lines is some hundred rows and a function's span one or
two.  A point lies in a range exactly if one of its ancestors, one per level,
is among the range's nodes, and then exactly one is.

Two ranges overlap if either starts inside the other.  So each side brings its
nodes and the ancestors of its start, and one equi-join on ``keys + node``
compares starts with nodes both ways; a pair whose starts are equal is counted
for the left start only.  Every overlapping pair appears exactly once without a
distinct, and the exact range test remains as residual condition.  The join
key includes the node, so a hot file is spread over its buckets, and AQE's
skew-join split applies to what remains.

Nodes are rows, and a shuffle writes each of them.  Where the right side has few
rows per key value (the functions of a file), ``overlap_hits`` spares them: the
right rows of a key value travel as one array, a left row is shuffled once as it
is, whatever its ranges, and compares them with the array where the two meet.
Only key values with more than ``MOST_ROWS`` right rows go through the tree.
"""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET = 64
MOST_ROWS = 1024            # right rows of a key value that are one array
FAN_BITS = 4                # fan-out 16
LEVELS = 7                  # a node of the last level has 64 * 16 ** 6 lines, half of all 32-bit line numbers


def _code(side: int, level: int, node: Column) -> Column:
    """A tree node as one number: whose start it compares in bit 0, its level in bits 1 to 3."""
    return F.shiftleft(node, 4) + (2 * level + side)


def _nodes(lo: Column, hi: Column, side: int) -> Column:
    """Codes of the tree nodes of buckets lo..hi: array<bigint>."""
    none = F.array().cast("array<bigint>")

    def inside(level: int) -> tuple[Column, Column]:  # first and last node of the level inside the range
        size = 1 << (FAN_BITS * level)
        return F.floor((lo + (size - 1)) / size).cast("long"), (F.floor((hi + 1) / size) - 1).cast("long")

    def run(level: int, a: Column, b: Column) -> Column:
        return F.when(a <= b, F.transform(F.sequence(a, F.greatest(a, b)), lambda x: _code(side, level, x))).otherwise(none)

    parts = []
    for level in range(LEVELS):
        a, b = inside(level)
        up_a, up_b = inside(level + 1)
        left_end = F.when(up_a <= up_b, F.least(b, F.shiftleft(up_a, FAN_BITS) - 1)).otherwise(b)
        parts.append(run(level, a, left_end))
        parts.append(F.when(up_a <= up_b, run(level, F.shiftleft(up_b + 1, FAN_BITS), b)).otherwise(none))
    return F.concat(*parts)


def _keyed(df: DataFrame, start: str, end: str, width: int, start_side: int) -> DataFrame:
    """One row per ``_key``: its ``side`` tells whose start it compares (0 left, 1 right)."""
    bucket = lambda c: F.floor(F.col(c) / width).cast("long")
    df = df.select("*", bucket(start).alias("_lo"), F.greatest(bucket(start), bucket(end)).alias("_hi"))
    lo, hi = F.col("_lo"), F.col("_hi")
    ancestors = [_code(start_side, level, F.shiftright(lo, FAN_BITS * level)) for level in range(LEVELS)]
    # most ranges lie in one bucket, which is their only node
    keys = F.when(lo == hi, F.array(*ancestors, _code(1 - start_side, 0, lo))).otherwise(F.concat(F.array(*ancestors), _nodes(lo, hi, 1 - start_side)))
    # the keys are a column of their own first: exploding an expression with lambdas would interpret all of it
    df = df.select("*", keys.alias("_keys")).select("*", F.explode("_keys").alias("_key")).drop("_lo", "_hi", "_keys")
    return df.select("*", F.col("_key").bitwiseAND(1).alias("side")).alias("_key")  # so _key.side is a name, too


def _inside(ls: Column, le: Column, rs: Column, re_: Column) -> tuple[Column, Column]:
    """The left start lies in the right range; the right start lies in the left range behind its start."""
    return ls.between(rs, re_), (rs > ls) & (rs <= le)


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str],
                 left_range: tuple[str, str], right_range: tuple[str, str],
                 width: int = DEFAULT_BUCKET, how: str = "inner") -> DataFrame:
    """Join rows whose closed ranges overlap, equal on ``keys``.

    ``how="left"`` keeps every left row: one that overlaps nothing appears once
    with null right columns, and so may one that does overlap.
    Column names other than ``keys`` must be distinct between the sides; ``side``
    is taken.
    """
    ls, le = left_range
    rs, re_ = right_range
    lb = _keyed(left, ls, le, width, 0).withColumnsRenamed({"_key": "_lkey", "side": "_lside"})
    rb = _keyed(right, rs, re_, width, 1).withColumnRenamed("_key", "_rkey").drop("side")
    for k in keys:
        rb = rb.withColumnRenamed(k, f"_r_{k}")
    cond = F.col("_lkey") == F.col("_rkey")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_r_{k}"))
    left_start, right_start = _inside(F.col(ls), F.col(le), F.col(rs), F.col(re_))
    joined = lb.join(rb, cond & F.when(F.col("_lside") == 0, left_start).otherwise(right_start), how)
    if how == "left":
        joined = joined.where(F.col("_rkey").isNotNull() | (F.col("_lkey").bitwiseAND(15) == 0))  # the start in its own bucket
    return joined.drop("_lkey", "_lside", "_rkey", *[f"_r_{k}" for k in keys])


def overlap_hits(left: DataFrame, right: DataFrame, keys: list[str], ranges: str, right_range: tuple[str, str],
                 among: DataFrame | None = None, most: int = MOST_ROWS) -> DataFrame:
    """Rows of ``left`` with ``hits``, the rows of ``right`` that equal them on
    ``keys`` and overlap one of their ranges.

    ``ranges`` names a column array<struct<lo, hi>> of closed ranges, one at least;
    ``hits`` is an ascending array of distinct structs of the right columns but
    ``keys``.  Rows of ``left`` are distinct; those are kept whose keys are
    ``among`` those of that table (of ``right`` if there is none).
    """
    rs, re_ = right_range
    rows = right.select(*keys, F.struct(*[c for c in right.columns if c not in keys]).alias("_row"))
    if among is not None:  # rows without _row, not a join: its conditions would reach the left rows, of one branch below only
        rows = rows.unionByName(among.select(*keys, F.lit(None).cast(rows.schema["_row"].dataType).alias("_row")))
    rows = rows.select("*", F.count("_row").over(Window.partitionBy(*keys)).alias("_n"))
    few = F.col("_n") <= most
    # the right rows of each key value, null if they are too many
    arrays = F.when(F.max("_n") <= most, F.sort_array(F.collect_set(F.when(few, F.col("_row")))))
    index = rows.groupBy(*keys).agg(arrays.alias("_rows"), F.max(F.isnull("_row")).alias("_among"))
    if among is not None:
        index = index.where("_among")
    index = index.drop("_among")
    # no filter here concerns the left rows (inline would bring one): both branches read one shuffle of them
    by_array, by_tree = (left.join(index.where(some), keys) for some in ("_rows IS NOT NULL", "_rows IS NULL"))
    overlaps = lambda d: F.exists(ranges, lambda r: operator.or_(*_inside(r["lo"], r["hi"], d[rs], d[re_])))
    pairs = overlap_join(by_tree.select(*left.columns, F.inline_outer(ranges).alias("_start", "_end")),
                         rows.where(~few & F.isnotnull("_row")).select(*keys, "_row", F.col("_row")[rs].alias("_first"), F.col("_row")[re_].alias("_last")),
                         keys, ("_start", "_end"), ("_first", "_last"), how="left")
    return (by_array.select(*left.columns, F.filter("_rows", overlaps).alias("hits"))
            .unionByName(pairs.groupBy(*left.columns).agg(F.sort_array(F.collect_set("_row")).alias("hits"))))
