"""Mixing sources to target weights by hash-threshold histograms.

Every document has a fixed hash.  For each source, words are summed by the
leading digit of the hash; the digit in which the running sum crosses the
source's budget is the boundary, and only that bucket is summed again by its
next digit, until one hash value is left.  Documents at or below the
threshold are taken.  Nothing is sorted, and the thresholds are nested: a
larger budget takes the same documents and more.

A target above the source's size takes every document once and the ones
below the threshold once more.  The boundary document is taken if that
brings the source nearer to its target.

Defined cases: null text has size 0; null source is a source of its own,
ordered last; rows with equal doc_id (or none) share a hash, so they are
taken together.  Empty tables and sources of size 0 take nothing.  The
hash depends on doc_id alone, so reruns agree.  Other columns are carried
untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repolens.llm.common import written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
DIGIT_BITS = 12
HASH_BITS = 60


def _size(text):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _hash(doc_id):
    """The first 60 bits of the MD5 of the id's text."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """src, source_size, target: one row per source.

    A source is capped when, at the level where it meets its cap, all
    sources together don't exceed the words to share.  The windows run over
    one row per source.
    """
    by_source = sized.groupBy("src").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("src").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    level = by_source.withColumn("weight", weight.cast("long")).withColumn("cap", (F.col("source_size") * most).cast("long"))
    level = level.withColumn("ratio", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy()
    below = Window.orderBy("ratio")
    level = (level.withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
             .withColumn("weights", F.sum("weight").over(everything))
             .withColumn("caps_to", F.sum("cap").over(below)).withColumn("weights_to", F.sum("weight").over(below))
             .withColumn("caps_at", F.sum("cap").over(Window.partitionBy("ratio"))).withColumn("weights_at", F.sum("weight").over(Window.partitionBy("ratio")))
             .withColumn("capped", F.expr("caps_to - caps_at + ratio * (weights - weights_to + weights_at) <= total")))
    spent = F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything)
    open_weight = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything)
    each = F.when(open_weight > 0, (F.col("total") - spent) / open_weight)
    return level.select("src", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(each * F.col("weight")).alias("target"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """src, source_size, target, whole (times every document is taken),
    threshold: documents with hash <= threshold are taken once more."""
    state = targets.select("src", "source_size", "target", F.expr("CASE WHEN target >= source_size THEN 1L ELSE 0L END").alias("whole"))
    state = state.select("*", F.expr("target - whole * source_size").alias("budget"), F.lit(0).cast("long").alias("spent"),
                         F.lit(0).cast("long").alias("prefix"), F.lit(None).cast("long").alias("threshold"))
    state = written(state, "mix-level")
    for shift in range(HASH_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        open_ = state.where("threshold IS NULL").withColumnRenamed("src", "state_src")
        inside = sized.join(open_, F.expr(f"src <=> state_src AND shiftright(hash, {shift + DIGIT_BITS}) = prefix"))
        buckets = (inside.groupBy("state_src", "spent", "budget", F.expr(f"shiftright(hash, {shift})").alias("digit"))
                   .agg(F.sum("size").alias("words"), F.min("hash").alias("low"), F.max("hash").alias("high")))
        run = buckets.withColumn("upto", F.col("spent") + F.sum("words").over(Window.partitionBy("state_src").orderBy("digit")))
        # the boundary: the first digit that reaches the budget, or the last of all
        edge = run.groupBy("state_src").agg(
            F.min(F.when(F.col("upto") >= F.col("budget"), F.struct("digit", "upto", "words", "low", "high"))).alias("hit"),
            F.max("high").alias("top"))
        edge = edge.select(F.col("state_src").alias("edge_src"), "hit", "top")
        nearer = "CASE WHEN hit.upto - budget <= budget - (hit.upto - hit.words) AND hit.words > 0 THEN hit.low ELSE hit.low - 1 END"
        state = state.join(edge, F.expr("src <=> edge_src"), "left").select(
            "src", "source_size", "target", "whole", "budget",
            F.expr("CASE WHEN threshold IS NULL AND hit IS NOT NULL THEN hit.upto - hit.words ELSE spent END").alias("spent"),
            F.expr("CASE WHEN threshold IS NULL AND hit IS NOT NULL THEN hit.digit ELSE prefix END").alias("prefix"),
            F.expr(f"CASE WHEN threshold IS NOT NULL THEN threshold WHEN hit IS NULL THEN top WHEN hit.low = hit.high THEN {nearer} END").alias("threshold"))
        state = written(state, "mix-level")
        if state.where("threshold IS NULL").isEmpty():
            break
    return state.select("src", "source_size", "target", "whole", "threshold")


def _copies():
    return F.expr("whole + CASE WHEN hash <= threshold THEN 1L ELSE 0L END")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken."""
    sized = written(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("src"),
                                _size(F.col(text_col).cast("string")).alias("size"), _hash(F.col(id_col)).alias("hash")), "mix-sizes")
    plan = thresholds(sized, source_targets(sized, weights, share, most)).withColumnRenamed("src", "plan_src")
    return (sized.join(plan, F.expr("src <=> plan_src"), "left")
            .select("doc_id", F.col("src").alias("source"), "size", "source_size", "target", (F.col("size") * _copies()).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The mix itself: ``docs`` with each row as many times as it is taken."""
    columns = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(id_col).alias("doc_id"),
                        F.col(source_col).cast("string").alias("src"), F.col(text_col).cast("string").alias("text"))
    sized = written(whole.select("src", _size(F.col("text")).alias("size"), _hash(F.col("doc_id")).alias("hash")), "mix-sizes")
    plan = thresholds(sized, source_targets(sized, weights, share, most)).withColumnRenamed("src", "plan_src")
    taken = whole.withColumn("hash", _hash(F.col("doc_id"))).join(plan, F.expr("src <=> plan_src")).withColumn("copies", _copies()).where("copies > 0")
    return taken.select("row", F.explode(F.expr("sequence(1L, copies)")).alias("copy")).select("row.*")
