"""I-Match fingerprints with randomised lexicon subsets, in DataFrame functions only.

1. Document frequencies of all terms over all documents.  The lexicon keeps
   the terms within an inverse-document-frequency band: in at least one of
   ``rarest`` documents and at most one of ``commonest``.  At most ``rarest``
   times the mean number of distinct terms of a document can be that
   frequent, however many documents there are, so the lexicon's size is
   bounded; it is broadcast up to ``broadcast_terms`` and joined by a shuffle
   beyond.
2. A text's distinct lexicon terms are sorted and hashed once for each of the
   randomised subsets: bits of a term's hash, other bits for each rate r, deal
   the terms into r parts, and the first parts are the subsets of that rate.
   So one look tells a term's subset.  The fingerprint is the hashes in a row; 0 stands for a subset
   that holds none of the terms.
3. Likeness of two fingerprints: of the subsets that hold a term of either,
   the share whose hashes agree.  Sparse subsets still agree on texts that
   differ in part, dense ones only on equal term sets.

Terms are the A-Z lower-cased runs of ``[^\\x20\\x09-\\x0D]``, by their 64-bit hash.

The edited text needs the next document by doc_id.  Ids are cut into ranges
by approximate quantiles; each range also gets the first row of the next
range (the last range that of the first), so one window per range finds every
successor and texts shuffle once.  All that follows on a text's terms stays in
that partitioning; only fingerprints leave it.

Defined cases: null text counts as empty; a text without lexicon terms is
fingerprinted by the hash of the whole text, so equal texts always agree.
A null doc_id comes first; rows that repeat a doc_id follow each other by
text; equal rows are interchangeable.  A single row is its own successor.
Empty tables give empty results.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repolens.llm.common import written

# (r, how many): subsets that keep one of r terms, r a power of two.  Most are sparse: those tell
# how much two texts share, the dense ones that their terms are the same.
SUBSETS = ((4, 4), (16, 8), (64, 16), (256, 24), (1024, 24), (4096, 24))
_SPACES = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _terms(text: Column) -> Column:
    """Distinct term hashes of a text."""
    words = F.filter(F.split(F.translate(text, _UPPER, _LOWER), _SPACES), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(texts: DataFrame, rarest: int, commonest: int) -> DataFrame:
    """term: those in the band; texts has one row and one text per document."""
    n = texts.count()
    counts = texts.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return counts.where(f"df * {rarest} >= {n} AND df * {commonest} <= {n}").select("term")


def _range_of(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are below the value, by binary search; null is in range 0."""
    if not bounds:
        return F.lit(0)
    edges, step = F.array(*[F.lit(b).cast("long") for b in bounds]), 1 << (len(bounds).bit_length() - 1)
    steps = F.array(*[F.lit(step >> k) for k in range(step.bit_length())])
    below = F.aggregate(steps, F.lit(0), lambda at, s: F.when((at + s <= len(bounds)) & (F.get(edges, at + s - 1) < value), at + s).otherwise(at))
    return F.coalesce(below, F.lit(0))


def successors(docs: DataFrame, ranges: int) -> DataFrame:
    """docs(doc_id, text) with next_id and next_text: the row after each, the first
    after the last; partitioned by ``to``, the row's range."""
    marks = [k / ranges for k in range(1, ranges)]
    found = docs.agg(F.percentile_approx("doc_id", marks, 100 * ranges).alias("q")).first()["q"] if marks else None
    bounds = sorted(set(found or []))
    placed = docs.withColumn("range", _range_of(F.col("doc_id"), bounds))
    first = {r["range"]: r["first"] for r in placed.groupBy("range").agg(F.min(F.struct("doc_id")).alias("first")).collect()}  # one row per range
    order = sorted(first)
    before = {r: order[i - 1] for i, r in enumerate(order)}
    first_id = F.lit(None).cast("long")
    home = F.lit(None).cast("int")
    if order:
        first_id = F.get(F.array(*[F.lit(first[r]["doc_id"] if r in first else None).cast("long") for r in range(order[-1] + 1)]), F.col("range"))
        home = F.get(F.array(*[F.lit(before.get(r)).cast("int") for r in range(order[-1] + 1)]), F.col("range"))
    here = F.struct(F.col("range").alias("to"), F.lit(False).alias("guest"))
    there = F.struct(home.alias("to"), F.lit(True).alias("guest"))
    dealt = placed.select("doc_id", "text", F.explode(F.when(F.col("doc_id").eqNullSafe(first_id), F.array(here, there)).otherwise(F.array(here))).alias("at"))
    rows = Window.partitionBy("to").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    dealt = dealt.select("doc_id", "text", "at.to", "at.guest")
    return dealt.select("to", "doc_id", "text", "guest", F.lead("doc_id").over(rows).alias("next_id"), F.lead("text").over(rows).alias("next_text")).where("NOT guest")


def _fingerprint(terms: Column, whole: Column) -> Column:
    """32 bits for each subset."""
    parts, shift = [], 0
    for rate, many in SUBSETS:
        def part_of(t: Column, shift: int = shift, rate: int = rate) -> Column:
            return F.shiftrightunsigned(t, shift).bitwiseAND(rate - 1)

        def hashed(chosen: Column, j: Column) -> Column:
            return F.when(F.size(chosen) > 0, F.xxhash64(chosen, j).bitwiseAND(0xFFFFFFFE) + 1).otherwise(F.lit(0).cast("long"))

        # bound once as the member of an array, so the terms of the rate's subsets are sifted once
        held = F.array(F.filter(terms, lambda t: part_of(t) < many) if many < rate else terms)
        numbers = F.sequence(F.lit(0).cast("long"), F.lit(many - 1).cast("long"))
        of_rate = F.transform(held, lambda some: F.transform(numbers, lambda j: hashed(F.filter(some, lambda t: part_of(t) == j), j + 1000 * rate)))
        parts.append(F.get(of_rate, F.lit(0)))
        shift += rate.bit_length() - 1
    plain = F.array_repeat(whole.bitwiseAND(0xFFFFFFFE) + 1, sum(many for _, many in SUBSETS))
    return F.when(F.size(terms) > 0, F.concat(*parts)).otherwise(plain)


def fingerprint_text(fingerprint: Column) -> Column:
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Of the subsets that hold a term of either, the share that agrees."""
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
    held = F.size(F.filter(pairs, lambda p: (p["a"] != 0) | (p["b"] != 0)))
    same = F.size(F.filter(pairs, lambda p: (p["a"] != 0) & (p["a"] == p["b"])))
    return F.when(held > 0, same / held).otherwise(F.lit(1.0))


def _hashed(rows: DataFrame, words: DataFrame, info: list[str]) -> DataFrame:
    """rows(to, id, which, text, *info) -> to, id, which, *info, fingerprint.

    The first exploded row of a text, with a null term, carries the other
    columns; the rest are a number and a term, so the grouping moves little.
    """
    numbered = rows.select("to", "id", "which", *info, F.xxhash64("text").alias("whole"), _terms(F.col("text")).alias("terms"))
    flat = numbered.select("to", "id", "which", "whole", *info, F.explode(F.concat(F.array(F.lit(None).cast("long")), F.col("terms"))).alias("term"))
    lead = F.struct("whole", *info)
    thin = flat.select("to", "id", "which", "term", F.when(F.col("term").isNull(), lead).alias("lead"))
    hits = thin.join(words.withColumn("known", F.lit(True)), "term", "left").where("known OR term IS NULL")
    grouped = hits.groupBy("to", "id", "which").agg(F.sort_array(F.collect_list("term")).alias("terms"), F.max("lead").alias("lead"))
    return grouped.select("to", "id", "which", *[F.col(f"lead.{c}").alias(c) for c in info], _fingerprint(F.col("terms"), F.col("lead.whole")).alias("fingerprint"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rarest: int = 2000, commonest: int = 10,
                 broadcast_terms: int = 2_000_000, ranges: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    words = written(lexicon(texts, rarest, commonest), "lexicon")
    if words.count() <= broadcast_terms:
        words = F.broadcast(words)
    ranges = ranges or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half))
    rows = successors(texts, ranges).select(
        "to", F.monotonically_increasing_id().alias("id"), "doc_id", "text", edited.alias("edited"), F.length("text").cast("long").alias("n_chars"),
        F.xxhash64("text").alias("text_hash"), "next_id", F.xxhash64("next_text").alias("next_hash"))
    info = ["doc_id", "n_chars", "text_hash", "next_id", "next_hash", "edited_sha"]
    both = rows.select("to", "id", "doc_id", "n_chars", "text_hash", "next_id", "next_hash", F.explode(F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("text"), F.lit(None).cast("binary").alias("edited_sha")),
        F.struct(F.lit(1).alias("which"), F.col("edited").alias("text"), F.unhex(F.sha2(F.col("edited").cast("binary"), 256)).alias("edited_sha")))).alias("one"))
    both = both.select("to", "id", "doc_id", "n_chars", "text_hash", "next_id", "next_hash", "one.*")
    hashed = _hashed(both, words, info)
    pair = hashed.groupBy("to", "id").agg(*[F.max(c).alias(c) for c in info], F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("own"),
                                    F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("other"))
    done = written(pair.drop("to", "id"), "imatch")
    after = done.groupBy(F.col("doc_id").alias("after_id"), F.col("text_hash").alias("after_hash")).agg(F.max("own").alias("after"))
    out = done.join(after, F.expr("next_id <=> after_id AND next_hash = after_hash"), "left")
    return out.select("doc_id", "n_chars", F.lower(F.hex("edited_sha")).alias("edited_sha256"), fingerprint_text(F.col("own")).alias("fingerprint"),
                      fingerprint_text(F.col("other")).alias("edited_fingerprint"), likeness(F.col("own"), F.col("other")).alias("near_edited"),
                      likeness(F.col("own"), F.col("after")).alias("near_next"))
