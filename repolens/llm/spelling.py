"""Spelling variants by a dictionary of trie-node pairs.

1. Words are counted: a task pre-aggregates its rows, one entry per word.
2. Words sorted as text are the leaves of the forward trie, and sorted as
   reversed text those of the backward trie.  A word adds to the trie the nodes
   beyond its common prefix with the word before, so one pass over each sorted
   range numbers the nodes in preorder; the few nodes that a range shares with
   the ranges before are known from one row per range.
3. A word of L letters is L + 1 pairs (node of a prefix, node of the rest's
   suffix) and L pairs that skip one position.  Pairs of integers stand for
   whole words exactly: equal skipping pairs are words that differ at that
   position; a skipping pair equal to a whole one is a word with one letter
   more.  Of a run of equal letters only the first is skipped for that, so each
   neighbour is found once.
4. A word's form is its most frequent neighbour if that is at least twice as
   frequent; forms are followed by pointer doubling, in as many rounds as the
   logarithm of the longest chain (frequencies double along a chain).

A pair that skips a position belongs to one word per letter of the alphabet at
most, so no join key is hot and a word has few neighbours per position.  Hot
words, however frequent, are one row per task.

Defined cases: null text has no words.  A null doc_id counts as an empty text
in the checksum.  Repeated rows are counted each.  Very long texts are one
row's work; very long words have as many pairs as letters.  Ties between
neighbours of equal frequency go to the smallest in code-point order.  Tables
without words give no rows.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolens.llm.common import slices, written

MIN_LETTERS = 5
MIN_COUNT = 3
TYPO = 97        # checksums divisible by this lose a letter
HELD = 200_000   # words that a task counts before it passes them on

# letters A-Z, a-z and U+00C0 to U+00FF, in UTF-8
_RUN = re.compile(rb"(?:[A-Za-z]|\xC3[\x80-\xBF])+")


def words_of(doc_id: int | None, text: bytes) -> Counter:
    """Words of a text, lower-cased and with the planted deletions, with their counts."""
    out: Counter = Counter()
    prefix = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    for run, n in Counter(_RUN.findall(text.lower())).items():  # bytes.lower() changes ASCII only
        h = zlib.crc32(run, prefix)
        if h % TYPO == 0:
            letters = run.decode()
            at = h % len(letters)
            run = (letters[:at] + letters[at + 1:]).encode()
        out[run] += n
    return out


def _counted(batches):
    held: Counter = Counter()

    def batch():
        some = [(w, n) for w, n in held.items() if len(w) >= MIN_LETTERS and (len(w) >= 2 * MIN_LETTERS or len(w.decode()) >= MIN_LETTERS)]
        words, counts = zip(*some, strict=True) if some else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["word", "n"])

    for some in slices(batches, "text"):
        for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).cast(pa.large_binary()).to_pylist(), strict=True):
            if text:
                held.update(words_of(doc_id, text))
            if len(held) >= HELD:
                yield batch()
                held.clear()
    yield batch()


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: words of at least MIN_LETTERS letters that occur MIN_COUNT times or more."""
    some = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = some.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return written(counts.where(F.col("n") >= MIN_COUNT), "spelling-words")


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    k = 0
    while a[k] == b[k]:
        k += 1
    return k


_NUMBERED = "id long, part int, key string, rest string, nodes array<long>, new long"


def _numbered(batches):
    """Nodes of a range's words by local numbers: 0 the root, then in preorder; the
    range's first word brings all its nodes.  The last row of a range has its node count."""
    part, count, nth, before, path = TaskContext.get().partitionId(), 0, 0, "", [0]
    for batch in batches:
        keys, rest = batch.column(0).to_pylist(), batch.column(1)
        paths, news = [], []
        for key in keys:
            shared = _common(before, key)
            path = path[:shared + 1] + list(range(count + 1, count + len(key) - shared + 1))
            count += len(key) - shared
            before = key
            paths.append(path)
            news.append(count)
        ids = [(part << 33) + nth + k for k in range(len(keys))]
        nth += len(keys)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([part] * len(keys), pa.int32()), pa.array(keys, pa.string()), rest,
                                          pa.array(paths, pa.list_(pa.int64())), pa.array(news, pa.int64())], ["id", "part", "key", "rest", "nodes", "new"])


def trie(words: DataFrame, key: str, rest: str, name: str) -> DataFrame:
    """id (ascending in the order of ``key``), key, rest (as text), nodes: of each prefix, the empty one first."""
    spark = words.sparkSession
    ranges = words.select(F.col(key).alias("key"), F.col(rest).cast("string").alias("rest")).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "key").sortWithinPartitions("key")
    local = written(ranges.mapInArrow(_numbered, _NUMBERED), name)
    ends = local.groupBy("part").agg(F.min("key").alias("first"), F.max_by(F.struct("key", "nodes"), "id").alias("last"), F.max("new").alias("new")).orderBy("part")
    rows, base, before, path = [], 0, "", [0]
    for end in ends.collect():  # one row per range, of the lengths of two words
        shared = _common(before, end["first"])
        known = path[:shared + 1]
        path = [known[m] if m <= shared else base + m - shared for m in end["last"]["nodes"]]
        rows.append((end["part"], base - shared, known))
        base, before = base + end["new"] - shared, end["last"]["key"]
    table = spark.createDataFrame(rows, "part int, shift long, known array<long>")
    local = local.join(table, "part")
    return local.select("id", "key", "rest", F.expr("transform(nodes, m -> if(m < size(known), known[int(m)], m + shift))").alias("nodes"))


def pairs(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, word, n) and the dictionary (p, s, kind, id, n): whole words are kind 2; skipped
    positions 1, or 0 if the letter repeats the one before."""
    ahead = written(trie(words, "word", "n", "spelling-forward").withColumn("n", F.col("rest").cast("long")), "spelling-ids")
    known = ahead.select("id", F.col("key").alias("word"), "n")
    back = trie(known.select(F.reverse("word").alias("reversed"), "id"), "reversed", "id", "spelling-backward")
    both = ahead.join(back.select(F.col("rest").cast("long").alias("id"), F.col("nodes").alias("ends")), "id")
    size = "size(nodes) - 1"
    letters = both.select("id", "n", "nodes", "ends", F.expr("filter(split(key, ''), x -> x <> '')").alias("c"))
    entries = letters.select("id", "n", F.explode(F.expr(
        f"concat(transform(sequence(0, {size}), i -> struct(nodes[i] AS p, ends[{size} - i] AS s, 2 AS kind)), "
        f"transform(sequence(0, {size} - 1), i -> struct(nodes[i] AS p, ends[{size} - 1 - i] AS s, if(i > 0 AND c[i] = c[if(i > 0, i - 1, 0)], 0, 1) AS kind)))")).alias("x"))
    return known, written(entries.select("x.p", "x.s", "x.kind", "id", "n"), "spelling-pairs")


def neighbours(entries: DataFrame) -> DataFrame:
    """id, other, other_n: every word with each of its neighbours."""
    a = entries.select("p", "s", "kind", "id")
    b = entries.select("p", "s", F.col("kind").alias("other_kind"), F.col("id").alias("other"), F.col("n").alias("other_n"))
    met = "id <> other AND ((kind < 2 AND other_kind < 2) OR (kind = 1 AND other_kind = 2) OR (kind = 2 AND other_kind = 1))"
    often = entries.groupBy("p", "s").agg(F.count(F.lit(1)).alias("many"), F.min("kind").alias("least")).where("many > 1 AND least < 2").select("p", "s")
    a = written(a.join(often, ["p", "s"]).select("p", "s", "kind", "id"), "spelling-met")
    return a.join(b, ["p", "s"]).where(met).select("id", "other", "other_n")


def followed(forms: DataFrame) -> DataFrame:
    """forms(id, to) -> id, to: the end of every chain, by pointer doubling."""
    now = written(forms.withColumn("moved", F.lit(True)), "spelling-chains")
    while not now.where("moved").isEmpty():
        ahead = now.select(F.col("id").alias("to"), F.col("to").alias("further"))
        now = written(now.select("id", "to").join(ahead, "to", "left").select("id", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")), "spelling-chains")
    return now.select("id", "to")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root."""
    known, entries = pairs(vocabulary(docs, id_col, text_col))
    best = neighbours(entries).groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), F.max(F.struct(F.col("other_n").alias("n"), (-F.col("other")).alias("back"))).alias("best"))
    found = known.join(best, "id", "left").select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                                  F.when(F.col("best.n") >= 2 * F.col("n"), F.struct((-F.col("best.back")).alias("id"), F.col("best.n").alias("n"))).alias("form"))
    found = written(found.select("id", "word", "n", "n_near", F.col("form.id").alias("form_id"), F.col("form.n").alias("form_n")), "spelling-found")
    roots = followed(found.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("to")))
    named = lambda key, name: known.select(F.col("id").alias(key), F.col("word").alias(name))
    linked = found.join(roots.withColumnRenamed("to", "root_id"), "id", "left").join(named("form_id", "form"), "form_id", "left").join(named("root_id", "root"), "root_id", "left")
    return linked.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants_sql() -> str:
    """The rows as DuckDB SQL: neighbours by patterns with one letter left out."""
    up, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(r, '{up}', '{low}') AS r
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents)),
counted AS (SELECT doc_id, r, count(*) AS n, encode(coalesce(doc_id::VARCHAR, '') || ':' || r) AS k FROM runs GROUP BY doc_id, r),
table256 AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i::BIGINT], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(0, 256)) AS i))),
summed AS (
  SELECT r, n, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, len(hex(k)) // 2), lambda j: ('0x' || substr(hex(k), 2 * j + 1, 2))::BIGINT)),
                   lambda c, x: xor(c >> 8, t[1 + xor(c % 256, x)]))) AS h
  FROM counted, table256),
typed AS (SELECT CASE WHEN h % {TYPO} = 0 THEN substr(r, 1, (h % len(r))::BIGINT) || substr(r, (h % len(r))::BIGINT + 2) ELSE r END AS word, n FROM summed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM typed WHERE len(word) >= {MIN_LETTERS} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM words)),
near AS (
  SELECT DISTINCT * FROM (
    SELECT x.word, y.word AS other, y.n AS other_n FROM cut x JOIN cut y ON x.a = y.a AND x.b = y.b AND x.i = y.i AND x.word <> y.word
    UNION ALL SELECT x.word, w.word, w.n FROM cut x JOIN words w ON w.word = x.a || x.b
    UNION ALL SELECT w.word, x.word, x.n FROM cut x JOIN words w ON w.word = x.a || x.b)),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS top FROM near GROUP BY word),
form AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top >= 2 * w.n THEN b.top END AS form_n,
         CASE WHEN b.top >= 2 * w.n THEN (SELECT min(e.other) FROM near e WHERE e.word = w.word AND e.other_n = b.top) END AS form
  FROM words w LEFT JOIN best b ON b.word = w.word),
chain(word, last, step) AS (
  SELECT word, word, 0 FROM form UNION ALL SELECT c.word, f.form, c.step + 1 FROM chain c JOIN form f ON f.word = c.last WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(last, step) AS root FROM chain GROUP BY word)
SELECT f.word, f.form, e.root, f.n::BIGINT AS n, f.n_near::BIGINT AS n_near, f.form_n::BIGINT AS form_n FROM form f JOIN ends e ON e.word = f.word"""
