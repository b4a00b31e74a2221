"""Quality rules with cross-document line frequency.

1. Every document gives its counts and, for each distinct line with a word, a
   hash of the normalised line and the words of all its occurrences.  Lines
   are normalised by lower-casing A-Z, turning white space into one space, and
   trimming.  Digits stay: rows of a table are different lines.
2. Distinct documents are counted per (host, line) and per host.  Copies of
   one text are one document, so a page that was fetched often doesn't make
   its own lines boilerplate.  Counts are pre-aggregated by (host, line, text)
   before each shuffle, so a line that a third of all rows carry is spread by
   its texts and then counted from partial sums.
3. A line goes if more documents of its host carry it than both
   ``min_documents`` and ``share`` of the host's documents.
4. A document is depleted, and rejected, if the remaining lines hold less than
   ``left`` of its words.  Documents that fail the base rules are rejected too.

The host is the ``source`` column, or any other column by name.

Defined cases: null text has no words and fails the base rules, as does an
empty one.  A null host is a host of its own.  Repeated rows are one document
in the counts and are each answered alike.  A very long text is one row's
work; its three-word windows are counted as numbers in arrays.  Ties: a line
at a limit stays, a document at ``left`` stays.  Empty tables give no rows.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolens.llm.common import slices, written

MIN_WORDS = 50
MAX_REPEATED = 50   # percent of words in repeated three-word windows
MIN_DOCUMENTS = 10
SHARE = 0.005
LEFT = 0.5

_SYMBOLS = [bytes([x]) for x in b"#*$%&|<>"]


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    code = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    _, pair = np.unique(code[:-1] * len(numbers) + code[1:], return_inverse=True)
    _, window, many = np.unique(pair[:-1].astype(np.int64) * len(numbers) + code[2:], return_inverse=True, return_counts=True)
    again = many[window] > 1
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k:k + len(again)] |= again
    return int(inside.sum())


def normalised(line: bytes) -> bytes:
    return b" ".join(line.lower().split())


def _key(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def measure(text: bytes) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, keys of the distinct
    normalised lines and the words of each.  bytes.split() knows the six separators only."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    of_line: dict[int, int] = {}
    for line in lines:
        key = _key(normalised(line))
        of_line[key] = of_line.get(key, 0) + len(line.split())
    return (len(words), len(b"".join(words).decode("utf-8", "replace")), sum(text.count(x) for x in _SYMBOLS), len(lines) - len(set(lines)),
            repeated_words(words), list(of_line), list(of_line.values()))


def _measured(batches):
    for batch in slices(batches, "text"):
        texts = [x or b"" for x in batch.column(2).cast(pa.large_binary()).to_pylist()]
        columns = list(zip(*map(measure, texts), strict=True))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([_key(x) for x in texts], pa.int64()), *(pa.array(x, pa.int64()) for x in columns[:5]),
             pa.array(columns[5], pa.list_(pa.int64())), pa.array(columns[6], pa.list_(pa.int64()))],
            ["doc_id", "host", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines", "words"])


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Counts, text_key and line keys of every row; row_no tells rows apart."""
    some = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).cast("string").alias("text"))
    out = some.mapInArrow(_measured, "doc_id long, host string, text_key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                                     "lines array<long>, words array<long>")
    return written(out.withColumn("row_no", F.monotonically_increasing_id()), "quality-rows")


def line_frequencies(rows: DataFrame) -> DataFrame:
    """host, line, documents: distinct texts of the host that have the line."""
    each = rows.select("host", "text_key", F.explode("lines").alias("line"))
    return each.groupBy("host", "line").agg(F.count_distinct("text_key").alias("documents"))


def frequent_lines(rows: DataFrame, min_documents: int = MIN_DOCUMENTS, share: float = SHARE) -> DataFrame:
    """host, line: lines of more documents than both limits allow."""
    hosts = rows.groupBy("host").agg(F.count_distinct("text_key").alias("of_host")).select(F.col("host").alias("same_host"), "of_host")
    some = line_frequencies(rows).where(F.col("documents") > min_documents)
    found = some.join(hosts, F.col("host").eqNullSafe(F.col("same_host"))).where(F.col("documents") > F.col("of_host") * share)
    return written(found.select("host", "line"), "quality-lines")


def removed_lines(rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """row_no, line, words: the frequent lines of every row."""
    each = rows.select("row_no", F.col("host").alias("own_host"), F.explode(F.arrays_zip("lines", "words")).alias("x"))
    each = each.select("row_no", "own_host", F.col("x.lines").alias("own_line"), F.col("x.words").alias("words"))
    return each.join(frequent, (F.col("own_line") == F.col("line")) & F.col("own_host").eqNullSafe(F.col("host"))).select("row_no", "line", "words")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          min_documents: int = MIN_DOCUMENTS, share: float = SHARE, left: float = LEFT) -> DataFrame:
    """One row per row: doc_id, the counts, n_removed_words, base_failed, kept."""
    rows = measured(docs, id_col, text_col, host_col)
    gone = removed_lines(rows, frequent_lines(rows, min_documents, share)).groupBy("row_no").agg(F.sum("words").alias("gone"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    lost = F.coalesce("gone", F.lit(0))
    return rows.join(gone, "row_no", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", lost.cast("long").alias("n_removed_words"), failed.alias("base_failed"),
        (~failed & (F.col("n_words") - lost >= F.col("n_words") * left)).alias("kept"))


def _without(batches):
    for batch in slices(batches, "text"):
        out = []
        for text, gone in zip(batch.column(1).cast(pa.large_binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
            drop = set(gone or ())
            out.append(text if not drop else b"\n".join(x for x in text.split(b"\n") if not x.strip() or _key(normalised(x)) not in drop))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.large_binary()).cast(pa.large_string()).cast(pa.string())], ["doc_id", "text"])


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
            min_documents: int = MIN_DOCUMENTS, share: float = SHARE, left: float = LEFT) -> DataFrame:
    """doc_id, text of the kept rows, frequent lines removed.  A row's lines to remove
    are gathered by (host, text); rows of equal host and text lose the same lines."""
    rows = measured(docs, id_col, text_col, host_col)
    gone = removed_lines(rows, frequent_lines(rows, min_documents, share)).groupBy("row_no").agg(F.sum("words").alias("gone"), F.collect_set("line").alias("gone_lines"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    kept = rows.join(gone, "row_no", "left").where(~failed & (F.col("n_words") - F.coalesce("gone", F.lit(0)) >= F.col("n_words") * left))
    kept = kept.groupBy("host", "text_key").agg(F.first("gone_lines").alias("gone_lines")).select(F.col("host").alias("of_host"), F.col("text_key").alias("of_text"), "gone_lines")
    keys = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).cast("string").alias("text"))
    keyed = keys.mapInArrow(_with_key, "doc_id long, host string, text string, text_key long")
    joined = keyed.join(kept, (F.col("text_key") == F.col("of_text")) & F.col("host").eqNullSafe(F.col("of_host"))).select("doc_id", "text", "gone_lines")
    return joined.mapInArrow(_without, "doc_id long, text string")


def _with_key(batches):
    for batch in slices(batches, "text"):
        keys = [_key(x or b"") for x in batch.column(2).cast(pa.large_binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], ["doc_id", "host", "text", "text_key"])


def quality_sql(min_documents: int = MIN_DOCUMENTS, share: float = SHARE, left: float = LEFT) -> str:
    """The rows as DuckDB SQL."""
    up, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    word = r"'[^\x20\x09-\x0D]+'"
    return rf"""
WITH base AS (
  SELECT row_number() OVER () AS row_no, doc_id, source AS host, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {word}) AS w FROM documents),
lines AS (
  SELECT row_no, host, t, line, len(lw) AS words, array_to_string(list_transform(lw, lambda x: translate(x, '{up}', '{low}')), ' ') AS norm
  FROM (SELECT *, regexp_extract_all(line, {word}) AS lw FROM (SELECT row_no, host, t, unnest(str_split(t, chr(10))) AS line FROM base)) WHERE len(lw) > 0),
dup AS (SELECT row_no, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY row_no),
grams AS (SELECT row_no, s, md5(w[s] || ' ' || w[s + 1] || ' ' || w[s + 2]) AS g FROM (SELECT row_no, w, unnest(range(1, len(w) - 1)) AS s FROM base WHERE len(w) > 2)),
again AS (SELECT row_no, s FROM (SELECT row_no, s, count(*) OVER (PARTITION BY row_no, g) AS n FROM grams) WHERE n > 1),
rep AS (SELECT row_no, count(DISTINCT s + o) AS n FROM again, (SELECT unnest([0, 1, 2]) AS o) GROUP BY row_no),
freq AS (SELECT host, norm, count(DISTINCT t) AS n FROM lines GROUP BY host, norm),
hosts AS (SELECT host, count(DISTINCT t) AS n FROM base GROUP BY host),
frequent AS (
  SELECT f.host, f.norm FROM freq f JOIN hosts h ON f.host IS NOT DISTINCT FROM h.host
  WHERE f.n > {min_documents} AND f.n > h.n * {share}::DOUBLE),
gone AS (
  SELECT l.row_no, sum(l.words) AS n FROM lines l JOIN frequent f ON l.norm = f.norm AND l.host IS NOT DISTINCT FROM f.host GROUP BY l.row_no),
counted AS (
  SELECT b.doc_id, len(b.w)::BIGINT AS n_words, len(array_to_string(b.w, ''))::BIGINT AS word_chars,
         len(regexp_replace(b.t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(d.n, 0)::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(g.n, 0)::BIGINT AS n_removed_words
  FROM base b LEFT JOIN dup d ON d.row_no = b.row_no LEFT JOIN rep r ON r.row_no = b.row_no LEFT JOIN gone g ON g.row_no = b.row_no),
judged AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM counted)
SELECT *, NOT base_failed AND n_words - n_removed_words >= n_words * {left}::DOUBLE AS kept FROM judged"""
