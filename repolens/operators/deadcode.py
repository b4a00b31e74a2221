"""Dead-code candidates: function names mentioned exactly once per repository.

The analysed tool counts ``\\bname\\b`` over the concatenated text of every
``.py`` file, once per name.  A whole-word match of an identifier is a
maximal run of word characters equal to the name, so one word count per
repository plus an equality join gives the same numbers in one pass.
Comments and strings count, as there.  Names are keyed bare; when several
files define the same name the greatest path wins (deterministic form of
"the later file overwrites").  Admittedly imprecise: a candidate list only.

Only words that are function names are counted.  The names' hashes fill a
Bloom filter of ``SLOTS`` byte slots; it is a literal of that size in the plan,
however many names there are, and each file's word array is filtered by it
before it is exploded.  So other words reach neither the aggregation nor the
shuffle, but for the few that the filter lets through, which the join drops.
(With many times more names than slots the filter lets most words through, and
the join alone decides.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repolens.functions.text import DEAD_CODE_SKIP_DIRS, WORD_RE, in_skipped_dir

# Byte slots of the names' filter, and probes of each name.
SLOTS, PROBES = 1 << 18, 2


def _workspace(files: DataFrame) -> DataFrame:
    return files.where(F.col("path").endswith(".py") & ~in_skipped_dir(F.col("path"), DEAD_CODE_SKIP_DIRS))


def defined_functions(files: DataFrame, symbols: DataFrame) -> DataFrame:
    """Non-dunder bare def names per repo with their (last-wins) file."""
    ws = _workspace(files).select("repo", "path")
    defs = symbols.where((F.col("kind") == "def") & (F.col("lang") == "python"))
    name = F.col("name")
    defs = defs.where(~(name.startswith("__") & name.endswith("__")))
    defs = defs.join(ws, ["repo", "path"], "left_semi")
    return defs.groupBy("repo", "name").agg(F.max("path").alias("path"))


def _slots(repo: Column, word: Column) -> list[Column]:
    """A word's places in the filter: two halves of one 64-bit hash."""
    h = F.xxhash64(repo, word)
    return [F.pmod(F.shiftrightunsigned(h, 32 * k) if k else h, F.lit(SLOTS)).cast("int") for k in range(PROBES)]


def name_filter(names: DataFrame) -> bytes:
    """names(repo, name) as a Bloom filter of SLOTS bytes; the driver gathers SLOTS numbers at most."""
    taken = names.select(F.explode(F.array(*_slots(F.col("repo"), F.col("name")))).alias("slot")).distinct()
    out = bytearray(SLOTS)
    for row in taken.collect():
        out[row["slot"]] = 1
    return bytes(out)


def mentions(files: DataFrame, names: DataFrame) -> DataFrame:
    """(repo, name, n): whole-word occurrences, in a repository's files, of words that
    may be among names(repo, name)."""
    slots = F.lit(name_filter(names.select("repo", "name")))
    held = lambda at: F.substring(slots, at + 1, F.lit(1)) == F.lit(b"\x01")

    def may_be_name(word: Column) -> Column:
        first, second = (held(at) for at in _slots(F.col("repo"), word))
        return first & second

    words = F.filter(F.regexp_extract_all("content", F.lit(WORD_RE), 0), may_be_name)
    return files.select("repo", F.explode(words).alias("name")).groupBy("repo", "name").agg(F.count(F.lit(1)).alias("n"))


def name_mentions(files: DataFrame, names: DataFrame) -> DataFrame:
    """(repo, name, path, n) of every name that occurs."""
    return names.join(mentions(_workspace(files), names), ["repo", "name"], "inner")


def functions_scanned(files: DataFrame, symbols: DataFrame) -> DataFrame:
    return defined_functions(files, symbols).groupBy("repo").agg(
        F.count(F.lit(1)).alias("functions_scanned"))


def dead_code_candidates(files: DataFrame, symbols: DataFrame) -> DataFrame:
    """(repo, function, path) for names whose word count in the repo is 1."""
    found = name_mentions(files, defined_functions(files, symbols))
    return found.where(F.col("n") == 1).select("repo", F.col("name").alias("function"), "path")


def dead_code_report(files: DataFrame, symbols: DataFrame) -> DataFrame:
    """Candidates with the per-repo scanned count, in one plan:
    (repo, function, path, functions_scanned)."""
    names = defined_functions(files, symbols)
    scanned = names.groupBy("repo").agg(F.count(F.lit(1)).alias("functions_scanned"))
    dead = name_mentions(files, names).where(F.col("n") == 1)
    return dead.join(scanned, "repo", "inner").select("repo", F.col("name").alias("function"), "path", "functions_scanned")
