"""A trigram index for line searches.

The index has a row per file: its distinct trigrams as numbers, and the stored
file that holds it.  A pattern that needs certain literals needs their
trigrams, so a search first reads the index alone, keeps the files that have all
trigrams of one of the pattern's alternatives, and then reads only the stored
files with candidates and searches those; results are those of ``search_code``.
A pattern without such literals (``@|the``) searches every file.

Trigrams are taken from text folded as the search folds it: lower case, and the
four characters that case-insensitive matching takes for ASCII letters.  They
are hashed to ``GRAMS`` numbers; a collision only keeps a file more.
"""

from __future__ import annotations

import re
from re import _constants as op  # the standard library's own reading of a pattern
from re import _parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repolens.functions.text import SEARCH_MATCH_CAP, SEARCHABLE_SUFFIXES, suffix
from repolens.operators.search import search_code, validate_pattern

GRAMS = 1 << 20
# Alternatives that a pattern may have before every file is searched.
MOST = 64
# Long s, Kelvin sign, dotted capital I and dotless i match s, k and i whatever the case.
_FOLDED, _PLAIN = "ſKİı", "skii"


def _folded(text: Column) -> Column:
    return F.lower(F.translate(text, _FOLDED, _PLAIN))


def _number(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(GRAMS)).cast("int")


def file_grams(text: Column) -> Column:
    """Sorted distinct trigram numbers of a text."""
    found = F.regexp_extract_all(_folded(text), F.lit(r"(?s)(?=(...))"), 1)
    return F.array_sort(F.array_distinct(F.transform(F.array_distinct(found), _number)))


def build_index(files: DataFrame) -> DataFrame:
    """files(repo, path, content), read from a stored table -> repo, path, stored, grams."""
    return files.where(F.lower(suffix(F.col("path"))).isin(*SEARCHABLE_SUFFIXES)).select(
        "repo", "path", F.col("_metadata.file_path").alias("stored"), file_grams(F.col("content")).alias("grams"))


def _alternatives(items) -> list[frozenset] | None:
    """Sets of trigrams; a match has all of at least one.  None: too many to tell."""
    found: list[set] = [set()]
    run = ""

    def with_run():
        nonlocal run
        for some in found:
            some.update(run[i:i + 3] for i in range(len(run) - 2))
        run = ""

    for kind, value in items:
        if kind is op.LITERAL:
            c = chr(value).translate(str.maketrans(_FOLDED, _PLAIN)).lower()
            if len(c) == 1 and c.isascii():  # others may match characters that fold in other ways
                run += c
                continue
        with_run()
        inner = None
        if kind is op.SUBPATTERN:
            inner = _alternatives(value[3])
        elif kind is op.BRANCH:
            parts = [_alternatives(x) for x in value[1]]
            inner = None if any(x is None for x in parts) else [y for x in parts for y in x]
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT) and value[0] > 0:
            inner = _alternatives(value[2])
        if inner:
            found = [a | b for a in found for b in inner]
            if len(found) > MOST:
                return None
    with_run()
    return [frozenset(x) for x in found]


def required_grams(pattern: str) -> list[frozenset] | None:
    """The trigrams of each alternative of a pattern; None if some match needs none."""
    try:
        found = _alternatives(_parser.parse(pattern, re.IGNORECASE))
    except (re.error, OverflowError):  # what only the JVM's dialect reads
        return None
    return found if found and all(found) else None


def candidates(index: DataFrame, pattern: str) -> DataFrame:
    """repo, path, stored of the files that may match."""
    grams = required_grams(pattern)
    if grams is None:
        return index.select("repo", "path", "stored")
    needed = F.lit(False)
    for some in grams:
        needed = needed | F.forall(F.array(*[_number(F.lit(g)) for g in sorted(some)]), lambda g: F.array_contains("grams", g))
    return index.where(needed).select("repo", "path", "stored")


def search_indexed(spark: SparkSession, index: DataFrame, pattern: str, read=None, prefix: str | None = None, cap: int | None = SEARCH_MATCH_CAP) -> DataFrame:
    """``search_code`` over the indexed files: (repo, path, line_no, match).

    ``read(paths)`` gives files(repo, path, content) of the stored files; the driver
    gathers the names of those with candidates, not their rows."""
    validate_pattern(pattern)
    read = read or (lambda paths: spark.read.parquet(*paths))
    found = candidates(index, pattern)
    stored = sorted(r["stored"] for r in found.select("stored").distinct().collect())
    if not stored:
        return spark.createDataFrame([], "repo string, path string, line_no bigint, match string")
    files = read(stored).join(found.select("repo", "path"), ["repo", "path"], "left_semi")
    return search_code(files, pattern, prefix, cap)
