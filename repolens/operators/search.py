"""Line search, symbol search and word counts.

``search_code`` is row-local: each file's lines are split, filtered and
capped inside its own row (``filter`` + ``slice`` on the line array), so
the search needs no shuffle at all and the cap of 20 is applied before
anything leaves the task.
"""

from __future__ import annotations

from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repolens.functions.text import (SEARCH_LINE, SEARCH_MATCH_CAP, SEARCHABLE_SUFFIXES, WORD_RE,
                                     in_skipped_dir, py_strip, scope, split_lines, suffix, template)
from repolens.operators.symbols import outline_line

_FILE = ["repo", "path"]


def explode_lines(files: DataFrame, text_col: str = "content") -> DataFrame:
    """(keys…, line_no from 1, line) with ``str.splitlines`` boundaries."""
    keys = [c for c in files.columns if c != text_col]
    return (files.select(*keys, F.posexplode(split_lines(F.col(text_col))).alias("pos", "line"))
            .select(*keys, (F.col("pos") + 1).cast("bigint").alias("line_no"), "line"))


def validate_pattern(pattern: str) -> str:
    """Reject an invalid pattern on the driver, before any task runs.

    The JVM's own compiler decides, as the JVM will run it; the
    ``(?P<name>…)`` spelling of a named group is read as ``(?<name>…)``."""
    pattern = pattern.replace("(?P<", "(?<")
    try:
        SparkSession.active()._jvm.java.util.regex.Pattern.compile("(?iu)" + pattern)
    except IllegalArgumentException as exc:
        raise ValueError(f"Invalid regex pattern: {exc}") from exc
    return "(?iu)" + pattern


def search_code(files: DataFrame, pattern: str, prefix: str | None = None,
                cap: int | None = SEARCH_MATCH_CAP, per_file: bool = False) -> DataFrame:
    """Case-insensitive regex search per line of searchable files.

    Output (repo, path, line_no, match) with ``match = 'Line n: <stripped>'``,
    at most ``cap`` first matches per file (None: all); with ``per_file`` only
    their number (repo, path, n) for files that have any.
    """
    regex = validate_pattern(pattern)
    path = F.col("path")
    candidates = files.where(F.lower(suffix(path)).isin(*SEARCHABLE_SUFFIXES)
                             & scope(path, prefix) & ~in_skipped_dir(path, prefix=prefix))
    numbered = F.transform(split_lines(F.col("content")),
                           lambda line, i: F.struct((i + 1).alias("line_no"), line.alias("text")))
    hits = F.filter(numbered, lambda x: x["text"].rlike(regex))
    if cap is not None:
        hits = F.slice(hits, 1, cap)
    if per_file:
        return candidates.select(*_FILE, F.size(hits).cast("bigint").alias("n")).where("n > 0")
    return (candidates.select(*_FILE, F.explode(hits).alias("m"))
            .select(*_FILE, F.col("m.line_no").cast("bigint").alias("line_no"),
                    template(SEARCH_LINE, n=F.col("m.line_no"), text=py_strip(F.col("m.text"))).alias("match")))


def match_counts(files: DataFrame, pattern: str, prefix: str | None = None,
                 cap: int = SEARCH_MATCH_CAP) -> DataFrame:
    """What ``search_code`` finds and keeps per file with a match: (repo, path,
    matches, kept).  Row-local, one search."""
    hits = search_code(files, pattern, prefix, cap=None, per_file=True)
    return hits.select(*_FILE, F.col("n").alias("matches"), F.least("n", F.lit(cap).cast("bigint")).alias("kept"))


def search_symbols(symbols: DataFrame, query: str, names_only: bool = False,
                   prefix: str | None = None) -> DataFrame:
    """Case-insensitive substring match on rendered outline lines
    (or on qualified names with ``names_only``): (repo, path, line).

    The no-symbols fallback text is never matched.  Lines are those of the
    rendered outline (parameters may take several); with ``names_only`` a
    match is its whole rendered entry, in one row."""
    rendered = outline_line(F.col("kind"), F.col("qualified_name"), F.col("name"), F.col("params"),
                            F.col("start_line"), F.col("end_line"))
    inside = symbols.where(scope(F.col("path"), prefix))
    if names_only:
        return inside.where(F.lower("qualified_name").contains(query.lower())).select(*_FILE, rendered.alias("line"))
    rows = inside.select(*_FILE, F.explode(F.split(rendered, "\n")).alias("line"))
    return rows.where(F.lower("line").contains(query.lower()))


def token_count(files: DataFrame, text_col: str = "content") -> DataFrame:
    """Whole-word occurrences per repository: (repo, token, n).

    Map-side partial aggregation collapses repeated words before the
    shuffle, so a hot word or a hot repo costs one row per task."""
    words = files.select(
        "repo", F.explode(F.regexp_extract_all(F.col(text_col), F.lit(WORD_RE), 0)).alias("token"))
    return words.groupBy("repo", "token").agg(F.count(F.lit(1)).alias("n"))


__all__ = ["explode_lines", "search_code", "search_symbols", "token_count", "validate_pattern"]
