"""Unified diffs -> hunks -> changed lines -> affected functions.

Parsing is row-local (no shuffle, no window): a git diff text is split
into file sections at ``diff --git`` lines, which can never be hunk body
lines (those start with ``+``, ``-``, space or ``\\``).  The new-file name
is the ``+++`` line *before* the first ``@@`` of its section, so an added
body line such as ``++ b/x`` (printed ``+++ b/x``) is never taken for a
header.  ``+++ /dev/null`` (deleted file) resets the file: its hunks are
not charged to any path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repolens.functions.text import py_strip
from repolens.operators.intervals import overlap_hits

_HUNK_RE = r"(?md)^@@ \S+ \+(\d+)(?:,(\d+))?(?= |$)"
_HUNK_HEADER_RE = r"(?md)^@@[^\n]*"


_LAST_LINE = (1 << 31) - 1
# Lines that one generated array holds at most.
LINE_CHUNK = 1 << 16


def _in_file(header):
    """The header's new-file range ends at a 32-bit line number."""
    number = lambda g: F.regexp_extract(header, r"^@@ \S+ \+(\d+)(?:,(\d+))?", g)
    count = F.when(number(2) == "", F.lit(1).cast("long")).otherwise(number(2).try_cast("long"))
    return F.coalesce(number(1).try_cast("long") + count <= _LAST_LINE, F.lit(False))


def diff_sections(diffs: DataFrame, diff_col: str = "diff") -> DataFrame:
    """(…, diff) -> one row per file section with new/old names and hunks."""
    keys = [c for c in diffs.columns if c != diff_col]
    # a literal is found many times faster than a line start with something behind it
    mark = "diff --git "
    pieces = diffs.select(*keys, F.posexplode(F.split(F.col(diff_col), "\n" + mark, -1)).alias("section_no", "piece"))
    sections = pieces.select(*keys, "section_no", F.when(F.col("section_no") == 0, F.col("piece")).otherwise(F.concat(F.lit(mark), "piece")).alias("section"))
    header = F.substring_index("section", "\n@@", 1)
    # arrays of one element: each name is made once, however many filters ask for it
    once = lambda df, **columns: df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))
    sections = once(sections, new_name=F.regexp_extract(header, r"(?md)^\+\+\+ (.*)$", 1), old_name=F.regexp_extract(header, r"(?md)^--- (.*)$", 1))
    new_name, old_name = F.col("new_name"), F.col("old_name")
    sections = once(sections, path=F.when(new_name.startswith("b/"), py_strip(F.substring(new_name, F.lit(3), F.length(new_name)))),
                    old_path=F.when(old_name.startswith("a/"), py_strip(F.substring(old_name, F.lit(3), F.length(old_name)))),
                    deleted=py_strip(new_name) == "/dev/null")
    return sections.select(
        *keys, "section_no", "path", "old_path", "deleted",
        F.regexp_extract_all("section", F.lit(_HUNK_RE), 1).alias("starts"),
        F.regexp_extract_all("section", F.lit(_HUNK_RE), 2).alias("counts"),
        F.regexp_extract_all("section", F.lit(_HUNK_HEADER_RE), 0).alias("headers"))


def diff_hunks(diffs: DataFrame, suffixes: tuple[str, ...] = (".py",), diff_col: str = "diff") -> DataFrame:
    """Hunks of files with the given suffixes: (…keys, path, start_line, line_count).

    ``line_count`` is the written count (1 when absent, 0 for a pure deletion).
    """
    sec = diff_sections(diffs, diff_col)
    keep = F.lit(False)
    for sfx in suffixes:
        keep = keep | F.col("path").endswith(sfx)
    keys = [c for c in diffs.columns if c != diff_col]
    hunks = sec.where(F.col("path").isNotNull() & keep).select(
        *keys, "path", F.explode(F.arrays_zip("starts", "counts")).alias("h"))
    # try_cast: an undecodable count skips the hunk instead of failing the job,
    # and so does a range past any file's last line (a 32-bit line number)
    out = hunks.select(
        *keys, "path",
        F.col("h.starts").try_cast("long").alias("start_line"),
        F.when(F.col("h.counts") == "", F.lit(1).cast("long")).otherwise(F.col("h.counts").try_cast("long"))
        .alias("line_count"))
    return out.where(F.col("start_line") + F.col("line_count") <= _LAST_LINE)


def diff_problems(diffs: DataFrame, suffixes: tuple[str, ...] = (".py",), diff_col: str = "diff") -> DataFrame:
    """Hunk headers whose new-file range cannot be read (skipped by
    ``diff_hunks``): (…keys, path, header, problem).  Row-local."""
    sec = diff_sections(diffs, diff_col)
    keep = F.lit(False)
    for sfx in suffixes:
        keep = keep | F.col("path").endswith(sfx)
    keys = [c for c in diffs.columns if c != diff_col]
    bad = F.filter("headers", lambda h: ~(h.rlike(r"^@@ \S+ \+\d+(?:,\d+)?( |$)") & _in_file(h)))
    return (sec.where(F.col("path").isNotNull() & keep)
            .select(*keys, "path", F.explode(bad).alias("header"))
            .withColumn("problem", F.lit("unreadable hunk range")))


def deleted_paths(diffs: DataFrame, diff_col: str = "diff") -> DataFrame:
    """Paths removed by a diff (``+++ /dev/null``): (…keys, path)."""
    keys = [c for c in diffs.columns if c != diff_col]
    sec = diff_sections(diffs, diff_col)
    return sec.where("deleted AND old_path IS NOT NULL").select(*keys, F.col("old_path").alias("path"))


def hunk_ranges(hunks: DataFrame) -> DataFrame:
    """Closed line range of each hunk; a zero count still marks one line."""
    return hunks.withColumn("end_line", F.col("start_line") + F.greatest(F.col("line_count"), F.lit(1)) - 1)


def line_set_union(hunks: DataFrame, keys: list[str]) -> DataFrame:
    """The changed lines of each (keys, path) as disjoint, non-adjacent ranges:
    (keys, path, start_line, end_line).

    A sweep: ranges in order of their starts, with the running maximum of the
    ends before; a range that starts beyond it begins a new run.  A range of any
    length is one row."""
    in_order = Window.partitionBy(*keys, "path").orderBy("start_line", "end_line")
    reach = F.max("end_line").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("start_line") <= F.coalesce(reach, F.lit(-2)) + 1, 0).otherwise(1)
    runs = hunk_ranges(hunks).select(*keys, "path", "start_line", "end_line", new.alias("new"))
    runs = runs.select("*", F.sum("new").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("run"))
    return (runs.groupBy(*keys, "path", "run").agg(F.min("start_line").alias("start_line"), F.max("end_line").alias("end_line"))
            .drop("run"))


def hunk_lines(hunks: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct changed line numbers per (keys, path).

    The merged ranges are disjoint, so their lines need no distinct.  They are
    made in chunks: no array is longer than ``LINE_CHUNK``, however long a range
    is (a 32-bit range has at most ``2 ** 31 / LINE_CHUNK`` chunks).  Chunks are
    dealt over tasks before their lines are made, so a huge range is many tasks'
    work and a task holds one chunk's lines at a time."""
    span = F.col("end_line") - F.col("start_line")
    chunks = line_set_union(hunks, keys).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(span / LINE_CHUNK))))
    chunks = chunks.repartition(*keys, "path", "start_line", "chunk")
    first = F.col("start_line") + F.col("chunk") * LINE_CHUNK
    return chunks.select(*keys, "path", F.explode(F.sequence(first, F.least(first + (LINE_CHUNK - 1), F.col("end_line")))).alias("line_no"))


def modified_line_count(hunks: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct changed lines per (keys, path): the lengths of the merged ranges,
    not their lines, so a huge range costs as much as a small one."""
    return (line_set_union(hunks, keys).groupBy(*keys, "path")
            .agg(F.sum(F.col("end_line") - F.col("start_line") + 1).alias("modified_line_count")))


def _ranges_of_files(hunks: DataFrame, keys: list[str]) -> DataFrame:
    """One row per (keys, path) with its distinct hunk ranges, ascending.  Diffs
    that are partitioned by the keys are not shuffled for it."""
    return hunk_ranges(hunks).groupBy(*keys, "path").agg(
        F.sort_array(F.collect_set(F.struct(F.col("start_line").alias("lo"), F.col("end_line").alias("hi")))).alias("ranges"))


def _function_rows(symbols: DataFrame) -> DataFrame:
    """Spans of functions; by their first column they ascend in document order."""
    return symbols.where(F.col("kind") == "def").select("repo", "path", "start_off", F.col("qualified_name").alias("function"), "start_line", "end_line")


def hunk_symbol_overlap(hunks: DataFrame, symbols: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, path, function, start_line, end_line, start_off): functions whose
    span contains a changed line (nested and outer both reported)."""
    hits = overlap_hits(_ranges_of_files(hunks, keys), _function_rows(symbols), ["repo", "path"], "ranges", ("start_line", "end_line"))
    return hits.select(*keys, "path", F.inline("hits")).select(*keys, "path", "function", "start_line", "end_line", "start_off")


def union_length(ranges):
    """Number of distinct integers covered by sorted closed ranges
    (array<struct<lo, hi>>), merged in one pass."""
    acc0 = F.struct(F.lit(-1).cast("long").alias("hi"), F.lit(0).cast("long").alias("n"))

    def step(acc, r):
        lo, hi = r["lo"].cast("long"), r["hi"].cast("long")
        add = F.when(lo > acc["hi"], hi - lo + 1).when(hi > acc["hi"], hi - acc["hi"]).otherwise(0)
        return F.struct(F.greatest(acc["hi"], hi).alias("hi"), (acc["n"] + add).alias("n"))

    return F.aggregate(ranges, acc0, step)["n"]


def change_impact(hunks: DataFrame, symbols: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """Per changed file that exists: modified line count and affected functions.

    Hunks are grouped per (change, path) first, collecting their ranges (whose
    union length is the modified line count); these rows are shuffled once, to the
    existing files and their function spans (see ``intervals.overlap_hits``).
    Output (keys…, path, modified_line_count, n_affected, affected_functions
    array<struct<function, start_line, end_line, span>> in document order).
    """
    out = overlap_hits(_ranges_of_files(hunks, keys), _function_rows(symbols), ["repo", "path"], "ranges", ("start_line", "end_line"), among=files)
    affected = F.transform("hits", lambda x: F.struct(
        x["function"].alias("function"), x["start_line"].alias("start_line"), x["end_line"].alias("end_line"),
        F.concat(F.lit("lines "), x["start_line"].cast("string"), F.lit("-"), x["end_line"].cast("string")).alias("span")))
    return out.select(*keys, *([] if "repo" in keys else ["repo"]), "path",
                      union_length(F.col("ranges")).alias("modified_line_count"),
                      F.size("hits").cast("bigint").alias("n_affected"),
                      affected.alias("affected_functions"))


def impact_report(diffs: DataFrame, symbols: DataFrame, files: DataFrame, keys: list[str],
                  suffixes: tuple[str, ...] = (".py",), diff_col: str = "diff") -> DataFrame:
    """``change_impact`` of diffs, and a row with a ``problem`` and no counts for
    each changed file that has an unreadable hunk range."""
    impact = change_impact(diff_hunks(diffs, suffixes, diff_col), symbols, files, keys)
    problems = diff_problems(diffs, suffixes, diff_col).groupBy(*keys, "path").agg(
        F.concat(F.min("problem"), F.lit(": "), F.min("header")).alias("problem"))
    return impact.withColumn("problem", F.lit(None).cast("string")).unionByName(problems, allowMissingColumns=True)
