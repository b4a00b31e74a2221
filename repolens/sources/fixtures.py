"""Code-shaped tables derived from the driver's TPC-H-like parquet tables.

The test data holds no source code, so files, commits, diffs, manifests and
archive listings are derived from ``part``, ``lineitem`` and ``supplier``.
Each derivation is one SQL text with ``{table}`` placeholders (literal
braces doubled, as for ``str.format``): Spark runs it
with DataFrame arguments, the DuckDB oracle with the registered views, so
both engines start from identical inputs.  Everything scales with the
source tables (no sampling, no caps).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# 10 % JavaScript, 90 % Python files; one row per part.
CODE_FILES_SQL = """
SELECT p_partkey AS file_id,
       'repo' || CAST(p_partkey % 5 AS STRING) AS repo,
       'src/' || replace(lower(p_brand), '#', '_') || '/m' || CAST(p_partkey AS STRING)
         || CASE WHEN p_partkey % 10 = 9 THEN '.js' ELSE '.py' END AS path,
       CASE WHEN p_partkey % 10 = 9 THEN
         'class ' || p_type || ' {{' || chr(10)
         || '  ' || replace(p_name, ' ', '_') || '(q) {{' || chr(10)
         || '    if (q > ' || CAST(p_size AS STRING) || ') {{ return 0; }}' || chr(10)
         || '    return q;' || chr(10) || '  }}' || chr(10) || '}}' || chr(10)
         || 'function f' || CAST(p_partkey AS STRING) || '(a, b) {{' || chr(10) || '  return a;' || chr(10) || '}}' || chr(10)
       ELSE
         'import os' || chr(10) || 'from lib.' || lower(p_type) || ' import load' || chr(10)
         || CASE WHEN p_size % 2 = 0 THEN 'import os' || chr(10) ELSE '' END || chr(10)
         || 'class ' || p_type || ':' || chr(10)
         || '    def ' || replace(p_name, ' ', '_') || '(self, q: int) -> int:' || chr(10)
         || '        for i in range(q):' || chr(10)
         || '            if i > ' || CAST(p_size AS STRING) || ' and q > 1:' || chr(10)
         || '                return i' || chr(10)
         || '        return q' || chr(10) || chr(10)
         || 'def f' || CAST(p_partkey AS STRING) || '(x):' || chr(10)
         || repeat('    while x and x > 1:' || chr(10) || '        x = x - 1 if x else 0' || chr(10), CAST(p_size % 9 AS INT))
         || '    return x' || chr(10)
         || CASE WHEN p_partkey % 3 = 0 THEN chr(10) || 'print(f' || CAST(p_partkey AS STRING) || '(3))' || chr(10) ELSE '' END
       END AS content
FROM {part}
"""

# every (order, part) pair is a commit touching the part's file.
TOUCHES_SQL = """
SELECT DISTINCT f.repo, l.l_orderkey AS commit_id, f.path
FROM {lineitem} l JOIN {code_files} f ON l.l_partkey = f.file_id
"""

# one zero-context hunk per line item; one part in 17 deletes its file.
HUNK_ROWS_SQL = """
SELECT f.repo, l.l_orderkey AS change_id,
       'diff --git a/' || f.path || ' b/' || f.path || chr(10)
       || '--- a/' || f.path || chr(10)
       || CASE WHEN l.l_partkey % 17 = 0 THEN '+++ /dev/null' ELSE '+++ b/' || f.path END || chr(10)
       || '@@ -1 +' || CASE WHEN l.l_partkey % 17 = 0 THEN '0,0'
            ELSE CAST(1 + (l.l_linenumber * 3) % 14 AS STRING)
                 || CASE WHEN CAST(l.l_quantity AS INT) % 4 = 1 THEN '' ELSE ',' || CAST(CAST(l.l_quantity AS INT) % 4 AS STRING) END
          END || ' @@' AS hunk_text
FROM {lineitem} l JOIN {code_files} f ON l.l_partkey = f.file_id
"""

# F3b: the same changes with ranges of very different lengths, up to 2,000,000,000 lines.
WIDE_HUNK_ROWS_SQL = """
SELECT f.repo, l.l_orderkey AS change_id,
       'diff --git a/' || f.path || ' b/' || f.path || chr(10) || '--- a/' || f.path || chr(10) || '+++ b/' || f.path || chr(10)
       || '@@ -1 +' || CAST(1 + (l.l_linenumber * 5) % 17 AS STRING)
       || CASE l.l_linenumber % 5 WHEN 0 THEN ',2000000000' WHEN 1 THEN ',70000' WHEN 2 THEN ',0' WHEN 3 THEN '' ELSE ',4' END || ' @@' AS hunk_text
FROM {lineitem} l JOIN {code_files} f ON l.l_partkey = f.file_id
"""

# F4 (DuckDB form; Spark builds the same text with array_sort + array_join).
CODE_DIFFS_DUCKDB_SQL = """
SELECT repo, change_id, string_agg(hunk_text, chr(10) ORDER BY hunk_text) AS diff
FROM {hunk_rows} GROUP BY repo, change_id
"""

# top-level manifests per supplier-repo.
MANIFESTS_SQL = """
SELECT 'repo' || CAST(s_suppkey AS STRING) AS repo, name AS path,
       CASE name
         WHEN 'package.json' THEN '{{"name":"p","dependencies":{{' || CASE WHEN s_suppkey % 3 = 0 THEN '"react":"^18.0.0","' ELSE '"' END || 'lib' || CAST(s_nationkey AS STRING) || '":"1.0"}},"devDependencies":{{"jest":"29","lib' || CAST(s_nationkey AS STRING) || '":"2.0"' || CASE WHEN s_suppkey % 5 = 0 THEN ',"next":"14"' ELSE '' END || '}}}}'
         WHEN 'requirements.txt' THEN '# pins' || chr(10) || CASE WHEN s_suppkey % 2 = 0 THEN 'Flask==3.0' ELSE 'pytest-django>=4' END || chr(10) || chr(10) || '  # indented note' || chr(10) || 'Lib' || CAST(s_nationkey AS STRING) || chr(10)
         WHEN '.env.example' THEN '# env' || chr(10) || 'API_KEY=abc=1' || chr(10) || ' REGION_' || CAST(s_nationkey AS STRING) || ' = eu' || chr(10) || 'NOVALUE' || chr(10)
         ELSE 'x' || chr(10) END AS content
FROM {supplier}
CROSS JOIN (VALUES ('package.json', 2), ('requirements.txt', 3), ('.env.example', 4), ('Dockerfile', 5), ('manage.py', 7), ('.github/workflows/ci.yml', 2), ('.github/workflows/x.yaml', 3)) AS v(name, k)
WHERE s_suppkey % k <> 1
"""

# shapes that lines and indentation alone don't tell: definitions on one line,
# statements behind semicolons and colons, fields of f-strings, repeated and dunder
# names, docstrings; object literals, templates in templates, keywords as names.
PY_SHAPE = '''\'\'\'Module @NAME@.\'\'\'
import os; from sys import path
try: import json
except ImportError: json = None
class Outer@K@:
    """Outer of @TYPE@.

    More.
    """
    def __init__(self): self.x = @SIZE@
    def run(self, q: int) -> str: "Runs once."; return f"{q if q and q > @SIZE@ else \'no\'} {f\'{q or 2}\'}"
    class Inner:
        async def run(self, *, a=")", b="#"):
            \'\'\'One.\'\'\'
            return [x for x in a if x] or b
def dup(x): return x
def dup(y):
    return f"{y!r:>{10 if y else 20}} {{ and }}"
'''
JS_SHAPE = """const o = {
  if(x) { return x; },
  get delete() { if (a) { return 1; } return 2; },
  nested: { for(y) { return y; } },
};
const t = `a ${ `b ${ `c ${ {d: 1}.d }` }` } {`;
class C@K@ extends Base {
  catch(e) { return `${e}`; }
  static async run(q) {
    switch (q) { case 1: { if (q) { return 1; } } default: { while (q) { q--; } } }
    return { if: 1, run() { return 2; } };
  }
}
function f@K@(a, b = {}) { return a / 2 / b; }
"""


def sql_text(text: str) -> str:
    """A text as SQL that both engines read alike, its @NAMES@ filled from ``part``."""
    parts = ["'" + line.replace("'", "' || chr(39) || '").replace("{", "{{").replace("}", "}}") + "'" for line in text.split("\n")]
    out = "(" + " || chr(10) || ".join(parts) + ")"
    for name, column in (("K", "CAST(p_partkey AS STRING)"), ("NAME", "p_name"), ("TYPE", "p_type"), ("SIZE", "CAST(p_size AS STRING)")):
        out = f"replace({out}, '@{name}@', {column})"
    return out


# A third of the files begins with comment lines, which moves all lines down.
SHAPE_PAD_SQL = "CASE WHEN p_partkey % 3 = 0 THEN p_size % 4 ELSE 0 END"
SHAPES_SQL = f"""
SELECT 'repo' || CAST(p_partkey % 5 AS STRING) AS repo, 'pkg/s' || CAST(p_partkey AS STRING) || '.py' AS path,
       repeat('# note' || chr(10), CAST({SHAPE_PAD_SQL} AS INT)) || {sql_text(PY_SHAPE)}
       || CASE WHEN p_partkey % 2 = 0 THEN 'print(dup(1))' || chr(10) ELSE '' END AS content
FROM {{part}}
UNION ALL
SELECT 'repo' || CAST(p_partkey % 5 AS STRING) AS repo, 'web/s' || CAST(p_partkey AS STRING) || '.js' AS path,
       repeat('// note' || chr(10), CAST({SHAPE_PAD_SQL} AS INT)) || {sql_text(JS_SHAPE)} AS content
FROM {{part}}
"""

# Git log text as `git log --format=format: --name-only` prints it: per
# commit a blank separator, the touched names (some padded), and a README
# that the churn suffix filter must drop.
GIT_LOG_SQL = """
SELECT repo, CASE WHEN commit_id % 2 = 0 THEN path ELSE '  ' || path || ' ' END AS line
FROM {touches}
UNION ALL
SELECT c.repo, v.line
FROM (SELECT DISTINCT repo, commit_id FROM {touches}) c
CROSS JOIN (VALUES (''), ('README.md')) AS v(line)
"""

# Coordinates of landed archives, with invalid owner/repo/branch values.
ARCHIVE_INDEX_SQL = """
SELECT s_suppkey AS archive_id,
       CASE s_suppkey % 4 WHEN 0 THEN s_name WHEN 1 THEN 'org' || CAST(s_nationkey AS STRING)
            ELSE 'team.' || CAST(s_nationkey AS STRING) END AS owner,
       CASE s_suppkey % 3 WHEN 0 THEN 'proj_' || CAST(s_suppkey AS STRING)
            WHEN 1 THEN 'proj-' || CAST(s_suppkey AS STRING) || chr(10) ELSE 'a/b' END AS repo,
       CASE s_suppkey % 5 WHEN 0 THEN 'main' WHEN 1 THEN 'feature/' || CAST(s_nationkey AS STRING)
            WHEN 2 THEN 'rel/../x' WHEN 3 THEN 'dev' || chr(10) ELSE 'v1.0' END AS branch,
       CAST(floor((s_acctbal + 1000.0) * 10000) AS BIGINT) AS compressed_bytes
FROM {supplier}
"""

# Entries of each landed archive (one per line item of the supplier), with
# a few hostile names.
ARCHIVE_ENTRIES_SQL = """
SELECT l.l_suppkey AS archive_id,
       CASE WHEN (l.l_orderkey * 7 + l.l_linenumber) % 997 = 0 THEN '../' || f.path
            WHEN (l.l_orderkey * 7 + l.l_linenumber) % 997 = 1 THEN '/abs/' || f.path
            WHEN (l.l_orderkey * 7 + l.l_linenumber) % 997 = 2 THEN 'x/../../' || f.path
            WHEN (l.l_orderkey * 7 + l.l_linenumber) % 997 = 3 THEN 'x/../' || f.path
            ELSE 'proj-main/' || f.path END AS name,
       CAST(floor(l.l_extendedprice) AS BIGINT) * 16 AS size
FROM {lineitem} l JOIN {code_files} f ON l.l_partkey = f.file_id
"""


_MARK = "\0"  # stands for the file's name in a shuffled hunk text


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CODE_FILES_SQL, part=_read(spark, sf_dir, "part"))


def touches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TOUCHES_SQL, lineitem=_read(spark, sf_dir, "lineitem"),
                     code_files=code_files(spark, sf_dir).select("file_id", "repo", "path"))


def hunk_rows(spark: SparkSession, sf_dir: str, rows_sql: str = HUNK_ROWS_SQL) -> DataFrame:
    return spark.sql(rows_sql, lineitem=_read(spark, sf_dir, "lineitem"),
                     code_files=code_files(spark, sf_dir).select("file_id", "repo", "path"))


def _short(text: Column) -> Column:
    """A hunk's text with its file's name written once, in front; ``_whole`` undoes it.

    A text that has the mark itself, or no name, is its own."""
    name = F.substring_index(F.substring_index(text, "\n--- a/", -1), "\n", 1)
    return F.when((name == "") | F.contains(text, F.lit(_MARK)), F.concat(F.lit(_MARK), text)).otherwise(F.concat(name, F.lit(_MARK), F.replace(text, name, F.lit(_MARK))))


def _whole(short: Column) -> Column:
    name = F.substring_index(short, _MARK, 1)
    rest = F.substring(short, F.length(name) + 2, F.length(short))
    return F.when(name == "", rest).otherwise(F.replace(rest, F.lit(_MARK), name))


def diffs_of(hunks: DataFrame) -> DataFrame:
    """The hunk texts of one change joined to one diff text (sorted).

    They are shuffled short: half the bytes, and a partial collection would only
    sort them once more."""
    moved = hunks.select("repo", "change_id", _short(F.col("hunk_text")).alias("short")).repartition("repo", "change_id")
    return (moved.select("repo", "change_id", _whole(F.col("short")).alias("hunk_text"))
            .groupBy("repo", "change_id")
            .agg(F.array_join(F.sort_array(F.collect_list("hunk_text")), "\n").alias("diff")))


def code_diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one diff text per change."""
    return diffs_of(hunk_rows(spark, sf_dir))


def wide_diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3b as one diff text per change."""
    return diffs_of(hunk_rows(spark, sf_dir, WIDE_HUNK_ROWS_SQL))


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SHAPES_SQL, part=_read(spark, sf_dir, "part"))


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(MANIFESTS_SQL, supplier=_read(spark, sf_dir, "supplier"))


def git_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(GIT_LOG_SQL, touches=touches(spark, sf_dir))


def archive_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ARCHIVE_INDEX_SQL, supplier=_read(spark, sf_dir, "supplier"))


def archive_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ARCHIVE_ENTRIES_SQL, lineitem=_read(spark, sf_dir, "lineitem"),
                     code_files=code_files(spark, sf_dir).select("file_id", "path"))


def as_files(docs: DataFrame) -> DataFrame:
    """Rows of ``documents`` laid out as text files: repo = source, path = lang/doc_id.txt."""
    return docs.select(F.col("source").alias("repo"), F.concat(F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
                       F.col("text").alias("content"))


def documents_as_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_files(_read(spark, sf_dir, "documents"))


def duckdb_sql(text: str, **tables: str) -> str:
    """Fill placeholders with DuckDB view / CTE names."""
    return text.format(**tables)
