"""Registered queries over ranges of any length (fixture F3b) and over shapes
that lines alone don't tell (fixture F6).

The SQL of the shapes doesn't parse them: it lists, by hand, the symbols of the
two texts with their lines, and joins that list to ``part``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repolens.functions import text as X
from repolens.operators import changes as C
from repolens.operators import complexity as CX
from repolens.operators import deadcode as DC
from repolens.operators import gramindex as G
from repolens.operators import pyfacts as PF
from repolens.operators import search as SE
from repolens.operators import symbols as S
from repolens.plans.oracle import with_ctes
from repolens.plans.registry import _DOC_LINES, _SYMBOL_COLS, _WS, _spans, query
from repolens.plans.symbol_store import stored_symbols
from repolens.plans.tables import scratch_base, write_table
from repolens.sources import fixtures as fx

# --------------------------------------------------------------------------
# ranges of any length
# --------------------------------------------------------------------------
_WIDE = """wide AS (
  SELECT DISTINCT f.repo, l.l_orderkey AS change_id, f.path, 1 + (l.l_linenumber * 5) % 17 AS lo,
         (l.l_linenumber * 5) % 17 + CASE l.l_linenumber % 5 WHEN 0 THEN 2000000000 WHEN 1 THEN 70000 WHEN 4 THEN 4 ELSE 1 END AS hi
  FROM lineitem l JOIN code_files f ON l.l_partkey = f.file_id WHERE f.path LIKE '%.py'),
begins AS (SELECT DISTINCT repo, change_id, path, lo FROM wide a WHERE NOT EXISTS (
  SELECT 1 FROM wide b WHERE b.repo = a.repo AND b.change_id = a.change_id AND b.path = a.path AND b.lo < a.lo AND b.hi >= a.lo - 1)),
merged AS (SELECT s.repo, s.change_id, s.path, CAST(s.lo AS BIGINT) AS start_line, CAST(max(w.hi) AS BIGINT) AS end_line
  FROM (SELECT *, lead(CAST(lo AS BIGINT), 1, 4000000000) OVER (PARTITION BY repo, change_id, path ORDER BY lo) AS next_lo FROM begins) s
  JOIN wide w ON w.repo = s.repo AND w.change_id = s.change_id AND w.path = s.path AND w.lo >= s.lo AND w.lo < s.next_lo
  GROUP BY 1, 2, 3, 4)
"""


@query("line_set_union", with_ctes("code_files", "").rstrip() + ",\n" + _WIDE + "SELECT repo, change_id, path, start_line, end_line FROM merged")
def q_line_set_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.line_set_union(C.diff_hunks(fx.wide_diffs(spark, sf_dir)), ["repo", "change_id"])


@query("wide_change_impact", with_ctes("symbols_q", "").rstrip() + ",\n" + _WIDE + """
SELECT m.repo, m.change_id, m.path, m.n AS modified_line_count, CAST(coalesce(a.n, 0) AS BIGINT) AS n_affected
FROM (SELECT repo, change_id, path, CAST(sum(end_line - start_line + 1) AS BIGINT) AS n FROM merged GROUP BY 1, 2, 3) m
LEFT JOIN (SELECT w.repo, w.change_id, w.path, count(DISTINCT s.start_line) AS n FROM wide w JOIN symbols_q s
             ON s.repo = w.repo AND s.path = w.path AND s.kind = 'def' AND w.lo <= s.end_line AND w.hi >= s.start_line GROUP BY 1, 2, 3) a
  ON a.repo = m.repo AND a.change_id = m.change_id AND a.path = m.path""")
def q_wide_change_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = fx.code_files(spark, sf_dir)
    impact = C.change_impact(C.diff_hunks(fx.wide_diffs(spark, sf_dir)), _spans(spark, sf_dir), files, ["repo", "change_id"])
    return impact.select("repo", "change_id", "path", "modified_line_count", "n_affected")


# --------------------------------------------------------------------------
# shapes
# --------------------------------------------------------------------------
# kind, name, class, params, return type, docstring, first and last line, score
_PY_SYMBOLS = [
    ("class", "Outer@K@", None, None, None, '"""Outer of @TYPE@.\n\n    More.\n    """', 5, 15, None),
    ("def", "__init__", "Outer@K@", "(self)", None, None, 10, 10, 1),
    ("def", "run", "Outer@K@", "(self, q: int)", "str", '"Runs once."', 11, 11, 4),
    ("class", "Inner", None, None, None, None, 12, 15, None),
    ("def", "run", "Inner", '(self, *, a=")", b="#")', None, "'''One.'''", 13, 15, 2),
    ("def", "dup", None, "(x)", None, None, 16, 16, 1),
    ("def", "dup", None, "(y)", None, None, 17, 18, 2),
]
_JS_SYMBOLS = [
    ("def", "if", None, "(x)", None, None, 2, 2, None),
    ("def", "delete", None, "()", None, None, 3, 3, None),
    ("def", "for", None, "(y)", None, None, 4, 4, None),
    ("class", "C@K@", None, None, None, None, 7, 13, None),
    ("def", "catch", "C@K@", "(e)", None, None, 8, 8, None),
    ("def", "run", "C@K@", "(q)", None, None, 9, 12, None),
    ("def", "run", "C@K@", "()", None, None, 11, 11, None),
    ("def", "f@K@", None, "(a, b = {})", None, None, 14, 14, None),
]


def _shape_symbols_sql() -> str:
    def text(x: str | None) -> str:
        return "CAST(NULL AS VARCHAR)" if x is None else fx.duckdb_sql(fx.sql_text(x))

    out = []
    for lang, path, rows in (("python", "'pkg/s' || p_partkey || '.py'", _PY_SYMBOLS), ("javascript", "'web/s' || p_partkey || '.js'", _JS_SYMBOLS)):
        for kind, name, owner, params, ret, doc, a, b, score in rows:
            qualified = name if owner is None else f"{owner}.{name}"
            out.append(f"SELECT 'repo' || (p_partkey % 5) AS repo, {path} AS path, '{lang}' AS lang, '{kind}' AS kind, {text(name)} AS name, {text(owner)} AS class_name, "
                       f"{text(qualified)} AS qualified_name, {text(params)} AS params, {text(ret)} AS return_type, {text(doc)} AS docstring, "
                       f"CAST({a} + {fx.SHAPE_PAD_SQL} AS INT) AS start_line, CAST({b} + {fx.SHAPE_PAD_SQL} AS INT) AS end_line, "
                       f"CAST({'NULL' if score is None else score} AS INT) AS complexity FROM part")
    return "WITH shape_symbols AS (" + "\nUNION ALL ".join(out) + ")\n"


_SHAPES = _shape_symbols_sql()
_SHAPE_COLS = [*_SYMBOL_COLS, "docstring"]


def _shape_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_symbols(fx.shapes(spark, sf_dir))


@query("shape_symbols", _SHAPES + f"SELECT {', '.join(_SHAPE_COLS)} FROM shape_symbols")
def q_shape_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shape_symbols(spark, sf_dir).select(*_SHAPE_COLS)


@query("docstring", _SHAPES + '''SELECT repo, path, qualified_name, start_line, docstring,
  CASE WHEN docstring LIKE '%Outer of%' THEN regexp_extract(docstring, '"""([^\n]*)', 1) || '...' ELSE trim(docstring, chr(34) || chr(39)) END AS summary
FROM shape_symbols WHERE docstring IS NOT NULL''')
def q_docstring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _shape_symbols(spark, sf_dir).where("docstring IS NOT NULL")
    return found.select("repo", "path", "qualified_name", "start_line", "docstring", X.doc_summary(F.col("docstring")).alias("summary"))


@query("decision_in_function", _SHAPES + """SELECT repo, path, qualified_name AS function, CAST(start_line AS BIGINT) AS line, CAST(complexity AS BIGINT) AS complexity_score
FROM shape_symbols WHERE lang = 'python' AND kind = 'def'""")
def q_decision_in_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CX.score_complexity(_shape_symbols(spark, sf_dir)).drop("risk_level")


@query("first_match", """
SELECT 'repo' || (p_partkey % 5) AS repo, 'pkg/s' || p_partkey || '.py' AS path, 'dup' AS qualified_name, 'def dup(x): return x' AS source FROM part
UNION ALL SELECT 'repo' || (p_partkey % 5), 'web/s' || p_partkey || '.js', 'dup', 'Error: no function named ''dup'' found in ''web/s' || p_partkey || '.js''.' FROM part""")
def q_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.function_source(_shape_symbols(spark, sf_dir), "dup", fx.shapes(spark, sf_dir))


@query("scope_filter", _SHAPES + """SELECT repo, path, 'def ' || qualified_name || params || '  — lines ' || start_line || '-' || end_line AS line
FROM shape_symbols WHERE lang = 'javascript' AND name = 'run'""")
def q_scope_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SE.search_symbols(_shape_symbols(spark, sf_dir), ".RUN(", prefix="web")


@query("dunder_filter", _SHAPES + """SELECT repo, name, max(path) AS path FROM shape_symbols
WHERE lang = 'python' AND kind = 'def' AND name <> '__init__' GROUP BY repo, name""")
def q_dunder_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DC.defined_functions(fx.shapes(spark, sf_dir), _shape_symbols(spark, sf_dir))


@query("shape_imports", """
SELECT 'repo' || (p_partkey % 5) AS repo, 'pkg/s' || p_partkey || '.py' AS path, CAST(3 AS BIGINT) AS import_count,
       'from sys import path' || chr(10) || 'import json' || chr(10) || 'import os' AS imports FROM part""")
def q_shape_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = PF.imports(fx.shapes(spark, sf_dir))
    return out.select("repo", "path", "import_count", F.array_join("imports", "\n").alias("imports"))


# --------------------------------------------------------------------------
# search by trigrams
# --------------------------------------------------------------------------
INDEXED_PATTERN = "licen[cs]ed|(gnu|general) public|reserved"


@query("search_indexed", f"""WITH {_DOC_LINES}
SELECT repo, path, line_no, 'Line ' || line_no || ': ' || regexp_replace(line, '^{_WS}+|{_WS}+$', '', 'g') AS match
FROM (SELECT *, row_number() OVER (PARTITION BY repo, path ORDER BY line_no) AS k
      FROM doc_lines WHERE regexp_matches(line, '(?i){INDEXED_PATTERN}'))
WHERE k <= 20""")
def q_search_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    index = spark.read.parquet(write_table(G.build_index(fx.as_files(docs)), "grams", scratch_base(spark)))
    return G.search_indexed(spark, index, INDEXED_PATTERN, lambda paths: fx.as_files(spark.read.parquet(*paths)))
