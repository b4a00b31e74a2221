"""Registered queries: (spark, sf_dir) -> DataFrame, with their oracle SQL.

Every query reads the whole driver tables (or tables Spark derives from
them); outputs are flat, with every computed column aliased and counts as
``bigint`` so the oracle comparison hashes like for like.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repolens.functions import text as X
from repolens.operators import changes as C
from repolens.operators import churn as CH
from repolens.operators import symbols as S
from repolens.plans.oracle import with_ctes
from repolens.plans.symbol_store import stored_symbols
from repolens.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return register


# --------------------------------------------------------------------------
# shared plan pieces
# --------------------------------------------------------------------------
def _symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_symbols(fx.code_files(spark, sf_dir))


def _spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _symbols(spark, sf_dir).where(F.col("lang") == "python")


def _files_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current snapshot: code files minus those a change deleted."""
    gone = C.deleted_paths(fx.code_diffs(spark, sf_dir)).select("repo", "path").distinct()
    return fx.code_files(spark, sf_dir).join(gone, ["repo", "path"], "left_anti")


def _hunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.diff_hunks(fx.code_diffs(spark, sf_dir))


_SYMBOL_COLS = ["repo", "path", "lang", "kind", "name", "class_name", "qualified_name",
                "params", "return_type", "start_line", "end_line"]


# --------------------------------------------------------------------------
# churn
# --------------------------------------------------------------------------
_DELETED_SQL = """deleted AS (
  SELECT DISTINCT repo, substr(line, 7) AS path FROM (
    SELECT repo, lag(line) OVER (PARTITION BY repo, change_id ORDER BY idx) AS line, line AS cur
    FROM diff_lines) WHERE cur = '+++ /dev/null' AND starts_with(line, '--- a/')),
files_now AS (SELECT f.* FROM code_files f ANTI JOIN deleted d ON f.repo = d.repo AND f.path = d.path)"""


def _hotspot_oracle(body: str) -> str:
    base = with_ctes("code_files,touches,git_log,diff_lines", "")
    base = base.rstrip() + ",\n" + _DELETED_SQL + """,
counts AS (SELECT repo, trim(line) AS path, count(*) AS commits FROM git_log
           WHERE trim(line) <> '' AND regexp_matches(trim(line), '\\.(py|js|jsx|ts|tsx)$') GROUP BY 1, 2),
hot AS (SELECT c.repo, c.path, c.commits,
               CAST(len(string_split(f.content, chr(10))) - CASE WHEN ends_with(f.content, chr(10)) THEN 1 ELSE 0 END AS BIGINT) AS loc
        FROM counts c JOIN files_now f ON c.repo = f.repo AND c.path = f.path)
""" + body
    return base


@query("churn_hotspots", _hotspot_oracle("""
SELECT repo, path, commits, loc, hotspot_score, rank FROM (
  SELECT *, commits * loc AS hotspot_score,
         row_number() OVER (PARTITION BY repo ORDER BY commits * loc DESC, path) AS rank FROM hot)
WHERE rank <= 15"""))
def q_churn_hotspots(spark, sf_dir):
    touched = CH.read_git_log(fx.git_log_lines(spark, sf_dir))
    return CH.churn_hotspots(touched, _files_now(spark, sf_dir))


@query("topk_hotspots", _hotspot_oracle("""
SELECT repo, path, commits, loc, commits * loc AS hotspot_score FROM hot
ORDER BY hotspot_score DESC, repo, path LIMIT 15"""))
def q_topk_hotspots(spark, sf_dir):
    touched = CH.read_git_log(fx.git_log_lines(spark, sf_dir))
    return CH.topk_hotspots(touched, _files_now(spark, sf_dir))


@query("commit_count", with_ctes("git_log", """
SELECT repo, trim(line) AS path, count(*) AS commits FROM git_log
WHERE trim(line) <> '' AND regexp_matches(trim(line), '\\.(py|js|jsx|ts|tsx)$') GROUP BY 1, 2"""))
def q_commit_count(spark, sf_dir):
    return CH.commit_count(CH.read_git_log(fx.git_log_lines(spark, sf_dir)))


@query("read_git_log", with_ctes("git_log", """
SELECT repo, trim(line) AS path FROM git_log
WHERE trim(line) <> '' AND regexp_matches(trim(line), '\\.(py|js|jsx|ts|tsx)$')"""))
def q_read_git_log(spark, sf_dir):
    return CH.read_git_log(fx.git_log_lines(spark, sf_dir))


@query("file_exists_join", _hotspot_oracle("SELECT repo, path, commits, loc FROM hot"))
def q_file_exists_join(spark, sf_dir):
    touched = CH.read_git_log(fx.git_log_lines(spark, sf_dir))
    return CH.hotspots(touched, _files_now(spark, sf_dir)).select("repo", "path", "commits", "loc")


# --------------------------------------------------------------------------
# structure
# --------------------------------------------------------------------------
@query("extract_symbols", with_ctes("symbols_q", f"SELECT {', '.join(_SYMBOL_COLS)} FROM symbols_q"))
def q_extract_symbols(spark, sf_dir):
    return _symbols(spark, sf_dir).select(*_SYMBOL_COLS)


@query("outline", with_ctes("symbols_q", """
SELECT f.repo, f.path, coalesce(o.outline, 'No functions or classes found.') AS outline
FROM code_files f LEFT JOIN (
  SELECT repo, path, string_agg(CASE WHEN kind = 'def'
           THEN 'def ' || qualified_name || params || '  — lines ' || start_line || '-' || end_line
           ELSE 'class ' || name || '  — lines ' || start_line || '-' || end_line END, chr(10) ORDER BY start_line) AS outline
  FROM symbols_q GROUP BY repo, path) o ON f.repo = o.repo AND f.path = o.path"""))
def q_outline(spark, sf_dir):
    files = fx.code_files(spark, sf_dir)
    return S.outline(files, stored_symbols(files))


@query("function_source", with_ctes("symbols_q,code_lines", """
SELECT s.repo, s.path, s.qualified_name,
       ltrim(string_agg(l.txt, chr(10) ORDER BY l.line_no)) AS source
FROM symbols_q s JOIN code_lines l ON s.repo = l.repo AND s.path = l.path
 AND l.line_no BETWEEN s.start_line AND s.end_line
WHERE s.kind = 'def'
GROUP BY s.repo, s.path, s.qualified_name"""))
def q_function_source(spark, sf_dir):
    return S.function_source(_symbols(spark, sf_dir))


@query("score_complexity", with_ctes("symbols_q,line_decisions", """
SELECT s.repo, s.path, s.qualified_name AS function, CAST(s.start_line AS BIGINT) AS line,
       CAST(1 + coalesce(sum(d.dec), 0) AS BIGINT) AS complexity_score,
       CASE WHEN 1 + coalesce(sum(d.dec), 0) > 20 THEN 'Extreme'
            WHEN 1 + coalesce(sum(d.dec), 0) > 10 THEN 'High'
            WHEN 1 + coalesce(sum(d.dec), 0) > 5 THEN 'Moderate' ELSE 'Low' END AS risk_level
FROM symbols_q s LEFT JOIN line_decisions d ON s.repo = d.repo AND s.path = d.path
 AND d.line_no BETWEEN s.start_line AND s.end_line
WHERE s.kind = 'def' AND s.lang = 'python'
GROUP BY s.repo, s.path, s.qualified_name, s.start_line"""))
def q_score_complexity(spark, sf_dir):
    from repolens.operators import complexity as CX
    return CX.score_complexity(_spans(spark, sf_dir))


# --------------------------------------------------------------------------
# changes
# --------------------------------------------------------------------------
@query("diff_hunks", with_ctes("hunks", "SELECT repo, change_id, path, start_line, line_count FROM hunks"))
def q_diff_hunks(spark, sf_dir):
    return _hunks(spark, sf_dir).select(
        "repo", "change_id", "path", F.col("start_line").cast("bigint"), F.col("line_count").cast("bigint"))


@query("hunk_lines", with_ctes("hunk_lines", "SELECT repo, change_id, path, line_no FROM hunk_lines"))
def q_hunk_lines(spark, sf_dir):
    return C.hunk_lines(_hunks(spark, sf_dir), ["repo", "change_id"]).select(
        "repo", "change_id", "path", F.col("line_no").cast("bigint"))


@query("modified_line_count", with_ctes("hunk_lines", """
SELECT repo, change_id, path, count(*) AS modified_line_count FROM hunk_lines GROUP BY 1, 2, 3"""))
def q_modified_line_count(spark, sf_dir):
    return C.modified_line_count(_hunks(spark, sf_dir), ["repo", "change_id"])


@query("hunk_symbol_overlap", with_ctes("hunk_overlaps", """
SELECT repo, change_id, path, function, start_line, end_line FROM hunk_overlaps"""))
def q_hunk_symbol_overlap(spark, sf_dir):
    files = fx.code_files(spark, sf_dir)
    return C.hunk_symbol_overlap(_hunks(spark, sf_dir), _spans(spark, sf_dir), ["repo", "change_id"]).drop("start_off")


@query("change_impact", with_ctes("hunk_lines,hunk_overlaps,symbols_q", """
SELECT c.repo, c.change_id, c.path, c.modified_line_count,
       CAST(coalesce(a.n_affected, 0) AS BIGINT) AS n_affected, coalesce(a.affected, '') AS affected
FROM (SELECT repo, change_id, path, count(*) AS modified_line_count FROM hunk_lines GROUP BY 1, 2, 3) c
JOIN code_files f ON f.repo = c.repo AND f.path = c.path
LEFT JOIN (SELECT repo, change_id, path, count(*) AS n_affected,
                  string_agg(function || ' (lines ' || start_line || '-' || end_line || ')', '; '
                             ORDER BY start_line) AS affected
           FROM hunk_overlaps GROUP BY 1, 2, 3) a
  ON a.repo = c.repo AND a.change_id = c.change_id AND a.path = c.path"""))
def q_change_impact(spark, sf_dir):
    files = fx.code_files(spark, sf_dir)
    impact = C.change_impact(_hunks(spark, sf_dir), _spans(spark, sf_dir), files, ["repo", "change_id"])
    return impact.select(
        "repo", "change_id", "path", "modified_line_count", "n_affected",
        F.array_join(F.transform("affected_functions", lambda x: F.concat(
            x["function"], F.lit(" ("), x["span"], F.lit(")"))), "; ").alias("affected"))


# --------------------------------------------------------------------------
# text
# --------------------------------------------------------------------------
@query("loc", """
SELECT doc_id, CAST(len(regexp_extract_all(text, '\\r\\n|\\r|\\n'))
       + CASE WHEN length(text) > 0 AND NOT regexp_matches(text, '[\\r\\n]$') THEN 1 ELSE 0 END AS BIGINT) AS loc
FROM documents""")
def q_loc(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", X.loc(F.col("text")).alias("loc"))


# Python whitespace (str.isspace) and splitlines boundaries in RE2 syntax.
_WS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_LINE_RE = r"\r\n|[\n\r\x0B\f\x1C-\x1E\x{85}\x{2028}\x{2029}]"
_DOC_LINES = f"""doc_lines AS (
  SELECT repo, path, doc_id, line_no, line FROM (
    SELECT source AS repo, lang || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path, doc_id,
           unnest(generate_series(1, len(l))) AS line_no, unnest(l) AS line, len(l) AS n
    FROM (SELECT *, string_split_regex(text, '{_LINE_RE}') AS l FROM documents))
  WHERE NOT (line_no = n AND line = ''))"""
SEARCH_PATTERN = "licen[cs]e|token|@| the "


@query("explode_lines", f"WITH {_DOC_LINES} SELECT doc_id, line_no, line FROM doc_lines")
def q_explode_lines(spark, sf_dir):
    from repolens.operators import search as SE
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text").alias("content"))
    return SE.explode_lines(docs)


@query("search_code", f"""WITH {_DOC_LINES}
SELECT repo, path, line_no, 'Line ' || line_no || ': ' || regexp_replace(line, '^{_WS}+|{_WS}+$', '', 'g') AS match
FROM (SELECT *, row_number() OVER (PARTITION BY repo, path ORDER BY line_no) AS k
      FROM doc_lines WHERE regexp_matches(line, '(?i){SEARCH_PATTERN}'))
WHERE k <= 20""")
def q_search_code(spark, sf_dir):
    from repolens.operators import search as SE
    return SE.search_code(fx.documents_as_files(spark, sf_dir), SEARCH_PATTERN)


@query("per_file_cap", f"""WITH {_DOC_LINES}
SELECT repo, path, CAST(count(*) AS BIGINT) AS matches, CAST(least(count(*), 20) AS BIGINT) AS kept
FROM doc_lines WHERE regexp_matches(line, '(?i){SEARCH_PATTERN}') GROUP BY repo, path""")
def q_per_file_cap(spark, sf_dir):
    from repolens.operators import search as SE
    return SE.match_counts(fx.documents_as_files(spark, sf_dir), SEARCH_PATTERN)


@query("token_count", r"""
SELECT source AS repo, token, count(*) AS n
FROM (SELECT source, unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS token FROM documents)
GROUP BY 1, 2""")
def q_token_count(spark, sf_dir):
    from repolens.operators import search as SE
    return SE.token_count(fx.documents_as_files(spark, sf_dir))


SYMBOL_QUERY = "Economy"


@query("search_symbols", with_ctes("symbols_q", f"""
SELECT repo, path, line FROM (
  SELECT repo, path, CASE WHEN kind = 'def'
           THEN 'def ' || qualified_name || params || '  — lines ' || start_line || '-' || end_line
           ELSE 'class ' || name || '  — lines ' || start_line || '-' || end_line END AS line
  FROM symbols_q) WHERE contains(lower(line), lower('{SYMBOL_QUERY}'))"""))
def q_search_symbols(spark, sf_dir):
    from repolens.operators import search as SE
    return SE.search_symbols(_symbols(spark, sf_dir), SYMBOL_QUERY)


@query("imports", with_ctes("code_lines", """
SELECT f.repo, f.path, CAST(coalesce(i.n, 0) AS BIGINT) AS import_count, coalesce(i.imports, '') AS imports
FROM code_files f LEFT JOIN (
  SELECT repo, path, count(*) AS n, string_agg(stmt, chr(10) ORDER BY stmt) AS imports
  FROM (SELECT DISTINCT repo, path, trim(txt) AS stmt FROM code_lines
        WHERE path LIKE '%.py' AND regexp_matches(txt, '^\\s*(import|from)\\s')
          AND NOT regexp_matches(txt, '^\\s*from\\s+__future__\\s'))
  GROUP BY repo, path) i ON f.repo = i.repo AND f.path = i.path
WHERE f.path LIKE '%.py'"""))
def q_imports(spark, sf_dir):
    from repolens.operators import pyfacts as PF
    out = PF.imports(fx.code_files(spark, sf_dir))
    return out.select("repo", "path", "import_count", F.array_join("imports", "\n").alias("imports"))


@query("distinct_imports", with_ctes("code_lines", """
SELECT repo, trim(txt) AS stmt, CAST(count(DISTINCT path) AS BIGINT) AS files
FROM code_lines WHERE path LIKE '%.py' AND regexp_matches(txt, '^\\s*(import|from)\\s')
GROUP BY 1, 2"""))
def q_distinct_imports(spark, sf_dir):
    from repolens.operators import pyfacts as PF
    return PF.distinct_imports(fx.code_files(spark, sf_dir))


@query("decision_points", with_ctes("sig_lines", """
SELECT repo, path, CAST(line_no AS BIGINT) AS line, kind FROM (
  SELECT repo, path, line_no, regexp_extract(txt, '^\\s*(if|for|while|except|with)\\b', 1)
         || CASE WHEN regexp_matches(txt, '^\\s*except\\b') THEN '_clause' ELSE '_statement' END AS kind
  FROM sig_lines WHERE path LIKE '%.py' AND regexp_matches(txt, '^\\s*(if|for|while|except|with)\\b')
  UNION ALL
  SELECT repo, path, line_no, 'boolean_operator' FROM (
    SELECT repo, path, line_no, unnest(regexp_extract_all(txt, '\\b(and|or)\\b')) AS w
    FROM sig_lines WHERE path LIKE '%.py')
  UNION ALL
  SELECT repo, path, line_no, 'conditional_expression' FROM (
    SELECT repo, path, line_no, unnest(regexp_extract_all(txt, '\\S\\s+else\\b')) AS w
    FROM sig_lines WHERE path LIKE '%.py'))"""))
def q_decision_points(spark, sf_dir):
    from repolens.operators import pyfacts as PF
    return PF.decision_points(fx.code_files(spark, sf_dir))


_DEAD_CTE = """,
py_defs AS (SELECT repo, name, max(path) AS path FROM symbols_q
            WHERE kind = 'def' AND lang = 'python' AND path LIKE '%.py'
              AND NOT (starts_with(name, '__') AND ends_with(name, '__')) GROUP BY repo, name),
words AS (SELECT repo, token, count(*) AS n FROM (
            SELECT repo, unnest(regexp_extract_all(content, '[\\p{L}\\p{N}_]+')) AS token
            FROM code_files WHERE path LIKE '%.py') GROUP BY 1, 2)
"""


@query("dead_code_candidates", with_ctes("symbols_q", "").rstrip() + _DEAD_CTE + """
SELECT d.repo, d.name AS function, d.path FROM py_defs d JOIN words w ON w.repo = d.repo AND w.token = d.name
WHERE w.n = 1""")
def q_dead_code(spark, sf_dir):
    from repolens.operators import deadcode as DC
    files = fx.code_files(spark, sf_dir)
    return DC.dead_code_candidates(files, _spans(spark, sf_dir))


@query("functions_scanned", with_ctes("symbols_q", "").rstrip() + _DEAD_CTE + """
SELECT repo, count(*) AS functions_scanned FROM py_defs GROUP BY repo""")
def q_functions_scanned(spark, sf_dir):
    from repolens.operators import deadcode as DC
    files = fx.code_files(spark, sf_dir)
    return DC.functions_scanned(files, _spans(spark, sf_dir))


@query("name_token_join", with_ctes("symbols_q", "").rstrip() + _DEAD_CTE + """
SELECT d.repo, d.name AS function, w.n AS mentions FROM py_defs d JOIN words w ON w.repo = d.repo AND w.token = d.name""")
def q_name_token_join(spark, sf_dir):
    from repolens.operators import deadcode as DC
    files = fx.code_files(spark, sf_dir)
    names = DC.defined_functions(files, _spans(spark, sf_dir))
    return DC.name_mentions(files, names).select("repo", F.col("name").alias("function"), F.col("n").alias("mentions"))


@query("doc_summary", f"""
SELECT doc_id, CASE WHEN len(ls) = 0 THEN '' WHEN len(ls) > 1 THEN ls[1] || '...' ELSE ls[1] END AS summary
FROM (SELECT doc_id, list_filter(list_transform(string_split(s3, chr(10)),
                       lambda x: regexp_replace(x, '^{_WS}+|{_WS}+$', '', 'g')), lambda x: x <> '') AS ls
      FROM (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '^{_WS}+|{_WS}+$', '', 'g'),
                   '^"+|"+$', '', 'g'), '^''+|''+$', '', 'g') AS s3 FROM documents))""")
def q_doc_summary(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", X.doc_summary(F.col("text")).alias("summary"))


def _doc_bytes(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    t = F.col("text")
    variants = F.array(
        F.struct(F.lit("utf8").alias("variant"), F.encode(t, "UTF-8").alias("raw")),
        F.struct(F.lit("utf16le_bom").alias("variant"),
                 F.concat(F.lit(bytearray(b"\xff\xfe")), F.encode(t, "UTF-16LE")).alias("raw")),
        F.struct(F.lit("utf16be_bom").alias("variant"),
                 F.concat(F.lit(bytearray(b"\xfe\xff")), F.encode(t, "UTF-16BE")).alias("raw")),
        F.struct(F.lit("bad_utf8").alias("variant"),
                 F.concat(F.encode(t, "UTF-8"), F.lit(bytearray(b"\xff"))).alias("raw")))
    return docs.select("doc_id", F.explode(variants).alias("v")).select("doc_id", "v.variant", "v.raw")


_VARIANTS = "(VALUES ('utf8'), ('utf16le_bom'), ('utf16be_bom'), ('bad_utf8')) AS v(variant)"


@query("decode_text", f"""
SELECT doc_id, variant, CASE WHEN variant = 'bad_utf8' THEN text || chr(65533) ELSE text END AS text
FROM documents CROSS JOIN {_VARIANTS}""")
def q_decode_text(spark, sf_dir):
    return _doc_bytes(spark, sf_dir).select("doc_id", "variant", X.decode_text(F.col("raw")).alias("text"))


@query("read_file", f"""
SELECT doc_id, variant, CASE WHEN variant = 'utf8' THEN text END AS text,
       CASE WHEN variant = 'utf8' THEN NULL ELSE 'Error reading file: not valid UTF-8' END AS problem
FROM documents CROSS JOIN {_VARIANTS}""")
def q_read_file(spark, sf_dir):
    from repolens.sources import files as FS
    return FS.read_file(_doc_bytes(spark, sf_dir), raw_col="raw").select("doc_id", "variant", "text", "problem")


# --------------------------------------------------------------------------
# project configuration
# --------------------------------------------------------------------------
_STRIP = f"'^{_WS}+|{_WS}+$'"
_PROJECT_CTES = with_ctes("manifests", "").rstrip() + f""",
top AS (SELECT * FROM manifests WHERE NOT contains(path, '/')
        OR regexp_matches(path, '^\\.github/workflows/[^/]+\\.yml$')),
npm AS (SELECT repo, list_concat(d, list_filter(v, lambda x: NOT list_contains(d, x))) AS keys FROM (
          SELECT repo, coalesce(json_keys(json_extract(content, '$.dependencies')), []) AS d,
                 coalesce(json_keys(json_extract(content, '$.devDependencies')), []) AS v
          FROM top WHERE path = 'package.json' AND json_valid(content) AND json_type(content) = 'OBJECT')),
pip AS (SELECT repo, list_transform(list_filter(string_split_regex(lower(content), '{_LINE_RE}'),
                       lambda l: regexp_replace(l, {_STRIP}, '', 'g') <> '' AND NOT starts_with(l, '#')),
                       lambda l: regexp_replace(l, {_STRIP}, '', 'g')) AS pkgs
        FROM top WHERE path = 'requirements.txt'),
env AS (SELECT repo, list_transform(list_filter(list_transform(string_split_regex(content, '{_LINE_RE}'),
                       lambda l: regexp_replace(l, {_STRIP}, '', 'g')),
                       lambda l: l <> '' AND NOT starts_with(l, '#') AND contains(l, '=')),
                       lambda l: regexp_replace(split_part(l, '=', 1), {_STRIP}, '', 'g')) AS keys
        FROM top WHERE path = '.env.example'),
fw AS (SELECT n.repo, s.fw FROM npm n JOIN (VALUES ('next', 'Next.js'), ('react', 'React'), ('vue', 'Vue'),
                ('express', 'Express'), ('@angular/core', 'Angular')) AS s(sig, fw) ON list_contains(n.keys, s.sig)
       UNION SELECT t.repo, s.fw FROM top t JOIN (VALUES ('requirements.txt', 'flask', 'Flask'),
                ('requirements.txt', 'django', 'Django'), ('requirements.txt', 'fastapi', 'FastAPI'),
                ('pyproject.toml', 'flask', 'Flask'), ('pyproject.toml', 'django', 'Django'),
                ('pyproject.toml', 'fastapi', 'FastAPI')) AS s(m, sig, fw)
                ON t.path = s.m AND contains(lower(t.content), s.sig)
       UNION SELECT repo, 'Django' FROM top WHERE path = 'manage.py'
       UNION SELECT repo, 'Next.js' FROM top WHERE path IN ('next.config.js', 'next.config.ts')),
repos AS (SELECT repo, list(path) AS paths FROM top GROUP BY repo),
cfg AS (SELECT repo,
          list_filter(['.env.example', '.env', 'docker-compose.yml', 'pytest.ini', 'tsconfig.json', '.eslintrc.json',
                       '.eslintrc.js', '.prettierrc', 'vite.config.js', 'vite.config.ts', 'next.config.js',
                       'next.config.ts', 'tailwind.config.js'], lambda c: list_contains(paths, c)) AS config_files,
          list_concat(list_filter(['Makefile', 'Dockerfile', '.gitlab-ci.yml'], lambda c: list_contains(paths, c)),
                      list_sort(list_filter(paths, lambda p: regexp_matches(p, '^\\.github/workflows/[^/]+\\.yml$')))) AS build_ci
        FROM repos)
"""


@query("project_config", _PROJECT_CTES + """
SELECT r.repo,
       coalesce((SELECT array_to_string(list_sort(list(DISTINCT fw)), ', ') FROM fw WHERE fw.repo = r.repo), '') AS frameworks,
       array_to_string(n.keys, ', ') AS npm, array_to_string(p.pkgs, ', ') AS pip,
       array_to_string(r.config_files, ', ') AS config_files, array_to_string(r.build_ci, ', ') AS build_ci,
       coalesce(array_to_string(e.keys, ', '), '') AS env_vars_expected
FROM cfg r LEFT JOIN npm n ON n.repo = r.repo LEFT JOIN pip p ON p.repo = r.repo LEFT JOIN env e ON e.repo = r.repo""")
def q_project_config(spark, sf_dir):
    from repolens.operators import project as PR
    prof = PR.project_config(fx.manifests(spark, sf_dir))
    return prof.select("repo", *[F.array_join(c, ", ").alias(c) for c in
                                 ("frameworks", "npm", "pip", "config_files", "build_ci", "env_vars_expected")])


@query("npm_keys", _PROJECT_CTES + "SELECT repo, array_to_string(keys, ', ') AS npm FROM npm")
def q_npm_keys(spark, sf_dir):
    from repolens.operators import project as PR
    m = fx.manifests(spark, sf_dir).where(F.col("path") == "package.json")
    k = PR.npm_keys(F.col("content"))
    return m.where(k.isNotNull()).select("repo", F.array_join(k, ", ").alias("npm"))


@query("merge_dependencies", _PROJECT_CTES + """
SELECT repo, key, CAST(pos AS BIGINT) AS pos FROM (
  SELECT repo, unnest(keys) AS key, unnest(generate_series(1, len(keys))) AS pos FROM npm)""")
def q_merge_dependencies(spark, sf_dir):
    from repolens.operators import project as PR
    m = fx.manifests(spark, sf_dir).where(F.col("path") == "package.json")
    return (m.select("repo", F.posexplode(PR.npm_keys(F.col("content"))).alias("p", "key"))
            .select("repo", "key", (F.col("p") + 1).cast("bigint").alias("pos")))


@query("pip_lines", _PROJECT_CTES + """
SELECT repo, pkg, CAST(pos AS BIGINT) AS pos FROM (
  SELECT repo, unnest(pkgs) AS pkg, unnest(generate_series(1, len(pkgs))) AS pos FROM pip)""")
def q_pip_lines(spark, sf_dir):
    from repolens.operators import project as PR
    m = fx.manifests(spark, sf_dir).where(F.col("path") == "requirements.txt")
    return (m.select("repo", F.posexplode(PR.pip_lines(F.col("content"))).alias("p", "pkg"))
            .select("repo", "pkg", (F.col("p") + 1).cast("bigint").alias("pos")))


@query("env_keys", _PROJECT_CTES + """
SELECT repo, key, CAST(pos AS BIGINT) AS pos FROM (
  SELECT repo, unnest(keys) AS key, unnest(generate_series(1, len(keys))) AS pos FROM env)""")
def q_env_keys(spark, sf_dir):
    from repolens.operators import project as PR
    m = fx.manifests(spark, sf_dir).where(F.col("path") == ".env.example")
    return (m.select("repo", F.posexplode(PR.env_keys(F.col("content"))).alias("p", "key"))
            .select("repo", "key", (F.col("p") + 1).cast("bigint").alias("pos")))


@query("framework_set", _PROJECT_CTES + "SELECT DISTINCT repo, fw AS framework FROM fw")
def q_framework_set(spark, sf_dir):
    from repolens.operators import project as PR
    facts = PR.project_facts(fx.manifests(spark, sf_dir))
    return facts.select("repo", F.explode("frameworks").alias("framework")).distinct()


@query("union_framework_rules", _PROJECT_CTES + """
SELECT fw AS framework, CAST(count(DISTINCT repo) AS BIGINT) AS repos FROM fw GROUP BY fw""")
def q_union_framework_rules(spark, sf_dir):
    from repolens.operators import project as PR
    facts = PR.project_facts(fx.manifests(spark, sf_dir))
    return (facts.select("repo", F.explode("frameworks").alias("framework")).distinct()
            .groupBy("framework").agg(F.count(F.lit(1)).alias("repos")))


@query("dependency_signal_join", _PROJECT_CTES + """
SELECT n.repo, s.fw AS framework FROM npm n JOIN (VALUES ('next', 'Next.js'), ('react', 'React'), ('vue', 'Vue'),
   ('express', 'Express'), ('@angular/core', 'Angular')) AS s(sig, fw) ON list_contains(n.keys, s.sig)""")
def q_dependency_signal_join(spark, sf_dir):
    from repolens.operators import project as PR
    m = fx.manifests(spark, sf_dir).where(F.col("path") == "package.json")
    return m.select("repo", F.explode(PR.dependency_signal_join(PR.npm_keys(F.col("content")))).alias("framework"))


@query("text_signal_join", _PROJECT_CTES + """
SELECT t.repo, s.fw AS framework FROM top t JOIN (VALUES ('requirements.txt', 'flask', 'Flask'),
   ('requirements.txt', 'django', 'Django'), ('requirements.txt', 'fastapi', 'FastAPI'),
   ('pyproject.toml', 'flask', 'Flask'), ('pyproject.toml', 'django', 'Django'),
   ('pyproject.toml', 'fastapi', 'FastAPI')) AS s(m, sig, fw) ON t.path = s.m AND contains(lower(t.content), s.sig)""")
def q_text_signal_join(spark, sf_dir):
    from repolens.operators import project as PR
    m = fx.manifests(spark, sf_dir).where(F.col("path").isin("requirements.txt", "pyproject.toml"))
    return m.select("repo", F.explode(PR.text_signal_join(F.col("path"), F.lower(F.col("content")))).alias("framework"))


@query("presence_join", _PROJECT_CTES + """
SELECT repo, array_to_string(config_files, ', ') AS config_files FROM cfg""")
def q_presence_join(spark, sf_dir):
    prof = _project(spark, sf_dir)
    return prof.select("repo", F.array_join("config_files", ", ").alias("config_files"))


@query("ci_workflows", _PROJECT_CTES + "SELECT repo, array_to_string(build_ci, ', ') AS build_ci FROM cfg")
def q_ci_workflows(spark, sf_dir):
    prof = _project(spark, sf_dir)
    return prof.select("repo", F.array_join("build_ci", ", ").alias("build_ci"))


def _project(spark, sf_dir):
    from repolens.operators import project as PR
    return PR.project_config(fx.manifests(spark, sf_dir))


# --------------------------------------------------------------------------
# archives and scan listing
# --------------------------------------------------------------------------
_COORD_SQL = """
SELECT archive_id, owner, repo, branch,
  CASE WHEN NOT regexp_full_match(owner, '[A-Za-z0-9._-]+') OR NOT regexp_full_match(repo, '[A-Za-z0-9._-]+')
       THEN 'Invalid owner or repo name.'
       WHEN NOT regexp_full_match(branch, '[A-Za-z0-9._/-]+') OR contains(branch, '..')
       THEN 'Invalid branch name.' END AS problem
FROM archive_index"""


@query("validate_coordinates", with_ctes("archive_index", _COORD_SQL))
def q_validate_coordinates(spark, sf_dir):
    from repolens.sources import archives as AR
    return AR.validate_coordinates(fx.archive_index(spark, sf_dir)).select(
        "archive_id", "owner", "repo", "branch", "problem")


@query("archive_admission", with_ctes("archive_index,archive_entries", """
SELECT a.archive_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_entries, CAST(coalesce(s.b, 0) AS BIGINT) AS expanded_bytes,
  CASE WHEN a.compressed_bytes > 104857600 THEN 'Archive exceeds the 100 MB download limit.'
       WHEN coalesce(s.n, 0) > 20000 THEN 'Archive contains more than 20000 entries.'
       WHEN coalesce(s.b, 0) > 524288000 THEN 'Archive expands to more than 500 MB.' END AS problem
FROM archive_index a LEFT JOIN (SELECT archive_id, count(*) AS n, sum(size) AS b FROM archive_entries GROUP BY 1) s
  ON a.archive_id = s.archive_id"""))
def q_archive_admission(spark, sf_dir):
    from repolens.sources import archives as AR
    idx = fx.archive_index(spark, sf_dir).select("archive_id", "compressed_bytes")
    return AR.archive_admission(idx, fx.archive_entries(spark, sf_dir)).select(
        "archive_id", "n_entries", "expanded_bytes", "problem")


_ESCAPE_SQL = """
esc AS (SELECT archive_id, name, starts_with(name, '/') OR min(depth) < 0 AS escapes FROM (
          SELECT archive_id, name, k, sum(CASE WHEN part = '..' THEN -1 WHEN part IN ('', '.') THEN 0 ELSE 1 END)
                 OVER (PARTITION BY archive_id, name, k ORDER BY i) AS depth FROM (
            SELECT archive_id, name, k, unnest(parts) AS part, unnest(generate_series(1, len(parts))) AS i FROM (
              SELECT archive_id, name, row_number() OVER () AS k, string_split(name, '/') AS parts FROM archive_entries)))
        GROUP BY archive_id, name, k)"""


@query("archive_containment", with_ctes("archive_entries", "").rstrip() + ",\n" + _ESCAPE_SQL + """
SELECT archive_id, bool_or(escapes) AS escapes, min(CASE WHEN escapes THEN name END) AS offending_entry
FROM esc GROUP BY archive_id""")
def q_archive_containment(spark, sf_dir):
    from repolens.sources import archives as AR
    return AR.archive_containment(fx.archive_entries(spark, sf_dir))


@query("classify_language", with_ctes("code_files,manifests", """
SELECT repo, path, CASE regexp_extract(regexp_extract(path, '([^/]*)$', 1), '^.+(\\.[^.]+)$', 1)
         WHEN '.py' THEN 'python' WHEN '.js' THEN 'javascript' WHEN '.jsx' THEN 'javascript' END AS lang
FROM (SELECT repo, path FROM code_files UNION ALL SELECT repo, path FROM manifests)"""))
def q_classify_language(spark, sf_dir):
    files = fx.code_files(spark, sf_dir).select("repo", "path").unionByName(
        fx.manifests(spark, sf_dir).select("repo", "path"))
    return files.select("repo", "path", X.classify_language(F.col("path")).alias("lang"))


@query("scan_outline", with_ctes("symbols_q,manifests", """
SELECT w.repo, w.path, CASE WHEN regexp_matches(w.path, '\\.(py|js|jsx)$') THEN 'source' ELSE 'other' END AS kind,
  CASE WHEN regexp_matches(w.path, '\\.(py|js|jsx)$') THEN coalesce(o.outline, 'No functions or classes found.') END AS outline
FROM (SELECT repo, path FROM code_files UNION ALL SELECT repo, path FROM manifests) w
LEFT JOIN (SELECT repo, path, string_agg(CASE WHEN kind = 'def'
           THEN 'def ' || qualified_name || params || '  — lines ' || start_line || '-' || end_line
           ELSE 'class ' || name || '  — lines ' || start_line || '-' || end_line END, chr(10) ORDER BY start_line) AS outline
  FROM symbols_q GROUP BY repo, path) o ON w.repo = o.repo AND w.path = o.path"""))
def q_scan_outline(spark, sf_dir):
    from repolens.sources import files as FS
    code = fx.code_files(spark, sf_dir).select("repo", "path", "content")
    work = code.unionByName(fx.manifests(spark, sf_dir).select("repo", "path", "content"))
    return FS.scan_outline(work, S.outline(code, stored_symbols(code)))


# --------------------------------------------------------------------------
# structure, finer grained (each a view of the same operators)
# --------------------------------------------------------------------------
# RE2 forms of the token rules (no possessive quantifiers; RE2 picks the
# leftmost alternative like the Java engine).
_RE2_PY_TOKEN = (r"""(?s)[ \t\f]*(?:(?:[rRbBuUfF]{1,2})?(?:\"\"\"(?:.)*?\"\"\"|'''(?:.)*?'''|"(?:[^"\\\n]|\\.)*"|"""
                 r"""'(?:[^'\\\n]|\\.)*')|#[^\n]*|\\\r?\n|\r?\n|->|[\p{L}\p{N}_]+|.)""")
_RE2_JS_TOKEN = (r"""(?s)[ \t\f]*(?:"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`(?:[^`\\]|\\.)*`|//[^\n]*|/\*.*?\*/"""
                 r"""|\r?\n|[\p{L}\p{N}_$]+|.)""")


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


@query("tokenize", with_ctes("code_files", f"""
SELECT repo, path, CAST(pos AS BIGINT) AS pos, tok,
  CAST(1 + coalesce(sum(len(tok) - len(replace(tok, chr(10), ''))) OVER w, 0) AS BIGINT) AS line,
  CAST(coalesce(sum(CASE WHEN tok IN ('(', '[', '{{') THEN 1 WHEN tok IN (')', ']', '}}') THEN -1 ELSE 0 END) OVER w, 0) AS BIGINT) AS dpt
FROM (
  SELECT repo, path, unnest(generate_series(0, len(t) - 1)) AS pos,
         ltrim(unnest(t), ' ' || chr(9) || chr(12)) AS tok
  FROM (SELECT repo, path, regexp_extract_all(content, {_sql_str(_RE2_PY_TOKEN)}) AS t FROM code_files
        WHERE path LIKE '%.py')
  UNION ALL
  SELECT repo, path, unnest(generate_series(0, len(t) - 1)) AS pos,
         ltrim(unnest(t), ' ' || chr(9) || chr(12)) AS tok
  FROM (SELECT repo, path, regexp_extract_all(content, {_sql_str(_RE2_JS_TOKEN)}) AS t FROM code_files
        WHERE path LIKE '%.js'))
WINDOW w AS (PARTITION BY repo, path ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""".replace("{{", "{").replace("}}", "}")))
def q_tokenize(spark, sf_dir):
    from repolens.operators import tokens as T
    files = fx.code_files(spark, sf_dir)
    out = []
    for lang, sfx in (("python", ".py"), ("javascript", ".js")):
        toks = T.tokenize(files.where(F.col("path").endswith(sfx)), lang)
        out.append(toks.select("repo", "path", F.col("pos").cast("bigint"), "tok",
                               F.col("line").cast("bigint"), F.col("dpt").cast("bigint")))
    return out[0].unionByName(out[1])


def _symbol_view(where_sql: str, cond):
    def fn(spark, sf_dir):
        return _symbols(spark, sf_dir).where(cond()).select(*_SYMBOL_COLS)
    return with_ctes("symbols_q", f"SELECT {', '.join(_SYMBOL_COLS)} FROM symbols_q WHERE {where_sql}"), fn


for _name, _sql, _cond in [
    ("py_functions", "lang = 'python' AND kind = 'def'", lambda: (F.col("lang") == "python") & (F.col("kind") == "def")),
    ("py_classes", "lang = 'python' AND kind = 'class'", lambda: (F.col("lang") == "python") & (F.col("kind") == "class")),
    ("js_functions", "lang = 'javascript' AND kind = 'def'",
     lambda: (F.col("lang") == "javascript") & (F.col("kind") == "def")),
    ("js_classes", "lang = 'javascript' AND kind = 'class'",
     lambda: (F.col("lang") == "javascript") & (F.col("kind") == "class")),
    ("enclosing_class", "class_name IS NOT NULL", lambda: F.col("class_name").isNotNull()),
]:
    _oracle, _fn = _symbol_view(_sql, _cond)
    query(_name, _oracle)(_fn)


@query("symbol_spans", with_ctes("symbols_q", """
SELECT repo, path, kind, name, start_line, end_line, CAST(end_line - start_line + 1 AS BIGINT) AS span_lines
FROM symbols_q"""))
def q_symbol_spans(spark, sf_dir):
    s = _symbols(spark, sf_dir)
    return s.select("repo", "path", "kind", "name", "start_line", "end_line",
                    (F.col("end_line") - F.col("start_line") + 1).cast("bigint").alias("span_lines"))


@query("read_unified_diff", with_ctes("diff_lines", """
SELECT repo, change_id, path, deleted FROM (
  SELECT repo, change_id,
         CASE WHEN starts_with(line, '+++ b/') THEN trim(substr(line, 7))
              WHEN cur_old IS NOT NULL THEN cur_old END AS path,
         line = '+++ /dev/null' AS deleted
  FROM (SELECT *, CASE WHEN starts_with(prev, '--- a/') THEN trim(substr(prev, 7)) END AS cur_old
        FROM (SELECT *, lag(line) OVER (PARTITION BY repo, change_id ORDER BY idx) AS prev FROM diff_lines))
  WHERE starts_with(line, '+++ '))"""))
def q_read_unified_diff(spark, sf_dir):
    sec = C.diff_sections(fx.code_diffs(spark, sf_dir))
    return sec.where(F.col("path").isNotNull() | F.col("deleted")).select(
        "repo", "change_id", F.coalesce("path", "old_path").alias("path"), "deleted")


@query("functions_scored", with_ctes("symbols_q", """
SELECT repo, path, count(*) AS functions_scored FROM symbols_q
WHERE lang = 'python' AND kind = 'def' GROUP BY repo, path"""))
def q_functions_scored(spark, sf_dir):
    from repolens.operators import complexity as CX
    return CX.functions_scored(CX.score_complexity(_spans(spark, sf_dir)))


@query("sort_complexity", with_ctes("symbols_q,line_decisions", """
SELECT repo, path, function, line, complexity_score,
       row_number() OVER (PARTITION BY repo, path ORDER BY complexity_score DESC, line) AS rank_in_file
FROM (SELECT s.repo, s.path, s.qualified_name AS function, CAST(s.start_line AS BIGINT) AS line,
             CAST(1 + coalesce(sum(d.dec), 0) AS BIGINT) AS complexity_score
      FROM symbols_q s LEFT JOIN line_decisions d ON s.repo = d.repo AND s.path = d.path
       AND d.line_no BETWEEN s.start_line AND s.end_line
      WHERE s.kind = 'def' AND s.lang = 'python'
      GROUP BY s.repo, s.path, s.qualified_name, s.start_line)"""))
def q_sort_complexity(spark, sf_dir):
    from repolens.operators import complexity as CX
    scores = CX.score_complexity(_spans(spark, sf_dir))
    return CX.sort_complexity(scores).select("repo", "path", "function", "line", "complexity_score", "rank_in_file")


@query("dead_code", with_ctes("symbols_q", "").rstrip() + _DEAD_CTE + """
SELECT d.repo, d.name AS function, d.path, s.functions_scanned
FROM py_defs d JOIN words w ON w.repo = d.repo AND w.token = d.name
JOIN (SELECT repo, count(*) AS functions_scanned FROM py_defs GROUP BY repo) s ON s.repo = d.repo
WHERE w.n = 1""")
def q_dead_code_report(spark, sf_dir):
    from repolens.operators import deadcode as DC
    files = fx.code_files(spark, sf_dir)
    return DC.dead_code_report(files, _spans(spark, sf_dir))


from repolens.plans import shape_queries  # noqa: E402,F401  (registers its queries here)
