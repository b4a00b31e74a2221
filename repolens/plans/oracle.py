"""DuckDB oracle SQL, one text per registered query.

Independent of the Spark implementation: structure is recomputed here
with *line* regexes over the fixture text (indentation and brace lines),
diffs with a line-by-line state machine (last file marker), so an
agreement between the two engines is evidence, not an echo.  Inputs are
the same fixture derivations (``repolens.sources.fixtures``).
"""

from __future__ import annotations

from repolens.sources import fixtures as fx

# --- fixture CTEs (DuckDB names) ------------------------------------------------
_CTES = {
    "code_files": lambda: fx.duckdb_sql(fx.CODE_FILES_SQL, part="part"),
    "touches": lambda: fx.duckdb_sql(fx.TOUCHES_SQL, lineitem="lineitem", code_files="code_files"),
    "hunk_rows": lambda: fx.duckdb_sql(fx.HUNK_ROWS_SQL, lineitem="lineitem", code_files="code_files"),
    "code_diffs": lambda: fx.duckdb_sql(fx.CODE_DIFFS_DUCKDB_SQL, hunk_rows="hunk_rows"),
    "manifests": lambda: fx.duckdb_sql(fx.MANIFESTS_SQL, supplier="supplier"),
    "git_log": lambda: fx.duckdb_sql(fx.GIT_LOG_SQL, touches="touches"),
    "archive_index": lambda: fx.duckdb_sql(fx.ARCHIVE_INDEX_SQL, supplier="supplier"),
    "archive_entries": lambda: fx.duckdb_sql(fx.ARCHIVE_ENTRIES_SQL, lineitem="lineitem", code_files="code_files"),
}

# Derived CTEs shared by several oracle texts (dependencies listed first).
_DERIVED = {
    # Lines of every code file: (repo, path, line_no, txt); trailing '' dropped.
    "code_lines": ("code_files", """
        SELECT repo, path, line_no, txt FROM (
          SELECT repo, path, unnest(generate_series(1, len(l))) AS line_no, unnest(l) AS txt, len(l) AS n
          FROM (SELECT repo, path, string_split(content, chr(10)) AS l FROM code_files))
        WHERE NOT (line_no = n AND txt = '')"""),
    # Non-blank, non-comment lines with indentation width.
    "sig_lines": ("code_lines", """
        SELECT repo, path, line_no, txt, length(txt) - length(ltrim(txt)) AS ind
        FROM code_lines WHERE trim(txt) <> '' AND NOT starts_with(ltrim(txt), '#')
          AND NOT starts_with(ltrim(txt), '//')"""),
    # Python definitions by line regex; spans by indentation.
    "py_heads": ("sig_lines", """
        SELECT repo, path, line_no, ind,
               regexp_extract(txt, '^\\s*(async\\s+)?(def|class)\\s+(\\w+)', 2) AS kind,
               regexp_extract(txt, '^\\s*(async\\s+)?(def|class)\\s+(\\w+)', 3) AS name,
               nullif(regexp_extract(txt, '^\\s*(?:async\\s+)?def\\s+\\w+\\s*(\\([^)]*\\))', 1), '') AS params,
               nullif(trim(regexp_extract(txt, '->\\s*([^:]+):\\s*$', 1)), '') AS return_type
        FROM sig_lines
        WHERE path LIKE '%.py' AND regexp_matches(txt, '^\\s*(async\\s+)?(def|class)\\s')"""),
    "py_spans": ("py_heads", """
        SELECT h.*,
          (SELECT max(x.line_no) FROM sig_lines x
            WHERE x.repo = h.repo AND x.path = h.path AND x.line_no >= h.line_no
              AND x.line_no < coalesce((SELECT min(c.line_no) FROM sig_lines c
                                        WHERE c.repo = h.repo AND c.path = h.path
                                          AND c.line_no > h.line_no AND c.ind <= h.ind), 2147483647)) AS end_line
        FROM py_heads h"""),
    # JavaScript definitions by line regex; spans by the closing-brace line at the same indent.
    "js_heads": ("sig_lines", """
        SELECT repo, path, line_no, ind,
               CASE WHEN regexp_matches(txt, '^\\s*class\\s+\\w+') THEN 'class' ELSE 'def' END AS kind,
               coalesce(nullif(regexp_extract(txt, '^\\s*class\\s+(\\w+)', 1), ''),
                        nullif(regexp_extract(txt, '^\\s*function\\s+(\\w+)', 1), ''),
                        regexp_extract(txt, '^\\s*(\\w+)\\s*\\(', 1)) AS name,
               CASE WHEN regexp_matches(txt, '^\\s*class\\s') THEN NULL
                    ELSE regexp_extract(txt, '(\\([^)]*\\))\\s*\\{\\s*$', 1) END AS params,
               CAST(NULL AS VARCHAR) AS return_type
        FROM sig_lines
        WHERE path LIKE '%.js' AND (regexp_matches(txt, '^\\s*class\\s+\\w+.*\\{\\s*$')
           OR regexp_matches(txt, '^\\s*function\\s+\\w+\\s*\\([^)]*\\)\\s*\\{\\s*$')
           OR (regexp_matches(txt, '^\\s*\\w+\\s*\\([^)]*\\)\\s*\\{\\s*$')
               AND NOT regexp_matches(txt, '^\\s*(if|for|while|switch|catch|function|return|with)\\b')))"""),
    "js_spans": ("js_heads", """
        SELECT h.*,
          (SELECT min(c.line_no) FROM sig_lines c
            WHERE c.repo = h.repo AND c.path = h.path AND c.line_no > h.line_no
              AND c.ind = h.ind AND starts_with(ltrim(c.txt), '}')) AS end_line
        FROM js_heads h"""),
    "all_spans": ("py_spans,js_spans", """
        SELECT *, CASE WHEN path LIKE '%.py' THEN 'python' ELSE 'javascript' END AS lang FROM py_spans
        UNION ALL
        SELECT *, 'javascript' AS lang FROM js_spans"""),
    # Symbols with the innermost enclosing class (looking through functions).
    "symbols": ("all_spans", """
        SELECT s.repo, s.path, s.lang, s.kind, s.name,
          CASE WHEN s.kind = 'def' THEN
            (SELECT arg_max(c.name, c.line_no) FROM all_spans c
              WHERE c.kind = 'class' AND c.repo = s.repo AND c.path = s.path
                AND c.line_no < s.line_no AND c.end_line >= s.line_no AND c.ind < s.ind) END AS class_name,
          s.params, s.return_type, s.line_no AS start_line, s.end_line
        FROM all_spans s"""),
    "symbols_q": ("symbols", """
        SELECT *, CASE WHEN class_name IS NULL THEN name ELSE class_name || '.' || name END AS qualified_name
        FROM symbols"""),
    # Decisions per Python line.
    "line_decisions": ("sig_lines", """
        SELECT repo, path, line_no,
          CASE WHEN regexp_matches(txt, '^\\s*(if|for|while|except|with)\\b') THEN 1 ELSE 0 END
          + len(regexp_extract_all(txt, '\\b(and|or)\\b'))
          + len(regexp_extract_all(txt, '\\belse\\b'))
          - CASE WHEN regexp_matches(txt, '^\\s*else\\b') THEN 1 ELSE 0 END AS dec
        FROM sig_lines WHERE path LIKE '%.py'"""),
    # Hunks by a line-by-line state machine over the diff text.
    "diff_lines": ("code_diffs", """
        SELECT repo, change_id, unnest(generate_series(1, len(l))) AS idx, unnest(l) AS line
        FROM (SELECT repo, change_id, string_split(diff, chr(10)) AS l FROM code_diffs)"""),
    "hunks": ("diff_lines", """
        SELECT repo, change_id, file AS path,
               CAST(regexp_extract(line, '^@@ \\S+ \\+(\\d+)', 1) AS BIGINT) AS start_line,
               CAST(coalesce(nullif(regexp_extract(line, '^@@ \\S+ \\+\\d+,(\\d+)', 1), ''), '1') AS BIGINT) AS line_count
        FROM (SELECT *, last_value(marker IGNORE NULLS) OVER (PARTITION BY repo, change_id ORDER BY idx
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS file
              FROM (SELECT *, CASE WHEN starts_with(line, '+++ ') THEN
                                CASE WHEN starts_with(line, '+++ b/') AND ends_with(trim(line), '.py')
                                     THEN trim(substr(line, 7)) ELSE '' END END AS marker
                    FROM diff_lines))
        WHERE starts_with(line, '@@') AND file <> ''"""),
    "hunk_lines": ("hunks", """
        SELECT DISTINCT repo, change_id, path,
               unnest(generate_series(start_line, start_line + greatest(line_count, 1) - 1)) AS line_no
        FROM hunks"""),
    "hunk_overlaps": ("hunks,symbols_q", """
        SELECT DISTINCT h.repo, h.change_id, h.path, s.qualified_name AS function, s.start_line, s.end_line
        FROM hunks h JOIN symbols_q s ON h.repo = s.repo AND h.path = s.path AND s.kind = 'def'
         AND h.start_line <= s.end_line AND h.start_line + greatest(h.line_count, 1) - 1 >= s.start_line"""),
}

_DEPS = {"touches": ["code_files"], "hunk_rows": ["code_files"], "code_diffs": ["hunk_rows"],
         "git_log": ["touches"], "archive_entries": ["code_files"]}


def _expand(names: list[str], out: list[str]) -> None:
    for n in names:
        if n in out:
            continue
        if n in _CTES:
            _expand(_DEPS.get(n, []), out)
        else:
            _expand(_DERIVED[n][0].split(","), out)
        out.append(n)


def with_ctes(needed: str, body: str) -> str:
    order: list[str] = []
    _expand([n for n in needed.split(",") if n], order)
    parts = []
    for n in order:
        text = _CTES[n]() if n in _CTES else _DERIVED[n][1]
        parts.append(f"{n} AS ({text})")
    return "WITH " + ",\n".join(parts) + "\n" + body
