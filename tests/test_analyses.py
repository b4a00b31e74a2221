"""Complexity, diffs, dead code, search, project config: hand cases."""

import pytest
from conftest import files_df
from pyspark.sql import functions as F

from repolens.operators import changes as C
from repolens.operators import complexity as CX
from repolens.operators import deadcode as DC
from repolens.operators import project as PR
from repolens.operators import pyfacts as PF
from repolens.operators import search as SE
from repolens.operators import symbols as S

DECISIONS = '''def a(x):
    if x:
        pass
    elif x > 1:
        pass
    return [i for i in x if i]

def b(x, y, z):
    return x and y and z

def c(p):
    with open(p) as f:
        return f

def d(v):
    match v:
        case 1:
            return 1
        case _:
            return 2

def e(x=1 if y else 2):
    return x

def outer(x):
    for i in x:
        def inner():
            while True:
                break
    try:
        pass
    except ValueError:
        pass
'''


def _scores(spark, src):
    files = files_df(spark, [("d.py", src)])
    return {r.function: r.complexity_score for r in CX.score_complexity(S.extract_symbols(files)).collect()}


def test_decision_kinds(spark):
    # elif and comprehension parts add nothing; a and b and c adds two;
    # with and match-case add one each; a conditional default counts;
    # a nested function's decisions count for it and for its parent.
    assert _scores(spark, DECISIONS) == {"a": 2, "b": 3, "c": 2, "d": 3, "e": 2, "outer": 4, "inner": 2}


def test_decision_points_rows(spark):
    files = files_df(spark, [("d.py", DECISIONS)])
    kinds = sorted((r.line, r.kind) for r in PF.decision_points(files).collect())
    assert (2, "if_statement") in kinds and (4, "if_statement") not in kinds
    assert kinds.count((9, "boolean_operator")) == 2
    assert (22, "conditional_expression") in kinds
    assert (17, "case_clause") in kinds and (19, "case_clause") in kinds
    assert (32, "except_clause") in kinds


def test_risk_levels(spark):
    body = "def f(x):\n" + "".join(f"    if x == {i}:\n        pass\n" for i in range(11)) + "    return x\n"
    files = files_df(spark, [("r.py", body)])
    row = CX.score_complexity(S.extract_symbols(files)).collect()[0]
    assert (row.complexity_score, row.risk_level) == (12, "High")


def test_imports(spark):
    src = "import os\nimport os\nfrom __future__ import annotations\nfrom a import (b,\n    c)\ndef f():\n    import json\n"
    files = files_df(spark, [("i.py", src), ("x.js", "import x from 'y'\n")])
    rows = PF.imports(files).collect()
    assert len(rows) == 1
    assert rows[0].import_count == 3
    assert rows[0].imports == ["from a import (b,\n    c)", "import json", "import os"]


DIFF = """diff --git a/pkg/m.py b/pkg/m.py
index 1..2 100644
--- a/pkg/m.py
+++ b/pkg/m.py
@@ -1,0 +2,2 @@
+++ b/fake.py
+x = 1
@@ -9 +10,0 @@
-old
diff --git a/gone.py b/gone.py
deleted file mode 100644
--- a/gone.py
+++ /dev/null
@@ -1,3 +0,0 @@
-a
-b
-c
diff --git a/web/app.js b/web/app.js
--- a/web/app.js
+++ b/web/app.js
@@ -1 +1 @@
-a
+b
"""


def test_diff_hunks_rules(spark):
    diffs = spark.createDataFrame([("r", 1, DIFF)], "repo string, change_id int, diff string")
    hunks = sorted((r.path, r.start_line, r.line_count) for r in C.diff_hunks(diffs).collect())
    # the added body line '++ b/fake.py' is not a header; the deleted file
    # charges nothing; the .js file is skipped; ',0' still marks one line.
    assert hunks == [("pkg/m.py", 2, 2), ("pkg/m.py", 10, 0)]
    lines = sorted(r.line_no for r in C.hunk_lines(C.diff_hunks(diffs), ["repo", "change_id"]).collect())
    assert lines == [2, 3, 10]
    assert [r.path for r in C.deleted_paths(diffs).collect()] == ["gone.py"]


def test_change_impact(spark):
    src = "class K:\n    def a(self):\n        return 1\n\n    def b(self):\n        def inner():\n            return 2\n        return inner\n"
    files = files_df(spark, [("pkg/m.py", src)])
    diff = "diff --git a/pkg/m.py b/pkg/m.py\n--- a/pkg/m.py\n+++ b/pkg/m.py\n@@ -7 +7 @@\n-x\n+y\n"
    diffs = spark.createDataFrame([("r", 5, diff), ("r", 6, diff.replace("pkg/m.py", "pkg/missing.py"))],
                                  "repo string, change_id int, diff string")
    out = C.change_impact(C.diff_hunks(diffs), S.extract_symbols(files), files, ["repo", "change_id"]).collect()
    assert len(out) == 1
    row = out[0]
    assert row.modified_line_count == 1
    assert [(f.function, f.span) for f in row.affected_functions] == [("K.b", "lines 5-8"), ("K.inner", "lines 6-7")]


def test_dead_code(spark):
    a = "def used():\n    pass\n\ndef lonely():\n    pass\n\ndef __init__(self):\n    pass\n"
    b = "used()\n# lonely is mentioned in a comment? no\n"
    files = files_df(spark, [("a.py", a), ("b.py", b), ("node_modules/c.py", "def lonely2():\n    pass\n")])
    syms = S.extract_symbols(files)
    dead = sorted((r.function, r.path) for r in DC.dead_code_candidates(files, syms).collect())
    assert dead == []  # 'lonely' appears twice (definition + comment)
    files2 = files_df(spark, [("a.py", a), ("b.py", "used()\n")])
    dead2 = sorted((r.function, r.path) for r in DC.dead_code_candidates(files2, S.extract_symbols(files2)).collect())
    assert dead2 == [("lonely", "a.py")]
    assert DC.functions_scanned(files2, S.extract_symbols(files2)).collect()[0].functions_scanned == 2


def test_search_code_cap_and_pattern(spark):
    content = "\n".join(f"Match {i}  " for i in range(30)) + "\nnothing\n"
    files = files_df(spark, [("a.txt", content), ("b.bin", content), ("node_modules/c.txt", content)])
    rows = SE.search_code(files, "match").orderBy("line_no").collect()
    assert len(rows) == 20 and rows[0].match == "Line 1: Match 0" and rows[-1].line_no == 20
    with pytest.raises(ValueError):
        SE.search_code(files, "(unclosed")


def test_search_symbols(spark):
    files = files_df(spark, [("s.py", "class Alpha:\n    def beta(self):\n        pass\n"), ("e.py", "x = 1\n")])
    syms = S.extract_symbols(files)
    assert [r.line for r in SE.search_symbols(syms, "ALPHA").orderBy("line").collect()] == [
        "class Alpha  — lines 1-3", "def Alpha.beta(self)  — lines 2-3"]
    assert SE.search_symbols(syms, "func").count() == 0  # fallback text is not matched


def test_project_config(spark):
    items = [
        ("package.json", '{"dependencies": {"react": "1", "a": "1"}, "devDependencies": {"jest": "1", "a": "2"}}'),
        ("requirements.txt", "# c\nFlask==3\n\n  # note\npytest-django\n"),
        (".env.example", "# x\nA=1=2\n B = 3\nNOVALUE\n"),
        ("Dockerfile", "x"), ("manage.py", ""), (".github/workflows/ci.yml", ""),
        (".github/workflows/x.yaml", ""), ("sub/package.json", "{}"), ("next.config.js", ""),
    ]
    prof = PR.project_config(files_df(spark, items)).collect()[0]
    assert prof.frameworks == ["Django", "Flask", "Next.js", "React"]
    assert prof.npm == ["react", "a", "jest"]
    assert prof.pip == ["flask==3", "# note", "pytest-django"]
    assert prof.config_files == [".env.example", "next.config.js"]
    assert prof.build_ci == ["Dockerfile", ".github/workflows/ci.yml"]
    assert prof.env_vars_expected == ["A", "B"]
    assert prof.dependencies == {"npm": ["react", "a", "jest"], "pip": ["flask==3", "# note", "pytest-django"]}


def test_project_config_bad_json(spark):
    prof = PR.project_config(files_df(spark, [("package.json", "{not json")])).collect()[0]
    assert prof.npm is None and prof.dependencies == {}


def test_search_scope_inside_skipped_dir(spark):
    files = files_df(spark, [("node_modules/pkg/a.js", "hit\n"), ("node_modules/pkg/node_modules/b.js", "hit\n"),
                             ("src/c.js", "hit\n")])
    assert [r.path for r in SE.search_code(files, "hit").collect()] == ["src/c.js"]
    scoped = sorted(r.path for r in SE.search_code(files, "hit", prefix="node_modules/pkg").collect())
    assert scoped == ["node_modules/pkg/a.js"]


def test_project_config_utf16_manifest(spark):
    raw = b"\xff\xfe" + "Django==5\n".encode("utf-16-le")
    df = spark.createDataFrame([("r", "requirements.txt", raw)], "repo string, path string, raw binary")
    prof = PR.project_config(df).collect()[0]
    assert prof.frameworks == ["Django"] and prof.pip == ["django==5"]


def test_unreadable_hunk_headers(spark):
    diff = ("diff --git a/m.py b/m.py\n--- a/m.py\n+++ b/m.py\n"
            "@@ -1 +x,y @@\n+a\n@@ -1 +3abc @@\n+b\n@@ -1 +7,2 @@\n+c\n+d\n")
    diffs = spark.createDataFrame([("r", 1, diff)], "repo string, change_id int, diff string")
    assert [(r.start_line, r.line_count) for r in C.diff_hunks(diffs).collect()] == [(7, 2)]
    assert sorted(r.header for r in C.diff_problems(diffs).collect()) == ["@@ -1 +3abc @@", "@@ -1 +x,y @@"]


def test_search_symbols_names_only_and_future_imports(spark):
    files = files_df(spark, [("s.py", "class Alpha:\n    def beta(self, lines):\n        pass\n")])
    syms = S.extract_symbols(files)
    assert SE.search_symbols(syms, "lines").count() == 2            # rendered lines match 'lines'
    assert SE.search_symbols(syms, "lines", names_only=True).count() == 0
    assert [r.line for r in SE.search_symbols(syms, "beta", names_only=True).collect()] == [
        "def Alpha.beta(self, lines)  — lines 2-3"]
    src = files_df(spark, [("f.py", "from __future__ import annotations\nimport os\n")])
    assert [r.stmt for r in PF.import_statements(src).collect()] == ["import os"]
    assert len(PF.import_statements(src, include_future=True).collect()) == 2


def test_imports_inside_lines(spark):
    """After a semicolon or a header's colon; text up to the next semicolon."""
    src = ("import os; import sys\ntry: import json\nexcept ImportError: import simplejson as json\n"
           "if 1: from a import b\nx = 1; from c import (d,  # why\n   e)\nraise E from e\ny = {1: 2}\n")
    got = [(r.line, r.stmt) for r in PF.import_statements(files_df(spark, [("i.py", src)])).orderBy("line", "stmt").collect()]
    assert got == [(1, "import os"), (1, "import sys"), (2, "import json"), (3, "import simplejson as json"), (4, "from a import b"),
                   (5, "from c import (d,  # why\n   e)")]


def test_imports_against_ast(spark):
    import ast
    import glob
    import os
    import sysconfig
    items, want = [], []
    for p in sorted(glob.glob(os.path.join(sysconfig.get_paths()["stdlib"], "*.py")))[40:80]:
        with open(p, encoding="utf-8") as fh:
            src = fh.read()
        name = os.path.basename(p)
        items.append((name, src))
        want += [(name, n.lineno, ast.get_source_segment(src, n)) for n in ast.walk(ast.parse(src)) if isinstance(n, (ast.Import, ast.ImportFrom))]
    got = PF.import_statements(files_df(spark, items), include_future=True).collect()
    assert sorted((r.path, r.line, r.stmt) for r in got) == sorted(want) and len(want) > 200


def test_line_ends_inside_diff_lines(spark):
    """A lone CR or a Unicode line end inside an added line starts no line."""
    diff = ("diff --git a/m.py b/m.py\n--- a/m.py\n+++ b/m.py\n@@ -1 +7,2 @@\n+a\r@@ -1 +99,3 @@\n+b @@ -1 +98 @@\n"
            "++ b/x\n@@ -1 +5,99999999999 @@\n@@ -1 +4000000000 @@\n")
    diffs = spark.createDataFrame([("r", 1, diff)], "repo string, change_id int, diff string")
    hunks = C.diff_hunks(diffs)
    assert [(r.start_line, r.line_count) for r in hunks.collect()] == [(7, 2)]
    assert C.diff_problems(diffs).count() == 2
    wide = spark.createDataFrame([("r", 1, "m.py", 1, 2_000_000_000), ("r", 1, "m.py", 5, 10)], "repo string, change_id int, path string, start_line long, line_count long")
    assert [r.modified_line_count for r in C.modified_line_count(wide, ["repo", "change_id"]).collect()] == [2_000_000_000]


def test_patterns_are_the_jvms(spark):
    files = files_df(spark, [("a.py", "alpha\nbeta\n")])
    for pattern in ("(?<n>alp)ha", "(?P<n>alp)ha"):
        assert [r.line_no for r in SE.search_code(files, pattern).collect()] == [1]
    with pytest.raises(ValueError):
        SE.search_code(files, "(alpha")
    assert [(r.matches, r.kept) for r in SE.match_counts(files_df(spark, [("b.py", "x\n" * 30), ("c.py", "y")]), "x").collect()] == [(30, 20)]


def test_unpaired_surrogates_fall_back(spark):
    from repolens.functions.text import decode_text
    good, bad = "a\U0001f642b".encode("utf-16"), b"\xff\xfe" + b"\x00\xd8a\x00"
    big = b"\xfe\xff" + "a\U0001f642b".encode("utf-16-be")
    df = spark.createDataFrame([(1, bytearray(good)), (2, bytearray(bad)), (3, bytearray(big)), (4, bytearray(b"\xff\xfe"))], "k int, raw binary")
    got = [r.t for r in df.select("k", decode_text(df.raw).alias("t")).orderBy("k").collect()]
    assert [got[0], got[2], got[3]] == ["a\U0001f642b", "a\U0001f642b", ""] and "�" in got[1]


def test_package_problems(spark):
    cases = {"ok": '{"dependencies": {"a": "1"}, "devDependencies": {"b": "1", "a": "2"}}', "tail": '{"dependencies": {"a": "1"}} x', "list": '{"dependencies": ["x"]}', "array": "[1]", "none": "{}"}
    files = spark.createDataFrame([(r, "package.json", c) for r, c in cases.items()], "repo string, path string, content string")
    got = {r.repo: (r.npm, r.problem) for r in PR.project_config(files).collect()}
    assert got == {"ok": (["a", "b"], None), "none": ([], None), "tail": (None, "not a JSON object"), "array": (None, "not a JSON object"),
                   "list": (None, "dependencies are not an object")}


def test_ranks_within_files(spark):
    scores = spark.createDataFrame([("r", "a.py", "f", 1, 2), ("r", "a.py", "g", 5, 9), ("r", "b.py", "h", 1, 1), ("r", "a.py", "i", 9, 2)], "repo string, path string, function string, line long, complexity_score long")
    assert {r.function: r.rank_in_file for r in CX.sort_complexity(scores).collect()} == {"g": 1, "f": 2, "i": 3, "h": 1}


def test_unknown_names_and_folders_have_a_text(spark):
    from repolens.sources.files import read_path
    files = files_df(spark, [("a.py", "def f():\n    return 1\n"), ("pkg/b.py", "x = 1\n"), ("n.md", "text")])
    got = {r.path: r.source for r in S.function_source(S.extract_symbols(files), "f", files).collect()}
    assert got == {"a.py": "def f():\n    return 1", "pkg/b.py": "Error: no function named 'f' found in 'pkg/b.py'."}
    raw = files.select("repo", "path", F.encode("content", "UTF-8").alias("raw"))
    one = lambda p: read_path(raw, "r", p).collect()[0].result
    assert (one("n.md"), one("pkg"), one("none")) == ("text", "Error: 'pkg' is not a file.", "Error: file not found at 'none'.")


def test_impact_report_names_problems(spark):
    files = files_df(spark, [("m.py", "def f():\n    return 1\n")])
    diff = "diff --git a/m.py b/m.py\n--- a/m.py\n+++ b/m.py\n@@ -1 +2 @@\n-x\n+y\n@@ -1 +x,y @@\n"
    diffs = spark.createDataFrame([("r", 1, diff)], "repo string, change_id int, diff string")
    rows = C.impact_report(diffs, S.extract_symbols(files), files, ["repo", "change_id"]).orderBy("modified_line_count").collect()
    assert [(r.modified_line_count, r.problem) for r in rows] == [(None, "unreadable hunk range: @@ -1 +x,y @@"), (1, None)]


def test_only_names_are_counted(spark):
    """The filter lets every name through, and of a thousand other words a few at most."""
    from repolens.operators import deadcode as DC
    words = " ".join(f"word{k}" for k in range(1000))
    files = files_df(spark, [("a.py", f"{words} lonely twice twice naïve"), ("b.py", "once"), ("c.txt", "lonely")])
    names = spark.createDataFrame([("r", n, "a.py") for n in ("lonely", "twice", "naïve", "absent")], "repo string, name string, path string")
    counted = {r.name: r.n for r in DC.mentions(files.where("path LIKE '%.py'"), names).collect()}
    assert {n: counted.get(n) for n in ("lonely", "twice", "naïve", "absent")} == {"lonely": 1, "twice": 2, "naïve": 1, "absent": None} and len(counted) < 10
    assert sorted((r.name, r.n) for r in DC.name_mentions(files, names).collect()) == [("lonely", 1), ("naïve", 1), ("twice", 2)]
    none = names.where("false")
    assert DC.name_mentions(files, none).collect() == []
