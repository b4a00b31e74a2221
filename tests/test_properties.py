"""Property tests: complexity vs CPython ast, diff parsing vs a line state machine."""

import ast
import glob
import os
import sysconfig

from conftest import files_df
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from repolens.operators import changes as C
from repolens.operators import complexity as CX
from repolens.operators import intervals as I
from repolens.operators import symbols as S


def _ast_complexity(src):
    """1 + decisions per function with the grammar's node kinds: if (not elif),
    for, while, except, with, case, boolean operator (one per extra operand),
    conditional expression; comprehension clauses add nothing; a nested
    function's decisions count for every function around it."""
    tree = ast.parse(src)
    lines = src.split("\n")

    def is_elif(node):
        return lines[node.lineno - 1][node.col_offset:].startswith("elif")

    def decisions(node):
        n = 0
        for sub in ast.walk(node):
            if isinstance(sub, ast.If) and not is_elif(sub):
                n += 1
            elif isinstance(sub, (ast.For, ast.AsyncFor, ast.While, ast.ExceptHandler,
                                  ast.With, ast.AsyncWith, ast.match_case, ast.IfExp)):
                n += 1
            elif isinstance(sub, ast.BoolOp):
                n += len(sub.values) - 1
        return n

    out = {}
    for node in ast.walk(tree):
        if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef)):
            decorators = sum(decisions(d) for d in node.decorator_list)
            out[node.lineno] = 1 + decisions(node) - decorators
    return out


def test_complexity_against_ast(spark):
    libdir = sysconfig.get_paths()["stdlib"]
    paths = sorted(glob.glob(os.path.join(libdir, "*.py")))[40:70]
    items = []
    for p in paths:
        with open(p, encoding="utf-8") as fh:
            src = fh.read()
        if "\t" not in src and "\f" not in src:
            items.append((os.path.basename(p), src))
    rows = CX.score_complexity(S.python_spans(files_df(spark, items))).collect()
    mine = {(r.path, r.line): r.complexity_score for r in rows}
    total = agree = 0
    for name, src in items:
        for line, score in _ast_complexity(src).items():
            total += 1
            agree += mine.get((name, line)) == score
    assert total > 300
    assert agree == total, f"{agree}/{total}"


def _reference_hunks(diff, suffix=".py"):
    """Line state machine with the documented rules: a file section starts at
    'diff --git'; its name is the '+++ b/' line before the first '@@';
    '/dev/null' and other suffixes charge nothing; body lines never set names."""
    out, current, in_header = [], None, False
    for line in diff.split("\n"):
        if line.startswith("diff --git "):
            current, in_header = None, True
        elif in_header and line.startswith("+++ "):
            name = line[4:].strip()
            current = name[2:].strip() if name.startswith("b/") and name.endswith(suffix) else None
        elif line.startswith("@@"):
            in_header = False
            parts = line.split(" ")
            if current and len(parts) > 2 and parts[2].startswith("+"):
                start, _, count = parts[2][1:].partition(",")
                out.append((current, int(start), int(count) if count else 1))
    return sorted(out)


name_st = st.sampled_from(["a.py", "pkg/b.py", "c.js", "d.py", "e.txt"])
hunk_st = st.tuples(st.integers(0, 50), st.integers(0, 4), st.integers(0, 3), st.booleans())


def _render(files):
    text = []
    for name, deleted, hunks in files:
        text += [f"diff --git a/{name} b/{name}", f"--- a/{name}", "+++ /dev/null" if deleted else f"+++ b/{name}"]
        for start, count, old, fake_header in hunks:
            cnt = "" if count == 1 else f",{count}"
            text.append(f"@@ -1,{old} +{start}{cnt} @@")
            text += ["-old"] * old
            body = [f"+line{i}" for i in range(count)]
            if fake_header and body:
                body[0] = "+++ b/evil.py"
            text += body
    return "\n".join(text) + "\n"


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(name_st, st.booleans(), st.lists(hunk_st, max_size=3)), max_size=4))
def test_diff_hunks_match_state_machine(spark, files):
    diff = _render(files)
    df = spark.createDataFrame([("r", 1, diff)], "repo string, change_id int, diff string")
    got = sorted((r.path, r.start_line, r.line_count) for r in C.diff_hunks(df).collect())
    assert got == _reference_hunks(diff)


def test_fstring_decisions_against_ast(spark):
    """Decisions in replacement fields: nested strings and f-strings, format
    specifications, doubled braces, the string's own quotes inside."""
    bodies = [
        'f"{a if b else c}"', "f'{a and b}' f'{c or d or a}'", 'f"{{a and b}} {a}"', 'f"{{{a or b}}}"', "f'{a:{b or c}}'", "f'{a!r:>{10 if b else c}} and else'",
        'f"{d["k"] or d["l"]}"', "f'{a + f'{b and c}'}'", "f\"{f'{f'{a or b}'}'}\"", 'f"{", ".join(x for x in a if x or b)}"', 'f"{ {1: a or b}[1] }"', 'f"{(lambda: a or b)()}"',
        'f"{a != b and c}"', 'rf"\\d{a or b}"', 'F"{a}" "b and c"', 'f"{\'x and y\'}"', 'f"\\N{EM DASH} {a or b}"', 'f"""{a and\n  b}\n{c or "}"}"""', "f'''{a if b else '''x'''}'''",
        '"{a and b}"', 'f"{a}" if b else c', 'f"{x:{y}}" and b', 'f"{a[1:2] or b}"', 'f"{a}}}{{ or {b or c}"', 'f""', "f'{a=} {b or c=}'"]
    src = "".join(f"def f{i}(a, b, c, d, x, y):\n    return {body}\n\n" for i, body in enumerate(bodies))
    got = {r.function: r.complexity_score for r in CX.score_complexity(S.python_spans(files_df(spark, [("m.py", src)]))).collect()}
    tree = ast.parse(src)
    for i, (node, body) in enumerate(zip(tree.body, bodies, strict=True)):
        n = sum(len(x.values) - 1 if isinstance(x, ast.BoolOp) else isinstance(x, ast.IfExp) for x in ast.walk(node))
        assert got[f"f{i}"] == 1 + n, body


def test_sections_with_a_preamble_and_quoted_headers(spark):
    diff = ("note\ndiff --git a/x.py b/x.py\n--- a/x.py\n+++ b/x.py \n@@ -1 +3,2 @@\n+diff --git a/no b/no\n diff --git a/no b/no\n+++ b/no.py\n"
            "diff --git a/y.py b/y.py\n--- a/y.py\n+++ /dev/null\n@@ -1 +0,0 @@")
    sections = C.diff_sections(spark.createDataFrame([(1, diff), (2, "diff --git a/z.py b/z.py\n--- a/z.py\n+++ b/z.py\n"), (3, None), (4, "")], "id int, diff string"))
    found = sorted((r.id, r.section_no, r.path, r.old_path, r.deleted, r.starts, r.counts) for r in sections.where("path IS NOT NULL OR deleted").collect())
    assert found == [(1, 1, "x.py", "x.py", False, ["3"], ["2"]), (1, 2, None, "y.py", True, ["0"], ["0"]), (2, 0, "z.py", "z.py", False, [], [])]
    names = sections.where("path IS NOT NULL")._jdf.queryExecution().optimizedPlan().toString()
    assert names.count("regexp_extract(") == 2  # a filter on the names doesn't search the text again


def test_keys_of_ranges_are_numbers_exploded_by_compiled_code(spark):
    ranges = spark.createDataFrame([(1, 5), (10, 700), (3, 2_000_000_000)], "a bigint, b bigint")
    keyed = I._keyed(ranges, "a", "b", 64, 0)
    assert dict(keyed.dtypes)["_key"] == "bigint"
    keys = {r.a: r.n for r in keyed.groupBy("a").agg(F.count_distinct("_key").alias("n")).collect()}
    assert keys[1] == 8 and keys[10] == 7 + 11 and keys[3] < 7 + 210
