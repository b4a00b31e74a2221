"""Symbols, outlines, function source against hand cases and CPython ast."""

import ast
import glob
import os
import sysconfig

from conftest import files_df

from repolens.operators import symbols as S

STOCK = '''from decimal import Decimal

class Stock:
    unit = "kg"

    def __init__(self, items=()):
        self.items = dict(items)

    @property
    def weight(self) -> Decimal:
        total = Decimal(0)
        for mass in self.items.values():
            total += mass
        return total

def merge(left: Stock, *others: Stock) -> Stock: return Stock({k: v for s in (left, *others) for k, v in s.items.items()})'''

NESTED = '''import os

@decorator
class Outer(Base):
    """Outer doc.

    More."""

    class Inner:
        def m(self):
            pass

    def method(self, a,
               b=1 if x else 2) -> dict[str, int]:
        def helper():
            return 1
        return helper()

    async def run(self): return 1


def free(x):  # comment
    s = """
def not_a_def():
    pass
"""
    return x

# trailing comment
'''


def _symbols(spark, items):
    return S.extract_symbols(files_df(spark, items)).orderBy("path", "start_off").collect()


def test_outline_of_a_module(spark):
    files = files_df(spark, [("stock.py", STOCK), ("flat.js", "let total = 0;\nfor (const n of [1, 2]) { total += n; }\n")])
    out = {r.path: r.outline for r in S.outline(files, S.extract_symbols(files)).collect()}
    assert out["stock.py"].split("\n") == [
        "class Stock  — lines 3-14",
        "def Stock.__init__(self, items=())  — lines 6-7",
        "def Stock.weight(self)  — lines 10-14",
        "def merge(left: Stock, *others: Stock)  — lines 16-16",
    ]
    assert out["flat.js"] == "No functions or classes found."


def test_nested_rules(spark):
    rows = _symbols(spark, [("n.py", NESTED)])
    got = [(r.kind, r.qualified_name, r.start_line, r.end_line) for r in rows]
    # spans as CPython ast reports them; helper is Outer.helper (nearest class)
    assert got == [
        ("class", "Outer", 4, 19),
        ("class", "Inner", 9, 11),
        ("def", "Inner.m", 10, 11),
        ("def", "Outer.method", 13, 17),
        ("def", "Outer.helper", 15, 16),
        ("def", "Outer.run", 19, 19),
        ("def", "free", 22, 27),
    ]
    assert got == _ast_spans(NESTED)
    by_name = {r.qualified_name: r for r in rows}
    assert by_name["Outer.method"].params == "(self, a,\n               b=1 if x else 2)"
    assert by_name["Outer.method"].return_type == "dict[str, int]"
    assert by_name["Outer"].docstring == '"""Outer doc.\n\n    More."""'
    assert by_name["free"].source.startswith("def free(x):")
    assert by_name["free"].source.endswith("return x")
    assert by_name["Outer.run"].source == "async def run(self): return 1"


def _ast_spans(src):
    tree = ast.parse(src)
    out = []

    def visit(node, cls):
        for child in ast.iter_child_nodes(node):
            if isinstance(child, (ast.FunctionDef, ast.AsyncFunctionDef)):
                out.append(("def", (cls + "." if cls else "") + child.name, child.lineno, child.end_lineno))
                visit(child, cls)
            elif isinstance(child, ast.ClassDef):
                out.append(("class", child.name, child.lineno, child.end_lineno))
                visit(child, child.name)
            else:
                visit(child, cls)

    visit(tree, None)
    return sorted(out, key=lambda t: (t[2], t[0] != "class"))


def test_against_ast_on_stdlib(spark):
    """Names, nearest-class qualification and spans equal CPython ast."""
    libdir = sysconfig.get_paths()["stdlib"]
    paths = sorted(glob.glob(os.path.join(libdir, "*.py")))[:40]
    items = []
    for p in paths:
        with open(p, encoding="utf-8") as fh:
            src = fh.read()
        if "\t" in src or "\f" in src:
            continue
        items.append((os.path.basename(p), src))
    rows = S.extract_symbols(files_df(spark, items)).collect()
    mine = {}
    for r in rows:
        mine.setdefault(r.path, []).append((r.kind, r.qualified_name if r.kind == "def" else r.name,
                                            r.start_line, r.end_line))
    checked = 0
    for name, src in items:
        expected = _ast_spans(src)
        got = sorted(mine.get(name, []), key=lambda t: (t[2], t[0] != "class"))
        assert got == expected, name
        checked += len(expected)
    assert checked > 500


def test_function_source_first_match(spark):
    src = "def f():\n    return 1\n\nclass A:\n    def f(self):\n        return 2\n"
    files = files_df(spark, [("a.py", src)])
    out = {r.qualified_name: r.source for r in S.function_source(S.extract_symbols(files)).collect()}
    assert out == {"f": "def f():\n    return 1", "A.f": "def f(self):\n        return 2"}


def test_javascript_outline(spark):
    src = """class Shape extends Base {
  constructor(a) {
    super(a);
  }
  static create(x) {
    if (x) { return new Shape(x); }
    return null;
  }
  get area() { return 0; }
}
function draw(ctx, s) {
  const f = () => { return 1; };
  const g = function named() {};
  return ctx;
}
export function util() {}
const obj = { method(a) { return a; } };
"""
    rows = _symbols(spark, [("s.js", src)])
    got = [(r.kind, r.qualified_name, r.start_line, r.end_line, r.params) for r in rows]
    assert got == [
        ("class", "Shape", 1, 10, None),
        ("def", "Shape.constructor", 2, 4, "(a)"),
        ("def", "Shape.create", 5, 8, "(x)"),
        ("def", "Shape.area", 9, 9, "()"),
        ("def", "draw", 11, 15, "(ctx, s)"),
        ("def", "util", 16, 16, "()"),
        ("def", "method", 17, 17, "(a)"),
    ]


def test_javascript_of_real_code(spark):
    """Generators, methods named by keywords, regex literals, nested templates, a class without a name."""
    src = """function* ids(from) { yield from; }
async function* pages(url) { yield url; }
class Cache {
  delete(key) { if (key) { return true; } }
  catch(error) { return error; }
  *walk() { yield 1; }
}
function clean(text) { return text.replace(/[({]/g, ""); }
function title(a) { return `x ${a ? `y ${a}` : "}"} {`; }
export default class extends Cache { go() { return 1 / 2 / 3; } }
function last() {}
"""
    got = [(r.kind, r.qualified_name, r.start_line, r.end_line) for r in _symbols(spark, [("r.js", src)])]
    assert got == [
        ("class", "Cache", 3, 7), ("def", "Cache.delete", 4, 4), ("def", "Cache.catch", 5, 5), ("def", "Cache.walk", 6, 6),
        ("def", "clean", 8, 8), ("def", "title", 9, 9), ("def", "go", 10, 10), ("def", "last", 11, 11),
    ]


def test_unbalanced_brackets_stay_local(spark):
    from repolens.operators.tokens import bracket_problems
    src = "x = foo)\n\ndef a(v):\n    return (v\n\nclass B:\n    def c(self):\n        return [1, (2]\n\ndef d(): pass\n"
    got = [(r.qualified_name, r.start_line) for r in _symbols(spark, [("b.py", src)])]
    assert got == [("a", 3), ("B", 6), ("B.c", 7), ("d", 10)]
    problems = {(r.line, r.problem) for r in bracket_problems(files_df(spark, [("b.py", src)])).collect()}
    assert problems == {(1, "unbalanced bracket"), (6, "unbalanced bracket"), (10, "unbalanced bracket")}
    assert bracket_problems(files_df(spark, [("n.py", NESTED), ("s.py", STOCK)])).count() == 0


def test_partition_count_is_the_sessions(spark):
    from repolens.operators.tokens import partition_files
    files, was = files_df(spark, [("a.py", "x = 1\n")]), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        assert partition_files(files).rdd.getNumPartitions() == 2000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_names_only_gives_one_row_for_a_long_header(spark):
    from repolens.operators.search import search_symbols
    syms = S.extract_symbols(files_df(spark, [("n.py", "def wide(a,\n         b,\n         c):\n    pass\n")]))
    assert [r.line for r in search_symbols(syms, "wide", names_only=True).collect()] == ["def wide(a,\n         b,\n         c)  — lines 1-4"]
    assert [r.line for r in search_symbols(syms, "c)").collect()] == ["         c)  — lines 1-4"]
