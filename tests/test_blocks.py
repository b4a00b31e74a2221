"""Files in blocks, overlap joins and range sweeps against plain versions."""

import random

from conftest import files_df
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from repolens.operators import changes as C
from repolens.operators import intervals as I
from repolens.operators import symbols as S
from repolens.operators import tokens as T

PIECES = ["x = 1\n", "def f(a, b='#'):\n    return a\n", '"""doc\nmore \'\'\' text\n"""\n', "'''one\n\n\"\"\"two\n'''\n", "s = 'a\\\nb'  # it's\n", "t = \"# no\"\n", "# \"\"\" comment\n",
          "y = (1,\n  2)\n", "u = r'''\\'''\n", "v = '''a\\'''b\n'''\n", "w = 1 + \\\n  2\n", "class K:\n    def m(self): pass\n", "z = ''\n", "q = f'''{x}\n'''\n"]
JS_PIECES = ["let x = 1;\n", "/* a\n ' ` */\n", "const t = `a ${b}\n c`;\n", "s = 'it';\n", "// don't `\n", "r = /['`]/;\n", "u = `${`in\n${ {a: 1}.a }`} \n`;\n", "function f(a) {\n  return a / 2 / 3;\n}\n", "v = \"`\";\n", "w = [1] / 2;\n"]


def tokens_of(spark, text, lang, block):
    path = "m.py" if lang == "python" else "m.js"
    rows = T.tokenize(files_df(spark, [(path, text)]), lang, block=block).orderBy("pos").collect()
    return [(r.tok, r.off, r.line, r.dpt, r.nlc, r.sig) for r in rows], {r.pos >> 32 for r in rows}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(PIECES), min_size=3, max_size=25), st.integers(5, 60))
def test_python_blocks_give_the_file_s_tokens(spark, pieces, block):
    text = "".join(pieces)
    whole, one = tokens_of(spark, text, "python", 1 << 20)
    assert one == {0} and tokens_of(spark, text, "python", block)[0] == whole


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(JS_PIECES), min_size=3, max_size=25), st.integers(5, 60))
def test_javascript_blocks_give_the_file_s_tokens(spark, pieces, block):
    text = "".join(pieces)
    whole, _ = tokens_of(spark, text, "javascript", 1 << 20)
    assert tokens_of(spark, text, "javascript", block)[0] == whole


def test_large_file_is_many_blocks(spark):
    text = "".join(f"def f{k}(a):\n    '''doc {k}\n    more'''\n    if a and {k}:\n        return a\n" for k in range(6000))
    whole, used = tokens_of(spark, text, "python", T.X.BLOCK)
    assert len(text) > 4 * T.X.BLOCK and len(used) >= 4 and whole == tokens_of(spark, text, "python", len(text))[0]
    spans = S.python_spans(files_df(spark, [("m.py", text)])).orderBy("start_pos").collect()
    assert [(r.name, r.start_line, r.complexity) for r in spans] == [(f"f{k}", 1 + 5 * k, 3) for k in range(6000)]


def brute_overlaps(left, right):
    return sorted((i, j) for i, (a, b) in enumerate(left) for j, (c, d) in enumerate(right) if a <= d and c <= b)


def overlaps(spark, left, right, how="inner"):
    rows = lambda some, n: spark.createDataFrame([("k", i, a, b) for i, (a, b) in enumerate(some)], f"k string, {n} int, {n}_lo long, {n}_hi long")
    out = I.overlap_join(rows(left, "l"), rows(right, "r"), ["k"], ("l_lo", "l_hi"), ("r_lo", "r_hi"), how=how)
    return out.select("l", "r").collect()


RANGE = st.tuples(st.integers(0, 3000), st.one_of(st.integers(0, 200), st.integers(0, 3000), st.just((1 << 31) - 4000))).map(lambda x: (x[0], x[0] + x[1]))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(RANGE, min_size=1, max_size=25), st.lists(RANGE, min_size=1, max_size=25))
def test_overlap_join(spark, left, right):
    expect = brute_overlaps(left, right)
    assert sorted(map(tuple, overlaps(spark, left, right))) == expect
    rows = overlaps(spark, left, right, "left")
    assert sorted(tuple(r) for r in rows if r.r is not None) == expect and {r.l for r in rows} == set(range(len(left)))


def test_nodes_of_a_huge_range_are_few(spark):
    rng = random.Random(1)
    ranges = [(0, (1 << 31) - 1), (1, 2_000_000_000), *[(a, rng.randrange(a, 1 << 31)) for a in (rng.randrange(1 << 31) for _ in range(50))]]
    df = spark.createDataFrame(ranges, "lo long, hi long")
    for r in I._keyed(df, "lo", "hi", 64, 0).where("_key.side = 1").groupBy("lo", "hi").count().collect():
        assert r["count"] <= 2 * ((1 << I.FAN_BITS) - 1) * I.LEVELS


def test_range_sweep_and_lines(spark):
    spans = [(1, 3), (2, 0), (4, 2), (9, 1), (8, 1), (20, 70_000), (100, 5), (200_000, 1)]
    hunks = spark.createDataFrame([("r", 1, "a.py", a, n) for a, n in spans] + [("r", 2, "a.py", 7, 2_000_000_000)], "repo string, change_id int, path string, start_line long, line_count long")
    merged = sorted((r.change_id, r.start_line, r.end_line) for r in C.line_set_union(hunks, ["repo", "change_id"]).collect())
    assert merged == [(1, 1, 5), (1, 8, 9), (1, 20, 70_019), (1, 200_000, 200_000), (2, 7, 2_000_000_006)]
    lines = [r.line_no for r in C.hunk_lines(hunks.where("change_id = 1"), ["repo", "change_id"]).collect()]
    assert sorted(lines) == sorted({x for a, n in spans for x in range(a, a + max(1, n))})
    counts = {r.change_id: r.modified_line_count for r in C.modified_line_count(hunks, ["repo", "change_id"]).collect()}
    assert counts == {1: len(lines), 2: 2_000_000_000}
    assert [r.line_no for r in C.hunk_lines(hunks.where("change_id = 2"), ["repo", "change_id"]).limit(2).collect()] == [7, 8]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("kmn"), st.lists(RANGE, min_size=1, max_size=4)), min_size=1, max_size=12), st.lists(st.tuples(st.sampled_from("km"), RANGE), max_size=20), st.sampled_from([0, 4, 1024]))
def test_overlap_hits_by_arrays_and_by_the_tree(spark, left, right, most):
    rows = spark.createDataFrame([(k, i, some) for i, (k, some) in enumerate(left)], "k string, i int, some array<struct<lo:long,hi:long>>")
    spans = spark.createDataFrame([(k, j, a, b) for j, (k, (a, b)) in enumerate(right)], "k string, j int, a long, b long")
    expect = {i: sorted(j for j, (m, (a, b)) in enumerate(right) if m == k and any(lo <= b and a <= hi for lo, hi in some)) for i, (k, some) in enumerate(left)}
    out = I.overlap_hits(rows, spans, ["k"], "some", ("a", "b"), most=most).collect()
    known = {k for k, _ in right}
    assert len({r.i for r in out}) == len(out) and {r.i: [x.j for x in r.hits] for r in out} == {i: hits for i, hits in expect.items() if left[i][0] in known}
    among = spark.createDataFrame([("k",), ("n",), ("n",), ("z",)], "k string")
    out = I.overlap_hits(rows, spans, ["k"], "some", ("a", "b"), among, most).collect()
    assert len({r.i for r in out}) == len(out) and {r.i: [x.j for x in r.hits] for r in out} == {i: hits for i, hits in expect.items() if left[i][0] in "kn"}


def shuffled_rows(df):
    """Rows that the run plan's shuffles wrote, a shuffle read twice counted once."""
    df.collect()
    seen, todo, rows = set(), [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name != "ReusedExchangeExec":
            if name == "ShuffleExchangeExec" and node.id() not in seen:
                seen.add(node.id())
                rows += node.metrics().apply("shuffleRecordsWritten").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return rows


def changed(spark):
    """Hunks of one file per change, most of them huge; functions of the file."""
    hunks = spark.createDataFrame([("r", c, "a.py", 1 + c % 7, 2_000_000_000 if c % 3 else 1) for c in range(300)], "repo string, change_id int, path string, start_line long, line_count long")
    symbols = spark.createDataFrame([("r", "a.py", "def", f"f{k}", 1 + 3 * k, 3 + 3 * k, k) for k in range(10)], "repo string, path string, kind string, qualified_name string, start_line int, end_line int, start_off long")
    return hunks, symbols


def test_impact_of_huge_hunks_shuffles_a_change_as_one_row(spark):
    hunks, symbols = changed(spark)
    impact = C.change_impact(hunks, symbols, symbols.select("repo", "path").distinct(), ["repo", "change_id"])
    assert {(r.change_id, r.n_affected) for r in impact.collect()} == {(c, 10 - c % 7 // 3 if c % 3 else 1) for c in range(300)}
    assert shuffled_rows(impact) <= 2 * 300 + 100


def test_overlap_of_huge_hunks_shuffles_a_change_as_one_row(spark):
    hunks, symbols = changed(spark)
    overlap = C.hunk_symbol_overlap(hunks, symbols, ["repo", "change_id"])
    assert overlap.count() == overlap.distinct().count() == sum(10 - c % 7 // 3 if c % 3 else 1 for c in range(300))
    assert shuffled_rows(overlap) <= 2 * 300 + 100
