"""Symbols kept by content against symbols computed anew."""

import os
import tempfile

from conftest import files_df

from repolens.operators import symbols as S
from repolens.operators.jssymbols import js_symbols
from repolens.plans import symbol_store as ST

A = "class K:\n    def m(self, a: int) -> str:\n        '''Doc é.'''\n        return a or 'x'\n\ndef f(): \"One.\"; return 1\n"
B = "function g(a) {\n  return a;\n}\n"


def rows(df):
    return sorted([tuple(r[c] for c in ["repo", "path", *ST.COLUMNS]) for r in df.collect()], key=str)


def test_only_new_texts_are_tokenized(spark):
    base = tempfile.mkdtemp(prefix="repolens-store-")
    files = files_df(spark, [("a.py", A), ("b.js", B), ("c.txt", "x"), ("same.py", A), ("empty.py", "")])
    files = files.unionByName(files_df(spark, [("vendored/a.py", A)], "other"))
    assert rows(ST.stored_symbols(files, base)) == rows(S.extract_symbols(files))
    contents = lambda: ST._contents(spark, ST.store_path(spark, base)).collect()
    assert len(contents()) == 3  # A, B and the empty text
    assert ST.add_missing(files, base) == 0
    changed = files_df(spark, [("a.py", A + "\ndef h(): pass\n"), ("b.js", B), ("renamed.py", A)])
    assert ST.add_missing(changed, base) == 1
    assert rows(ST.stored_symbols(changed, base)) == rows(S.extract_symbols(changed))
    assert rows(ST.stored_symbols(files, base)) == rows(S.extract_symbols(files))


def test_one_text_in_two_languages_and_unfinished_batches(spark):
    base = tempfile.mkdtemp(prefix="repolens-store-")
    files = files_df(spark, [("a.py", B), ("a.js", B)])
    assert {r[2] for r in rows(ST.stored_symbols(files, base))} == {"javascript"}
    # a batch without contents is what a lost job leaves behind
    S.extract_symbols(files).selectExpr("'lost' AS content_key", "* EXCEPT (repo, path)", "'blost' AS batch").write.parquet(f"{ST.store_path(spark, base)}/symbols/blost")
    assert rows(ST.stored_symbols(files, base)) == rows(S.extract_symbols(files))
    assert rows(ST.stored_symbols(files.where("false"), tempfile.mkdtemp(prefix="repolens-store-"))) == []


def test_docstrings_and_slices(spark):
    found = {r.qualified_name: r for r in S.extract_symbols(files_df(spark, [("a.py", A), ("u.py", "é = '日本'\n" + A)])).where("path = 'u.py'").collect()}
    assert found["K.m"].docstring == "'''Doc é.'''" and found["K.m"].params == "(self, a: int)" and found["K.m"].return_type == "str"
    assert found["f"].docstring == '"One."' and found["f"].source == 'def f(): "One."; return 1'
    src = 'def a(): "x" + y\ndef b(x={1: "s"}): "d"\ndef c(): return "s"\ndef d(x: "t"): pass\ndef e(): "x" "y"\ndef g() -> "r": \'z\'\n'
    docs = {r.name: r.docstring for r in S.extract_symbols(files_df(spark, [("d.py", src)])).collect()}
    assert docs == {"a": None, "b": '"d"', "c": None, "d": None, "e": None, "g": "'z'"}


def test_tasks_hold_a_bounded_number_of_characters(spark, monkeypatch):
    monkeypatch.setattr(ST, "TASK_CHARS", 200)
    base = tempfile.mkdtemp(prefix="repolens-store-")
    files = files_df(spark, [(f"f{i}.py", f"def f{i}(x):\n    return {i} or x\n") for i in range(120)])
    assert rows(ST.stored_symbols(files, base)) == rows(S.extract_symbols(files))
    written = [f for _, _, names in os.walk(ST.store_path(spark, base).removeprefix("file:")) for f in names if f.endswith(".parquet")]
    assert len(written) > 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_generated_methods_are_compiled(spark):
    """The JVM interprets methods of more than 8000 bytes, many times slower."""
    files = files_df(spark, [("a.py", A), ("b.js", B)])
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for found in (js_symbols(files), S.python_symbols(files)):
            stages = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(found._jdf.queryExecution().executedPlan())
            assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_content_keys_are_bytes(spark, tmpdir_fresh):
    ST.add_missing(files_df(spark, [("a.py", "def f(): pass\n")]), tmpdir_fresh)
    assert [len(r.content_key) for r in ST._contents(spark, ST.store_path(spark, tmpdir_fresh)).collect()] == [32]
