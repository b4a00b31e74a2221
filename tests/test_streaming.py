import os

from conftest import files_df

from repolens.operators import symbols as S
from repolens.streaming import changes as SC


def test_stream_change_impact(spark, tmpdir_fresh):
    src = "class K:\n    def a(self):\n        return 1\n\n    def b(self):\n        return 2\n"
    files = files_df(spark, [("pkg/m.py", src)])
    symbols_path = os.path.join(tmpdir_fresh, "symbols")
    files_path = os.path.join(tmpdir_fresh, "files")
    S.extract_symbols(files).write.parquet(symbols_path)
    files.write.parquet(files_path)
    land = os.path.join(tmpdir_fresh, "diffs")
    diff = "diff --git a/pkg/m.py b/pkg/m.py\n--- a/pkg/m.py\n+++ b/pkg/m.py\n@@ -{0} +{0} @@\n-x\n+y\n"
    spark.createDataFrame([("r", 1, diff.format(3)), ("r", 2, diff.format(6))], SC.DIFF_SCHEMA.replace("repo string", "repo string")) \
        .write.parquet(os.path.join(land, "part1"))
    out = os.path.join(tmpdir_fresh, "out")
    q = SC.start_change_impact(spark, os.path.join(land, "part1"), symbols_path, files_path, out,
                               name="t_change_impact",
                               checkpoint_location=os.path.join(tmpdir_fresh, "stream-ckpt"))
    q.awaitTermination(120)
    rows = spark.read.parquet(out).collect()
    got = sorted((r.change_id, [f.function for f in r.affected_functions]) for r in rows)
    assert got == [(1, ["K.a"]), (2, ["K.b"])]


def test_build_tables_then_stream(spark, tmpdir_fresh):
    from repolens.plans import tables as TB
    src = "def f():\n    return 1\n"
    paths = TB.build_code_tables(files_df(spark, [("m.py", src)]), base=tmpdir_fresh)
    syms = TB.read_table(spark, "symbols", base=tmpdir_fresh)
    assert [(r.repo, r.qualified_name, r.end_line) for r in syms.collect()] == [("r", "f", 2)]
    assert set(paths) == {"files", "symbols"}
