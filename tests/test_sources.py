"""File tree reader, decoding, archives, coordinates, git log."""

import os
import zipfile

from pyspark.sql import functions as F

from repolens.functions import text as X
from repolens.operators import churn as CH
from repolens.sources import archives as AR
from repolens.sources import files as FS
from repolens.sources import fixtures as fx


def _write(root, rel, data: bytes):
    full = os.path.join(root, rel)
    os.makedirs(os.path.dirname(full), exist_ok=True)
    with open(full, "wb") as fh:
        fh.write(data)


def test_scan_files_keeps_hidden_and_prunes(spark, tmpdir_fresh):
    repo = os.path.join(tmpdir_fresh, "proj")
    for rel in ["pkg/__init__.py", ".env.example", ".github/workflows/ci.yml", "node_modules/x.js",
                "a/b/.venv/lib.py", "a/b/c.py", "README.md"]:
        _write(repo, rel, b"x = 1\n")
    rows = FS.scan_files(spark, tmpdir_fresh).select("repo", "path", "size").collect()
    got = sorted((r.repo, r.path) for r in rows)
    assert got == [("proj", ".env.example"), ("proj", ".github/workflows/ci.yml"), ("proj", "README.md"),
                   ("proj", "a/b/c.py"), ("proj", "pkg/__init__.py")]


def test_scan_outline_kinds(spark):
    files = spark.createDataFrame([("r", "a.py", "def f():\n    pass\n"), ("r", ".py", ""), ("r", "n.md", "x")],
                                  "repo string, path string, content string")
    from repolens.operators import symbols as S
    out = {r.path: (r.kind, r.outline) for r in FS.scan_outline(files, S.outline(files, S.extract_symbols(files))).collect()}
    assert out == {"a.py": ("source", "def f()  — lines 1-2"),
                   ".py": ("source", "Error: Unsupported file type ''."),
                   "n.md": ("other", None)}


def test_decode_text_and_strict_read(spark):
    text = "héllo\nwörld"
    rows = [("le", b"\xff\xfe" + text.encode("utf-16-le")), ("be", b"\xfe\xff" + text.encode("utf-16-be")),
            ("u8", text.encode()), ("bad", text.encode() + b"\xff"), ("odd", b"\xff\xfeab\x00")]
    df = spark.createDataFrame(rows, "k string, raw binary")
    out = {r.k: r.t for r in df.select("k", X.decode_text(F.col("raw")).alias("t")).collect()}
    assert out["le"] == text and out["be"] == text and out["u8"] == text
    assert out["bad"] == text + "�"
    assert out["odd"] == b"\xff\xfeab\x00".decode("utf-8", errors="replace")
    strict = {r.k: (r.text, r.problem) for r in FS.read_file(df).collect()}
    assert strict["u8"] == (text, None) and strict["bad"][0] is None and strict["bad"][1]


def test_read_path_missing(spark):
    files = spark.createDataFrame([("r", "a.py", b"x")], "repo string, path string, raw binary")
    assert FS.read_path(files, "r", "a.py").collect()[0].result == "x"
    assert FS.read_path(files, "r", "b.py").collect()[0].result == "Error: file not found at 'b.py'."


def test_coordinates(spark):
    rows = [("octo", "proj", "main"), ("oc/to", "p", "main"), ("o", "p\n", "main"),
            ("o", "p", "feature/x"), ("o", "p", "a/../b"), ("o", "p", "dev\n")]
    df = spark.createDataFrame(rows, "owner string, repo string, branch string")
    got = [(r.problem, r.local_path) for r in AR.validate_coordinates(df).collect()]
    assert got == [(None, "repos/proj-main"), ("Invalid owner or repo name.", None),
                   ("Invalid owner or repo name.", None), (None, "repos/p-feature/x"),
                   ("Invalid branch name.", None), ("Invalid branch name.", None)]


def test_containment_rule(spark):
    names = ["a/b.py", "../x", "/etc/passwd", "a/../../x", "a/../b", "./c", "a//b"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: r.e for r in df.select("name", AR.escapes_root(F.col("name")).alias("e")).collect()}
    assert got == {"a/b.py": False, "../x": True, "/etc/passwd": True, "a/../../x": True,
                   "a/../b": False, "./c": False, "a//b": False}


def _zip(path, entries):
    with zipfile.ZipFile(path, "w") as z:
        for name, data in entries:
            z.writestr(name, data)


def test_ingest_archive(spark, tmpdir_fresh):
    land = os.path.join(tmpdir_fresh, "land")
    os.makedirs(land)
    _zip(os.path.join(land, "good.zip"), [("proj-main/a.py", "def f():\n    pass\n"), ("proj-main/README.md", "hi")])
    _zip(os.path.join(land, "evil.zip"), [("evil-main/ok.py", "x"), ("../escape.py", "x")])
    _zip(os.path.join(land, "many.zip"), [(f"many-main/f{i}.py", "") for i in range(AR.MAX_MEMBERS + 1)])
    with open(os.path.join(land, "text.zip"), "w") as out:
        out.write("this is no archive")
    index = spark.createDataFrame(
        [("file:" + os.path.join(land, "good.zip"), "octo", "proj", "main"),
         ("file:" + os.path.join(land, "text.zip"), "octo", "text", "main"),
         ("file:" + os.path.join(land, "evil.zip"), "octo", "evil", "main"),
         ("file:" + os.path.join(land, "many.zip"), "octo", "many", "main")],
        "archive string, owner string, repo string, branch string")
    files, verdict = AR.ingest_archive(spark, os.path.join(land, "*.zip"), index)
    v = {r.repo: (r.status, r.problem) for r in verdict.collect()}
    assert v["proj"] == ("success", None)
    assert v["text"][0] == "error" and v["text"][1].startswith("Not a readable zip archive.")
    assert v["evil"] == ("error", "Refused archive: entry '../escape.py' resolves outside 'repos/'.")
    assert v["many"] == ("error", f"Archive contains more than {AR.MAX_MEMBERS} entries.")
    got = sorted((r.repo, r.path, r.content) for r in files.select("repo", "path", "content").collect())
    assert got == [("proj-main", "README.md", "hi"), ("proj-main", "a.py", "def f():\n    pass\n")]


def test_archive_admission_limits(spark):
    archives = spark.createDataFrame([(1, 200 * 1024 * 1024), (2, 10), (3, 10)], "archive_id int, compressed_bytes long")
    entries = spark.createDataFrame([(2, "a", 600 * 1024 * 1024), (3, "b", 5)], "archive_id int, name string, size long")
    got = {r.archive_id: r.problem for r in AR.archive_admission(archives, entries).collect()}
    assert got == {1: "Archive exceeds the 100 MB download limit.", 2: "Archive expands to more than 500 MB.", 3: None}


def test_git_log_and_loc(spark):
    log = spark.createDataFrame([("r", ""), ("r", "  a.py "), ("r", "b.md"), ("r", "a.py"), ("r", "c.tsx")],
                                "repo string, line string")
    counts = {r.path: r.commits for r in CH.commit_count(CH.read_git_log(log)).collect()}
    assert counts == {"a.py": 2, "c.tsx": 1}
    df = spark.createDataFrame([("",), ("a",), ("a\n",), ("a\r\nb",), ("a\rb\n\n",)], "t string")
    assert [r.n for r in df.select(X.loc(F.col("t")).alias("n")).collect()] == [0, 1, 1, 2, 3]


def test_hunk_texts_are_shuffled_short_and_come_back_whole(spark):
    hunk = "diff --git a/{0} b/{0}\n--- a/{0}\n+++ b/{0}\n@@ -1 +3 @@"
    texts = [hunk.format(name) for name in ("pkg/m.py", "m", "", "a b/c\0.py", "++ b/x.py")] + ["", "no name", "\0", "x\0--- a/y", "x\n--- a/\ny", "x\n--- a/y\n--- a/z", hunk.format("u.py") + "\0", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", "t", fx._short(F.col("t")).alias("short"))
    rows = df.select("i", "t", "short", fx._whole(F.col("short")).alias("back")).orderBy("i").collect()
    assert [r.back for r in rows] == texts and len(rows[0].short) == len(texts[0]) - 3 * len("pkg/m.py") + 5
    diffs = fx.diffs_of(spark.createDataFrame([("r", 1, t) for t in texts] + [("q", 1, None)], "repo string, change_id int, hunk_text string"))
    below = diffs._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning", 1)[1]
    assert "collect_list" not in below
    assert {r.repo: r.diff for r in diffs.collect()} == {"r": "\n".join(sorted(t for t in texts if t is not None)), "q": ""}
