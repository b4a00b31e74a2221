"""Spelling variants against a comparison of all words."""

import collections
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from repolens.llm import spelling
from tests.llm.conftest import SMALL

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut_words(rows):
    out = collections.Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            x = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if x % 97 == 0:
                run = run[:x % len(run)] + run[x % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a != b and (a[k + 1:] == b[k + 1:] if len(a) == len(b) else len(b) == len(a) + 1 and a[k:] == b[k + 1:])


def brute(words):
    by_size = collections.defaultdict(list)
    for w in words:
        by_size[len(w)].append(w)
    others = {w: [x for size in (-1, 0, 1) for x in by_size[len(w) + size] if near(w, x)] for w in words}
    form = {}
    for w, some in others.items():
        best = min(some, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(others[w]), None if form[w] is None else words[form[w]]))
    return sorted(out)


def answers(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_small_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert answers(spelling.variants(docs)) == brute(cut_words([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))


def test_odd_rows(spark, odd, none):
    rows = [(None, "Straße straße STRASSE Überzug überzug"), (7, "aabbb aabb aabbbb abbbb " * 5), (7, "aabbb aabb aabbbb abbbb " * 5), (8, "x" * 400 + " " + "x" * 399 + "y "), (9, "é×÷ÿÀ é×÷ÿÁ " * 4)]
    more = spark.createDataFrame([(i, t, None, None, 0, "", 0, "", 0, "") for i, t in rows], odd.schema)
    both = odd.unionByName(more).unionByName(more.where("doc_id >= 8")).unionByName(more.where("doc_id = 8"))
    expect = brute(cut_words([(r.doc_id, r.text) for r in both.collect()]))
    assert answers(spelling.variants(both)) == expect and any(len(w) == 400 for w, *_ in expect)
    assert answers(spelling.variants(none)) == []


def test_chains_and_ties(spark):
    """abcde <- abcdf <- abcgf ...: forms are followed to the last; equal frequencies go to the smallest."""
    counts = {"mmmmm": 3, "mmmmn": 6, "mmmnn": 12, "mmnnn": 24, "mnnnn": 48, "nnnnn": 96, "qrstu": 4, "qrstv": 8, "qrsta": 8, "qrstuu": 8}
    rows = [(k, w) for w, n in counts.items() for k in range(n)]
    rows = [(next(d for d in range(10_000 * i, 10_000 * i + 5000) if zlib.crc32(f"{d}:{w}".encode()) % 97), w) for i, (_, w) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {x[0]: x for x in answers(spelling.variants(docs))}
    assert [got[w][3] for w in counts] == list(counts.values())
    assert all(got[w][2] == "nnnnn" for w in list(counts)[:6]) and got["qrstu"][1] == "qrsta"
    assert list(got.values()) == brute(counts)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text("abÿ", min_size=1, max_size=7), min_size=1, max_size=60, unique=True), st.integers(1, 9))
def test_trie_numbers(spark, words, parts):
    """Equal prefixes have equal numbers and different ones different numbers, over ranges of any size."""
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
        rows = spelling.trie(df, "word", "n", "test-trie").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    number = {}
    for r in rows:
        assert len(r.nodes) == len(r.key) + 1
        for k, node in enumerate(r.nodes):
            assert number.setdefault(r.key[:k], node) == node
    assert sorted(number.values()) == list(range(len(number)))  # dense
    assert [r.key for r in sorted(rows, key=lambda r: r.id)] == sorted(words)


@pytest.mark.parametrize("a,b,expect", [("abc", "abd", 2), ("", "abc", 0), ("ab", "abc", 2), ("abc", "abc", 3)])
def test_common(a, b, expect):
    assert spelling._common(a, b) == expect
