"""Quality rules against a plain count."""

import collections
import re

from repolens.llm import quality
from tests.llm.conftest import SMALL, passage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TABLE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def norm(line):
    return " ".join(WORD.findall(line)).translate(TABLE)


def brute(rows, min_documents, share, left):
    """rows of (doc_id, host, text)."""
    texts, by_line = collections.defaultdict(set), collections.defaultdict(set)
    for _, host, text in rows:
        texts[host].add(text or "")
        for line in (text or "").split("\n"):
            if WORD.search(line):
                by_line[host, norm(line)].add(text)
    frequent = {k for k, v in by_line.items() if len(v) > min_documents and len(v) > share * len(texts[k[0]])}
    out = []
    for doc_id, host, text in rows:
        text = text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        grams = collections.defaultdict(list)
        for k in range(len(words) - 2):
            grams[tuple(words[k:k + 3])].append(k)
        inside = {k + o for at in grams.values() if len(at) > 1 for k in at for o in range(3)}
        gone = sum(len(WORD.findall(x)) for x in lines if (host, norm(x)) in frequent)
        failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
        out.append((doc_id, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside), gone, failed,
                    not failed and len(words) - gone >= left * len(words)))
    return out


def answers(df):
    return [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_removed_words, r.base_failed, r.kept) for r in df.collect()]


def test_small_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    for limits in ((10, 0.005, 0.5), (1, 0.0, 0.9)):
        assert sorted(answers(quality.judge(docs, min_documents=limits[0], share=limits[1], left=limits[2]))) == sorted(brute(rows, *limits))


def test_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.source, r.text) for r in odd.collect()]
    assert sorted(answers(quality.judge(odd, min_documents=1, share=0.0)), key=str) == sorted(brute(rows, 1, 0.0, 0.5), key=str)
    assert answers(quality.judge(none)) == [] and quality.cleaned(none).collect() == []


def boilerplate(k):
    return "\n".join([["All Rights", "all  rights", " ALL rights\t"][k % 3] + " reserved by the owners", "", "HOME | about\tus | contact", passage(100 + k, 60)])


def test_lines_of_a_host_go(spark):
    """The frame of 40 pages of one host goes, whatever its case and blanks; copies of one page and
    the same frame on a small host stay; pages of nothing but frame are rejected."""
    frame = "\n".join(passage(7 + k, 20) for k in range(3))
    rows = [(k, "big", boilerplate(k)) for k in range(40)] + [(100 + k, "copies", boilerplate(77)) for k in range(40)]
    rows += [(200 + k, "small", boilerplate(k)) for k in range(5)] + [(300 + k, "big", frame + f"\nown {k} words") for k in range(30)] + [(400 + k, None, boilerplate(k)) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert all(got[k].kept and got[k].n_removed_words == 12 for k in [*range(40), *range(400, 412)])
    assert all(got[k].kept and got[k].n_removed_words == 0 for k in [*range(100, 140), *range(200, 205)])
    assert all(not got[k].kept and not got[k].base_failed for k in range(300, 330))
    texts = {r.doc_id: r.text for r in quality.cleaned(docs).collect()}
    assert texts[3] == "\n" + passage(103, 60) and texts[200] == boilerplate(0) and set(texts) == {k for k in got if got[k].kept}


def test_line_and_document_at_a_limit_stay(spark):
    half = passage(3, 30)
    rows = [(k, "h", half + f"\n{passage(50 + k, 30)}") for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert [r.n_removed_words for r in quality.judge(docs, min_documents=4, share=0.0).collect()] == [0] * 4
    assert all(r.n_removed_words == 30 and r.kept for r in quality.judge(docs, min_documents=3, share=0.0).collect())
    assert not any(r.kept for r in quality.judge(docs, min_documents=3, share=0.0, left=0.51).collect())


def test_very_long_text():
    words = [b"w%d" % (k % 70_001) for k in range(300_000)]
    assert quality.repeated_words(words) == 300_000
    assert quality.repeated_words([b"w%d" % k for k in range(300_000)]) == 0
    assert quality.repeated_words([b"a"] * 4) == 4 and quality.repeated_words([b"a"] * 3) == 0
