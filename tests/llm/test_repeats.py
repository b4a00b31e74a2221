"""Byte and word repeats against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from repolens.llm import common, doubling, queries, repeats, suffixes
from repolens.llm.repeats import byte_anchors, merged, word_anchors
from tests.llm.conftest import SMALL, ordered

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_bytes(rows, window=100):
    """rows in order; the same row given twice is one document."""
    seen, out = {}, {}
    for d, t in rows:
        b, covered = (t or "").encode(), set()
        if (d, t or "") in out:
            continue
        for s in range(len(b) - window + 1):
            if seen.setdefault(b[s:s + window], (d, t or "", s)) != (d, t or "", s):
                covered.update(range(s, s + window))
        kept = bytes(x for i, x in enumerate(b) if i not in covered)
        out[d, t or ""] = (len(b), len(covered), sum(i - 1 not in covered for i in covered), hashlib.sha256(kept).hexdigest())
    return out


def brute_words(rows, window=50):
    seen, out = {}, []
    for d, t in rows:
        w = WORD.findall(t or "")
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            seen[k] = min(seen.get(k, d), d)
    for d, t in rows:
        w, covered = WORD.findall(t or ""), set()
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s:s + window])] < d:
                covered.update(range(s, s + window))
        out.append((d, len(w), len(covered), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in covered).encode()).hexdigest()))
    return out


def same(out, want):
    key = lambda r: (r[0] is not None, *map(str, r))
    assert sorted(map(tuple, out), key=key) == sorted(want, key=key)


def test_bytes_of_documents(spark, small_rows):
    brute = brute_bytes(small_rows)
    same(queries.QUERIES["op7_suffix_dedup"](spark, SMALL).collect(), [(d, *brute[d, t or ""]) for d, t in small_rows])


def test_words_of_documents(spark, small_rows):
    same(queries.QUERIES["op9_substring_dedup"](spark, SMALL).collect(), brute_words(small_rows))


def test_odd_rows(odd, odd_rows):
    rows = ordered([(r[0], r[1]) for r in odd_rows])
    brute = brute_bytes(rows)
    same(suffixes.remove_repeated_bytes(odd).collect(), [(d, *brute[d, t or ""]) for d, t in rows])
    lowest = [(-1 if d is None else d, t) for d, t in rows]
    same(doubling.remove_repeated_words(odd).collect(), [(None if r[0] < 0 else r[0], *r[1:]) for r in brute_words(lowest)])


@pytest.mark.parametrize("seed", [1, 2])
def test_small_windows_of_random_texts(spark, seed):
    """Few letters: repeats of all lengths, in and between documents, and periodic texts."""
    rng = random.Random(seed)
    rows = [(k, "".join(rng.choice("ab") for _ in range(rng.randrange(60)))) for k in range(60)] + [(100 + k, "ab" * rng.randrange(20) + "a" * rng.randrange(30)) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    brute = brute_bytes(rows, 8)
    same(suffixes.remove_repeated_bytes(docs, window=8, gram=3).collect(), [(d, *brute[d, t]) for d, t in rows])
    rows = [(d, " ".join(t)) for d, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    same(doubling.remove_repeated_words(docs, window=10, gram=3).collect(), brute_words(rows, 10))


@pytest.mark.parametrize("split", [1, 3, 40])
def test_frequent_anchors_by_cores(spark, odd, odd_rows, split):
    """The same results however narrow the blocks are that frequent anchors' windows are dealt in."""
    rng = random.Random(5)
    rows = [(k, "".join(rng.choice("ab") for _ in range(rng.randrange(60)))) for k in range(60)] + [(100 + k, "ab" * rng.randrange(20) + "a" * rng.randrange(30)) for k in range(20)]
    rows += rows[:9] + [(k, t + "b") for k, t in rows[9:15]]
    docs, rows = spark.createDataFrame(rows, "doc_id long, text string").repartition(5), ordered(rows)
    # Of two texts of one doc_id the order is by hash, so bytes are compared without them.
    single = [r for r in rows if not 9 <= r[0] < 15]
    brute = brute_bytes(single, 8)
    same(suffixes.remove_repeated_bytes(docs.where("doc_id NOT BETWEEN 9 AND 14"), window=8, gram=3, split=split).collect(), [(d, *brute[d, t]) for d, t in single])
    spaced = docs.selectExpr("doc_id", "rtrim(regexp_replace(text, '(.)', '$1  ')) AS text")
    same(doubling.remove_repeated_words(spaced, window=10, gram=3, split=split).collect(), brute_words([(d, " ".join(t)) for d, t in rows], 10))
    lowest = [(-1 if r[0] is None else r[0], r[1]) for r in odd_rows]
    same(doubling.remove_repeated_words(odd, split=split).collect(), [(None if r[0] < 0 else r[0], *r[1:]) for r in brute_words(lowest)])


def test_a_common_line_is_spread_over_parts(spark):
    """One line inside otherwise different texts: no part holds all of its pieces."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7))
    for anchors, window, within, size in ((byte_anchors(100, 24), 100, True, 9), (word_anchors(50, 13), 50, False, 40)):
        line = [word() for _ in range(size)]
        rows = [(k, " ".join([word() for _ in range(60)] + line + [word() for _ in range(60)])) for k in range(400)]
        docs = repeats.identified(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), "doc_id", "text")
        marked = repeats.packed(docs).join(repeats.repeated_anchors(docs, anchors, 16), ["doc_id", "text_hash"]).select("doc_id", "text_hash", "packed", "ordinals")
        held = Counter()
        for r in marked.mapInArrow(repeats._cut(anchors, window, 24 if within else 13, 64, within), repeats._PIECE).where("kind > 0").collect():
            held[r.part] += len(r.docs) // 8
        assert sum(held.values()) > 300 and max(held.values()) < 0.1 * sum(held.values())


def thue_morse(levels):
    a, b = "a", "b"
    for _ in range(levels):
        a, b = a + b, b + a
    return a, b


@pytest.mark.parametrize("levels", [9, 10, 11, 12])
def test_words_that_fool_polynomial_hashes(spark, levels):
    """Thue-Morse words have equal hashes modulo 2 ** 64 from 1,024 letters on; here they differ,
    as words, in windows of such words, and as texts of bytes."""
    a, b = thue_morse(levels)
    data, _, starts, ends, _, hashes = common.word_hashes(pa.array([f"{a} {b} {a}"]), lower=False)
    assert hashes[0] != hashes[1] and hashes[0] == hashes[2]
    assert common.word_numbers(data, starts, ends).tolist() == [0, 1, 0]
    if levels > 10:
        return
    rest = [f"w{k}" for k in range(60)]
    rows = [(1, " ".join([a, *rest])), (2, " ".join([b, *rest])), (3, " ".join([a, *rest[:55]])), (4, a + b), (5, b + a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same(doubling.remove_repeated_words(docs).collect(), brute_words(rows))
    brute = brute_bytes(rows)
    same(suffixes.remove_repeated_bytes(docs).collect(), [(d, *brute[d, t]) for d, t in rows])


def test_windows_with_equal_keys_are_compared():
    numbers = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3], np.int64)
    at = np.array([0, 3, 6])
    same_keys = doubling.same_windows(numbers, at, np.zeros(3, np.uint64), 3)
    assert same_keys[0] == same_keys[2] != same_keys[1]


def test_words_split_at_blocks_of_eight_bytes():
    words = [bytes([65 + (k * 7 + n) % 26 for k in range(n)]) for n in range(1, 200)]
    words += [w[:-1] + b"!" for w in words] + [w + b"\0" for w in words]
    text = b" ".join(words).decode()
    data, _, starts, ends, _, hashes = common.word_hashes(pa.array([text]), lower=False)
    assert len(starts) == len(words) and len(set(hashes.tolist())) == len(set(words))
    alone = [common.word_hashes(pa.array([w.decode()]), lower=False)[5][0] for w in words]
    assert hashes.tolist() == alone


def test_every_window_has_one_anchor():
    rng = random.Random(3)
    texts = ["".join(rng.choice("abc ") for _ in range(n)) for n in (0, 5, 99, 100, 101, 700, 3000)]
    found = byte_anchors(100, 24)(pa.array(texts))
    windows = [s for lo, hi in zip(found.low, found.high, strict=True) for s in range(lo, hi + 1)]
    ends = np.cumsum([len(t) for t in texts])
    assert windows == [s for e, t in zip(ends, texts, strict=True) for s in range(e - len(t), e - 99)]
    assert all((found.at >= found.high) & (found.at + 24 <= found.low + 100))


def test_merged_runs():
    spans = [np.array(x, np.int32).tobytes() for x in ([[5, 9], [0, 2]], [[8, 12], [2, 3], [20, 21]])]
    a, b = merged(spans)
    assert a.tolist() == [0, 5, 20] and b.tolist() == [3, 12, 21]
    assert [len(x) for x in merged(None)] == [0, 0]


def test_levels_double():
    assert doubling.levels(13, 50) == [13, 26, 50] and doubling.levels(50, 50) == [50]


def test_empty_tables(none):
    assert suffixes.remove_repeated_bytes(none).collect() == [] and doubling.remove_repeated_words(none).collect() == []
