"""Fingerprints, exact and near duplicates."""

import hashlib
import itertools
import re

import duckdb
import pytest
import xxhash

from repolens.llm import exact, imatch, near, queries
from tests.llm.conftest import SMALL, ordered

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def hash64(data, seed=42):
    x = xxhash.xxh64(data, seed=seed).intdigest()
    return x - (1 << 64) if x >> 63 else x


def of_long(x, seed=42):
    return hash64(x.to_bytes(8, "little", signed=True), seed)


def of_ints(values, j):
    seed = 42
    for v in values:
        seed = of_long(v, seed) % (1 << 64)
    return hash64(j.to_bytes(8, "little"), seed)


def brute_fingerprints(texts, rarest, commonest):
    """Sorted lexicon terms hashed for every subset, text by text."""
    terms = [{hash64(w.encode()) for w in WORD.findall(t.translate(LOWER))} for t, _ in texts]
    df = {}
    for found in terms:
        for w in found:
            df[w] = df.get(w, 0) + 1
    n = len(texts)
    words = {w for w, c in df.items() if c * rarest >= n and c * commonest <= n}

    def one(text):
        found = sorted({hash64(w.encode()) for w in WORD.findall(text.translate(LOWER))} & words)
        out, shift = [], 0
        for rate, many in imatch.SUBSETS:
            for s in range(many):
                chosen = [t for t in found if (t % (1 << 64) >> shift) % rate == s]
                out.append((of_ints(chosen, 1000 * rate + s) & 0xFFFFFFFE) + 1 if chosen else 0)
            shift += rate.bit_length() - 1
        return out if found else [(hash64(text.encode()) & 0xFFFFFFFE) + 1] * len(out)

    return [(one(t), one(e)) for t, e in texts]


def likeness(a, b):
    held = [(x, y) for x, y in zip(a, b, strict=True) if x or y]
    return sum(x == y for x, y in held) / len(held) if held else 1.0


@pytest.mark.parametrize("which", ["small", "odd"])
def test_imatch_against_brute_force(spark, small_rows, odd_rows, odd, which):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet") if which == "small" else odd
    rows = ordered(small_rows if which == "small" else [(r[0], r[1] or "") for r in odd_rows])
    out = ordered([tuple(r) for r in imatch.fingerprints(docs, rarest=200, ranges=5).collect()])
    texts = []
    for i, (_, t) in enumerate(rows):
        half = len(t) // 2
        texts.append((t, t[:len(t) - half] + rows[(i + 1) % len(rows)][1][:half]))
    brute = brute_fingerprints(texts, 200, 10)
    show = lambda x: "".join(f"{v:08x}" for v in x)
    want = [(d, len(t), hashlib.sha256(e.encode()).hexdigest(), show(f), show(g), likeness(f, g), likeness(f, brute[(i + 1) % len(rows)][0]))
            for i, ((d, t), (_, e), (f, g)) in enumerate(zip(rows, texts, brute, strict=True))]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[3])
    assert sorted(out, key=key) == sorted(want, key=key)


def test_imatch_tells_halves_from_strangers(spark):
    """In each class of lengths, half a text is nearer than a stranger."""
    out = imatch.fingerprints(spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet")).collect()
    for low, high in ((300, 1000), (1000, 10_000), (10_000, 1 << 40)):
        some = [r.near_edited > r.near_next for r in out if low <= r.n_chars < high]
        assert len(some) >= 20 and sum(some) >= 0.95 * len(some) - 1


def test_imatch_is_native(spark):
    plan = queries.QUERIES["op1_imatch"](spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_exact_dedup_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = con.execute(queries.ORACLE["op2_exact_dedup"]).fetchall()
    assert sorted(map(tuple, queries.QUERIES["op2_exact_dedup"](spark, SMALL).collect())) == sorted(want)


@pytest.mark.parametrize("range_rows", [1 << 23, 3])
def test_exact_dedup_of_odd_rows(odd, odd_rows, range_rows):
    """In one range and in many."""
    out = exact.exact_dedup(odd, range_rows=range_rows).collect()
    groups = {}
    for i, t, *_ in odd_rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    want = []
    for i, t, *_ in odd_rows:
        ids = groups[(t or "").translate(LOWER)]
        keep = max((x for x in ids if x is not None), default=None)
        want.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").translate(LOWER).encode()).hexdigest()))
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))
    kept = exact.drop_copies(odd, range_rows=range_rows)
    assert kept.columns == odd.columns
    assert sorted(r.text or "" for r in kept.collect()) == sorted(max(t for _, t, *_ in [(0, r[1] or "") for r in odd_rows] if t.translate(LOWER) == k) if k != "one" else "One" for k in groups)


def test_exact_dedup_of_rows_with_maps(odd):
    """Columns that have no order pass; of rows equal in id and text one stays."""
    rows = odd.selectExpr("doc_id", "text", "map('a', doc_id) AS lead", "map('k', size) AS sha")
    kept = exact.drop_copies(rows.unionByName(rows))
    assert kept.columns == rows.columns and kept.count() == len({(r.text or "").translate(LOWER) for r in rows.collect()})


def test_share_of_rows_that_shuffle_is_constant(spark):
    """Unique texts: about as many pass the filters however many ranges there are."""
    docs = spark.range(40_000).selectExpr("id AS doc_id", "concat('text ', id) AS text").repartition(4)
    for range_rows in (40_000, 5_000, 1_500):
        rows = exact.digests(docs)
        found, bits, ranges = exact.filters(rows, range_rows=range_rows)
        assert ranges == -(-40_000 // range_rows)
        out = exact.marked(rows, found, bits, ranges)
        assert out.count() == 40_000 and out.where("maybe").count() < 0.025 * 40_000


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows, percent):
    sets, parent = [(d, shingle_set(t)) for d, t in rows], {d: d for d, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            i, j = root(a), root(b)
            parent[max(i, j)] = min(i, j)
    return {d: (len(s), root(d)) for d, s in sets}


def test_near_duplicates_against_brute_force(spark, small_rows):
    want = brute_components(small_rows, 85)
    out = queries.QUERIES["op5_near_dedup"](spark, SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want and len(out) == len(small_rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_near_duplicates_of_odd_rows(odd, odd_rows):
    rows = [(-1 if r[0] is None else r[0], r[1]) for r in odd_rows]
    want = brute_components(rows, 85)
    out = near.near_duplicates(odd).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles) for r in out) == sorted((d, len(shingle_set(t))) for d, t in rows)
    assert {(-1 if r.doc_id is None else r.doc_id): (-1 if r.component_id is None else r.component_id) for r in out} == {d: c for d, (_, c) in want.items()}
    assert near.drop_near_copies(odd).columns == odd.columns


def test_near_chain_and_large_group(spark):
    """A chain whose ends share nothing is one component; so is a group of many copies with one edit each."""
    words = [f"c{k}" for k in range(400)]
    chain = [(k, " ".join(words[4 * k:4 * k + 120])) for k in range(60)]
    base = [f"g{k}" for k in range(200)]
    group = [(1000 + k, " ".join(base[:k] + [f"edit{k}"] + base[k + 1:])) for k in range(0, 200)]
    docs = spark.createDataFrame(chain + group, "doc_id long, text string").repartition(4)
    out = {r.doc_id: r.component_id for r in near.near_duplicates(docs).collect()}
    want = brute_components(chain + group, 85)
    assert out == {d: c for d, (_, c) in want.items()}


def test_near_null_ids_and_ids_with_two_texts(spark):
    """A null id in a class, and an id whose two texts link to different documents."""
    words = [f"w{k}" for k in range(200)]
    a, a1, a2 = " ".join(words), " ".join([*words[:-1], "x"]), " ".join(["y", *words[1:]])
    b, b1 = " ".join(f"v{k}" for k in range(150)), " ".join([*(f"v{k}" for k in range(149)), "z"])
    rows = [(None, a), (5, a), (6, a1), (7, a2), (20, b), (21, b1), (22, "alone " + "here is some text " * 3), (23, a1 + " more"), (23, b1 + " more"), (None, "another one without an id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.component_id, r.kept) for r in near.near_duplicates(docs).collect())
    assert got == sorted([(False, 0, None, True), (False, 0, None, True), *((True, d, None, False) for d in (5, 6, 7, 20, 21, 23, 23)), (True, 22, 22, True)], key=lambda x: x[:2]), got
    without = near.near_duplicates(docs.where("doc_id <> 23 OR doc_id IS NULL").where("doc_id IS NOT NULL")).collect()
    assert {r.doc_id: r.component_id for r in without} == {5: 5, 6: 5, 7: 5, 20: 20, 21: 20, 22: 22}


def test_near_recall_at_the_threshold(spark):
    """Every pair at exactly 85 %, and none just below, over many random sets; the pipeline's 80 % likewise."""
    import random
    rng, rows, links = random.Random(4), [], {85: set(), 80: set()}
    for k in range(120):
        n = rng.randrange(60, 400)
        left = [f"t{k}x{i}" for i in range(n)]
        cut = rng.randrange(0, max(1, n // 8))
        right = left[:n - cut] + [f"u{k}x{i}" for i in range(cut)]
        rows += [(2 * k, " ".join(left)), (2 * k + 1, " ".join(right))]
        x, y = ({tuple(t[i:i + 5]) for i in range(len(t) - 4)} for t in (left, right))
        for percent in links:
            if 100 * len(x & y) >= percent * len(x | y):
                links[percent].add(2 * k)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.component_id for r in near.near_duplicates(docs).collect()}
    assert {d - 1 for d, c in found.items() if c == d - 1 and d % 2} == links[85]
    kept = {r.doc_id for r in near.drop_near_copies(docs).collect()}
    assert {d for d in links[80] if d + 1 not in kept} == links[80] and 2 * 120 - len(kept) == len(links[80])


def test_empty_tables(none):
    assert imatch.fingerprints(none).collect() == [] and exact.exact_dedup(none).collect() == [] and exact.drop_copies(none).collect() == []
    assert near.near_duplicates(none).collect() == [] and near.drop_near_copies(none).collect() == []
