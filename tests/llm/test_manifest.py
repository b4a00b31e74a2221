"""The Merkle manifest against a plain tree in memory."""

import hashlib
import zlib

import pytest

from repolens.llm import merkle


def h(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def plain_leaf(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    out = b""
    for x in fields:
        raw = None if x is None else str(x).encode()
        out += b"-" if raw is None else str(len(raw)).encode() + b":" + raw
    return hashlib.sha256(out).hexdigest()


def plain_tree(nodes):
    """Root and each leaf's list of (left, right) siblings."""
    proofs, where, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, at in enumerate(where):
            run = level[at // 8 * 8:at // 8 * 8 + 8]
            proofs[i].append((run[:at % 8], run[at % 8 + 1:]))
        level = [h("".join(level[i:i + 8])) for i in range(0, len(level), 8)]
        where = [at // 8 for at in where]
    return level[0], proofs


def plain_manifest(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    trees = {}
    for r in rows:
        key = None if r["doc_id"] is None else str(r["doc_id"]).encode()
        bad = key is not None and zlib.crc32(key) % 3 == 0
        start = plain_leaf(r, r["text"].translate(lower) if bad and r["text"] is not None else r["text"])
        trees.setdefault(r["lang"], []).append((r["doc_id"], plain_leaf(r, r["text"]), start))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for some in trees.values():
        some.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    made = {k: plain_tree([x[1] for x in trees[k]]) for k in langs}
    root, upper = plain_tree([made[k][0] for k in langs])
    out = []
    for place, k in enumerate(langs):
        for (doc_id, leaf, start), proof in zip(trees[k], made[k][1], strict=True):
            proof, now = proof + upper[place], start
            for left, right in proof:
                now = h("".join([*left, now, *right]))
            out.append((doc_id, leaf, made[k][0], root, h("".join(x for left, right in proof for x in left + right)), now, now == root))
    return out


def rows_of(df):
    return [(r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()]


@pytest.mark.parametrize("levels,limit", [(1, 2), (3, 8192)])
def test_odd_rows(spark, odd, levels, limit):
    twice = odd.unionByName(odd.where("doc_id > 20"))
    expect = plain_manifest([r.asDict() for r in twice.collect()])
    assert sorted(rows_of(merkle.manifest(twice, levels, limit)), key=str) == sorted(expect, key=str)


def test_empty_and_one(spark, odd, none):
    assert rows_of(merkle.manifest(none)) == []
    one = odd.where("doc_id = 41")
    assert rows_of(merkle.manifest(one)) == plain_manifest([r.asDict() for r in one.collect()])


def test_many_langs_and_a_hot_one(spark):
    """600 leaves of one lang and 70 langs of one to three, in blocks of 8 and of 64."""
    rows = [(k, f"Text {k}", "hot" if k < 600 else f"l{k % 70}", None, k) for k in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    expect = sorted(plain_manifest([r.asDict() for r in docs.collect()]))
    for levels in (1, 2):
        assert sorted(rows_of(merkle.manifest(docs, levels, 16))) == expect


def test_queue_spills_in_order():
    queue = merkle.ExternalQueue(3)
    labels = [(k * 37 % 101, k % 3) for k in range(500)]
    for k, x in enumerate(labels):
        queue.push(x, k)
    assert queue.runs
    out = []
    while queue.head() is not None:
        label = queue.head()
        out += [(label, k) for k in queue.messages(label)]
    assert [x[0] for x in out] == sorted(labels) and all(labels[k] == x for x, k in out)
    assert out == sorted(out)  # equal labels in the order of arrival
