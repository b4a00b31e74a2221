"""Merkle manifest of a table by time-forward processing.

Every row is a leaf.  The leaves of one ``lang``, ascending by doc_id, are
hashed together in runs of ``FAN`` until one node, the subroot, remains; the
subroots, ordered by lang, form the root in the same way.

A tree is an acyclic graph whose nodes are evaluated in the order of their
labels: each node sends its digest forward, as a message to its parent's
label.  Within a task the messages wait in an external priority queue ordered
by label (post-order: last leaf, then level), which keeps ``limit`` messages
in memory and the rest in sorted runs on disk; between tasks the shuffle,
sorted by label, is the queue.  Tasks hold blocks of ``FAN ** levels`` leaves
of one lang; block roots are the leaves of the next tier, so a tier is a few
hundred times smaller than the one before.

Then the sweep is reversed: from the last tier to the first and from the root
of every block to its leaves, each node receives its proof suffix (siblings
from its parent's level upward) and sends each child that suffix with the
child's own siblings before it.  Leaves therefore receive whole proofs,
recompute the root from the tampered or original leaf, and compare.

Positions: leaves are sorted in ranges; a leaf's place is its index in the
range plus the counts of the ranges before it (one row per range and lang).
No task holds more than a block and its proofs; a lang with a third of all
rows is many blocks.

Defined cases: a null field is ``-`` in the leaf, an empty text ``0:``.  A
null lang is a lang of its own, the first.  Null doc_ids come first in their
lang and are never tampered with.  Equal doc_ids are ordered by leaf digest,
so repeated rows are leaves of their own side by side, and any order among
equal rows gives the same rows.  A very long text is hashed as one row's
work.  A table without rows has no root and gives no rows.  Other columns are
not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repolens.llm.common import slices, written

FAN = 8
LEVELS = 3          # of a block: FAN ** LEVELS leaves
QUEUE_LIMIT = 8192  # messages held in memory

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest_of(*parts: bytes) -> bytes:
    """SHA-256 over the hex texts of digests."""
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def leaf_digest(fields) -> bytes:
    """Of encoded fields: ``-`` for None, else byte count, ``:``, bytes."""
    return hashlib.sha256(b"".join(b"-" if x is None else b"%d:%b" % (len(x), x) for x in fields)).digest()


def _leaves(batches):
    for batch in slices(batches, "text"):
        ids, sources, langs, counts = (batch.column(i).to_pylist() for i in range(4))
        texts = batch.column(4).cast(pa.large_binary()).to_pylist()
        whole, changed = [], []
        for i, source, lang, n, text in zip(ids, sources, langs, counts, texts, strict=True):
            key = None if i is None else b"%d" % i
            fields = [key, None if source is None else source.encode(), None if lang is None else lang.encode(), None if n is None else b"%d" % n, text]
            whole.append(leaf_digest(fields))
            tampered = key is not None and zlib.crc32(key) % 3 == 0
            changed.append(leaf_digest([*fields[:4], None if text is None else text.lower()]) if tampered else None)
        yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(0), pa.array(whole, pa.binary()), pa.array(changed, pa.binary())], ["tree", "doc_id", "digest", "tampered"])


def leaves(docs: DataFrame) -> DataFrame:
    """tree (the lang), doc_id, digest, tampered (digest after tampering; null: not tampered with)."""
    columns = [F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col("n_chars").cast("long"), F.col("text").cast("string")]
    return docs.select(*columns).mapInArrow(_leaves, "tree string, doc_id long, digest binary, tampered binary")


def placed(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """``rows`` with ``at``, the place in their tree in the order of ``by``, and ``total``, the tree's size."""
    spark = rows.sparkSession
    rows = written(rows.withColumn("row_no", F.monotonically_increasing_id()), name)
    keys = ["tree", *by, "row_no"]  # row_no only deals equal rows over ranges
    ranges = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys)
    ranges = written(ranges.withColumn("part", F.spark_partition_id()).withColumn("nth", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), name)
    counts = ranges.groupBy("part", "tree").agg(F.count(F.lit(1)).alias("n"), F.min("nth").alias("first"))
    whole = Window.partitionBy("tree")
    counts = counts.select(F.col("part").alias("of_part"), F.col("tree").alias("of_tree"), (F.sum("n").over(whole.orderBy("part")) - F.col("n") - F.col("first")).alias("before"), F.sum("n").over(whole).alias("total"))
    counts = written(counts, name)
    joined = ranges.join(counts, (F.col("part") == F.col("of_part")) & F.col("tree").eqNullSafe(F.col("of_tree")))
    return written(joined.withColumn("at", F.col("nth") + F.col("before")).drop("part", "nth", "of_part", "of_tree", "before", "row_no"), name)


class ExternalQueue:
    """A priority queue of (label, message); more than ``limit`` messages go to
    sorted runs on disk."""

    def __init__(self, limit: int = QUEUE_LIMIT):
        self.limit, self.heap, self.runs, self.count = limit, [], [], 0

    def push(self, label, message) -> None:
        self.count += 1  # equal labels leave in the order in which they came
        heapq.heappush(self.heap, (label, self.count, message))
        if len(self.heap) > self.limit:
            run = tempfile.TemporaryFile()
            for item in sorted(self.heap):
                pickle.dump(item, run)
            run.seek(0)
            self.heap = []
            self._next(run)

    def _next(self, run) -> None:
        try:
            heapq.heappush(self.runs, (pickle.load(run), id(run), run))
        except EOFError:
            run.close()

    def head(self):
        """The least label, or None."""
        least = [x[0] for x in (self.heap[:1] + [r[0] for r in self.runs[:1]])]
        return min(least) if least else None

    def pop(self):
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            item, _, run = heapq.heappop(self.runs)
            self._next(run)
            return item[2]
        return heapq.heappop(self.heap)[2]

    def messages(self, label):
        """All messages for ``label``, which must be the least."""
        while self.head() == label:
            yield self.pop()


def depth(leaves_: int) -> int:
    """Levels above ``leaves_`` leaves, up to one node."""
    k = 0
    while FAN ** k < leaves_:
        k += 1
    return k


class Block:
    """Labels of a block's nodes: (last leaf, level), leaves counted from the block's first."""

    def __init__(self, number: int, total: int, levels: int):
        size = FAN ** levels
        self.leaves = min(size, total - number * size)
        self.levels = levels if total > size else depth(total)

    def label(self, level: int, nth: int) -> tuple[int, int]:
        return min((nth + 1) * FAN ** level, self.leaves) - 1, level

    def parent(self, level: int, nth: int) -> tuple[int, int, int]:
        return *self.label(level + 1, nth // FAN), nth // FAN


def forward(block: Block, rows, queue: ExternalQueue, note=lambda *record: None) -> bytes:
    """The block's root.  ``rows`` yields (digest, payload) of its leaves in order;
    note(level, nth, children or leaf's row) is called for each node in label order."""
    rows, root = enumerate(rows), None
    at = next(rows, None)
    while at is not None or queue.head() is not None:
        label = queue.head()
        if at is not None and (label is None or (at[0], 0) < label[:2]):
            level, nth, digest = 0, at[0], at[1][0]
            note(0, nth, at[1])
            at = next(rows, None)
        else:
            level, nth = label[1], label[2]
            children = list(queue.messages(label))
            digest = digest_of(*children)
            note(level, nth, children)
        if level == block.levels:
            root = digest
        else:
            queue.push(block.parent(level, nth), digest)
    return root


def backward(block: Block, records, suffix: bytes, queue: ExternalQueue):
    """From ``records`` in falling label order and the root's proof suffix: (leaf's row, its whole proof)."""
    down = lambda level, nth: (-block.label(level, nth)[0], -level)
    queue.push(down(block.levels, 0), suffix)
    for level, nth, held in records:
        suffix = queue.pop()
        if level == 0:
            yield held, suffix
            continue
        for k in range(len(held) - 1, -1, -1):
            own = bytes((k, len(held) - 1 - k)) + b"".join(held[:k]) + b"".join(held[k + 1:])
            queue.push(down(level - 1, nth * FAN + k), own + suffix)


def proof_levels(proof: bytes):
    """(digests to the left, digests to the right) of each level, from the leaf upward."""
    at = 0
    while at < len(proof):
        left, right = proof[at], proof[at + 1]
        at += 2
        some = [proof[at + 32 * i:at + 32 * (i + 1)] for i in range(left + right)]
        at += 32 * len(some)
        yield some[:left], some[left:]


def _runs(batches, names: list[str]):
    """(tree, block, rows) of a partition sorted by tree and block; rows must be used up before the next."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(batch.schema.get_field_index(x)).to_pylist() for x in ["tree", "block", *names]), strict=True)

    stream = rows()
    head = next(stream, None)
    while head is not None:
        key = head[:2]

        def run(key=key):
            nonlocal head
            while head is not None and head[:2] == key:
                now = head
                head = next(stream, None)
                yield now[2:]

        yield *key, run()


def _batches(rows, schema: pa.Schema, size: int = 1024):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _up(levels: int, limit: int):
    schema = pa.schema([("tree", pa.string()), ("at", pa.int64()), ("total", pa.int64()), ("digest", pa.binary())])

    def roots(batches):
        queue = ExternalQueue(limit)
        for tree, number, rows in _runs(batches, ["total", "digest"]):
            total, digest = next(rows)
            block = Block(number, total, levels)
            root = forward(block, ((d,) for part in ([(total, digest)], rows) for _, d in part), queue)
            yield tree, number, -(-total // FAN ** levels), root

    return lambda batches: _batches(roots(batches), schema)


class _Records:
    """Records written one after the other and read from the last to the first."""

    def __init__(self):
        self.file, self.starts = tempfile.TemporaryFile(), []

    def add(self, *record) -> None:
        self.starts.append(self.file.tell())
        pickle.dump(record, self.file)

    def reversed(self):
        for at in reversed(self.starts):
            self.file.seek(at)
            yield pickle.load(self.file)

    def clear(self) -> None:
        self.file.seek(0)
        self.file.truncate()
        self.starts = []


def _down(levels: int, limit: int, leaf: bool):
    tier = pa.schema([("tree", pa.string()), ("at", pa.int64()), ("suffix", pa.binary()), ("subroot", pa.binary()), ("root", pa.binary())])
    last = pa.schema([("doc_id", pa.int64()), *((x, pa.string()) for x in ("leaf", "subroot", "root", "proof_sha256", "folded_root"))])

    def swept(batches):
        queue, records = ExternalQueue(limit), _Records()
        for tree, number, rows in _runs(batches, ["kind", "at", "total", "digest", "suffix", "subroot", "root", "doc_id", "tampered"]):
            _, _, _, _, suffix, subroot, root, _, _ = next(rows)  # kind 0: what the block's root received
            first = next(rows)
            block = Block(number, first[2], levels)
            forward(block, ((r[3], r[1], r[7], r[8]) for part in ([first], rows) for r in part), queue, records.add)
            for (digest, at, doc_id, tampered), proof in backward(block, records.reversed(), suffix, queue):
                if not leaf:
                    yield tree, at, proof, subroot, root
                    continue
                folded, siblings = tampered or digest, hashlib.sha256()
                for left, right in proof_levels(proof):
                    siblings.update("".join(x.hex() for x in left + right).encode())
                    folded = digest_of(*left, folded, *right)
                yield doc_id, digest.hex(), (subroot or digest).hex(), root.hex(), siblings.hexdigest(), folded.hex()
            records.clear()

    return lambda batches: _batches(swept(batches), last if leaf else tier, 256)


def _dealt(rows: DataFrame, *order: str) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "tree", "block").sortWithinPartitions("tree", "block", *order)


def tiers(rows: DataFrame, levels: int = LEVELS, limit: int = QUEUE_LIMIT) -> list[DataFrame]:
    """``rows`` (tree, at, total, digest) and the tiers above; the last has one row, the root, per tree."""
    out, size = [rows], FAN ** levels
    while True:
        blocks = out[-1].select("tree", F.expr(f"at div {size}").alias("block"), "at", "total", "digest")
        out.append(written(_dealt(blocks, "at").mapInArrow(_up(levels, limit), "tree string, at long, total long, digest binary"), "merkle-tier"))
        if out[-1].where("total > 1").isEmpty():
            return out


def delivered(above: list[DataFrame], suffixes: DataFrame, levels: int, limit: int, leaf: bool) -> DataFrame:
    """Proof suffixes (tree, at, suffix, subroot, root) of the last tier's nodes, swept to the first tier's."""
    size = FAN ** levels
    for k in range(len(above) - 2, -1, -1):
        more = ["doc_id", "tampered"] if leaf and k == 0 else [F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("tampered")]
        empty = lambda *names: [F.lit(None).cast("binary").alias(x) for x in names]
        nodes = above[k].select("tree", F.expr(f"at div {size}").alias("block"), F.lit(1).alias("kind"), "at", "total", "digest", *empty("suffix", "subroot", "root"), *more)
        heads = suffixes.select("tree", F.col("at").alias("block"), F.lit(0).alias("kind"), "at", F.lit(0).cast("long").alias("total"), *empty("digest"), "suffix", "subroot", "root",
                                F.lit(None).cast("long").alias("doc_id"), *empty("tampered"))
        last = leaf and k == 0
        schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string" if last else "tree string, at long, suffix binary, subroot binary, root binary"
        suffixes = _dealt(heads.unionByName(nodes), "kind", "at").mapInArrow(_down(levels, limit, last), schema)
        suffixes = suffixes if k == 0 else written(suffixes, "merkle-suffixes")
    return suffixes


def manifest(docs: DataFrame, levels: int = LEVELS, limit: int = QUEUE_LIMIT) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    by_lang = tiers(placed(leaves(docs), ["doc_id", "digest"], "merkle-leaves"), levels, limit)
    subroots = by_lang[-1].select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "digest")
    subroots = placed(subroots, ["lang"], "merkle-subroots")
    over_all = tiers(subroots.select("tree", "at", "total", "digest"), levels, limit)
    start = over_all[-1].select("tree", "at", F.lit(b"").alias("suffix"), F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"))
    proofs = delivered(over_all, start, levels, limit, False).select(F.col("at").alias("place"), "suffix", "root")
    heads = subroots.join(proofs, F.col("at") == F.col("place")).select(F.col("lang").alias("tree"), F.lit(0).cast("long").alias("at"), "suffix", F.col("digest").alias("subroot"), "root")
    out = delivered(by_lang, written(heads, "merkle-heads"), levels, limit, True)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest_sql(levels: int = 7) -> str:
    """The same rows as DuckDB SQL, for up to 8 ** levels leaves a tree."""
    up, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    field = lambda x: f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"
    leaf = lambda text: f"sha256({' || '.join(field(x) for x in ('doc_id', 'source', 'lang', 'n_chars', text))})"
    # CRC-32 by shifts: the list holds each byte and then eight times -1
    crc = ("xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(str_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), "
           "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))")
    out = [f"""base AS (
  SELECT doc_id, lang, {leaf('text')} AS leaf, coalesce({crc} % 3 = 0, false) AS bad, {leaf(f"translate(text, '{up}', '{low}')")} AS other FROM documents),
list_of AS (SELECT *, CASE WHEN bad THEN other ELSE leaf END AS start, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM base),
a0 AS (SELECT lang AS tree, pos, leaf AS d FROM list_of)"""]

    def climb(name: str) -> None:
        for k in range(levels):
            out.append(f"""{name}r{k} AS (
  SELECT tree, pos // 8 AS pos, list(d ORDER BY pos) AS run, sum(count(*)) OVER (PARTITION BY tree) > 1 AS more FROM {name}{k} GROUP BY tree, pos // 8),
{name}{k + 1} AS (SELECT tree, pos, CASE WHEN more THEN sha256(array_to_string(run, '')) ELSE run[1] END AS d FROM {name}r{k})""")

    climb("a")
    out.append(f"""subs AS (SELECT tree AS lang, d AS subroot, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place FROM a{levels}),
b0 AS (SELECT 0 AS tree, place AS pos, subroot AS d FROM subs)""")
    climb("b")
    out.append("""s0 AS (SELECT r.*, s.place, s.subroot, start AS cur, '' AS proof FROM list_of r JOIN subs s ON r.lang IS NOT DISTINCT FROM s.lang)""")
    names = [(f"ar{k}", "s.lang", f"(s.pos // {8 ** k})") for k in range(levels)] + [(f"br{k}", "0", f"(s.place // {8 ** k})") for k in range(levels)]
    for k, (runs, tree, at) in enumerate(names):
        left, right = f"g.run[1:{at} % 8]", f"g.run[{at} % 8 + 2:]"
        out.append(f"""s{k + 1} AS (
  SELECT s.* REPLACE (CASE WHEN g.more THEN sha256(array_to_string(list_concat(CASE WHEN {at} % 8 = 0 THEN [] ELSE {left} END, [s.cur], {right}), '')) ELSE s.cur END AS cur,
                      CASE WHEN g.more THEN s.proof || array_to_string(list_concat(CASE WHEN {at} % 8 = 0 THEN [] ELSE {left} END, {right}), '') ELSE s.proof END AS proof)
  FROM s{k} s JOIN {runs} g ON g.tree IS NOT DISTINCT FROM {tree} AND g.pos = {at} // 8)""")
    steps = ",\n".join(out)
    return f"""
WITH {steps}
SELECT s.doc_id, s.leaf, s.subroot, b.d AS root, sha256(s.proof) AS proof_sha256, s.cur AS folded_root, s.cur = b.d AS verified
FROM s{len(names)} s, b{levels} b"""
