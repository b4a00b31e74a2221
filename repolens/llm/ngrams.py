"""Language-model scores from an interpolated modified Kneser-Ney bigram model.

Counted in Spark, in three passes over the training texts' tokens:

1. Vocabulary.  Tasks count their words' 64-bit hashes, parts (ranges of the
   hash) add them up and write sorted arrays of hashes, counts and running
   counts.  A word's id is its place in that order.
2. Bigrams.  Tasks count pairs of ids; a pair's part follows the running
   counts, so parts hold equal shares of all tokens, and a very frequent
   context is split over several.  Parts write sorted arrays of pairs and
   counts and of their contexts' sums; contexts that cross parts (one a
   boundary at most) are added up by the driver.
3. Continuations: in how many contexts a word follows, by the vocabulary's parts.

Workers map the arrays into memory and look up each slice's distinct words
and pairs, in order.  With c the pair's count, n its context's, and D the
discounts for 1, 2 and 3 or more that the counts of counts give:

    p(w | v) = (c - D(c)) / n + (D1 N1 + D2 N2 + D3 N3) / n * p(w)

p(w) is the same over continuation counts, interpolated with 1 / (V + 1).

A text's tokens are its words with A-Z lower-cased, then one end; the first
has the begin context.  The order is two: counts of triples of these texts
are nearly as many as the tokens, so they take more room than they tell.

Defined cases: null text is empty, its only token the end.  A null doc_id
belongs to the training rows.  With no training rows every token scores 0
(probability 1 of V + 1 = 1).  Repeated rows count, and are scored, each.
Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import mix64, scratch, slices, word_hashes, written
from repolens.llm.repeats import by_part
from repolens.llm.store import Store

END = mix64(np.array([0x656E64], np.uint64))[0]
HELD = 3_000_000  # distinct keys that a task gathers before it sends them on


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id's text, modulo 10, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def token_hashes(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens, the first token of each row and every token's row."""
    _, offsets, _, _, rows, hashes = word_hashes(column, lower=True)
    bounds, n = np.searchsorted(rows, np.arange(len(offsets))), len(offsets) - 1
    out = np.empty(len(hashes) + n, np.uint64)
    ends = bounds[1:] + np.arange(n)
    word = np.ones(len(out), bool)
    word[ends] = False
    out[word], out[ends] = hashes, END
    return out, bounds[:-1] + np.arange(n), np.repeat(np.arange(n), np.diff(bounds) + 1)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and their sums."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts[order], first)


def _planes(x: np.ndarray) -> bytes:
    """Bytes of equal weight together: the high, mostly zero ones compress well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()


def _unplaned(blob: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def _sent(keys: np.ndarray, counts: np.ndarray, part: np.ndarray):
    """A row of each part; keys are sorted and parts follow their order.  Keys go
    as the steps between them in the high half and the low half as it is."""
    cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True]))) if len(part) else np.zeros(1, np.int64)
    at, blobs, sums = [], [], []
    for x, y in zip(cuts[:-1], cuts[1:], strict=True):
        high, low = (keys[x:y] >> np.uint64(32)).astype(np.uint32), keys[x:y].astype(np.uint32)
        at.append(int(part[x]))
        blobs.append(_planes(np.concatenate([np.diff(high, prepend=np.uint32(0)), low])))
        sums.append(_planes(counts[x:y].astype(np.uint64)))
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(blobs, pa.binary()), pa.array(sums, pa.binary())], ["part", "keys", "counts"])


def _received(blob: bytes) -> np.ndarray:
    both = _unplaned(blob, np.uint32)
    high = np.cumsum(both[:len(both) // 2], dtype=np.uint32).astype(np.uint64)
    return (high << np.uint64(32)) | both[len(both) // 2:]


_SENT = "part int, keys binary, counts binary"


def _counted(keys_of, part_of):
    """Sums of the keys of a task's slices, sent by part."""
    def run(batches):
        held, size = [], 0
        for batch in slices(batches, "text"):
            keys = np.sort(keys_of(batch.column(0)))
            held.append(summed(keys, np.ones(len(keys), np.uint64)))
            size += len(held[-1][0])
            if size > HELD:
                keys, counts = summed(*map(np.concatenate, zip(*held, strict=True)))
                held, size = [(keys, counts)], len(keys)
                if size > HELD // 2:
                    yield _sent(keys, counts, part_of(keys))
                    held, size = [], 0
        if held:
            keys, counts = summed(*map(np.concatenate, zip(*held, strict=True)))
            yield _sent(keys, counts, part_of(keys))
    return run


def _hash_part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _write_vocabulary(store: Store):
    def run(batches):
        for held in by_part(batches, ["part", "keys", "counts"]):
            part = held["part"][0]
            keys, counts = summed(np.concatenate([_received(x) for x in held["keys"]]), np.concatenate([_unplaned(x, np.uint64) for x in held["counts"]]))
            store.write(f"word-{part}", keys)
            store.write(f"count-{part}", counts)
            store.write(f"upto-{part}", np.cumsum(counts, dtype=np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([len(keys)], pa.int64()), pa.array([int(counts.sum())], pa.int64())], ["part", "words", "tokens"])
    return run


@dataclass
class Vocabulary:
    """Ids, counts and running counts of words; one part's arrays at a time."""

    store: Store
    parts: int
    words: np.ndarray   # words before each part
    tokens: np.ndarray  # tokens before each part
    opened: dict = field(default_factory=dict)

    @property
    def size(self) -> int:
        return int(self.words[-1])

    @property
    def total(self) -> int:
        return int(self.tokens[-1])

    def array(self, name: str, part: int, dtype) -> np.ndarray:
        if (name, part) not in self.opened:
            self.opened[name, part] = self.store.read(f"{name}-{part}", dtype)
        return self.opened[name, part]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """id (-1: unknown), count and tokens before, for sorted hashes."""
        ids, counts, before = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        cuts = np.searchsorted(_hash_part(hashes, self.parts), np.arange(self.parts + 1))
        for part in np.flatnonzero(np.diff(cuts)):
            x, y = cuts[part], cuts[part + 1]
            words = self.array("word", part, np.uint64)
            if not len(words):
                continue
            at = np.minimum(np.searchsorted(words, hashes[x:y]), len(words) - 1)
            hit = np.flatnonzero(words[at] == hashes[x:y])
            at = at[hit]
            ids[x + hit] = at + self.words[part]
            counts[x + hit] = self.array("count", part, np.uint64)[at].astype(np.int64)
            before[x + hit] = self.array("upto", part, np.uint64)[at].astype(np.int64) - counts[x + hit] + self.tokens[part]
        return ids, counts, before


class Places:
    """A slice's tokens by id, and the parts of pairs."""

    def __init__(self, vocabulary: Vocabulary, begins: int):
        self.vocabulary, self.begins = vocabulary, begins

    def tokens(self, column):
        """Per token: distinct word's number; per distinct word: id, count, tokens before.  Begin is id V."""
        hashes, first, rows = token_hashes(column)
        distinct, number = np.unique(hashes, return_inverse=True)
        return number, first, rows, *self.vocabulary.find(distinct)

    def part(self, context: np.ndarray, count: np.ndarray, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        v, n = self.vocabulary, max(1, self.vocabulary.total + self.begins)
        place = (before + count * (word / (v.size + 1))) / n * v.parts
        return np.minimum(place.astype(np.int64), v.parts - 1)

    def pairs(self, column):
        """Per token: context's number (-1: begin) and word's number; the rest as tokens()."""
        number, first, rows, ids, counts, before = self.tokens(column)
        context = np.empty_like(number)
        context[1:] = number[:-1]
        context[first] = -1
        v = self.vocabulary
        # one more entry, reached as number -1: the begin context
        return context, number, first, rows, np.append(ids, v.size), np.append(counts, self.begins), np.append(before, v.total)


def _send_pairs(places: Places):
    def run(batches):
        held, size = [], 0

        def all_of(held):
            keys, parts, counts = map(np.concatenate, zip(*held, strict=True))
            order = np.argsort(keys, kind="stable")
            first = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1])))
            return keys[order][first], parts[order][first], np.add.reduceat(counts[order], first)

        for batch in slices(batches, "text"):
            context, word, _, _, ids, counts, before = places.pairs(batch.column(0))
            keys, first, many = np.unique((ids[context] << 32 | ids[word]).astype(np.uint64), return_index=True, return_counts=True)
            c, w = context[first], word[first]
            held.append((keys, places.part(ids[c], counts[c], before[c], ids[w]), many.astype(np.uint64)))
            size += len(keys)
            if size > HELD:
                held = [all_of(held)]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield _sent(held[0][0], held[0][2], held[0][1])
                    held, size = [], 0
        if held:
            keys, parts, counts = all_of(held)
            yield _sent(keys, counts, parts)
    return run


_PAIRS = "part int, keys binary, counts binary, pairs long, n1 long, n2 long, n3 long, n4 long"


def _write_pairs(store: Store, vocabulary: Vocabulary):
    """Arrays of one part's pairs and contexts.  A row without part says how many
    pairs, counts of 1 to 4, and sums of its first and last contexts, which may
    go on in other parts.  The others hold continuation counts by vocabulary part."""
    def run(batches):
        for held in by_part(batches, ["part", "keys", "counts"]):
            part = held["part"][0]
            keys, counts = summed(np.concatenate([_received(x) for x in held["keys"]]), np.concatenate([_unplaned(x, np.uint64) for x in held["counts"]]))
            store.write(f"pair-{part}", keys)
            store.write(f"times-{part}", counts)
            contexts = keys >> np.uint64(32)
            first = np.flatnonzero(np.concatenate(([True], contexts[1:] != contexts[:-1])))
            sums = np.stack([np.add.reduceat(x, first) for x in (counts, (counts == 1).astype(np.uint64), (counts == 2).astype(np.uint64), (counts > 2).astype(np.uint64))], 1)
            store.write(f"context-{part}", contexts[first])
            store.write(f"sums-{part}", sums)
            edge = sorted({0, len(first) - 1})
            words, many = summed(keys & np.uint64(0xFFFFFFFF), np.ones(len(keys), np.uint64))
            home = np.searchsorted(vocabulary.words, words.astype(np.int64), "right") - 1
            sent = _sent(words, many, home)
            rows = sent.num_rows
            ns = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
            yield pa.RecordBatch.from_arrays([
                pa.array([-1 - part, *sent.column(0).to_pylist()], pa.int32()), pa.array([contexts[first][edge].tobytes(), *sent.column(1).to_pylist()], pa.binary()),
                pa.array([sums[edge].tobytes(), *sent.column(2).to_pylist()], pa.binary()),
                *(pa.array([x] + [0] * rows, pa.int64()) for x in (len(keys), *ns))], [x.split()[0] for x in _PAIRS.split(", ")])
    return run


def _write_continuations(store: Store, vocabulary: Vocabulary):
    def run(batches):
        for held in by_part(batches, ["part", "keys", "counts"]):
            part = held["part"][0]
            words, counts = summed(np.concatenate([_received(x) for x in held["keys"]]), np.concatenate([_unplaned(x, np.uint64) for x in held["counts"]]))
            dense = np.zeros(int(vocabulary.words[part + 1] - vocabulary.words[part]), np.uint64)
            dense[words.astype(np.int64) - vocabulary.words[part]] = counts
            store.write(f"after-{part}", dense)
            yield pa.RecordBatch.from_arrays([pa.array([int((counts == k).sum()) for _ in (0,)], pa.int64()) for k in (1, 2, 3, 4)] + [pa.array([int((counts > 2).sum())], pa.int64())],
                                             ["n1", "n2", "n3", "n4", "more"])
    return run


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """For counts of 0, 1, 2 and 3 or more; a class without counts of its size
    or the next takes half of what it may lose at most one of."""
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    d1 = 1 - 2 * y * n2 / n1 if n1 and n2 else 0.5
    d2 = 2 - 3 * y * n3 / n2 if n2 and n3 else 0.5
    d3 = 3 - 4 * y * n4 / n3 if n3 and n4 else 0.5
    return np.clip(np.array([0.0, d1, d2, d3]), [0, 0.05, 0.05, 0.05], [0, 0.95, 1.95, 2.95])


@dataclass
class Model:
    vocabulary: Vocabulary
    begins: int
    pairs: int
    pair_discounts: np.ndarray
    word_discounts: np.ndarray
    word_rest: float               # what the discounts leave for 1 / (V + 1)
    edge_contexts: np.ndarray      # sorted ids of contexts in several parts
    edge_sums: np.ndarray

    def continuation(self, ids: np.ndarray) -> np.ndarray:
        """p(w) for sorted or unknown (-1) ids."""
        v, out = self.vocabulary, np.zeros(len(ids))
        known = np.flatnonzero(ids >= 0)
        home = np.searchsorted(v.words, ids[known], "right") - 1
        for part in np.unique(home):
            some = known[home == part]
            counts = np.asarray(v.array("after", part, np.uint64)[ids[some] - v.words[part]], np.float64)
            out[some] = counts - self.word_discounts[np.minimum(counts, 3).astype(np.int64)]
        return np.maximum(out, 0) / max(1, self.pairs) + self.word_rest / (v.size + 1)

    def probability(self, places: Places, context_id, count, before, word_id, word_p) -> np.ndarray:
        """p(w | v) of distinct pairs."""
        v, out = self.vocabulary, np.array(word_p)
        known = np.flatnonzero(context_id >= 0)
        if not len(known):
            return out
        c, w = context_id[known], np.maximum(word_id[known], 0)
        sums = np.zeros((len(known), 4))
        home = places.part(c, count[known], before[known], np.zeros(len(known)))
        for part in np.unique(home):
            some = np.flatnonzero(home == part)
            ids = v.array("context", part, np.uint64)
            if len(ids):
                at = np.minimum(np.searchsorted(ids, c[some].astype(np.uint64)), len(ids) - 1)
                hit = ids[at] == c[some].astype(np.uint64)
                sums[some[hit]] = v.array("sums", part, np.uint64).reshape(-1, 4)[at[hit]]
        if len(self.edge_contexts):
            at = np.minimum(np.searchsorted(self.edge_contexts, c), len(self.edge_contexts) - 1)
            hit = self.edge_contexts[at] == c
            sums[hit] = self.edge_sums[at[hit]]
        times = np.zeros(len(known))
        keys, part = (c << 32 | w).astype(np.uint64), places.part(c, count[known], before[known], w)
        for p in np.unique(part):
            some = np.flatnonzero((part == p) & (word_id[known] >= 0))
            pairs = v.array("pair", p, np.uint64)
            if len(pairs) and len(some):
                order = some[np.argsort(keys[some], kind="stable")]
                at = np.minimum(np.searchsorted(pairs, keys[order]), len(pairs) - 1)
                hit = pairs[at] == keys[order]
                times[order[hit]] = v.array("times", p, np.uint64)[at[hit]]
        d, n = self.pair_discounts, sums[:, 0]
        seen = n > 0
        rest = sums[:, 1:] @ d[1:]
        own = times - d[np.minimum(times, 3).astype(np.int64)]
        out[known[seen]] = (np.maximum(own, 0)[seen] + rest[seen] * out[known][seen]) / n[seen]
        return out


def _dealt(df: DataFrame, parts: int) -> DataFrame:
    return df.repartition(parts, "part").sortWithinPartitions("part")


def train(texts: DataFrame, parts: int | None = None) -> Model:
    """The model of texts(text).  The driver gathers a few numbers for each part."""
    spark = texts.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    store = Store(scratch(spark, "bigrams"))
    sent = texts.mapInArrow(_counted(lambda column: token_hashes(column)[0], lambda keys: _hash_part(keys, parts)), _SENT)
    found = _dealt(sent, parts).mapInArrow(_write_vocabulary(store), "part int, words long, tokens long").collect()
    sizes = np.zeros((parts, 2), np.int64)
    for row in found:
        sizes[row["part"]] = row["words"], row["tokens"]
    words, tokens = np.concatenate((np.zeros((1, 2), np.int64), np.cumsum(sizes, axis=0))).T
    vocabulary = Vocabulary(store, parts, words, tokens)
    begins = int(Vocabulary(store, parts, words, tokens).find(np.array([END]))[1][0]) if len(found) else 0
    if not begins:
        return Model(vocabulary, 0, 0, np.zeros(4), np.zeros(4), 1.0, np.zeros(0, np.int64), np.zeros((0, 4)))
    pairs = _dealt(texts.mapInArrow(_send_pairs(Places(vocabulary, begins)), _SENT), parts)
    summary = written(pairs.mapInArrow(_write_pairs(store, vocabulary), _PAIRS), "bigram-parts")
    total, ns, edges = 0, np.zeros(4, np.int64), {}
    for row in summary.where("part < 0").collect():  # one row per part
        total += row["pairs"]
        ns += [row[f"n{k}"] for k in (1, 2, 3, 4)]
        for c, s in zip(np.frombuffer(row["keys"], np.uint64).tolist(), np.frombuffer(row["counts"], np.uint64).reshape(-1, 4), strict=True):
            edges[c] = edges.get(c, 0) + s.astype(np.float64)
    after = _dealt(summary.where("part >= 0").select("part", "keys", "counts"), parts)
    of_counts = after.mapInArrow(_write_continuations(store, vocabulary), "n1 long, n2 long, n3 long, n4 long, more long").agg(*[F.sum(x) for x in ("n1", "n2", "n3", "n4", "more")]).first()
    by_word = discounts(*of_counts[:4])
    rest = float(by_word[1:] @ np.array([of_counts[0], of_counts[1], of_counts[4]])) / total
    ids = np.array(sorted(edges), np.int64)
    return Model(vocabulary, begins, total, discounts(*ns.tolist()), by_word, rest, ids, np.array([edges[i] for i in ids.tolist()]))


def _scores(model: Model):
    def run(batches):
        places = Places(model.vocabulary, model.begins)
        v = model.vocabulary
        for batch in slices(batches, "text"):
            context, word, _, rows, ids, counts, before = places.pairs(batch.column(1))
            n = batch.num_rows
            base = np.log10((counts[:-1] + 0.1) / (v.total + 0.1 * (v.size + 1)))
            word_p = model.continuation(ids[:-1])
            pair, first, number = np.unique((context + 1) * len(ids) + word, return_index=True, return_inverse=True)
            c, w = context[first], word[first]
            p = model.probability(places, ids[c], counts[c], before[c], ids[w], word_p[w])
            sums = lambda x: np.bincount(rows, weights=x, minlength=n)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(np.bincount(rows, minlength=n).astype(np.int64)), pa.array(np.bincount(rows[ids[word] >= 0], minlength=n).astype(np.int64)),
                pa.array([v.total] * n, pa.int64()), pa.array(sums(base[word])), pa.array(sums(np.log10(p)[number]))],
                ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every document."""
    pair = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("doc_id", pair.schema[0].dataType), *(T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")),
                           *(T.StructField(c, T.DoubleType()) for c in ("base_score", "score"))])
    return pair.mapInArrow(_scores(model), schema)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document; learns from the rows that aren't held out.
    Also perplexity: 10 to the minus mean log10 probability of a token."""
    texts = docs.where(~held_out(id_col)).select(F.col(text_col).cast("string").alias("text"))
    out = scores(docs, train(texts), id_col, text_col)
    return (out.withColumn("held_out", held_out("doc_id")).withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
            .select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"))
