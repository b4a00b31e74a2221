"""Packing token sequences by first-fit decreasing over a tournament tree.

A document's ids, ended by one end id, are cut into pieces of ``length`` ids;
the last piece is what is left.  Pieces are dealt into randomised groups of
about ``group_pieces`` pieces.  Within a group, pieces go by falling length
into the first sequence with room; a tournament tree over the sequences'
free capacities finds it in logarithmic time.  Groups are independent, so
packing takes one shuffle of small rows; texts are never shuffled.

The ids are those of the ``tokenizers`` library for the same byte-level
vocabulary; the ranks file read by ``tiktoken`` gives equal ids (the tests
compare them) in a quarter of the time.  The vocabulary's added tokens, which
that library finds inside text, are split off first, the longest of the
leftmost; with ``added={}`` such strings are ordinary text.  What lies between is encoded part by part if it is long.  It
is cut where no token can reach over: the vocabulary's pattern splits text
into pieces first, and a piece ends for certain before a lone space or line
end behind a letter or digit, and between a letter and a digit or mark.  A
text without any such place (one word of megabytes) is encoded whole.

Defined cases: null or empty text has the end id alone; repeated rows are
packed each; a null doc_id is carried.  A very long text is cut in one pass, a
million characters at a time.  Pieces of equal length go by doc_id, start and
checksum.  An empty table gives no pieces.
Other columns are not read.
"""

from __future__ import annotations

import itertools
import json
import re
import zlib

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import giving_back, slices, written

LONG = 1 << 20
# Behind the match a piece of the vocabulary's pattern ends: letters, numbers and other
# visible characters never share one (but for contractions, so no quotes), and a
# blank begins one unless blanks follow.
_SAFE = regex.compile(r"[\p{L}\p{N}](?= [\p{L}\p{N}])|\p{L}(?=\p{N}|[^\s\p{L}\p{N}'’])|\p{N}(?=\p{L}|[^\s\p{L}\p{N}'’])|[^\s\p{L}\p{N}'’](?=\p{L}|\p{N})")


def default_ranks() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_added() -> dict[str, int]:
    """The added tokens of the vocabulary and their ids."""
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        found = json.load(file)["added_tokens"]
    if any(x[k] for x in found for k in ("single_word", "lstrip", "rstrip")):
        raise ValueError("added tokens that depend on their surroundings")
    return {x["content"]: x["id"] for x in found}


class Encoder:
    """Little-endian unsigned 32-bit ids of texts; strings of ``added`` have ids of their own."""

    def __init__(self, path: str, added: dict[str, int] | None = None):
        import base64

        import public_tokenizers
        import tiktoken
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.added = {k: v.to_bytes(4, "little") for k, v in (added or {}).items()}
        self.marks = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    def encode(self, text: str) -> bytes:
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()

    def parts(self, text: str):
        """The text's ids, about LONG characters at a time."""
        at = 0
        for mark in self.marks.finditer(text) if self.marks else ():
            yield from self.plain(text[at:mark.start()])
            yield self.added[mark[0]]
            at = mark.end()
        yield from self.plain(text[at:] if at else text)

    def plain(self, text: str):
        """The same for a text without added tokens."""
        at = 0
        while len(text) - at > LONG:
            found = _SAFE.search(text, at + LONG)
            if not found:
                break
            yield self.encode(text[at:found.end()])
            at = found.end()
        yield self.encode(text[at:] if at else text)


def _pieces(path: str, length: int, end_id: int, added: dict[str, int] | None):
    def cut(encoder, text):
        """(start, length, crc) of each piece and the number of ids."""
        held, start, out = b"", 0, []
        for part in itertools.chain(encoder.parts(text), [end_id.to_bytes(4, "little")]):
            part, at = memoryview(held + part), 0
            while len(part) - at > 4 * length:
                out.append((start, length, zlib.crc32(part[at:at + 4 * length])))
                at, start = at + 4 * length, start + length
            held = bytes(part[at:])
        out.append((start, len(held) // 4, zlib.crc32(held)))
        return out, start + len(held) // 4

    def run(batches):
        encoder = Encoder(path, added)
        for batch in slices(batches, "text"):
            rows, starts, lengths, crcs, totals = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                found, total = cut(encoder, text or "")
                for s, n, crc in found:
                    rows.append(i), starts.append(s), lengths.append(n), crcs.append(crc), totals.append(total)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals))],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
    return run


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None,
           length: int = 1024, end_id: int = 0, added: dict[str, int] | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: one row per piece."""
    pair = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("doc_id", pair.schema[0].dataType)] + [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens")])
    return pair.mapInArrow(giving_back(_pieces(ranks or default_ranks(), length, end_id, default_added() if added is None else added)), schema)


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[int]:
    """The bin of each piece; ``lengths`` must fall.  ``tree`` holds, for every
    subtree of bins, the largest free capacity: the winner of its matches."""
    leaves = 1 << max(0, len(lengths) - 1).bit_length()
    tree, bins = [capacity] * (2 * leaves), []
    for n in lengths:
        at = 1
        while at < leaves:
            at *= 2
            if tree[at] < n:
                at += 1
        bins.append(at - leaves)
        tree[at] -= n
        while at > 1:
            at >>= 1
            most = max(tree[2 * at], tree[2 * at + 1])
            if tree[at] == most:
                break
            tree[at] = most
    return bins


def _pack(capacity: int):
    def run(group):
        group = group.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], ignore_index=True)
        bins, filled, offsets = first_fit_decreasing(group["length"].tolist(), capacity), {}, []
        for b, n in zip(bins, group["length"].tolist(), strict=True):
            offsets.append(filled.get(b, 0))
            filled[b] = offsets[-1] + n
        return group.assign(sequence_id=group["deal"].astype("int64") * (1 << 24) + bins, offset=offsets).drop(columns="deal")
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None,
         length: int = 1024, end_id: int = 0, group_pieces: int = 4096, added: dict[str, int] | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece."""
    cut = written(pieces(docs, id_col, text_col, ranks, length, end_id, added), "pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    # the row's number keeps repeated rows from meeting in one group
    deal = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)).cast("long")
    schema = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return cut.withColumn("deal", deal).groupBy("deal").applyInPandas(_pack(length), schema)
