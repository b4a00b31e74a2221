"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of ``window`` bytes, forwards and backwards, and
labels every byte; a document's probabilities are the means over all its
bytes, so whole texts count.  It is trained in numpy by backpropagation
through time (Adam) on a bounded sample: about ``per_language`` documents of
each language, chosen by a hash of the id, and ``windows_per_doc`` windows of
each.  Only text and language of the given training rows are learned from;
a prediction reads the text alone.

Defined cases: a text that is null or has no letter is ``und`` with score 0.
Training rows without language are left out; with no training rows at all
every document is ``und``.  Equal texts get equal answers; repeated rows are
answered each.  A long text is read window by window.  Other columns are
carried by ``with_language`` untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import byte_view, giving_back, slices

UNKNOWN = "und"
PADDED = 8192   # windows, sorted by size, that are padded to the longest of them
AT_ONCE = 1024  # of these, windows labelled at a time: a worker holds their states, some 8 KB each


class ByteGRU:
    """Two GRUs of ``hidden`` units over byte windows and a softmax per byte.

    One step, for each direction, with x the byte's row of gate inputs:
    z, r = sigmoid(x_zr + U_zr h);  c = tanh(x_c + r * (U_c h + b));  h = z h + (1 - z) c.
    Parameters are kept as [2 directions, ...]; activations are features x batch.
    """

    def __init__(self, classes: int, hidden: int = 8, seed: int = 1):
        rng, scale = np.random.default_rng(seed), 1 / np.sqrt(hidden)
        self.hidden, self.classes = hidden, classes
        self.w = {
            "x": (rng.normal(size=(2, 256, 3 * hidden)) * 0.3).astype(np.float32),
            "u": (rng.normal(size=(2, 3 * hidden, hidden)) * scale).astype(np.float32),
            "b": np.zeros((2, hidden, 1), np.float32),
            "o": (rng.normal(size=(classes, 2 * hidden)) * scale).astype(np.float32),
            "c": np.zeros((classes, 1), np.float32),
        }

    def _scan(self, d: int, seq: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States [T, hidden, B] of direction d over seq [T, B]."""
        n, w = self.hidden, self.w
        x, u, b = w["x"][d].copy(), w["u"][d].copy(), w["b"][d]
        x[:, :2 * n] *= 0.5  # sigmoid(a) = 0.5 + 0.5 tanh(a / 2)
        u[:2 * n] *= 0.5
        states = np.empty((len(seq), n, seq.shape[1]), np.float32)
        h = np.zeros((n, seq.shape[1]), np.float32)
        for t in range(len(seq)):
            g = np.take(x, seq[t], axis=0).T
            a = u @ h
            zr = a[:2 * n]
            zr += g[:2 * n]
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            uc = a[2 * n:]
            uc += b
            c = zr[n:] * uc
            c += g[2 * n:]
            np.tanh(c, out=c)
            if keep is not None:
                keep.append((h, zr.copy(), uc.copy(), c.copy()))
            h = c + zr[:n] * (h - c)
            states[t] = h
        return states

    def _probabilities(self, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
        """[T, classes, B] for each byte; backward's states are in reading order."""
        n = self.hidden
        logits = np.matmul(self.w["o"][:, :n], forward) + np.matmul(self.w["o"][:, n:], backward) + self.w["c"]
        np.clip(logits, -30, 30, out=logits)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def label(self, seq: np.ndarray) -> np.ndarray:
        """Probabilities [T, classes, B] for bytes [T, B]."""
        return self._probabilities(self._scan(0, seq), self._scan(1, seq[::-1])[::-1])

    def gradients(self, seq: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
        """Mean cross-entropy over the bytes in ``mask`` [T, B], and its gradients."""
        n, w, kept = self.hidden, self.w, ([], [])
        forward = self._scan(0, seq, kept[0])
        backward = self._scan(1, seq[::-1], kept[1])[::-1]
        p = self._probabilities(forward, backward)
        hit = p[:, labels, np.arange(len(labels))]
        loss = -(np.log(hit + 1e-9) * mask).sum() / mask.sum()
        p[:, labels, np.arange(len(labels))] -= 1
        p *= mask[:, None, :] / mask.sum()
        g = {k: np.zeros_like(v) for k, v in w.items()}
        g["o"][:, :n] = np.einsum("tcb,thb->ch", p, forward, optimize=True)
        g["o"][:, n:] = np.einsum("tcb,thb->ch", p, backward, optimize=True)
        g["c"][:, 0] = p.sum(axis=(0, 2))
        for d, (order, part) in enumerate(((seq, w["o"][:, :n]), (seq[::-1], w["o"][:, n:]))):
            from_out = np.matmul(part.T, p if d == 0 else p[::-1])
            dh, u = np.zeros((n, seq.shape[1]), np.float32), w["u"][d]
            for t in range(len(seq) - 1, -1, -1):
                h, zr, uc, c = kept[d][t]
                z, r = zr[:n], zr[n:]
                dh = dh + from_out[t]
                dc = dh * (1 - z) * (1 - c * c)
                da = np.concatenate([dh * (h - c) * z * (1 - z), dc * uc * r * (1 - r), dc * r])
                g["u"][d] += da @ h.T
                g["b"][d] += da[2 * n:].sum(axis=1, keepdims=True)
                np.add.at(g["x"][d], order[t], np.concatenate([da[:2 * n], dc]).T)
                dh = dh * z + u.T @ da
        return float(loss), g

    def fit(self, windows: np.ndarray, masks: np.ndarray, labels: np.ndarray, steps: int = 240, batch: int = 256, rate: float = 0.02, seed: int = 1) -> ByteGRU:
        """windows, masks [N, T]; labels [N]."""
        rng = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(x) for k, x in self.w.items()} for _ in range(2))
        for step in range(1, steps + 1):
            some = rng.integers(0, len(windows), batch)
            _, g = self.gradients(np.ascontiguousarray(windows[some].T), np.ascontiguousarray(masks[some].T), labels[some])
            size = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
            now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, x in g.items():
                x *= min(1.0, 1.0 / (size + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * x
                v[k] = 0.99 * v[k] + 0.01 * x * x
                self.w[k] -= (now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
        return self


def cut_windows(lengths: np.ndarray, offsets: np.ndarray, window: int):
    """Start, length and row of the windows that cover each text."""
    count = -(-lengths // window)
    rows = np.repeat(np.arange(len(lengths)), count)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
    starts = offsets[rows] + nth * window
    return starts, np.minimum(window, offsets[rows] + lengths[rows] - starts), rows


def pooled(model: ByteGRU, data: np.ndarray, offsets: np.ndarray, window: int, at_once: int = AT_ONCE) -> np.ndarray:
    """Mean class probabilities [rows, classes] over all bytes of each text."""
    lengths = np.diff(offsets)
    starts, sizes, rows = cut_windows(lengths, offsets[:-1], window)
    total = np.zeros((len(lengths), model.classes))
    padded = np.concatenate([data, np.zeros(window, np.uint8)])
    order = np.argsort(sizes, kind="stable")  # short windows together, cut to their longest
    for i in range(0, len(order), PADDED):
        alike = order[i:i + PADDED]
        most = int(sizes[alike].max())
        for j in range(0, len(alike), at_once):
            some = alike[j:j + at_once]
            inside = np.arange(most)[:, None] < sizes[some]
            seq = np.where(inside, padded[starts[some] + np.arange(most)[:, None]], 0)
            p = model.label(seq)
            p *= inside[:, None, :]
            sums = p.sum(axis=0)
            for k in range(model.classes):
                total[:, k] += np.bincount(rows[some], weights=sums[k], minlength=len(lengths))
    return total / np.maximum(lengths, 1)[:, None]


def _sample_windows(window: int, per_doc: int):
    def run(batches):
        for batch in slices(batches, "text"):
            data, offsets = byte_view(batch.column(0))
            lengths, out, rows = np.diff(offsets), [], []
            for i, n in enumerate(lengths):
                step = max(window, int(n) // per_doc)
                for at in range(0, int(n), step)[:per_doc]:
                    out.append(data[offsets[i] + at:offsets[i] + min(at + window, int(n))].tobytes())
                    rows.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), batch.column(1).take(pa.array(rows, pa.int64()))], ["bytes", "lang"])
    return run


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", hidden: int = 8, window: int = 64,
          per_language: int = 600, windows_per_doc: int = 8, steps: int = 240, seed: int = 1) -> tuple[ByteGRU | None, list[str]]:
    """A model and its languages.  The driver gathers at most about
    languages x per_language x windows_per_doc windows of ``window`` bytes."""
    rows = rows.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col)).alias("hash")).where("lang IS NOT NULL AND length(text) > 0")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per language
    if not counts:
        return None, []
    languages = sorted(counts)
    spread = F.pmod(F.col("hash"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rate = F.lit(0.0)
    for lang in languages:
        rate = F.when(F.col("lang") == lang, F.lit(min(1.0, per_language / counts[lang]))).otherwise(rate)
    sample = rows.where(spread < rate).select("text", "lang").mapInArrow(giving_back(_sample_windows(window, windows_per_doc)), "bytes binary, lang string")
    found = sorted((r["lang"], bytes(r["bytes"])) for r in sample.collect())  # bounded sample; sorted: reruns agree
    data = np.frombuffer(b"".join(x.ljust(window, b"\0") for _, x in found), np.uint8).reshape(-1, window)
    masks = (np.arange(window) < np.array([len(x) for _, x in found])[:, None]).astype(np.float32)
    labels = np.array([languages.index(lang) for lang, _ in found])
    rng = np.random.default_rng(seed)
    sizes = np.bincount(labels, minlength=len(languages))
    even = np.concatenate([rng.choice(np.flatnonzero(labels == k), sizes.max()) for k in range(len(languages)) if sizes[k]])
    model = ByteGRU(len(languages), hidden, seed)
    return model.fit(data[even], masks[even], labels[even], steps, seed=seed), languages


def _answers(model: ByteGRU | None, languages: list[str], window: int, at: int | None = None):
    def with_text(batch):
        return batch if at is None else pa.RecordBatch.from_arrays([batch.column(0), batch.column(0).field(at)], ["row", "text"])

    def run(batches):
        for batch in slices(map(with_text, batches), "text"):
            column = batch.column(1)
            if model is None:
                names, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            else:
                p = pooled(model, *byte_view(column), window)
                letters = [bool(x) and any(map(str.isalpha, x)) for x in column.to_pylist()]
                names = [languages[k] if ok else UNKNOWN for k, ok in zip(p.argmax(axis=1), letters, strict=True)]
                scores = [min(1.0, float(s)) if ok else 0.0 for s, ok in zip(p.max(axis=1), letters, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["row", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: ByteGRU | None, languages: list[str], text_col: str = "text", window: int = 64) -> DataFrame:
    """row (a struct of docs' columns), lang_pred, score."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    # a string is read inside the row: sent beside it, whole texts would be held twice by both sides
    at = next((i for i, f in enumerate(docs.schema) if f.name == text_col and f.dataType == T.StringType()), None)
    whole = docs.select(row) if at is not None else docs.select(row, F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([whole.schema[0], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return whole.mapInArrow(giving_back(_answers(model, languages, window, at)), schema)


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id's text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", window: int = 64) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; learns from the rows that aren't held out."""
    model, languages = train(docs.where(~held_out(id_col)), text_col, lang_col, id_col, window=window)
    pair = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = predict(pair, model, languages, window=window)
    return out.select("row.doc_id", "lang_pred", "score").withColumn("held_out", held_out("doc_id")).select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    window: int = 64, least: float = 0.4) -> DataFrame:
    """``docs`` without the documents that language ID rejects: unknown, or scored below ``least``."""
    model, languages = train(docs.where(~held_out(id_col)), text_col, lang_col, id_col, window=window)
    return predict(docs, model, languages, text_col, window).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("row.*")
