"""Main text, language, mixing, packing and language-model scores."""

import collections
import itertools
import math
import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from repolens.llm import html_main, langid, mixing, ngrams, packing, queries
from repolens.llm.common import byte_view, giving_back
from tests.llm.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# main text -------------------------------------------------------------------
def test_minimum_cut_is_least():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 8)
        odds = [rng.uniform(-3, 3) for _ in range(n)]
        edges = [(a, b, rng.uniform(0, 2)) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.5]

        def cost(labels):
            return sum(round(1000 * abs(x)) for x, c in zip(odds, labels, strict=True) if (x > 0) != c) + sum(round(1000 * w) for a, b, w in edges if labels[a] != labels[b])

        assert cost(html_main.minimum_cut(odds, edges)) == min(cost(x) for x in itertools.product([False, True], repeat=n))


def test_main_text_of_a_page():
    page = """<!DOCTYPE html><html><head><title>No</title><script>if (a < b) { x = "<p>no</p>" }</script></head><body class="has-sidebar">
      <header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/x">Other</a></ul></nav>
      <div id="content"><h1>A title &amp; more</h1><p>The first paragraph tells a&nbsp;story, in   several
      words, about something.<p>The second one has <b>bold</b> and <a href="?a>b">linked</a> words, and it goes on.
      <!-- <p>hidden</p> --><div class="ad-box">Buy this now, the best offer of the year for all of you.</div>
      <p>The third paragraph ends the story, as a third paragraph should do.</p></div>
      <div class="comments"><p>I think that this is a very good story and would like to say more.</p></div>
      <form><label>Mail address for the newsletter of this site</label><input></form><footer>&copy; 2020 all of us"""
    assert html_main.main_text(page) == ("A title & more\n\nThe first paragraph tells a story, in several words, about something.\n\n"
                                         "The second one has bold and linked words, and it goes on.\n\nThe third paragraph ends the story, as a third paragraph should do.")
    assert [html_main.main_text(x) for x in (None, "", "<p", "<script>x", "<!-- x", "</p></div>")] == [""] * 6
    assert html_main.main_text("<article>" + "<p>word" * 3000) == "\n\n".join(["word"] * 3000)


WORDS = "The first paragraph tells a story, in several words, about something that goes on."


@pytest.mark.parametrize("head", ["<head><title>No</title>", "<head><meta charset=utf-8><link href=x><script>no</script>\n", "<head><title>No</title><html><head>", "<head><noframes>no</noframes><basefont>"])
@pytest.mark.parametrize("body", ["<body>", "", "<body class=x><div>"])
def test_an_open_head_ends_where_text_starts(head, body):
    assert html_main.main_text(f"<html>{head}{body}<p>{WORDS}<p>{WORDS}") == f"{WORDS}\n\n{WORDS}"
    assert html_main.main_text(f"<html>{head}{body}{WORDS}") == WORDS


@pytest.mark.parametrize("attributes", ['style="overflow:hidden"', "style='overflow: hidden'", 'data-id="form-3"', 'data-class="ad"', 'title="hidden class=ad"', 'aria-hidden=false', 'class="a" class="ad"'])
def test_attributes_by_their_whole_names(attributes):
    assert html_main.main_text(f"<body><article {attributes}><p>{WORDS}</article>") == WORDS
    assert html_main.main_text(f"<body><div {attributes}><p>{WORDS}</div>") == WORDS


@pytest.mark.parametrize("attributes", ["hidden", "HIDDEN", 'style="a" hidden', 'hidden=""', 'aria-hidden="true"', 'data-x="y"class="ad"', "ID=form-3", "class = 'a sidebar'", 'data-id="x" id=ad'])
def test_attributes_that_tell_boilerplate(attributes):
    assert html_main.main_text(f"<body><div {attributes}><p>{WORDS}</div><p>{WORDS}") == WORDS


NAMES = ["post-with-sidebar", "layout-with-sidebar", "content-sidebar-wrap", "main-header-fixed", "social-science-article", "form-content", "legal-text", "no-comments"]


@pytest.mark.parametrize("name", NAMES)
def test_names_are_evidence_not_verdicts(name):
    """Three good paragraphs stay, whatever the element around them is called, alone and in a page."""
    others = [f"{WORDS} Number {k} says so." for k in range(3)]
    article, text = "".join(f"<p>{x}</p>" for x in others), "\n\n".join(others)
    assert html_main.main_text(f'<body><div class="{name}">{article}</div>') == text
    page = f'<body><nav><a href=x>Home</a> <a href=y>News</a></nav><div id="{name}">{article}</div><div class="sidebar"><p>{WORDS}</p></div><footer>© all of us</footer>'
    assert html_main.main_text(page) == text
    assert html_main.main_text(f'<body><article class="post share-story {name}">{article}</article><div class="comment-body">{WORDS}</div>') == text


def test_depth_costs_what_it_is_long():
    page = "<div>" * 100_000 + f"<p>{WORDS}</p>" + "</div></section>" * 100_000 + f"<p>{WORDS}</p>"
    assert html_main.main_text(page) == f"{WORDS}\n\n{WORDS}"
    page = "".join(f"<div class='c{k}'><p>{WORDS}" for k in range(4000))
    assert html_main.main_text(page).count("tells a story") == 4000


def test_weights_are_fitted():
    rng = np.random.default_rng(3)
    rows = np.column_stack([np.ones(4000), rng.normal(size=(4000, len(html_main.FEATURES) - 1))])
    true = rng.normal(size=len(html_main.FEATURES))
    labels = rng.random(4000) < 1 / (1 + np.exp(-rows @ true))
    found = html_main.fit(rows, labels.astype(float), np.zeros(len(true)))
    agree = ((rows @ found > 0) == labels).mean()
    assert agree > 0.97 * ((rows @ true > 0) == labels).mean()
    assert (html_main.fit(rows[:0], labels[:0]) == html_main.PRIOR).all() and (html_main.fit(rows, np.ones(4000)) == html_main.PRIOR).all()


def test_odd_pages(spark):
    page = f"<nav><a href=x>Home</a></nav><article><p>{WORDS}</p></article><div class=ad>Buy this.</div>"
    rows = [(1, "u", None, "a"), (2, "u", "", "b"), (None, None, page, None), (3, "v", page, "c"), (3, "v", page, "c"), (4, "w", "<p>" + "word " * 200_000, "d"), (5, "x", "no markup at all, just a line", "e")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").withColumn("order", F.lit(1)).withColumn("features", F.lit("x")).repartition(3)
    got = sorted([(r.page_id, r.url, r.text, r.n_chars) for r in html_main.extract(pages).collect()], key=str)
    long = " ".join(["word"] * 200_000)
    expect = [(1, "u", "", 0), (2, "u", "", 0), (None, None, WORDS, len(WORDS)), (3, "v", WORDS, len(WORDS)), (3, "v", WORDS, len(WORDS)), (4, "w", long, len(long))]
    assert [x for x in got if x[0] != 5] == sorted(expect, key=str) and len(got) == 7
    assert html_main.extract(pages.where("false")).collect() == []


def test_formulas_are_text():
    formula = '<math><semantics><mrow><mi>x</mi><mspace width="1em"/><mo>=</mo><mn>2</mn></mrow><annotation encoding="application/x-tex">\\frac</annotation></semantics></math>'
    assert html_main.main_text(f"<article><p>{WORDS} So {formula} holds.<p>{WORDS}</article>") == f"{WORDS} So x=2 holds.\n\n{WORDS}"
    assert html_main.main_text(f"<article><p>{WORDS} So <math><annotation/><mi>y</mi></math> and <math/> hold.</article>") == f"{WORDS} So y and hold."


def test_pages_keep_their_articles(spark):
    pages = duckdb.sql(f"SELECT page_id, html FROM '{SMALL}/pages.parquet'").fetchall()
    out = {r.page_id: r for r in queries.QUERIES["op3_html_main_text"](spark, SMALL).collect()}
    assert len(out) == len(pages)
    import html
    for i, page in pages:
        body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"</?b>|<br>", "", x)).split()) for x in re.split(r"</?(?:h1|p)>", body)]
        assert out[i].text == "\n\n".join(x for x in parts if x) and out[i].n_chars == len(out[i].text)


# language --------------------------------------------------------------------
def test_gru_gradients():
    rng = np.random.default_rng(1)
    seq, mask, labels = rng.integers(0, 256, (9, 4)).astype(np.uint8), (rng.random((9, 4)) < 0.8).astype(float), np.array([0, 1, 2, 1])
    model = langid.ByteGRU(3, 3)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    _, g = model.gradients(seq, mask, labels)
    for k, w in model.w.items():
        at = np.unravel_index(np.abs(g[k]).argmax(), w.shape)
        was, ends = w[at], []
        for step in (1e-3, -1e-3):
            w[at] = was + step
            ends.append(model.gradients(seq, mask, labels)[0])
        w[at] = was
        assert abs((ends[0] - ends[1]) / 2e-3 - g[k][at]) < 2e-4


def test_pooling_covers_whole_texts():
    texts = ["", "a", "abc" * 50, "x" * 64, "longer text " * 40]
    model = langid.ByteGRU(2, 4, seed=3)
    data, offsets = byte_view(pa.array(texts))
    p = langid.pooled(model, data, offsets, 64, at_once=3)
    for i, t in enumerate(texts):
        b, parts = t.encode(), []
        for at in range(0, len(b), 64):
            w = np.frombuffer(b[at:at + 64], np.uint8)
            parts.append(w)
        if not parts:
            assert not p[i].any()
            continue
        # a last window may be read among longer ones, after zero bytes: compare the sums of full windows only
        if len(b) % 64 == 0:
            want = sum(model.label(w[:, None]).sum(axis=0)[:, 0] for w in parts) / len(b)
            assert np.allclose(p[i], want, atol=1e-4)
        assert abs(p[i].sum() - 1) < 1e-4


def test_language_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    want = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{sf}/documents.parquet'").fetchall())
    out = queries.QUERIES["op4_language_id"](spark, sf).collect()
    assert len(out) == len(want) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == want[r.doc_id] for r in held) > 0.97 * len(held)


def plain_probabilities(model, text):
    """One text, window by window and byte by byte, in double precision."""
    w, n = {k: v.astype(float) for k, v in model.w.items()}, model.hidden
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def states(d, window):
        h, out = np.zeros(n), []
        for byte in window:
            x, a = w["x"][d][byte], w["u"][d] @ h
            z, r = sigmoid(x[:n] + a[:n]), sigmoid(x[n:2 * n] + a[n:2 * n])
            c = np.tanh(x[2 * n:] + r * (a[2 * n:] + w["b"][d][:, 0]))
            h = z * h + (1 - z) * c
            out.append(h)
        return out

    total, raw = np.zeros(model.classes), text.encode()
    for at in range(0, len(raw), 64):
        window = raw[at:at + 64]
        for forward, backward in zip(states(0, window), states(1, window[::-1])[::-1], strict=True):
            logits = w["o"] @ np.concatenate([forward, backward]) + w["c"][:, 0]
            p = np.exp(logits - logits.max())
            total += p / p.sum()
    return total / len(raw)


def test_language_against_a_plain_network(spark):
    """The trained network run plainly on some texts of whole windows (a last, shorter window
    is read backward behind its end's zero bytes): the same language and score."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model, languages = langid.train(docs.where(~langid.held_out()))
    texts = [t.encode()[:len(t.encode()) // 64 * 64].decode("utf-8", "ignore") for (t,) in duckdb.sql(f"SELECT text FROM '{SMALL}/documents.parquet' WHERE strlen(text) BETWEEN 200 AND 900 ORDER BY doc_id LIMIT 12").fetchall()]
    texts = [t for t in texts if len(t.encode()) % 64 == 0]
    assert len(texts) >= 5
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.row.doc_id: (r.lang_pred, r.score) for r in langid.predict(rows, model, languages).collect()}
    for i, text in enumerate(texts):
        p = plain_probabilities(model, text)
        assert got[i][0] == languages[int(p.argmax())] and abs(got[i][1] - p.max()) < 1e-3


def test_labelling_holds_few_states_at_a_time():
    model, data = langid.ByteGRU(4, 8), np.random.default_rng(1).integers(32, 127, 1 << 20).astype(np.uint8)
    tracemalloc.start()
    p = langid.pooled(model, data, np.arange(0, len(data) + 1, 1 << 16), 64)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert p.shape == (16, 4) and most < 16 << 20


def test_tasks_give_freed_memory_back(monkeypatch):
    gone, pool = [], pa.default_memory_pool()
    monkeypatch.setattr(pa, "default_memory_pool", lambda: gone.append(1) or pool)
    assert list(giving_back(lambda batches: (x + 1 for x in batches))(iter([1, 2]))) == [2, 3] and gone == [1]
    stopped = giving_back(lambda batches: iter(batches))([1, 2])
    assert next(stopped) == 1
    stopped.close()
    assert gone == [1, 1]


def test_text_is_sent_once_and_may_be_of_other_types(spark):
    docs = spark.createDataFrame([(1, "one two", "a"), (2, None, "b"), (3, "12", None), (4, "three", "c")], "id long, body string, lang string")
    model = langid.ByteGRU(2, 4, seed=3)
    whole = langid.predict(docs, model, ["x", "y"], "body")
    sent = whole._jdf.queryExecution().analyzed().children().head().output()
    assert [sent.apply(i).name() for i in range(sent.size())] == ["row"]
    found = sorted(map(tuple, whole.collect()))
    as_bytes = docs.withColumn("body", F.col("body").cast("binary"))
    assert [x[1:] for x in sorted(map(tuple, langid.predict(as_bytes, model, ["x", "y"], "body").collect()))] == [x[1:] for x in found]
    assert [x[1] == langid.UNKNOWN for x in found] == [False, True, True, False] and [x[0][1] for x in found] == ["one two", None, "12", "three"]


def test_language_of_odd_rows(odd, odd_rows, none):
    out = langid.identify(odd).collect()
    assert len(out) == len(odd_rows)
    blank = {r[0] for r in odd_rows if not any(map(str.isalpha, r[1] or ""))}
    assert {r.doc_id for r in out if r.lang_pred == "und"} == blank == {3, 4, 5, 41}
    assert all(r.lang_pred in ("en", "de", "und") for r in out)
    kept = langid.keep_identified(odd, least=0.0)
    assert kept.columns == odd.columns and kept.count() == len(odd_rows) - len(blank)
    assert langid.identify(none).collect() == []


# mixing ----------------------------------------------------------------------
def test_mix_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = con.execute(queries.ORACLE["op6_mix_sources"]).fetchall()
    assert sorted(map(tuple, queries.QUERIES["op6_mix_sources"](spark, SMALL).collect())) == sorted(want)


def test_mix_of_odd_rows(odd, none):
    out = mixing.mix(odd).collect()
    con = duckdb.connect()
    frame = odd.select("doc_id", "text", "source").toPandas()
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    con.register("documents", pa.Table.from_pandas(frame))
    want = con.execute(mixing_sql()).fetchall()
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, set(want) if len(want) != len(out) else want))
    taken, target = collections.Counter(), {}
    for r in out:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken in (0, r.size, 2 * r.size)
    rows = mixing.mixed_documents(odd)
    assert rows.columns == odd.columns
    counted = collections.Counter()
    for r in rows.collect():
        counted[r.source] += len(WORD.findall(r.text or ""))
    assert {k: v for k, v in counted.items() if v} == {k: v for k, v in taken.items() if v}
    assert mixing.mix(none).collect() == [] and mixing.mixed_documents(none).collect() == []


def mixing_sql():
    """Rows that repeat a doc_id share a hash; the SQL joins them to their one pick."""
    return queries.mixing_sql("documents")


# packing ---------------------------------------------------------------------
def test_ids_are_the_tokenizers(small_rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    odd = ["", "  a  b\n\n c\t\td ", "x\x85y\xa0z  \x1c\x1d a\x0b\x0cb", "don't we'll 's  's", "日本語 テキスト　全角   x", " \n", "<|endoftext|> a <|endoftext|>b",
           "a\x00b \x00 c", "\U0001f642 \U0001f642\U0001f642  é e", "1 2 3  4 5 " * 50]
    encoder, packing.LONG = packing.Encoder(packing.default_ranks()), 100
    try:
        for text in odd + [t for _, t in small_rows]:
            got = np.frombuffer(b"".join(encoder.parts(text)), "<u4").tolist()
            assert got == tokenizer.encode(text, add_special_tokens=False).ids
    finally:
        packing.LONG = 1 << 20


def test_long_texts_of_all_scripts_are_cut_in_one_pass(monkeypatch):
    """Texts without a space between Latin letters: the ids of the whole, in time that follows the length."""
    import time
    encoder = packing.Encoder(packing.default_ranks())
    samples = ["吾輩は猫である。名前はまだ無い。どこで生れたか、とんと見当がつかぬ！" * 40, "QUJDREVGR0hJSktMTU5PUFFSU1RVVldYWVo0NTY3ODkrLw" * 60, "это русский текст, и ещё один; а тут 12 чисел " * 40,
               "it's a dog's life, isn't it? 'tis \"quoted\"... \n\n  and   spaced\t\ttext " * 40, "x" * 2000, "🙂🙃 🙂" * 300]
    monkeypatch.setattr(packing, "LONG", 97)
    for text in samples:
        assert b"".join(encoder.plain(text)) == encoder.encode(text)
    monkeypatch.undo()
    text = samples[0] * (4_000_000 // len(samples[0]))
    began = time.time()
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], ["doc_id", "text"])
    out = next(packing._pieces(packing.default_ranks(), 1024, 0, None)(iter([batch])))
    assert time.time() - began < 30 and sum(out.column(2).to_pylist()) == out.column(4)[0].as_py()


def test_added_tokens_inside_text(spark, tmp_path):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"abc{end}def {end}", end, f"{end}{end} {end}", f"  {end}  x", f"a{end}" * 40, "<|endoftext|", f"<|{end}|>", "1 2 3 4 " * 20 + end + " 1 2 3" * 30, "é" + end + "\n\n"]
    encoder, packing.LONG = packing.Encoder(packing.default_ranks(), packing.default_added()), 50
    try:
        for text in texts:
            assert np.frombuffer(b"".join(encoder.parts(text)), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    finally:
        packing.LONG = 1 << 20
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for out in (queries.QUERIES["op8_packing"](spark, str(tmp_path)), corpus_pipeline.pack_sequences(spark, docs, str(tmp_path))):
        got = {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in out.collect()}
        for i, text in enumerate(texts):
            ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4")
            assert got[i] == (len(ids), zlib.crc32(ids.tobytes()))


def test_tournament_tree_is_first_fit():
    rng = random.Random(4)
    for _ in range(200):
        lengths = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 40))), reverse=True)
        room, want = [], []
        for n in lengths:
            k = next((i for i, free in enumerate(room) if free >= n), len(room))
            if k == len(room):
                room.append(20)
            room[k] -= n
            want.append(k)
        assert packing.first_fit_decreasing(lengths, 20) == want


def packed(rows, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    places, filled = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        places[r.doc_id].append(r)
        filled[r.sequence_id].append((r.offset, r.length))
    for spans in filled.values():
        spans.sort()
        assert [o for o, _ in spans] == [0, *itertools.accumulate(n for _, n in spans)][:-1] and sum(n for _, n in spans) <= 1024
    for d, found in texts.items():
        want = []
        for t in found:
            ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
            want += [(s, len(ids[s:s + 1024]), zlib.crc32(np.array(ids[s:s + 1024], "<u4").tobytes()), len(ids)) for s in range(0, len(ids), 1024)]
        assert sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in places[d]) == sorted(want)
    return sum(n for spans in filled.values() for _, n in spans) / (1024 * len(filled))


def test_packing_round_trip(spark, small_rows, odd, odd_rows, none):
    assert packed(queries.QUERIES["op8_packing"](spark, SMALL).collect(), {d: [t] for d, t in small_rows}) > 0.98
    texts = collections.defaultdict(list)
    for r in odd_rows:
        texts[r[0]].append(r[1])
    packed(packing.pack(odd, group_pieces=4).collect(), texts)
    assert packing.pack(none).collect() == []


# language model --------------------------------------------------------------
def brute_scores(rows):
    tokens = [(d, WORD.findall((t or "").translate(LOWER)) + [None]) for d, t in rows]
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows}
    words, pairs = collections.Counter(), collections.Counter()
    for d, w in tokens:
        if not held[d]:
            words.update(w)
            pairs.update(zip(["<begin>", *w], w, strict=False))
    n, v, total = sum(words.values()), len(words), len(pairs)
    sums, after = collections.defaultdict(lambda: [0, 0, 0, 0]), collections.Counter()
    for (a, b), c in pairs.items():
        sums[a][0] += c
        sums[a][min(c, 3)] += 1
        after[b] += 1
    of = lambda counts: ngrams.discounts(*[sum(c == k for c in counts) for k in (1, 2, 3, 4)])
    d2, d1 = of(list(pairs.values())), of(list(after.values()))
    rest = sum(d1[min(c, 3)] for c in after.values()) / total if total else 1.0

    def p(a, b):
        q = (max(after[b] - d1[min(after[b], 3)], 0) / total if b in after else 0) + rest / (v + 1)
        if a not in sums:
            return q
        s, c = sums[a], pairs[a, b]
        return (max(c - d2[min(c, 3)], 0) + (d2[1] * s[1] + d2[2] * s[2] + d2[3] * s[3]) * q) / s[0]

    return [(d, held[d], len(w), sum(x in words for x in w), n, sum(math.log10((words[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w),
             sum(math.log10(p(a, b)) for a, b in zip(["<begin>", *w], w, strict=False))) for d, w in tokens]


def close(out, want):
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:4], round(r[5], 3))
    out, want = sorted((tuple(r)[:7] for r in out), key=key), sorted(want, key=key)
    assert [r[:5] for r in out] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in out], [r[5:] for r in want], rtol=1e-9, atol=1e-9)


def test_scores_against_brute_force(spark, small_rows):
    out = queries.QUERIES["op10_lm_scores"](spark, SMALL).collect()
    close(out, brute_scores(small_rows))
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("parts", [1, 7])
def test_scores_of_odd_rows(odd, odd_rows, none, parts):
    """Seven parts for few words: a context's pairs lie in several parts."""
    rows = [(r[0], r[1]) for r in odd_rows]
    model = ngrams.train(odd.where(~ngrams.held_out()).select("text"), parts)
    out = [(r.doc_id, r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10 == 0, *list(r)[1:]) for r in ngrams.scores(odd, model).collect()]
    close(out, brute_scores(rows))
    assert ngrams.score_documents(none).collect() == []


def test_no_training_rows(spark):
    docs = spark.createDataFrame([(next(k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0), "a b c")], "doc_id long, text string")
    (r,) = ngrams.score_documents(docs).collect()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 4, 0, 0, 0.0, 0.0)
