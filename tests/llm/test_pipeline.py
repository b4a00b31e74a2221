"""The pipeline's stages against what each decides on its own input."""

import collections
import re

import __spark_entry__ as entry
import corpus_pipeline
from repolens.llm import near
from repolens.llm.common import written
from tests.llm.conftest import SMALL
from tests.llm.test_pairs import LOWER, brute_components
from tests.llm.test_texts import packed

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_stages_of_small_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SMALL), "test-stage")
        rows.append(docs.collect())
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    start, identified, exact, apart, mixed, pieces = rows
    assert {r.doc_id for r in identified} == {r.doc_id for r in start if any(map(str.isalpha, r.text or ""))}
    last = {}
    for r in identified:
        last[(r.text or "").translate(LOWER)] = max(r.doc_id, last.get((r.text or "").translate(LOWER), -1))
    assert sorted(r.doc_id for r in exact) == sorted(last.values())
    groups = brute_components([(r.doc_id, r.text) for r in exact], 80)
    assert sorted(r.doc_id for r in apart) == sorted(d for d, (_, c) in groups.items() if d == c)
    size, taken = collections.Counter(), collections.Counter()
    for r in apart:
        size[r.source] += len(WORD.findall(r.text or ""))
    for r in mixed:
        taken[r.source] += len(WORD.findall(r.text or ""))
    assert max(collections.Counter(r.doc_id for r in mixed).values()) <= 2
    assert abs(sum(taken.values()) / sum(size.values()) - 1.5) < 0.15 and all(taken[s] <= 2 * size[s] for s in size)
    texts = collections.defaultdict(list)
    for r in mixed:
        texts[r.doc_id].append(r.text)
    assert packed(pieces, texts) > 0.95


def test_run_is_the_stages(spark):
    out = entry.queries()["pipeline"](spark, SMALL)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 100


def test_near_stage_keeps_strangers(spark):
    docs = spark.createDataFrame([(k, " ".join(f"s{k}t{i}" for i in range(40))) for k in range(30)], "doc_id long, text string")
    assert near.drop_near_copies(docs).count() == 30


def test_stages_of_odd_rows(odd, none, spark):
    """Nulls, empty and very long texts, repeated rows, a map column and clashing names go
    through the chain; an empty table gives an empty result."""
    rows = odd.unionByName(odd.where("doc_id > 20")).selectExpr("*", "map('a', doc_id) AS lead")
    columns = rows.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, SMALL)
        if name == "packing":
            assert out.where("length < 1 OR length > 1024").isEmpty() and not out.isEmpty()
            break
        assert out.columns == columns
        rows = written(out, "test-odd")
    texts = [(r.text or "").translate(LOWER) for r in rows.collect()]
    assert texts and all(any(map(str.isalpha, t)) for t in texts)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SMALL).collect() == []
