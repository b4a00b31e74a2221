"""Symbols kept by content: a corpus that changes is tokenized where it changed.

The store below the shared checkpoint folder holds two tables, written in
batches: ``symbols`` by content key (SHA-256 of the text) and language, and
``contents``, the keys whose symbols are there.  A request hashes its files,
tokenizes each text that ``contents`` doesn't list, once however many files have
it, appends a batch, and joins files with symbols by content key.  Paths and
repositories are the request's own, so renamed, copied and vendored files cost
nothing.

A batch counts from the moment its ``contents`` are written, after its
``symbols``; what a lost job leaves behind is never read.  If two jobs add the
same content, the first batch by name is read.  ``VERSION`` names the rules that
made the symbols; a store of other rules is another folder.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repolens.functions.text import classify_language
from repolens.operators import symbols as S
from repolens.operators import tokens as T
from repolens.operators.jssymbols import js_symbols
from repolens.session import checkpoint_dir

VERSION = 2
# Characters that one task tokenizes, about: its tokens, some hundred bytes each, are sorted in memory.
TASK_CHARS = 1 << 20
_CONTENTS = "content_key binary, lang string, batch string"
_TYPES = {"lang": "string", "kind": "string", "name": "string", "class_name": "string", "qualified_name": "string", "params": "string", "return_type": "string",
          "docstring": "string", "start_line": "int", "end_line": "int", "start_pos": "bigint", "start_off": "bigint", "end_off": "bigint", "complexity": "int", "source": "string"}
COLUMNS = list(_TYPES)


def store_path(spark: SparkSession, base: str | None = None) -> str:
    return f"{base or checkpoint_dir(spark).rstrip('/') + '/tables'}/symbol-store-{VERSION}"


def _listed(spark: SparkSession, root: str) -> DataFrame:
    """content_key, lang, batch as the batches list them."""
    try:
        return spark.read.schema(_CONTENTS).parquet(f"{root}/contents/*")
    except AnalysisException:  # no batch yet
        return spark.createDataFrame([], _CONTENTS)


def _contents(spark: SparkSession, root: str) -> DataFrame:
    """content_key, lang, batch of all texts whose symbols are stored."""
    return _listed(spark, root).groupBy("content_key", "lang").agg(F.min("batch").alias("batch"))


def _keyed(files: DataFrame) -> DataFrame:
    lang = classify_language(F.col("path"))
    return files.select("repo", "path", lang.alias("lang"), F.unhex(F.sha2("content", 256)).alias("content_key"), "content").where("lang IS NOT NULL")


def add_missing(files: DataFrame, base: str | None = None) -> int:
    """Tokenize the texts that the store lacks; how many those were."""
    spark = files.sparkSession
    root, batch = store_path(spark, base), f"b{uuid.uuid4().hex}"
    known = _contents(spark, root).select("content_key", "lang")
    missing = _keyed(files).dropDuplicates(["content_key", "lang"]).join(known, ["content_key", "lang"], "left_anti")
    named = F.when(F.col("lang") == "python", F.lit("m.py")).otherwise(F.lit("m.js"))
    # within a batch a number stands for the key: every token carries it through each sort
    scratch = f"{root}/missing/{batch}"
    missing.select("content_key", "lang", F.monotonically_increasing_id().alias("repo"), named.alias("path"), "content").write.parquet(f"{scratch}/texts")
    texts = spark.read.parquet(f"{scratch}/texts")
    n, chars = texts.agg(F.count(F.lit(1)), F.sum(F.length("content"))).first()
    if n:
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (chars or 0) // TASK_CHARS + 1)
        for lang, symbols in (("python", S.python_symbols), ("javascript", js_symbols)):
            some = T.partition_files(texts.where(F.col("lang") == lang).select("repo", "path", "content"), parts)
            symbols(some, partitioned=True).write.parquet(f"{scratch}/offsets/{lang}")
        offsets = spark.read.parquet(*[f"{scratch}/offsets/{lang}" for lang in ("python", "javascript")])
        S.with_text(offsets, texts, ("content_key",)).select("content_key", *COLUMNS, F.lit(batch).alias("batch")).write.parquet(f"{root}/symbols/{batch}")
        texts.select("content_key", "lang", F.lit(batch).alias("batch")).write.parquet(f"{root}/contents/{batch}")
    return n


def stored_symbols(files: DataFrame, base: str | None = None) -> DataFrame:
    """What ``extract_symbols`` gives for files(repo, path, content), read from the store."""
    spark = files.sparkSession
    add_missing(files, base)
    root = store_path(spark, base)
    batches = [r["batch"] for r in _listed(spark, root).select("batch").distinct().collect()]  # one per request that found new texts
    types = ", ".join(f"{c} {t}" for c, t in _TYPES.items())
    if not batches:
        return spark.createDataFrame([], "repo string, path string, " + types)
    table = spark.read.schema(f"content_key binary, {types}, batch string").parquet(*[f"{root}/symbols/{b}" for b in batches])
    where = _keyed(files).drop("content").join(_contents(spark, root), ["content_key", "lang"])
    return where.join(table, ["content_key", "lang", "batch"]).select("repo", "path", *COLUMNS)

