"""File sources: a directory-tree reader, strict reads, and the scan listing.

``scan_files`` uses a Python data source so that names starting with ``_``
or ``.`` (``__init__.py``, ``.env.example``, ``.github/workflows/x.yml``)
are kept -- Spark's file listing hides them.  The driver only plans
partitions (one per top-level entry of each repository); executors walk
their subtree, prune ignored directory names and read the bytes.  The
tree must sit on storage every executor can reach.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from repolens.functions.text import (NO_SYMBOLS_TEXT, NOT_A_FILE_TEXT, NOT_FOUND_TEXT, PARSEABLE_SUFFIXES, SKIP_DIRS,
                                     UNSUPPORTED_TEXT, classify_language, file_name, strict_utf8, suffix, template)

FILES_SCHEMA = "repo string, path string, size bigint, raw binary"


class _TreePartition(InputPartition):
    def __init__(self, repo: str, base: str, rel: str, walk: bool):
        super().__init__((repo, rel))
        self.repo, self.base, self.rel, self.walk = repo, base, rel, walk


class _TreeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"]
        self.repo = options.get("repo")
        self.skip = set((options.get("skip") or ",".join(SKIP_DIRS)).split(","))

    def _repos(self):
        if self.repo:
            return [(self.repo, self.root)]
        return [(e.name, e.path) for e in sorted(os.scandir(self.root), key=lambda e: e.name) if e.is_dir()]

    def partitions(self):
        parts = []
        for repo, base in self._repos():
            top_files = False
            for e in sorted(os.scandir(base), key=lambda e: e.name):
                if e.is_dir(follow_symlinks=False):
                    if e.name not in self.skip:
                        parts.append(_TreePartition(repo, base, e.name, True))
                else:
                    top_files = True
            if top_files:
                parts.append(_TreePartition(repo, base, "", False))
        return parts or [_TreePartition("", self.root, "", False)]

    def read(self, partition):
        base, skip = partition.base, self.skip
        if not partition.walk:
            if not partition.repo:
                return
            for e in sorted(os.scandir(base), key=lambda e: e.name):
                if e.is_file(follow_symlinks=False):
                    with open(e.path, "rb") as fh:
                        data = fh.read()
                    yield (partition.repo, e.name, len(data), data)
            return
        start = os.path.join(base, partition.rel)
        for root, dirs, names in os.walk(start):
            dirs[:] = sorted(d for d in dirs if d not in skip)
            for name in sorted(names):
                full = os.path.join(root, name)
                rel = os.path.relpath(full, base).replace(os.sep, "/")
                with open(full, "rb") as fh:
                    data = fh.read()
                yield (partition.repo, rel, len(data), data)


class RepoTreeSource(DataSource):
    """``spark.read.format("repotree").option("path", root)``: one row per file.

    Each first-level directory of ``path`` is a repository (or set option
    ``repo`` to read ``path`` itself as one repository).
    """

    @classmethod
    def name(cls):
        return "repotree"

    def schema(self):
        return FILES_SCHEMA

    def reader(self, schema):
        return _TreeReader(self.options)


def scan_files(spark: SparkSession, root: str, repo: str | None = None) -> DataFrame:
    """files(repo, path, size, raw, content): raw bytes plus replacement-decoded text."""
    spark.dataSource.register(RepoTreeSource)
    reader = spark.read.format("repotree").option("path", root)
    if repo:
        reader = reader.option("repo", repo)
    df = reader.load()
    return df.withColumn("content", F.make_valid_utf8(F.col("raw").cast("string")))


def read_file(files: DataFrame, raw_col: str = "raw") -> DataFrame:
    """Strict UTF-8 read: ``text`` or a ``problem`` for undecodable bytes."""
    text = strict_utf8(F.col(raw_col))
    return files.withColumn("text", text).withColumn(
        "problem", F.when(F.col("text").isNull(), F.lit("Error reading file: not valid UTF-8")))


def read_path(files: DataFrame, repo: str, path: str) -> DataFrame:
    """Text of one file, or the error text for a folder or a path that is not there."""
    spark = files.sparkSession
    want = spark.createDataFrame([(repo, path)], "repo string, path string")
    found = read_file(files.where((F.col("repo") == repo) & (F.col("path") == path)))
    inside = files.where((F.col("repo") == repo) & F.col("path").startswith(path.rstrip("/") + "/"))
    folder = inside.select("repo").limit(1).withColumn("folder", F.lit(NOT_A_FILE_TEXT.format(path=path)))
    missing = F.coalesce("folder", F.lit(NOT_FOUND_TEXT.format(path=path)))
    return (want.join(found, ["repo", "path"], "left").join(folder, "repo", "left")
            .select("repo", "path", F.coalesce(F.col("text"), F.col("problem"), missing).alias("result")))


def scan_outline(files: DataFrame, outlines: DataFrame) -> DataFrame:
    """The scan listing: every file as 'source' (with its outline) or 'other'.

    ``outlines`` is ``symbols.outline(...)`` output.  A source-named file
    without a real suffix (``.py`` alone) gets the unsupported-type text.
    """
    name = file_name(F.col("path"))
    is_source = F.lit(False)
    for sfx in PARSEABLE_SUFFIXES:
        is_source = is_source | name.endswith(sfx)
    listed = files.select("repo", "path", F.when(is_source, "source").otherwise("other").alias("kind"),
                          classify_language(F.col("path")).alias("lang"))
    joined = listed.join(outlines, ["repo", "path"], "left")
    unsupported = template(UNSUPPORTED_TEXT, ext=suffix(F.col("path")))
    outline = (F.when(F.col("kind") == "other", F.lit(None))
               .when(F.col("lang").isNull(), unsupported)
               .otherwise(F.coalesce(F.col("outline"), F.lit(NO_SYMBOLS_TEXT))))
    return joined.select("repo", "path", "kind", outline.alias("outline"))
