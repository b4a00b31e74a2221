"""Landed repository archives: coordinate checks, admission, containment, expansion.

The download itself is out of scope (network client); archives arrive as
files.  Expansion runs on executors (``mapInPandas`` over ``binaryFile``
rows, one archive per row, bounded by the admission limits); the checks
are plain aggregates over the entry listing.
"""

from __future__ import annotations

import io
import zipfile
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repolens.functions.text import template

# ---------------------------------------------------------------------------
# Fixed values (must match the analysed tool).
# ---------------------------------------------------------------------------
MAX_DOWNLOAD_BYTES = 100 * 1024 * 1024
MAX_UNCOMPRESSED_BYTES = 500 * 1024 * 1024
MAX_MEMBERS = 20_000
SEGMENT_RE = r"\A[A-Za-z0-9._-]+\z"
BRANCH_RE = r"\A[A-Za-z0-9._/-]+\z"
MSG_BAD_NAME = "Invalid owner or repo name."
MSG_BAD_BRANCH = "Invalid branch name."
MSG_TOO_BIG = "Archive exceeds the {mb} MB download limit."
MSG_TOO_MANY = "Archive contains more than {n} entries."
MSG_EXPANDS = "Archive expands to more than {mb} MB."
MSG_ESCAPES = "Refused archive: entry '{name}' resolves outside 'repos/'."
LOCAL_PATH = "repos/{repo}-{branch}"
# ---------------------------------------------------------------------------

MSG_NOT_ZIP = "Not a readable zip archive."
_BROKEN = (zipfile.BadZipFile, RuntimeError, NotImplementedError, zlib.error, EOFError, ValueError, OSError)


def validate_coordinates(index: DataFrame) -> DataFrame:
    """Adds ``problem`` (null when valid) and ``local_path`` to (owner, repo, branch) rows.

    ``\\z`` anchors: a trailing newline is refused (Python's ``$`` let it pass).
    """
    bad_name = ~F.col("owner").rlike(SEGMENT_RE) | ~F.col("repo").rlike(SEGMENT_RE)
    bad_branch = ~F.col("branch").rlike(BRANCH_RE) | F.col("branch").contains("..")
    problem = (F.when(bad_name, F.lit(MSG_BAD_NAME))
               .when(bad_branch, F.lit(MSG_BAD_BRANCH)))
    return index.withColumn("problem", problem).withColumn(
        "local_path", F.when(problem.isNull(), template(LOCAL_PATH, repo=F.col("repo"), branch=F.col("branch"))))


def escapes_root(name: F.Column) -> F.Column:
    """True when the entry name resolves outside the extraction folder:
    absolute, or some prefix climbs above the start with '..'."""
    step = lambda acc, part: F.struct(
        (acc["d"] + F.when(part == "..", -1).when(part.isin("", "."), 0).otherwise(1)).alias("d"),
        (acc["esc"] | ((acc["d"] + F.when(part == "..", -1).when(part.isin("", "."), 0).otherwise(1)) < 0)).alias("esc"))
    walk = F.aggregate(F.split(name, "/"), F.struct(F.lit(0).alias("d"), F.lit(False).alias("esc")), step)
    return name.startswith("/") | walk["esc"]


def archive_containment(entries: DataFrame, key: str = "archive_id") -> DataFrame:
    """Per archive: whether any entry escapes, and the first such name."""
    esc = escapes_root(F.col("name"))
    return entries.groupBy(key).agg(
        F.max(esc).alias("escapes"),
        F.min(F.when(esc, F.col("name"))).alias("offending_entry"))


def archive_admission(archives: DataFrame, entries: DataFrame, key: str = "archive_id") -> DataFrame:
    """Size and count limits, in the order the tool applies them."""
    stats = entries.groupBy(key).agg(F.count(F.lit(1)).alias("n_entries"),
                                     F.sum("size").cast("bigint").alias("expanded_bytes"))
    joined = archives.join(stats, key, "left").fillna({"n_entries": 0, "expanded_bytes": 0})
    problem = (F.when(F.col("compressed_bytes") > MAX_DOWNLOAD_BYTES,
                      F.lit(MSG_TOO_BIG.format(mb=MAX_DOWNLOAD_BYTES // (1024 * 1024))))
               .when(F.col("n_entries") > MAX_MEMBERS, F.lit(MSG_TOO_MANY.format(n=MAX_MEMBERS)))
               .when(F.col("expanded_bytes") > MAX_UNCOMPRESSED_BYTES,
                     F.lit(MSG_EXPANDS.format(mb=MAX_UNCOMPRESSED_BYTES // (1024 * 1024)))))
    return joined.withColumn("problem", problem)


def archive_verdict(index: DataFrame, entries: DataFrame, key: str = "archive_id") -> DataFrame:
    """Coordinates, limits and containment combined: one row per archive."""
    coords = validate_coordinates(index).withColumnRenamed("problem", "coord_problem")
    adm = archive_admission(index.select(key, "compressed_bytes"), entries, key).withColumnRenamed(
        "problem", "size_problem").drop("compressed_bytes")
    cont = archive_containment(entries, key)
    out = coords.join(adm, key, "left").join(cont, key, "left")
    refused = template(MSG_ESCAPES, name=F.col("offending_entry"))
    problem = F.coalesce(F.col("coord_problem"), F.col("size_problem"), F.when(F.col("escapes"), refused))
    return out.select(key, "owner", "repo", "branch", "n_entries", "expanded_bytes",
                      F.when(problem.isNull(), "success").otherwise("error").alias("status"),
                      problem.alias("problem"),
                      F.when(problem.isNull(), F.col("local_path")).alias("local_path"))


def _listed(batches):
    """The central directory of every archive: names and sizes, nothing is expanded."""
    for pdf in batches:
        rows = []
        for path, content in zip(pdf["path"], pdf["content"]):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    rows.append((path, None, -1, None, None))  # it is a zip, also without entries
                    rows += [(path, info.filename, int(info.file_size), info.is_dir(), None) for info in z.infolist()]
            except _BROKEN as exc:
                rows.append((path, None, -1, None, f"{MSG_NOT_ZIP} ({type(exc).__name__})"))
        yield pd.DataFrame(rows, columns=["archive", "name", "size", "is_dir", "problem"])


def _expand(batches, batch_bytes: int = 32 << 20):
    """Files of admitted archives, some megabytes at a time; an entry that can't
    be read (encrypted, unknown compression, damaged) has no data."""
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            rows, size = [], 0
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                for info in z.infolist():
                    if info.is_dir():
                        continue
                    try:
                        data = z.read(info)
                    except _BROKEN:
                        data = None
                    rows.append((path, info.filename, int(info.file_size), data))
                    size += len(data or b"")
                    if size > batch_bytes:
                        yield pd.DataFrame(rows, columns=["archive", "name", "size", "raw"])
                        rows, size = [], 0
            yield pd.DataFrame(rows, columns=["archive", "name", "size", "raw"])


def read_archive_entries(spark: SparkSession, pattern: str) -> DataFrame:
    """What every landed zip lists: (archive, name, size, is_dir, problem).

    ``binaryFile`` gives one row per archive; executors read the lists.  Each
    archive also has one row without a name, with its ``problem`` if it is no
    readable zip."""
    zips = spark.read.format("binaryFile").load(pattern).select("path", "content")
    return zips.mapInPandas(_listed, "archive string, name string, size bigint, is_dir boolean, problem string")


def ingest_archive(spark: SparkSession, pattern: str, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Landed zips + their coordinates -> (files, verdicts).

    ``index`` maps ``archive`` (file path) to owner/repo/branch.  Lists are
    judged first; only admitted archives are expanded.  Files of refused
    archives are left out; paths drop the archive's top folder and live under
    repo ``{repo}-{branch}``.
    """
    landed = spark.read.format("binaryFile").load(pattern)
    entries = read_archive_entries(spark, pattern)
    broken = entries.where(F.col("problem").isNotNull()).select("archive", F.col("problem").alias("broken"))
    idx = index.join(landed.select(F.col("path").alias("archive"), F.col("length").alias("compressed_bytes")), "archive", "inner")
    verdict = archive_verdict(idx, entries.where(F.col("name").isNotNull()).drop("problem"), key="archive")
    verdict = verdict.join(broken, "archive", "left").select(
        *[c for c in verdict.columns if c not in ("status", "problem", "local_path")],
        F.when(F.col("broken").isNull(), F.col("status")).otherwise("error").alias("status"),
        F.coalesce("problem", "broken").alias("problem"), F.when(F.col("broken").isNull(), F.col("local_path")).alias("local_path"))
    ok = verdict.where(F.col("status") == "success").select(
        "archive", F.concat(F.col("repo"), F.lit("-"), F.col("branch")).alias("repo"))
    admitted = landed.join(ok, landed["path"] == ok["archive"], "left_semi").select("path", "content")
    files = (admitted.mapInPandas(_expand, "archive string, name string, size bigint, raw binary").join(ok, "archive", "inner")
             .select("repo", F.regexp_replace("name", r"^[^/]*/", "").alias("path"), "size", "raw")
             .withColumn("content", F.make_valid_utf8(F.col("raw").cast("string"))))
    return files, verdict
