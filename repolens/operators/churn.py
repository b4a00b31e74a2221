"""Churn: commit counts from a git log, physical lines, hotspot ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repolens.functions.text import CHURN_SUFFIXES, HOTSPOT_TOP_K, loc, py_strip


def read_git_log(log_lines: DataFrame) -> DataFrame:
    """``git log --format=format: --name-only`` lines -> touched paths.

    Input ``(repo, line)``; output ``(repo, path)``, one row per touch.
    Lines are stripped, blanks dropped, and only churn suffixes kept.
    """
    path = py_strip(F.col("line"))
    keep = F.lit(False)
    for sfx in CHURN_SUFFIXES:
        keep = keep | path.endswith(sfx)
    return (log_lines.select("repo", path.alias("path"))
            .where((F.col("path") != "") & keep))


def commit_count(touched: DataFrame) -> DataFrame:
    """Touches per path: ``(repo, path, commits)``.

    A commit lists a path once, so the row count equals the number of
    distinct commits; counting rows keeps the aggregate map-side combinable.
    """
    return touched.groupBy("repo", "path").agg(F.count(F.lit(1)).alias("commits"))


def file_loc(files: DataFrame) -> DataFrame:
    """``(repo, path, loc)`` for every file."""
    return files.select("repo", "path", loc(F.col("content")).alias("loc"))


def hotspots(touched: DataFrame, files: DataFrame) -> DataFrame:
    """All hotspot rows: paths that still exist, with commits x loc."""
    counts = commit_count(touched)
    # file_exists_join: paths touched in history but gone now drop out.
    joined = counts.join(file_loc(files), ["repo", "path"], "inner")
    return joined.select("repo", "path", "commits", "loc",
                         (F.col("commits") * F.col("loc")).cast("bigint").alias("hotspot_score"))


def churn_hotspots(touched: DataFrame, files: DataFrame, k: int = HOTSPOT_TOP_K) -> DataFrame:
    """Top-k hotspots per repository (score desc, path asc for ties).

    ``row_number() <= k`` over a per-repo window is planned as a
    group limit, so each task keeps only k rows per repo before the shuffle.
    """
    w = Window.partitionBy("repo").orderBy(F.desc("hotspot_score"), F.asc("path"))
    return (hotspots(touched, files)
            .withColumn("rank", F.row_number().over(w).cast("bigint"))
            .where(F.col("rank") <= k))


def topk_hotspots(touched: DataFrame, files: DataFrame, k: int = HOTSPOT_TOP_K) -> DataFrame:
    """Top-k over everything (one workspace view): TakeOrderedAndProject."""
    return (hotspots(touched, files)
            .orderBy(F.desc("hotspot_score"), F.asc("repo"), F.asc("path"))
            .limit(k))
