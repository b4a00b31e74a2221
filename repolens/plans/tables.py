"""Materialise the derived tables once and read them back.

Symbols are expensive (tokenization + windows) and reused by outline,
search, change impact, complexity and the streaming job, so a deployment
builds them once and writes them.  Writing also cuts the lineage: a lost
executor later re-reads parquet instead of re-running the token pipeline.
Tables go below the shared ``spark.checkpoint.dir`` unless a base folder is
given, in ranges of ``(repo, path)``: file sizes follow the data, however
many repositories there are, and a repository filter skips files and row
groups by their statistics.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from repolens.operators import symbols as S
from repolens.session import checkpoint_dir


def table_path(spark: SparkSession, name: str, base: str | None = None) -> str:
    return f"{base or checkpoint_dir(spark) + '/tables'}/{name}"


def scratch_base(spark: SparkSession) -> str:
    """A base folder of its own below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str, base: str | None = None, by_repo: bool = True) -> str:
    """Write ``df`` as parquet (overwrite) and return its path."""
    path = table_path(df.sparkSession, name, base)
    order = [c for c in ("repo", "path") if c in df.columns]
    if by_repo and "repo" in order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    df.write.mode("overwrite").parquet(path)
    return path


def build_code_tables(files: DataFrame, base: str | None = None) -> dict[str, str]:
    """files(repo, path, content) -> written ``files`` and ``symbols`` tables."""
    return {
        "files": write_table(files.select("repo", "path", "content"), "files", base),
        "symbols": write_table(S.extract_symbols(files), "symbols", base),
    }


def read_table(spark: SparkSession, name: str, base: str | None = None) -> DataFrame:
    return spark.read.parquet(table_path(spark, name, base))
