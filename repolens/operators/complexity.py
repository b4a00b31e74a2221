"""Cyclomatic complexity per Python function.

The score (1 + decisions inside the span, nested functions included) is
computed with the symbols themselves (prefix sums over logical lines, see
``symbols``); this module ranks and labels it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repolens.functions.text import risk_level


def score_complexity(symbols: DataFrame) -> DataFrame:
    """(repo, path, function, line, complexity_score, risk_level) per Python def."""
    defs = symbols.where((F.col("kind") == "def") & (F.col("lang") == "python"))
    score = F.col("complexity").cast("bigint")
    return defs.select("repo", "path", F.col("qualified_name").alias("function"),
                       F.col("start_line").cast("bigint").alias("line"),
                       score.alias("complexity_score"), risk_level(score).alias("risk_level"))


def sort_complexity(scores: DataFrame) -> DataFrame:
    """``rank_in_file``: score descending, ties in document order, file by file."""
    w = Window.partitionBy("repo", "path").orderBy(F.desc("complexity_score"), "line")
    return scores.withColumn("rank_in_file", F.row_number().over(w).cast("bigint"))


def functions_scored(scores: DataFrame) -> DataFrame:
    return scores.groupBy("repo", "path").agg(F.count(F.lit(1)).alias("functions_scored"))
