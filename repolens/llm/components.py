"""Connected components of links between long ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolens.llm.common import written


def components(links: DataFrame, rounds: int = 64) -> DataFrame:
    """links(a, b) -> node, comp: nodes with equal comp are connected; comp is
    one of them.  Nodes without a link to another node have no row.

    Each round every vertex joins its neighbour (or itself) of least hash, and
    links are drawn anew between the merged vertices; hashes change from round
    to round, so chains shorten by a constant share.  The minimum is
    pre-aggregated, so a vertex with very many links is no hot group.
    """
    both = links.where("a <> b").select("a", "b")
    both = written(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    member = written(both.select(F.col("a").alias("node"), F.col("a").alias("comp")).distinct(), "members")
    for k in range(rounds):
        if both.isEmpty():
            return member
        order = lambda c: F.struct(F.xxhash64(F.lit(k), F.col(c)).alias("order"), F.col(c).alias("to"))
        joined = both.groupBy("a").agg(F.min(order("b")).alias("best")).select("a", F.least(F.col("best"), order("a"))["to"].alias("to"))
        joined = written(joined, "joined")
        member = written(member.join(joined, F.col("comp") == F.col("a"), "left")
                         .select("node", F.coalesce("to", "comp").alias("comp")), "members")
        to_a = joined.select("a", F.col("to").alias("new_a"))
        to_b = joined.select(F.col("a").alias("b"), F.col("to").alias("new_b"))
        both = written(both.join(to_a, "a").join(to_b, "b").where("new_a <> new_b")
                       .select(F.col("new_a").alias("a"), F.col("new_b").alias("b")).distinct(), "links")
    raise RuntimeError("links did not settle")
