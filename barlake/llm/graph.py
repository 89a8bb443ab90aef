"""Connected components of an edge table, on joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import stored


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether each vertex of (a, b) has one edge up at most and no vertex with one has edges below."""
    ups = edges.select("a", F.lit(1).alias("up")).unionByName(edges.select(F.col("b").alias("a"), F.lit(0).alias("up")))
    seen = ups.groupBy("a").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return seen.where("up > 1 or (up = 1 and least = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for each vertex of (a, b) that is not the least of its component; root is the least.

    Alternates two steps until each component is a star around its least
    vertex: every vertex hands its larger neighbours its least one, then each
    vertex's smaller neighbours are tied to the least of them.  Minima are
    taken before the shuffle, and a vertex with many neighbours meets its
    minimum in a join that Spark can split.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not _is_forest_of_stars(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        now = stored(tied.select("e.*").where("a <> b").distinct(), "edges")
    return now.select(F.col("a").alias("id"), F.col("b").alias("root"))
