"""Connected components of an edge table, by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a vertex is tied to the least of the vertex and its neighbours."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.join(least, "a").filter(F.col("b") > F.col("a"))
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its neighbours below it are tied to the least of them. Edges lead from the greater to the less."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``label`` (the least id of its component) of every vertex but the least ones.

    ``edges`` has bigint columns a and b. A vertex with many edges is one row of a pre-aggregated minimum and a
    skewed join key that adaptive execution splits. Each round is staged; rounds grow with the log of the longest path.
    """
    now = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    mark = None
    while True:
        now = stage(_small_star(_large_star(now)), "edges")
        was, mark = mark, tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if mark == was:
            return now.select(F.col("a").alias("id"), F.col("b").alias("label"))
