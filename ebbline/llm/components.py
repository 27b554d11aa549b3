"""Connected components by alternating large-star and small-star steps.

Every step is an aggregation with map-side combine and an equi-join.  The
aggregate is written as a table before the join: both sides then come in by
shuffles of the join's own, which AQE splits where a hub has very many edges
(an aggregate's partitions it must leave as they are).  The number of rounds
grows with the logarithm of the graph's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import cut, scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = cut(both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m")), "least")
    return both.join(least, "src").where(F.col("dst") > F.col("src")).select(F.col("dst").alias("src"), F.col("m").alias("dst"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).where("src <> dst")
    least = cut(down.groupBy("src").agg(F.min("dst").alias("m")), "least")
    linked = down.join(least, "src").where(F.col("dst") != F.col("m")).select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    return linked.unionByName(least.select("src", F.col("m").alias("dst")))


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge down at most, and none that has one is the end of another."""
    ends = edges.select(F.col("src").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(edges.select(F.col("dst").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return not ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down > 1 or (down = 1 and up = 1)").limit(1).count()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the undirected edges (src, dst); root is the least node reached.

    Nodes without an edge to another node do not appear.
    """
    spark = edges.sparkSession
    with scratch(spark) as keep_last:
        now = cut(edges.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct(), "edges")
        for _ in range(most_rounds):
            if _are_stars(now):
                break
            with scratch(spark) as keep:
                now = keep(cut(_small_star(cut(_large_star(now), "edges")).distinct(), "edges"))
        else:
            raise RuntimeError(f"components not reached in {most_rounds} rounds")
        keep_last(now)
    return now.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionByName(now.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct())
