"""Connected components of an edge table by alternating stars.

Each round hangs the larger neighbours of every node under its least neighbour,
then the smaller ones; the edge table never grows, a node with very many edges
is a minimum that is combined before the shuffle and a join that Spark may
split, and nothing but two figures per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.session import cut_lineage

# minima are stored before they are joined back: then both sides of the join are
# shuffled, and Spark may split a node of very many edges


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = cut_lineage(both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("_least")))
    return (
        both.where(F.col("dst") > F.col("src"))
        .join(least, "src")
        .where(F.col("dst") != F.col("_least"))
        .select(F.col("dst").alias("src"), F.col("_least").alias("dst"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    # every edge points from the larger to the smaller node here
    least = cut_lineage(edges.groupBy("src").agg(F.min("dst").alias("_least")))
    below = (
        edges.join(least, "src")
        .where(F.col("dst") != F.col("_least"))
        .select(F.col("dst").alias("src"), F.col("_least").alias("dst"))
    )
    return below.unionByName(least.select("src", F.col("_least").alias("dst"))).where("src != dst").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Least node reachable for every node that has an edge and isn't least itself.

    ``edges`` has columns src and dst of one type, in any direction, with
    repeats and loops allowed. Returns node and root, one row per node.
    """
    def figures(df: DataFrame) -> tuple:
        return tuple(df.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))
        ).first())

    current = cut_lineage(
        edges.where("src != dst")
        .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .distinct()
    )
    before = figures(current)
    while before[0]:
        current = cut_lineage(_small_star(cut_lineage(_large_star(current))))
        after = figures(current)
        if after == before:
            break
        before = after
    return current.select(F.col("src").alias("node"), F.col("dst").alias("root"))
