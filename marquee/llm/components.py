"""Connected components of a stored list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node passes its larger neighbours on to its smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(least, "u").select(F.col("m").alias("u"), "v").filter("u < v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node passes its smaller neighbours and itself on to the smallest of them."""
    least = edges.groupBy("v").agg(F.min("u").alias("m"))
    smaller = edges.join(least, "v").select(F.col("m").alias("u"), F.col("u").alias("v"))
    own = least.select(F.col("m").alias("u"), "v")
    return smaller.unionByName(own).filter("u < v").distinct()


def connected(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (u, v): the smallest node it is linked to.

    Large and small stars by turns until nothing changes; each round's edges are written to the
    shared folder. Links of a node to itself and repeated links do no harm.
    """
    edges = written(
        links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .filter("u < v")
        .distinct(),
        "stars",
    )
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if not state[0] or state == before:
            break
        before = state
        edges = written(_small_star(_large_star(edges)), "stars")
    roots = edges.select(F.col("u").alias("node")).distinct().withColumn("label", F.col("node"))
    return edges.select(F.col("v").alias("node"), F.col("u").alias("label")).unionByName(roots)
