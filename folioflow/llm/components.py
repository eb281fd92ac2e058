"""Connected components by joins, for links that no single machine need hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.session import stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node of its component for every node of a link.

    Each round, every node moves its links to its smallest neighbour (large star), then every node
    its smaller links to the smallest of them (small star). Both keep components connected; at the
    fixed point every link ends at its component's smallest node. Rounds grow with the logarithm of the
    component size. Each round is a written table.
    """
    both = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    edges = stored(both)
    while True:
        large = _star(edges.union(edges.select("v", "u").toDF("u", "v")), larger=True)
        small = _star(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), larger=False)
        after = stored(small.withColumn("h", F.xxhash64("u", "v")))
        if _mark(after) == _mark(edges.withColumn("h", F.xxhash64("u", "v"))):
            break
        edges = after.drop("h")
    edges = after.drop("h")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v"), F.col("v")).distinct()
    )


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Link each neighbour (only larger ones, or all) of u, and u, to the least of u and its neighbours."""
    # Written, so that both sides of the join are plain shuffles, which Spark splits where a node is hot.
    least = stored(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    joined = pairs.join(least, "u")
    if larger:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def _mark(edges: DataFrame) -> tuple:
    """Number and order-free digest of the links."""
    row = edges.agg(F.count("*"), F.sum(F.col("h").cast("decimal(38,0)"))).first()
    return tuple(row)
