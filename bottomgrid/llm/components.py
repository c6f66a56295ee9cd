"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_table


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is
    its least node. Each round replaces the edges of every node by edges to
    its least neighbour, first towards larger, then towards smaller nodes; a
    few rounds suffice, as the depth shrinks by squaring. Every round is a
    written table. A node with very many edges is a skewed key of an equi-join
    with one row per node; both sides of it are tables, so adaptive execution
    can split such a node."""
    e = as_table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                 "edges")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = as_table(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
            .alias("x")).select("x.*").where("a <> b").distinct())
        e = as_table(small, "edges")
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
                    F.count_distinct("a").alias("d")).first()
        if now == before or now["n"] == 0:
            break
        before = now
    roots = e.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
