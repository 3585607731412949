"""Connected components of a link table, as rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyrisk.llm.text import stored


def components(links: DataFrame, most: int = 60) -> DataFrame:
    """``node`` and ``component`` (smallest node reachable) for every node of ``links`` (a, b).

    Alternates large-star and small-star steps: each node hands its larger
    neighbours, then its smaller ones, to the smallest neighbour it knows.
    The number of rounds grows with the logarithm of the longest chain; links
    that already are stars around their smallest node need none.  Every
    step is an aggregation with map-side combine and a join that the engine can
    split at hot nodes; each round is written to the shared folder.  Self-links
    and nulls are ignored.  Raises if ``most`` rounds do not suffice.
    """
    edges = (
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    edges, rounds = stored(edges, "links"), 0
    while not _settled(edges):
        if rounds == most:
            raise RuntimeError(f"components did not settle in {most} rounds")
        edges, rounds = stored(_round(edges), "links"), rounds + 1
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step on distinct edges (u, v), u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # Large star: larger neighbours of u point to the smallest around u.
    large = both.join(least, "u").where("v > u AND v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    # Small star: u and its smaller neighbours point to the smallest of them.
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    pairs = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v"))))
    return large.join(low, "u").select(pairs.alias("e")).select("e.*").where("u != v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether each node either has one smaller node, or is only the smaller one: then all are stars around their smallest."""
    ends = F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up"))))
    nodes = edges.select(ends.alias("e")).groupBy("e.node").agg(F.sum("e.up").alias("up"), F.min("e.up").alias("low"))
    return nodes.where("up > 1 OR (up = 1 AND low = 0)").agg(F.count("*")).first()[0] == 0
