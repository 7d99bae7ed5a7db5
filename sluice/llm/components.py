"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import discard, materialise


def _large(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least of its neighbourhood."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every node that is not the least of its component; ``edges`` has u and v, self-loops allowed.

    Each pass is two joins on the edges that are left, written to the shared folder; their number of passes grows with
    the logarithm of a component's width. Mins are reduced before the exchange, so a hub is no burden.
    """
    edges = materialise(edges.select("u", "v").where("u <> v").distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or state == seen:
            return edges.select("u", F.col("v").alias("root"))
        seen = state
        fewer = materialise(_small(_large(edges)), "edges")
        discard(edges)
        edges = fewer
