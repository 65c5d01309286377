"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.sources.storage import stage


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``; a root is its component's minimum.

    In turns, each node's larger neighbours, then its smaller ones, are tied to the smallest
    neighbour, until nothing changes.  Each round is written to the shared folder.  Minima
    are pre-aggregated and written, so that each join is one of two plain exchanges, whose
    long side adaptive execution can split at a node with very many neighbours.  Roots are not listed among the nodes.
    """
    links = stage(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    mark = None
    while True:
        both = links.union(links.select("v", "u"))
        lowest = stage(
            both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "lowest"
        )
        tied = both.join(lowest, "u").filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        tied = stage(tied.distinct(), "tied")
        smallest = stage(tied.groupBy("u").agg(F.min("v").alias("m")), "smallest")
        links = stage(
            tied.join(smallest, "u")
            .filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(smallest)
            .distinct(),
            "links",
        )
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
