"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component is its smallest node.

    Alternates two steps until nothing changes: every node links its larger neighbours to
    its smallest one, then its smaller neighbours to their smallest. Both keep the graph
    connected the same way and shrink it to stars in a logarithmic number of rounds. Only
    smallest neighbours are gathered, never neighbour lists, and every round is written to
    the shared folder. Self-links and nulls are ignored.
    """
    pairs = edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).where("a > b")
    stars, before = written(pairs.distinct(), "links"), None
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = (
            both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        ).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        moved = large.join(least, "a").where("b > low")
        small = moved.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            least.select("a", F.col("low").alias("b"))
        )
        stars = written(small.distinct(), "stars")
        # all tables hold distinct edges; two sums of hashes tell whether they are the same
        now = stars.agg(
            F.count("*"),
            *[F.sum(F.xxhash64("a", "b", F.lit(seed)) % (1 << 40)) for seed in (1, 2)],
        ).first()
        if now == before:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now
