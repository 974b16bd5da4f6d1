"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.session import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``least``, the smallest node of its component, for every node in
    ``edges`` (``a``, ``b``: longs).

    Rounds of large and small stars: each node's larger, then its smaller,
    neighbours move to its smallest neighbour, until nothing changes.  Every round is two
    aggregations with partial minimums and two joins; no neighbour list is gathered,
    and the edges are written to the shared folder between rounds.
    """
    now = stored(_falling(edges.select("a", "b")), "edges")
    mark = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _falling(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        now = stored(_falling(small), "edges")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("least"))
    return nodes.unionByName(nodes.select(F.col("least").alias("node"), "least").distinct())


def _falling(edges: DataFrame) -> DataFrame:
    return (
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)
