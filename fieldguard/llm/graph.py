"""Connected components of a link table by large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldguard.session import settle


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One round over (a, b) with a > b: neighbours go to the least vertex next to them."""
    if larger:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.join(least, "a")
    if larger:
        out = moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        own = moved.select("a", F.col("m").alias("b"))
        out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(own)
    return out.where("a <> b").distinct()


def components(links: DataFrame, rounds: int = 64) -> DataFrame:
    """vertex, component (the least vertex reachable) for every vertex of ``links`` (two columns).

    A vertex without links has no row. Every round is written to the shared folder, so a lost
    executor costs a read; no round holds a vertex's neighbours together.
    """
    one, two = links.columns
    edges = links.where(F.col(one) != F.col(two)).select(
        F.greatest(one, two).alias("a"), F.least(one, two).alias("b")
    )
    edges = settle(edges.distinct())
    state = None
    for _ in range(rounds):
        edges = settle(_star(_star(edges, True), False))
        now = tuple(
            edges.agg(
                F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
            ).first()
        )
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("component")).union(roots)
