"""Connected components of an edge table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import saved


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); component is its smallest node.

    Alternating large-star and small-star steps: each hangs a node's neighbours on the smallest
    one, so paths shorten to stars in a logarithmic number of rounds.  Neighbour sets are only
    reduced to their minimum, never collected; every round is written to the shared folder."""
    now = saved(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(now)
    while state[0]:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = saved(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionAll(low.select("a", F.col("m").alias("b")))
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
        now = saved(small)
        before, state = state, _state(now)
        if state == before:
            break
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
