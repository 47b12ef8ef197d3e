"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import frozen


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _hook(pairs: DataFrame) -> DataFrame:
    """Every (u, v) of ``pairs`` with m, the smallest of u and all its v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the undirected ``edges`` (a, b), label being
    the smallest node of its component. Loops and repeated edges do no harm.

    Alternating large-star and small-star steps: each links the neighbours of a
    node to the smallest of them, until nothing changes. The edges stay
    distributed and are written to the shared checkpoint folder in each round;
    only a count and a checksum reach the driver.
    """
    now = frozen(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())
    state = _state(now)
    while state[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _hook(both).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        hooked = _hook(down)
        small = (hooked.select(F.col("v").alias("a"), F.col("m").alias("b"))
                       .unionByName(hooked.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a > b").distinct())
        now = frozen(small)
        state, before = _state(now), state
        if state == before:
            break
    return (now.select(F.col("a").alias("node"), F.col("b").alias("label"))
               .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()))
