"""Connected components of a graph given as edges between long ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written


def apart(c: Column) -> Column:
    """The same long value, in a form that the optimiser takes for another one.

    Joining an aggregate on its own group key would reuse the aggregate's
    partitioning, and then Spark can't split a hot key of the other side.
    Joined on this, both sides get an exchange of the join and a hot key's
    rows are dealt over many tasks.
    """
    return F.bitwise_not(F.bitwise_not(c))


def _with_least(pairs: DataFrame) -> DataFrame:
    """(u, v) with the least v of each u as ``m``."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(apart(F.col("u")).alias("k"), "m")
    return pairs.join(least, F.col("u") == F.col("k")).drop("k")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node with an edge; ``edges`` has long columns a and b.

    Large-star and small-star steps alternate until the edges form stars
    around the least node of each component.  Each round is written to the
    shared scratch folder; only its row count and a checksum reach the driver.
    """
    spark = edges.sparkSession

    def canonical(e: DataFrame) -> DataFrame:
        return e.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = written(spark, canonical(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), "edges")
    before = state(now)
    if not before[0]:
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        small = _with_least(canonical(large))
        small = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                               F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        now = written(spark, canonical(small), "edges")
        after = state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"no stable components after {max_rounds} rounds")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
