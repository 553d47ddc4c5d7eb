"""Mixing sources to target weights by Poisson replication.

Every source has a target share of the output.  Its repetition rate is the
number of documents it should have over the number it has, and each document
is repeated a Poisson number of times with that mean: the distribution is
inverted at a uniform number seeded by a hash of the document's id, so the
result does not depend on partitioning and a rerun gives the same one.  The
repetitions are exploded and dealt out by a hash of id and repetition, in the
order of which each partition is sorted: a global shuffle in one exchange.

Rates above ``CHUNK`` are cut into equal parts, each with a number of its own
(sums of Poisson numbers are Poisson), so nothing underflows.  A null source
is a source.  Rows with equal ids are repeated equally often; null ids count as
one id.  An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shuffle_width, unused_name, written

CHUNK = 16
# places of the distribution that are tabulated: for rates up to CHUNK, the rest has a probability below 2^-52,
# the step of the uniform numbers, so none of them lies beyond
PLACES = 96
BROADCAST_SOURCES = 10_000
PARTS = 1 << 40  # steps of a weight, of the largest one


def uniform(*parts) -> Column:
    """A number in (0, 1) from an md5 over ``parts``, in steps of 2^-52."""
    text = F.concat_ws(":", *(p if isinstance(p, Column) else F.lit(str(p)) for p in parts))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def poisson_table(rate: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... of a Poisson distribution with mean ``rate`` (at most CHUNK)."""
    start = F.struct(F.array(F.exp(-rate)).alias("sums"), F.exp(-rate).alias("p"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        return F.struct(F.concat(acc["sums"], F.array(F.element_at(acc["sums"], -1) + p)).alias("sums"), p.alias("p"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(PLACES - 1)), start, step, lambda acc: acc["sums"])


def source_rates(docs: DataFrame, source: str = "source", weights: dict | None = None, alpha: float = 0.5,
                 total: int | None = None) -> DataFrame:
    """(source, n, rate): documents of each source and how often each should appear on average.

    Shares are in proportion to ``weights`` (sources not named get none) or, by
    default, to the source's documents to the power ``alpha``.  ``total`` is the
    expected size of the output (by default that of the input).  However small a
    positive weight is, its source has a rate (at least 2^-40 of the largest one's share).
    """
    spark = docs.sparkSession
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.pow(F.col("n"), F.lit(float(alpha)))
    else:
        pairs = [x for s, w in weights.items() for x in (F.lit(s), F.lit(float(w)))]
        weight = F.coalesce(F.create_map(*pairs)[F.col("source")], F.lit(0.0)) if pairs else F.lit(0.0)
    counts = written(spark, counts.withColumn("weight", weight), "sources")
    # whole numbers, so that sums don't depend on their order: millionths of weights of 1 or more, else
    # parts of the largest weight, and one part at least for a source that has a weight at all
    if weights is None and alpha >= 0:
        whole = F.round(F.col("weight") * 1_000_000).cast("long")
    else:
        largest = counts.agg(F.max("weight")).first()[0] or 1.0
        whole = F.when(F.col("weight") > 0, F.greatest(F.round(F.col("weight") / largest * float(PARTS)).cast("long"), F.lit(1))
                       ).otherwise(F.lit(0)).cast("long")
    counts = counts.withColumn("w", whole)
    n, w = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.col("w").cast("decimal(20,0)")), F.lit(0))).first()
    target = float(n if total is None else total)
    return counts.select("source", "n", (F.lit(target) * F.col("w") / F.lit(float(max(w, 1))) / F.col("n")).alias("rate"))


def replicate(docs: DataFrame, rates: DataFrame, source: str = "source", id_col: str = "doc_id", seed: int = 1) -> DataFrame:
    """Every document with its number of repetitions (column ``copies``, at least 1; others go).

    The table of rates has a row a source.  It is broadcast up to
    ``BROADCAST_SOURCES`` rows and joined by a shuffle beyond that.
    """
    names = docs.columns
    numbered = docs.select(*(F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(names)))
    key = {c.lower(): F.col(f"_c{i}") for i, c in enumerate(names)}
    parts = rates.filter("rate > 0").select("source", F.ceil(F.col("rate") / CHUNK).cast("int").alias("_m"), "rate")
    parts = parts.select("source", "_m", poisson_table(F.col("rate") / F.col("_m")).alias("_sums"))
    few = rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    joined = numbered.join(F.broadcast(parts) if few else parts, key[source.lower()].eqNullSafe(F.col("source")))
    name = F.coalesce(key[id_col.lower()].cast("string"), F.lit("null"))

    def drawn(j: Column) -> Column:
        u = F.array(uniform(seed, "copies", name, j.cast("string")))
        return F.get(F.transform(u, lambda x: F.size(F.filter(F.col("_sums"), lambda p: p <= x))), F.lit(0))

    copies = F.aggregate(F.sequence(F.lit(1), F.col("_m")), F.lit(0), lambda acc, j: acc + drawn(j))
    out = joined.withColumn("_copies", copies).filter("_copies > 0")
    return out.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(names)), F.col("_copies").alias(unused_name(docs, "copies")))


def mix_sources(docs: DataFrame, source: str = "source", id_col: str = "doc_id", seed: int = 1, weights: dict | None = None,
                alpha: float = 0.5, total: int | None = None) -> DataFrame:
    """The mixed documents in random order, with the number of each repetition (column ``replica``, from 1)."""
    copies, replica = unused_name(docs, "copies"), unused_name(docs, "replica")
    order = unused_name(docs, "order_key")
    out = replicate(docs, source_rates(docs, source, weights, alpha, total), source, id_col, seed)
    out = out.withColumn(replica, F.explode(F.sequence(F.lit(1), F.col(copies)))).drop(copies)
    name = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null"))
    out = out.withColumn(order, F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("order"), name, F.col(replica).cast("string"))))
    out = out.repartition(shuffle_width(docs.sparkSession), order).sortWithinPartitions(order)
    return out.drop(order)
