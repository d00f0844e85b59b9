"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

A source's repetition rate is what its target share asks for over what it has; a document gets a Poisson number of copies
with that mean, found by inverting the distribution at a number that depends on the seed and the document's id alone.  So
the draw is the same on any cluster and in any order, documents decide independently, and no counter is shared.  Copies
are dealt out and sorted by a hash, which is a global shuffle.

A large rate is split into equal parts of at most ``PART``, each with a draw of its own: a sum of Poisson numbers is
Poisson again, and no probability underflows.

Defined cases: a null source is a source of its own; a null or empty text has mass 0 but is drawn like any other of its
source; a source whose mass is 0, or which has no target weight, gets rate 0; equal ids (also null ones) share their draw;
an empty table gives an empty one; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexcohort.llm.common import fresh

#: A source far larger than the others (here: the first) is brought down; every other one gets an equal share.
WEIGHTS = {"src0": 0.1}
OTHER_WEIGHT = 0.05
SEED = 17
#: Largest mean of one draw, and the number of copies up to which its distribution is followed: the rest is below 1e-18.
PART, STEPS = 8, 48


def uniform(*parts: Column) -> Column:
    """In [0, 1): the first 52 bits of an MD5 over the parts joined by colons, so that other engines get the same."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def thresholds(mean: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... STEPS of a Poisson X."""
    def step(held, k):
        p = held["p"] * mean / k
        return F.struct(p.alias("p"), (held["c"] + p).alias("c"), F.concat(held["all"], F.array(held["c"] + p)).alias("all"))

    zero = F.exp(-mean)
    start = F.struct(zero.alias("p"), zero.alias("c"), F.array(zero).alias("all"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step, lambda held: held["all"])


def rates(docs: DataFrame, weights: Mapping[str, float], other: float, source: str = "source",
          text: str = "text") -> DataFrame:
    """``(source, rate)``, one row per source: target share over present share of the characters.

    Shares are over all sources present, so the expected size of the mixture is that of the input.
    """
    weight = F.lit(float(other))
    for name, w in weights.items():
        weight = F.when(F.col("source") == name, F.lit(float(w))).otherwise(weight)
    mass = (docs.select(F.col(source).alias("source"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("n"))
            .groupBy("source").agg(F.sum("n").alias("mass")).withColumn("weight", weight))
    # one row, read as two numbers
    all_mass = mass.agg(F.sum("mass")).scalar()
    all_weight = mass.agg(F.sum(F.when(F.col("mass") > 0, F.col("weight")))).scalar()
    share = F.col("weight") * all_mass / (all_weight * F.col("mass"))
    rate = F.when((F.col("mass") > 0) & (F.col("weight") > 0), share).otherwise(F.lit(0.0))
    return mass.select("source", rate.alias("rate"))


def copies(doc_id: Column, cuts: Column, n_parts: Column, seed: int) -> Column:
    """Poisson number of copies, by inversion; ``cuts`` are the thresholds of one of ``n_parts`` equal parts of the rate."""
    draws = F.transform(F.sequence(F.lit(1), n_parts), lambda i: uniform(F.lit(seed), doc_id, i))
    return F.aggregate(draws, F.lit(0), lambda n, u: n + F.size(F.filter(cuts, lambda c: c <= u)))


def mixed(docs: DataFrame, weights: Mapping[str, float] = WEIGHTS, other: float = OTHER_WEIGHT, seed: int = SEED,
          source: str = "source", doc_id: str = "doc_id", text: str = "text", partitions: int | None = None) -> DataFrame:
    """``docs`` with every row as often as drawn, plus ``rate``, ``copy`` (from 1) and the shuffle's key.

    Copies go to a partition by their key and lie in its order there.

    The table of rates has a row per source; Spark broadcasts it only if its measured size allows, and otherwise splits
    the partitions of a dominating source.
    """
    n_rate, n_cuts, n_parts, n_source, n_copy, n_key = fresh(docs, "rate", "cuts", "parts", "source_key", "copy", "shuffle_key")
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int")
    table = (rates(docs, weights, other, source, text).withColumn("parts", parts)
             .select(F.col("source").alias(n_source), F.col("rate").alias(n_rate), F.col("parts").alias(n_parts),
                     thresholds(F.col("rate") / F.col("parts")).alias(n_cuts)))
    drawn = docs.join(table, F.col(f"`{source}`").eqNullSafe(F.col(n_source)))
    many = copies(F.col(f"`{doc_id}`"), F.col(n_cuts), F.col(n_parts), seed)
    each = drawn.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(n_rate),
                        F.explode(F.sequence(F.lit(0), many)).alias(n_copy)).filter(F.col(n_copy) > 0)
    name = F.concat_ws(":", F.lit(f"order-{seed}"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")), F.col(n_copy).cast("string"))
    keyed = each.withColumn(n_key, F.md5(name))
    spread = keyed.repartition(partitions, n_key) if partitions else keyed.repartition(n_key)
    return spread.sortWithinPartitions(n_key)
