"""Exact quantiles that never gather a large group in one task.

Values are read long, ``(group, feature, value)``.  Where no group is large the
built-in exact percentile does it in one pass.  A large group is narrowed down:
a round takes approximate quantiles of the interval that holds a wanted rank as
cuts (a sketch per task, merged), counts the values between and on the cuts,
and keeps the part with the rank.  Cuts are values that occur and are compared
only, so infinities, ties and any spread of magnitudes are narrowed alike: a
round leaves about one value in ``slots``.  Once few values are left they are
read exactly.  All state (ranks, intervals) is a table; linear interpolation
between neighbouring ranks in both ways.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexcohort.operators.moments import long_values
from hexcohort.sources.scratch import materialize

SLOTS = 64
READ_LIMIT = 10_000
ONE_PASS = 200_000


def _long(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return long_values(df, by, columns).filter(F.col("value").isNotNull())


def _one_pass(long: DataFrame, probs: Sequence[float], key: Sequence[str]) -> DataFrame:
    """Built-in exact percentiles, one group per feature, so that features spread over tasks."""
    q = long.groupBy(*key).agg(F.percentile("value", [float(p) for p in probs]).alias("q"))
    cells = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.col("q")[i].alias("value")) for i, p in enumerate(probs)])
    return q.select(*key, F.explode(cells).alias("c")).select(*key, "c.prob", "c.value")


def _matched(left: DataFrame, right: DataFrame, key: Sequence[str], how: str) -> DataFrame:
    """Join on the key columns, NULL matching NULL; the right side's key columns are dropped."""
    if not key:
        return left.withColumn("one_", F.lit(1)).join(right.withColumn("one_", F.lit(1)), "one_", how).drop("one_")
    renamed = right.withColumnsRenamed({k: f"{k}_r" for k in key})
    cond = [F.col(k).eqNullSafe(F.col(f"{k}_r")) for k in key]
    return left.join(renamed, cond, how).drop(*[f"{k}_r" for k in key])


def _ranks(sizes: DataFrame, probs: Sequence[float], key: Sequence[str]) -> DataFrame:
    """``(*key, prob, pos, rank)``: the one or two ranks that each probability needs."""
    each = sizes.select(*key, "n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
    each = each.withColumn("pos", (F.col("n") - 1) * F.col("prob"))
    ranks = F.array_distinct(F.array(F.floor("pos").cast("long"), F.ceil("pos").cast("long")))
    return each.select(*key, "n", "prob", "pos", F.explode(ranks).alias("rank"))


def _narrowed(long: DataFrame, targets: DataFrame, key: Sequence[str], read_limit: int, slots: int) -> DataFrame:
    """``targets(*key, rank, n, before, lo, hi)`` with every interval one value or small enough to read."""
    done = None
    spot = [*key, "lo", "hi"]
    within = F.col("value").between(F.col("lo"), F.col("hi"))
    cuts = [(i + 1) / slots for i in range(slots - 1)]
    while True:
        settled = (F.col("n") <= read_limit) | (F.col("lo") == F.col("hi"))
        done = targets.filter(settled) if done is None else done.unionByName(targets.filter(settled))
        targets = targets.filter(~settled)
        if targets.isEmpty():
            return done
        spots = targets.select(*spot, "before").distinct()
        sketched = (_matched(long, spots, key, "inner").filter(within).groupBy(*spot, "before")
                    .agg(F.array_distinct(F.percentile_approx("value", cuts, 100 * slots)).alias("cuts")))
        place = F.size(F.filter("cuts", lambda c: c < F.col("value"))) * 2 + F.array_contains("cuts", F.col("value")).cast("int")
        counts = (_matched(long, materialize(sketched, "cuts"), key, "inner").filter(within)
                  .groupBy(*spot, "before", place.alias("slot"))
                  .agg(F.count(F.lit(1)).alias("held"), F.min("value").alias("from"), F.max("value").alias("to")))
        upto = F.col("before") + F.sum("held").over(Window.partitionBy(*spot).orderBy("slot"))
        parts = counts.select(*spot, "from", "to", "held", upto.alias("upto"))
        hit = (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("held"))
        targets = materialize(_matched(targets.drop("n", "before"), parts, spot, "inner").filter(hit)
                              .select(*key, "rank", F.col("held").alias("n"), (F.col("upto") - F.col("held")).alias("before"),
                                      F.col("from").alias("lo"), F.col("to").alias("hi")), "ranks")


def _refined(long: DataFrame, sizes: DataFrame, probs: Sequence[float], key: Sequence[str], read_limit: int,
             slots: int) -> DataFrame:
    ranks = materialize(_ranks(sizes, probs, key), "ranks")
    start = _matched(ranks.select(*key, "rank").distinct(), sizes, key, "inner").withColumn("before", F.lit(0).cast("long"))
    found = materialize(_narrowed(long, start.select(*key, "rank", "n", "before", "lo", "hi"), key, read_limit, slots), "ranks")
    spots = found.filter(F.col("lo") != F.col("hi")).select(*key, "lo", "hi").distinct()
    inside = _matched(long, spots, key, "inner").filter(F.col("value").between(F.col("lo"), F.col("hi")))
    lists = inside.groupBy(*key, "lo", "hi").agg(F.array_sort(F.collect_list("value")).alias("values"))
    read = _matched(found, lists, [*key, "lo", "hi"], "left")
    at = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(
        F.try_element_at("values", (F.col("rank") - F.col("before") + 1).cast("int")))
    values = read.select(*key, "rank", at.alias("value"))
    pairs = (_matched(ranks, values, [*key, "rank"], "inner").groupBy(*key, "prob", "pos")
             .agg(F.min_by("value", "rank").alias("low"), F.max_by("value", "rank").alias("high"),
                  F.min("rank").alias("k0"), F.max("rank").alias("k1")))
    mixed = (F.col("k1") - F.col("pos")) * F.col("low") + (F.col("pos") - F.col("k0")) * F.col("high")
    return pairs.select(*key, "prob", F.when(F.col("k0") == F.col("k1"), F.col("low")).otherwise(mixed).alias("value"))


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                    one_pass: int = ONE_PASS, read_limit: int = READ_LIMIT, slots: int = SLOTS) -> DataFrame:
    """Long table ``(*by, feature, prob, value)`` of exact quantiles per group; any number of groups of any size."""
    by = list(by)
    key = [*by, "feature"]
    long = _long(df.select(*by, *columns), by, columns)
    sizes = materialize(long.groupBy(*key).agg(F.count("value").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")),
                        "sizes")
    large = sizes.filter(F.col("n") > one_pass)
    if large.isEmpty():
        return _one_pass(long, probs, key)
    long = materialize(long, "long")
    marked = _matched(long, large.select(*key, F.lit(True).alias("is_large")), key, "left")
    small = _one_pass(marked.filter(F.col("is_large").isNull()), probs, key)
    return small.unionByName(_refined(long, large, probs, key, read_limit, slots))


def medians(df: DataFrame, columns: Sequence[str], **kw) -> dict[str, float]:
    """Exact medians of whole columns (driver holds one number per column)."""
    if not columns:
        return {}
    rows = exact_quantiles(df, columns, [0.5], **kw).collect()
    return {r["feature"]: r["value"] for r in rows if r["value"] is not None}


def quantile_values(df: DataFrame, columns: Sequence[str], probs: Sequence[float], **kw) -> dict[str, list[float]]:
    rows = exact_quantiles(df, columns, probs, **kw).collect()
    found = {(r["feature"], r["prob"]): r["value"] for r in rows}
    return {c: [found.get((c, float(p))) for p in probs] for c in columns}
