"""Mutual information of a numeric feature and a label by nearest neighbours, without bins.

For every row: the distance ``d`` to its ``k``-th nearest row of the same label, and the number ``m`` of rows of any label nearer
than ``d``.  With ``n`` rows, ``n_y`` of the row's label, and the digamma function ``psi``,

    mi = psi(n) + mean(psi(k)) - mean(psi(n_y)) - mean(psi(m)), at least 0.

A label with up to ``k`` rows uses one fewer than it has; labels with one row take no part.  Everything is one-dimensional, so
both steps are a range sort: rows are numbered in order and cut into chunks of positions, a chunk gets copies of the ``k`` rows
before and after it for the neighbours, and running sums get the totals of the chunks before.  Equal rows fold to one first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexcohort.operators.moments import long_values
from hexcohort.operators.numbering import number_rows
from hexcohort.sources.scratch import materialize

#: Rows of a chunk.
CHUNK = 1 << 16
#: Euler's constant, and from where on the series of the digamma function is used.
EULER, SERIES = 0.5772156649015329, 16


def digamma(n: Column) -> Column:
    """Digamma function of a whole number from 1."""
    x = n.cast("double")
    series = (F.ln(x) - F.lit(0.5) / x - F.lit(1 / 12) / x ** 2 + F.lit(1 / 120) / x ** 4 - F.lit(1 / 252) / x ** 6 + F.lit(1 / 240) / x ** 8)
    small = F.array(*[F.lit(sum(1 / i for i in range(1, m)) - EULER) for m in range(1, SERIES)])
    return F.when(n >= SERIES, series).otherwise(F.element_at(small, F.least(n, F.lit(SERIES - 1)).cast("int")))


def _neighbour_distance(rows: DataFrame, k: int, chunk: int) -> DataFrame:
    """Adds ``d`` to ``rows(feature, label, value, n, k)``: distance to the ``k``-th nearest other row of the same label."""
    placed = number_rows(rows, "pos", ["feature", "label", "value"])
    at, inside = F.floor(F.col("pos") / chunk), F.col("pos") % chunk
    copies = F.array_compact(F.array(at, F.when(inside < k, at - 1), F.when(inside >= chunk - k, at + 1)))
    spread = placed.withColumn("own", at).withColumn("chunk", F.explode(copies))
    near = F.collect_list(F.struct("feature", "label", "value", "n", "pos")).over(Window.partitionBy("chunk").orderBy("pos").rowsBetween(-k, k))
    around = spread.withColumn("near", near).filter(F.col("chunk") == F.col("own"))
    same = F.filter("near", lambda r: (r["feature"] == F.col("feature")) & r["label"].eqNullSafe(F.col("label")))
    apart = F.array_sort(F.transform(same, lambda r: F.struct(
        F.abs(r["value"] - F.col("value")).alias("d"), (r["n"] - F.when(r["pos"] == F.col("pos"), 1).otherwise(0)).alias("n"))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("d"))
    reach = F.aggregate(apart, start, lambda s, r: F.when(s["n"] >= F.col("k"), s).otherwise(F.struct((s["n"] + r["n"]).alias("n"), r["d"].alias("d"))))
    return around.select("feature", "label", "value", "n", "n_y", "k", reach["d"].alias("d"))


def _rows_before(data: DataFrame, asked: DataFrame, chunk: int) -> DataFrame:
    """``(feature, at, side, before)`` for ``asked(feature, at, side)``: rows of the feature below ``at`` (side 0) or up to it (side 2)."""
    events = data.select("feature", F.col("value").alias("at"), F.lit(1).alias("side"), "n").unionByName(
        asked.distinct().withColumn("n", F.lit(0).cast("long")))
    placed = number_rows(events, "pos", ["feature", "at", "side"]).withColumn("chunk", F.floor(F.col("pos") / chunk))
    totals = placed.groupBy("feature", "chunk").agg(F.sum("n").alias("total"))
    start = F.coalesce(F.sum("total").over(Window.partitionBy("feature").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    running = F.sum("n").over(Window.partitionBy("feature", "chunk").orderBy("pos"))
    return (placed.withColumn("running", running).filter("side <> 1").join(totals.withColumn("start", start), ["feature", "chunk"])
            .select("feature", "at", "side", (F.col("start") + F.col("running")).alias("before")))


def neighbour_information(df: DataFrame, features: Sequence[str], label: str, k: int = 3, chunk: int = CHUNK) -> DataFrame:
    """``(feature, mi)``; rows without a label, and missing or non-finite values of a feature, take no part in it.

    "Nearer than ``d``" is ``value - d < other < value + d``, or an equal value where ``d`` is 0.  A feature without two rows of
    one label has no row in the result.
    """
    values = long_values(df.filter(F.col(f"`{label}`").isNotNull()), [label], features).withColumnRenamed(label, "label")
    finite = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < float("inf"))
    folded = materialize(values.filter(finite).groupBy("feature", "label", (F.col("value") + F.lit(0.0)).alias("value")).agg(F.count(F.lit(1)).alias("n")), "values")
    per_label = folded.groupBy("feature", "label").agg(F.sum("n").alias("n_y")).filter("n_y > 1")       # features x labels
    rows = materialize(folded.join(per_label, ["feature", "label"]).withColumn("k", F.least(F.lit(k), F.col("n_y") - 1)), "labelled")
    far = materialize(_neighbour_distance(rows, k, chunk), "distances")
    tied = F.col("d") == 0
    low = F.struct((F.col("value") - F.col("d")).alias("at"), F.when(tied, 0).otherwise(2).alias("side"))
    high = F.struct((F.col("value") + F.col("d")).alias("at"), F.when(tied, 2).otherwise(0).alias("side"))
    ends = far.select("feature", "n", "n_y", "k", low.alias("low"), high.alias("high"))
    asked = ends.select("feature", F.explode(F.array("low", "high")).alias("e")).select("feature", "e.at", "e.side")
    before = materialize(_rows_before(rows.groupBy("feature", "value").agg(F.sum("n").alias("n")), asked, chunk), "before")
    end = F.struct("at", "side")
    found = (ends.join(before.select("feature", end.alias("low"), F.col("before").alias("below")), ["feature", "low"])
             .join(before.select("feature", end.alias("high"), F.col("before").alias("upto")), ["feature", "high"]))
    mean = lambda c: F.sum(F.col("n") * digamma(c)) / F.sum("n")      # noqa: E731
    mi = digamma(F.sum("n")) + mean(F.col("k")) - mean(F.col("n_y")) - mean(F.col("upto") - F.col("below"))
    return found.groupBy("feature").agg(F.greatest(mi, F.lit(0.0)).alias("mi"))
