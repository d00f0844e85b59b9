"""Counts, means and variances of many columns at once.

Rows are turned to (group, feature, value) on the fly and folded by one small
aggregation: the plan stays the same size whatever the number of columns, and
partial sums leave each task instead of rows.  Tables without gaps use the
vector summary of Spark ML, which folds a whole row in one step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def long_values(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``(*by, feature, value)``; missing values stay."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(*by, F.explode(pairs).alias("p")).select(*by, "p.feature", "p.value")


def grouped_moments(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """``(group, feature, rows_n, n, m, v)``: rows, values, mean and population variance."""
    return long_values(df, [group], columns).groupBy(group, "feature").agg(
        F.count(F.lit(1)).alias("rows_n"), F.count("value").alias("n"), F.avg("value").alias("m"),
        F.var_pop("value").alias("v"))


def complete_moments(df: DataFrame, columns: Sequence[str], group: str) -> DataFrame:
    """Same table for columns without missing values."""
    vec = array_to_vector(F.array(*[F.col(c).cast("double") for c in columns]))
    s = df.groupBy(group).agg(F.count(F.lit(1)).alias("rows_n"),
                              Summarizer.metrics("mean", "variance").summary(vec).alias("s"))
    parts = s.select(group, "rows_n", vector_to_array("s.mean").alias("m"), vector_to_array("s.variance").alias("v"))
    names = F.array(*[F.lit(c) for c in columns])
    n = F.col("rows_n").cast("double")
    return (parts.select(group, "rows_n", F.explode(F.arrays_zip(names.alias("feature"), "m", "v")).alias("z"))
            .select(group, F.col("z.feature").alias("feature"), "rows_n", F.col("rows_n").alias("n"), F.col("z.m").alias("m"),
                    (F.col("z.v") * (n - F.lit(1.0)) / n).alias("v")))


def with_totals(moments: DataFrame) -> DataFrame:
    """Adds the same numbers over all groups, merged from the folded rows: ``all_rows, all_n, all_m, all_ss``."""
    w = Window.partitionBy("feature")
    m = moments.withColumns({"all_rows": F.sum("rows_n").over(w), "all_n": F.sum("n").over(w),
                             "all_sum": F.sum(F.col("n") * F.col("m")).over(w)})
    m = m.withColumn("all_m", F.try_divide(F.col("all_sum"), F.col("all_n"))).drop("all_sum")
    inner = F.col("n") * (F.col("v") + F.pow(F.col("m") - F.col("all_m"), 2))
    return m.withColumn("all_ss", F.sum(inner).over(w))


def column_stats(df: DataFrame, columns: Sequence[str], complete: bool = False) -> dict[str, dict[str, float]]:
    """``mean, std (population), lo, hi`` per column; four numbers per column reach the driver."""
    if complete:
        vec = array_to_vector(F.array(*[F.col(c).cast("double") for c in columns]))
        s = df.select(Summarizer.metrics("count", "mean", "variance", "min", "max").summary(vec).alias("s")).first()["s"]
        n = s["count"]
        pop = (n - 1) / n if n else 0.0
        return {c: {"mean": float(s["mean"][i]), "std": float(s["variance"][i] * pop) ** 0.5,
                    "lo": float(s["min"][i]), "hi": float(s["max"][i])} for i, c in enumerate(columns)}
    rows = long_values(df, [], columns).groupBy("feature").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("lo"),
        F.max("value").alias("hi")).collect()
    return {r["feature"]: r.asDict() for r in rows}
