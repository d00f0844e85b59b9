"""Exploratory measures: correlation, mutual information, variance, winsorising, label codes."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.expr import clip, literal_map, rnd
from hexcohort.functions.joins import join_small
from hexcohort.operators.moments import long_values
from hexcohort.operators.numbering import number_rows
from hexcohort.operators.profile import population_std
from hexcohort.operators.quantiles import exact_quantiles, quantile_values


def correlation_matrix(df: DataFrame, features: Sequence[str] = tuple(K.CORRELATION_FEATURES),
                       complete: bool | None = None) -> DataFrame:
    """Pearson correlation of every feature pair (i < j), pairwise complete.

    Without missing values (looked up unless told) the matrix comes from Spark
    ML, which folds whole rows; otherwise every pair is its own aggregate.
    """
    cols = [c for c in features if c in df.columns]
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    schema = "pos int, feature_a string, feature_b string, corr double"
    if complete is None:
        gap = F.greatest(*[F.col(c).isNull().cast("int") for c in cols], F.lit(0))
        complete = df.agg(F.max(gap).alias("g")).first()["g"] == 0
    if complete:
        vec = df.select(array_to_vector(F.array(*[F.col(c).cast("double") for c in cols])).alias("v"))
        m = Correlation.corr(vec, "v").first()[0].toArray()      # features x features
        rows = [(n, cols[i], cols[j], None if math.isnan(m[i, j]) else float(m[i, j])) for n, (i, j) in enumerate(pairs)]
        return df.sparkSession.createDataFrame(rows, schema)
    row = df.agg(*[F.corr(cols[i], cols[j]).alias(f"p{n}") for n, (i, j) in enumerate(pairs)])
    cells = [F.struct(F.lit(n).alias("pos"), F.lit(cols[i]).alias("feature_a"), F.lit(cols[j]).alias("feature_b"),
                      F.nanvl(F.col(f"p{n}"), F.lit(None).cast("double")).alias("corr")) for n, (i, j) in enumerate(pairs)]
    return row.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def top_correlations(df: DataFrame, features: Sequence[str] = tuple(K.CORRELATION_FEATURES), n: int = 10,
                     digits: int = 6) -> DataFrame:
    """The ``n`` largest absolute correlations below 1, each value once (first declared pair)."""
    m = correlation_matrix(df, features).withColumn("value", rnd(F.abs("corr"), digits)).filter(F.col("value") < 1.0)
    first = m.groupBy("value").agg(F.min(F.struct("pos", "feature_a", "feature_b")).alias("p"))
    return (first.select("p.feature_a", "p.feature_b", F.col("value").alias("abs_corr"))
            .orderBy(F.desc("abs_corr")).limit(n))


def mutual_information(df: DataFrame, features: Sequence[str], label: str, bins: int = 10) -> DataFrame:
    """``(feature, mi)`` by counts over quantile bins of the feature and the label.

    The bin limits are exact quantiles, each a value of the feature or strictly
    between two neighbouring ones, so no rounding decides a bin; the rows are folded to (feature, bin,
    label) counts before anything is shuffled.
    """
    probs = [i / bins for i in range(1, bins)]
    limits = quantile_values(df, features, probs)
    cells = []
    for c in features:
        over = [F.when(F.col(c) > F.lit(v), 1).otherwise(0) for v in limits[c] if v is not None]
        b = sum(over, F.lit(0))
        cells.append(F.struct(F.lit(c).alias("feature"), F.when(F.col(c).isNotNull(), b).alias("bin")))
    joint = (df.select(F.col(label).alias("label"), F.explode(F.array(*cells)).alias("c"))
             .select("label", "c.feature", "c.bin").filter(F.col("bin").isNotNull() & F.col("label").isNotNull())
             .groupBy("feature", "bin", "label").agg(F.count(F.lit(1)).cast("double").alias("n")))
    every = F.sum("n").over(Window.partitionBy("feature"))
    by_bin = F.sum("n").over(Window.partitionBy("feature", "bin"))
    by_label = F.sum("n").over(Window.partitionBy("feature", "label"))
    p = joint.select("feature", "n", every.alias("all_n"), by_bin.alias("bin_n"), by_label.alias("label_n"))
    term = F.col("n") / F.col("all_n") * F.ln(F.col("n") * F.col("all_n") / (F.col("bin_n") * F.col("label_n")))
    return p.groupBy("feature").agg((F.sum(term) + F.lit(0.0)).alias("mi"))


def feature_variance(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``(feature, raw_variance, scaled_variance)``: sample variance before and after standard scaling."""
    m = long_values(df, [], features).groupBy("feature").agg(
        F.var_samp("value").alias("raw_variance"), F.var_pop("value").alias("p"), F.avg("value").alias("m"))
    scaled = F.when(F.sqrt("p") <= F.abs("m") * F.lit(1e-12), F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("raw_variance"), F.col("p")), F.lit(0.0)))
    return m.select("feature", "raw_variance", scaled.alias("scaled_variance"))


def low_variance(df: DataFrame, features: Sequence[str], threshold: float = K.LOW_VARIANCE) -> DataFrame:
    return feature_variance(df, features).withColumn("is_low", F.col("scaled_variance") < F.lit(threshold))


def winsor_bounds(df: DataFrame, features: Sequence[str], group: str, lo: float = 0.01,
                  hi: float = 0.99) -> DataFrame:
    """``(group, feature, low, high)`` by exact quantiles within each group."""
    q = exact_quantiles(df, features, [lo, hi], by=[group])
    return q.groupBy(group, "feature").agg(F.max(F.when(F.col("prob") == lo, F.col("value"))).alias("low"),
                                           F.max(F.when(F.col("prob") == hi, F.col("value"))).alias("high"))


def winsorize(df: DataFrame, feature: str, group: str, lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """The feature clipped to the quantiles of its group, as ``<feature>_w``."""
    bounds = winsor_bounds(df, [feature], group, lo, hi).drop("feature")
    x = F.col(feature)
    limited = F.when(x.isNotNull(), F.least(F.greatest(x, F.col("low")), F.col("high")))
    return join_small(df, bounds, group).withColumn(f"{feature}_w", limited).drop("low", "high")


def histogram(df: DataFrame, feature: str, group: str, bins: int = 40) -> DataFrame:
    """Density histogram per group after winsorising: ``(group, bin, n, density)``.

    Every group has ``bins`` equal bins over its own clipped range.
    """
    bounds = winsor_bounds(df, [feature], group).drop("feature")
    rows = join_small(df.select(group, feature).filter(F.col(feature).isNotNull()), bounds, group)
    x = F.least(F.greatest(F.col(feature), F.col("low")), F.col("high"))
    width = (F.col("high") - F.col("low")) / F.lit(float(bins))
    pos = F.coalesce(F.floor(F.try_divide(x - F.col("low"), width)), F.lit(0))
    counted = (rows.select(group, F.least(pos, F.lit(bins - 1)).cast("int").alias("bin"), width.alias("w"))
               .groupBy(group, "bin").agg(F.count(F.lit(1)).alias("n"), F.max("w").alias("w")))
    total = F.sum("n").over(Window.partitionBy(group))
    return counted.select(group, "bin", "n", F.try_divide(F.col("n").cast("double"), total * F.col("w")).alias("density"))


def label_encode(df: DataFrame, column: str, name: str) -> DataFrame:
    """Codes 0..k-1 in alphabetical order of the distinct values."""
    codes = number_rows(df.select(column).filter(F.col(column).isNotNull()).distinct(), name, [column])
    return join_small(df, codes.withColumn(name, F.col(name).cast("int")), column)


def radar(moments: DataFrame, dims: dict[str, str]) -> DataFrame:
    """Segment means on a 0-1 scale where the population mean sits at 0.5 (mean +- 2 deviations)."""
    name = F.element_at(literal_map({c: n for n, c in dims.items()}), F.col("feature"))
    std, mean = population_std(), F.col("all_m")
    v = clip((F.col("m") - (mean - F.lit(2.0) * std)) / (F.lit(4.0) * std + F.lit(1e-6)), 0, 1)
    return (moments.filter((F.col("segment_id") >= 0) & F.col("feature").isin(list(dims.values())))
            .select("segment_id", name.alias("dimension"), v.alias("value"), F.lit(0.5).alias("population")))
