"""Reporting queries: the tables behind charts, dashboards and listings.

Each folds the subscriber table to segments, personas or cells first; names and
plans are attached to the folded rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.expr import literal_map, rnd
from hexcohort.functions.joins import join_small
from hexcohort.operators.profile import display_label, segment_moments
from hexcohort.operators.quantiles import exact_quantiles, quantile_values
from hexcohort.operators.recommend import plan_name, plan_price
from hexcohort.operators.sampling import hash_sample
from hexcohort.sources.sinks import colour


def _named(df: DataFrame, names: DataFrame | None, fallback: str) -> DataFrame:
    """Left join of segment names onto a folded table."""
    other = F.concat(F.lit(fallback), F.col("segment_id").cast("string"))
    if names is None:
        return df.withColumn("name", other)
    return (df.join(names.select("segment_id", F.col("segment_name").alias("name")), "segment_id", "left")
            .withColumn("name", F.coalesce("name", other)))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def size_pct(df: DataFrame, column: str = "segment_id") -> DataFrame:
    """Rows and percent of all rows per value."""
    n = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n").cast("double") / F.sum("n").over(Window.partitionBy(F.lit(1))).cast("double") * F.lit(100.0)
    return n.withColumn("pct", rnd(share, 1))


def group_means(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(group).agg(*[F.avg(c).alias(f"mean_{c}") for c in columns])


def group_medians(df: DataFrame, group: str, column: str) -> DataFrame:
    return exact_quantiles(df, [column], [0.5], by=[group]).select(group, F.col("value").alias(f"median_{column}"))


def group_sums(df: DataFrame, group: str, column: str) -> DataFrame:
    return df.groupBy(group).agg(F.sum(column).alias(f"total_{column}"))


def flag_rates(df: DataFrame, group: str, flags: Sequence[str]) -> DataFrame:
    return df.groupBy(group).agg(*[F.avg(F.col(c).cast("double")).alias(f"rate_{c}") for c in flags])


def category_shares(df: DataFrame, group: str, category: str, levels: Sequence[str], digits: int = 2) -> DataFrame:
    """Share of every level within the group, one column per level, 0 when absent."""
    known = F.count(category).cast("double")
    return df.groupBy(group).agg(*[
        rnd(F.coalesce(F.try_divide(F.count_if(F.col(category) == v).cast("double"), known), F.lit(0.0)), digits)
        .alias(f"{category}_{v}") for v in levels])


def n_distinct(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column: folded per value first, or by sketch."""
    if approximate:
        return df.agg(*[F.approx_count_distinct(c).alias(f"n_{c}") for c in columns])
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns])


def kpi_overview(df: DataFrame) -> DataFrame:
    """Subscribers, segments, mean charges and mean data volume (one pass over folded segments)."""
    per = df.groupBy("segment_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("monthly_charges").alias("c"), F.count("monthly_charges").alias("nc"),
        F.sum("data_usage_gb").alias("d"), F.count("data_usage_gb").alias("nd"))
    return per.agg(F.sum("n").alias("n_subscribers"), F.count("segment_id").alias("n_segments"),
                   F.try_divide(F.sum("c"), F.sum("nc")).alias("avg_monthly_charges"),
                   F.try_divide(F.sum("d"), F.sum("nd")).alias("avg_data_usage_gb"))


def geo_centre(df: DataFrame, group: str | None = None, lat: str = "home_lat", lon: str = "home_lon") -> DataFrame:
    aggs = [F.avg(lat).alias("centre_lat"), F.avg(lon).alias("centre_lon")]
    return df.groupBy(group).agg(*aggs) if group else df.agg(*aggs)


def segment_distribution(df: DataFrame, names: DataFrame | None = None, metric: str | None = None) -> DataFrame:
    """Subscribers (or the mean of a metric) per segment with its name."""
    value = F.avg(metric).alias(f"mean_{metric}") if metric else F.count(F.lit(1)).alias("n")
    return _named(df.groupBy("segment_id").agg(value), names, "Segment ")


def usage_by_segment(df: DataFrame, names: DataFrame | None = None) -> DataFrame:
    agg = df.groupBy("segment_id").agg(F.avg("data_usage_gb").alias("avg_data_usage_gb"))
    return _named(agg, names, "Seg ").orderBy("avg_data_usage_gb")


def box_stats(df: DataFrame, column: str, group: str = "segment_id") -> DataFrame:
    """Minimum, quartiles and maximum per group."""
    probs = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    q = exact_quantiles(df, [column], list(probs.values()), by=[group])
    return q.groupBy(group).agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for n, p in probs.items()])


def usage_sample(df: DataFrame, n: int = 3000, seed: int = 42) -> DataFrame:
    """Seeded sample of data volume against charges."""
    return hash_sample(df.select("subscriber_id", "segment_id", "data_usage_gb", "monthly_charges"), n, seed=seed)


def segment_points(df: DataFrame, names: DataFrame | None = None, n: int = 4000, seed: int = 42) -> DataFrame:
    """Seeded sample of home positions with colour and label per segment."""
    pts = hash_sample(df.select("subscriber_id", "segment_id", "home_lat", "home_lon"), n, seed=seed)
    if names is not None:
        pts = join_small(pts, names.select("segment_id", "segment_name"), "segment_id")
    else:
        pts = pts.withColumn("segment_name", F.lit(None).cast("string"))
    return pts.select("subscriber_id", "segment_id", "home_lat", "home_lon",
                      F.when(F.col("segment_id") < 0, F.lit(K.NOISE_COLOUR)).otherwise(colour(F.col("segment_id")))
                      .alias("color"), display_label(F.col("segment_id"), F.col("segment_name")).alias("label"))


def density_kpis(density: DataFrame) -> DataFrame:
    return density.agg(F.count(F.lit(1)).alias("n_cells"),
                       F.coalesce(F.sum("n_subscribers"), F.lit(0)).alias("covered_subscribers"),
                       F.avg("avg_monthly_charges").alias("avg_arpu"))


def cell_heat(density: DataFrame, names: dict[int, str] | None = None, cell: str = "home_h3", n: int = 20) -> DataFrame:
    """Segment shares of the first ``n`` cells, columns renamed to segment names."""
    names = names or {}
    shares = {c: names.get(int(c[len("pct_seg_"):]), c) for c in density.columns if c.startswith("pct_seg_")}
    return density.orderBy(cell).limit(n).select(cell, *[F.col(c).alias(v) for c, v in shares.items()])


def dominant_counts(density: DataFrame) -> DataFrame:
    return density.groupBy("dominant_segment").agg(F.count(F.lit(1)).alias("n_cells"))


def time_mix(df: DataFrame) -> DataFrame:
    """Mean share per part of the day, segment against all: ``(segment_id, time_window, grp, data_ratio)``."""
    cols = list(K.TIME_WINDOWS.values())
    m = segment_moments(df.select("segment_id", *cols), cols).filter(F.col("segment_id") >= 0)
    window = F.element_at(literal_map({c: w for w, c in K.TIME_WINDOWS.items()}), F.col("feature"))
    both = F.array(F.struct(F.lit("Segment").alias("grp"), F.col("m").alias("data_ratio")),
                   F.struct(F.lit("All Subs").alias("grp"), F.col("all_m").alias("data_ratio")))
    return m.select("segment_id", window.alias("time_window"), F.explode(both).alias("c")).select(
        "segment_id", "time_window", "c.*")


def segment_heatmap(df: DataFrame, features: Sequence[str] = tuple(K.HEATMAP_FEATURES)) -> DataFrame:
    """Z-score of segment means across segments (population deviation over the k rows, none -> 0)."""
    means = df.groupBy("segment_id").agg(*[F.avg(c).alias(c) for c in features])
    every = Window.partitionBy(F.lit(1))
    cols = []
    for c in features:
        m, s = F.avg(c).over(every), F.stddev_pop(c).over(every)
        dust = F.abs(m) * F.lit(1e-12)
        cols.append(F.when(s <= dust, F.lit(0.0)).otherwise((F.col(c) - m) / s).alias(f"z_{c}"))
    return means.select("segment_id", *cols)


def _revenue(df: DataFrame) -> DataFrame:
    """Size, mean charge and revenue per segment, with the share of all rows."""
    per = df.groupBy("segment_id").agg(F.count(F.lit(1)).alias("n"), F.avg("monthly_charges").alias("arpu"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1))).cast("double")
    return per.withColumns({"pct": F.col("n").cast("double") / total * F.lit(100.0), "revenue": F.col("arpu") * F.col("n")})


def action_plan(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Marketing table: size, percent, mean charge, revenue and the first two offers per segment."""
    offers = F.array_join(F.transform(F.slice("plans", 1, 2), lambda p: F.concat(
        plan_name(p), F.lit(" ($"), plan_price(p, 60.0).cast("int").cast("string"), F.lit(")"))), " | ")
    return (dim.select("segment_id", "segment_name", offers.alias("top_offers"))
            .join(_revenue(df), "segment_id", "left")
            .select("segment_id", "segment_name", F.coalesce("n", F.lit(0)).alias("n"),
                    rnd(F.coalesce("pct", F.lit(0.0)), 1).alias("pct"), "arpu", "revenue", "top_offers"))


def upsell(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Gap between the price of the first plan and the mean charge, where positive, times the size."""
    first = F.coalesce(F.get("plans", 0), F.lit("data_boost"))
    gap = F.col("price") - F.col("arpu")
    return (dim.select("segment_id", "segment_name", first.alias("plan_id"))
            .withColumn("price", plan_price(F.col("plan_id"), 60.0))
            .join(_revenue(df), "segment_id").filter(gap > 0)
            .select("segment_id", "segment_name", "plan_id", gap.alias("uplift_per_sub"), "n",
                    (gap * F.col("n")).alias("total_uplift")))


def uplift_estimate(df: DataFrame, share: float = K.UPLIFT_SHARE) -> DataFrame:
    """Assumed share of each segment's revenue."""
    return (_revenue(df).filter(F.col("segment_id") >= 0)
            .select("segment_id", "n", "revenue", (F.col("revenue") * F.lit(share)).alias("uplift")))


def heat_points(df: DataFrame, weight: str = "data_usage_gb") -> DataFrame:
    """Positions with a weight relative to the 95th percentile."""
    top = quantile_values(df, [weight], [0.95])[weight][0]
    scale = F.lit(float(top)) if top else F.lit(1.0)
    return df.filter(F.col("home_lat").isNotNull() & F.col("home_lon").isNotNull()).select(
        "subscriber_id", "home_lat", "home_lon", (F.col(weight) / scale).alias("weight"))
