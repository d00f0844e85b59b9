"""Cohorts per hexagonal cell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexcohort.functions.expr import rnd
from hexcohort.sources.scratch import small_table


#: Labels up to which the wide form has a column for each.
WIDE = 1000


def cell_shares(df: DataFrame, cell: str = "home_h3", segment: str = "segment_id", min_subs: int = 5,
                segments: Sequence[int] | None = None) -> DataFrame:
    """Size, dominant segment, means, segment entropy and ``shares`` (a map by label) per cell, for any number of labels.

    Rows fold to one per (cell, label) before they are shuffled, and these to one per cell; the plan does not grow with the
    labels.  Noise (negative labels) and rows without cell are left out; the smallest label wins a tie.  ``segments`` limits
    which labels are looked at, in the order in which they win ties; sizes and means still cover all.
    """
    means = {"m_charges": "monthly_charges", "m_data": "data_usage_gb", "m_rsrq": "home_zone_rsrq"}
    folded = (df.filter((F.col(segment) >= 0) & F.col(cell).isNotNull()).groupBy(cell, F.col(segment).cast("int").alias("label_"))
              .agg(F.count(F.lit(1)).alias("n_"), *[F.sum(c).alias(f"s_{m}") for m, c in means.items()],
                   *[F.count(c).alias(f"c_{m}") for m, c in means.items()]))
    cells = (folded.groupBy(cell).agg(
        F.sum("n_").alias("n_subscribers"), *[F.try_divide(F.sum(f"s_{m}"), F.sum(f"c_{m}")).alias(m) for m in means],
        F.array_sort(F.collect_list(F.struct(F.col("label_").alias("label"), F.col("n_").cast("double").alias("n")))).alias("parts"))
        .filter(F.col("n_subscribers") >= min_subs))
    total, best, one = F.col("n_subscribers").cast("double"), F.col("parts"), F.lit(None).cast("int")
    if segments is not None:
        wanted = F.array(*[F.lit(int(k)) for k in segments])
        cells = cells.withColumn("parts", F.filter("parts", lambda e: F.array_contains(wanted, e["label"])))
        best, one = F.transform("parts", lambda e: F.struct((-e["n"]).alias("n"), F.array_position(wanted, e["label"]).alias("at"), e["label"].alias("label"))), F.lit(segments[0])
    else:
        best = F.transform("parts", lambda e: F.struct((-e["n"]).alias("n"), F.lit(0).alias("at"), e["label"].alias("label")))

    def term(e):
        p = e["n"] / total
        return p * F.ln(p + F.lit(1e-10))

    entropy = -F.aggregate("parts", F.lit(0.0), lambda t, e: t + term(e)) + F.lit(0.0)
    return cells.select(
        cell, "n_subscribers", F.coalesce(F.array_min(best)["label"], one).cast("int").alias("dominant_segment"),
        rnd(F.col("m_charges"), 2).alias("avg_monthly_charges"), rnd(F.col("m_data"), 2).alias("avg_data_usage_gb"),
        rnd(F.col("m_rsrq"), 2).alias("avg_rsrq"), entropy.alias("segment_entropy"),
        F.map_from_entries(F.transform("parts", lambda e: F.struct(e["label"], rnd(e["n"] / total, 3)))).alias("shares"))


def segment_ids(df: DataFrame, segment: str = "segment_id", most: int = WIDE) -> list[int]:
    """The labels in use, noise left out, ascending; at most ``most`` reach the driver."""
    rows, fits = small_table(df.filter(F.col(segment) >= 0).select(segment).distinct(), most)
    if not fits:
        raise ValueError(f"more than {most} labels: use cell_shares, which has them in a map")
    return sorted(r[0] for r in rows)


def segment_density(df: DataFrame, cell: str = "home_h3", segment: str = "segment_id", min_subs: int = 5,
                    segments: list[int] | None = None) -> DataFrame:
    """``cell_shares`` with a column of shares per label (``pct_seg_0`` ...)."""
    ids = (segments if segments is not None else segment_ids(df, segment)) or [0]   # no label: no rows, same shape
    wide = cell_shares(df, cell, segment, min_subs, ids)
    return wide.select(*[c for c in wide.columns if c != "shares"],
                       *[F.coalesce(F.try_element_at("shares", F.lit(int(k))), F.lit(0.0)).alias(f"pct_seg_{k}") for k in ids])


def distinct_sketches(df: DataFrame, partition: Sequence[str], column: str, lg_k: int = 14) -> DataFrame:
    """``(*partition, sketch)``: a HyperLogLog sketch of the column's values per partition (a refresh, a cell ...).

    Sketches are a few kilobytes whatever they counted, and are merged by ``distinct_over``.  The relative standard error is
    ``1.04 / sqrt(2 ** lg_k)``, 0.8 % at 14; nulls do not count.
    """
    return df.groupBy(*partition).agg(F.hll_sketch_agg(F.col(column).cast("string"), lg_k).alias("sketch"))


def distinct_over(sketches: DataFrame, keys: Sequence[str] = (), name: str = "n_distinct") -> DataFrame:
    """Distinct values over all partitions of ``sketches`` that share ``keys``, without the rows they came from."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))


def group_entropy(df: DataFrame, group: str, category: str, name: str = "entropy") -> DataFrame:
    """Entropy (natural log, +1e-10 inside) of a category within each group.

    Counts per (group, category) come first, so a group is folded before it is
    brought together.
    """
    counts = df.groupBy(group, category).agg(F.count(F.lit(1)).cast("double").alias("n"))
    # sum(-p ln p) needs the group total: one window over the folded counts
    p = F.col("n") / F.sum("n").over(Window.partitionBy(group))
    return (counts.withColumn("p", p).groupBy(group)
            .agg((-F.sum(F.col("p") * F.ln(F.col("p") + F.lit(1e-10))) + F.lit(0.0)).alias(name)))


def dominant_value(df: DataFrame, group: str, value: str, name: str = "dominant") -> DataFrame:
    """Most frequent value per group, smallest on ties; folded counts only."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(group).agg(F.min(F.struct(-F.col("n"), F.col(value).alias("v"))).alias("b"))
    return best.select(group, F.col("b.v").alias(name))


def cell_concentration(df: DataFrame, cell: str = "home_h3", top: float = 0.2) -> DataFrame:
    """Share of subscribers living in the fullest ``top`` fraction of cells.

    Works on the histogram "how many cells have n subscribers": the number of
    distinct sizes is far below the number of cells, so the running sum over it
    is a small window.
    """
    sizes = (df.filter(F.col(cell).isNotNull()).groupBy(cell).agg(F.count(F.lit(1)).alias("n"))
             .groupBy("n").agg(F.count(F.lit(1)).alias("cells")))
    down = Window.orderBy(F.desc("n"))
    every = Window.partitionBy(F.lit(1))
    run = (sizes.withColumn("upto", F.sum("cells").over(down))
           .withColumn("all_cells", F.sum("cells").over(every))
           .withColumn("all_subs", F.sum(F.col("n") * F.col("cells")).over(every)))
    wanted = F.ceil(F.col("all_cells") * F.lit(float(top)))
    taken = F.greatest(F.lit(0), F.least(F.col("cells"), wanted - (F.col("upto") - F.col("cells"))))
    return run.select("all_cells", "all_subs", (taken * F.col("n")).alias("s"), wanted.alias("w")).agg(
        F.max("all_cells").alias("n_cells"), F.max("w").alias("top_cells"),
        (F.sum("s").cast("double") / F.max("all_subs").cast("double")).alias("subscriber_share"))
