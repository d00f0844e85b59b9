"""Segment profiles, archetype matching, names and the segment dimension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.expr import argmax_label, literal_map, numeric_columns, rnd
from hexcohort.operators.moments import grouped_moments, with_totals


def profile_features(df: DataFrame) -> list[str]:
    """Numeric columns minus ids, flags and cell counts."""
    return [c for c in numeric_columns(df) if c not in K.PROFILE_EXCLUDED and not c.startswith("h3_poi_")]


def segment_moments(df: DataFrame, features: Sequence[str], segment: str = "segment_id") -> DataFrame:
    """``(segment_id, feature, rows_n, n, m, v)`` with the ``all_*`` numbers of the whole table.

    One folding pass over the table; the whole-table numbers are merged from
    the folded rows.
    """
    m = grouped_moments(df, features, segment)
    return with_totals(m if segment == "segment_id" else m.withColumnRenamed(segment, "segment_id"))


def population_std() -> Column:
    """Sample deviation over all rows; no spread (or rounding dust) counts as 1."""
    std = F.sqrt(F.try_divide(F.col("all_ss"), F.col("all_n") - 1))
    return F.when(std <= F.abs(F.col("all_m")) * F.lit(1e-12), F.lit(1.0)).otherwise(std)


def segment_zscores(df: DataFrame, features: Sequence[str], segment: str = "segment_id") -> DataFrame:
    """Size, percent, mean and z-score per segment (noise left out, counted in the total)."""
    m = segment_moments(df, features, segment).filter(F.col("segment_id") >= 0)
    z = (F.col("m") - F.col("all_m")) / population_std()
    values = F.struct((rnd(F.col("m"), 3) + F.lit(0.0)).alias("mean"), (rnd(z, 3) + F.lit(0.0)).alias("zscore"))
    # one map per segment: at most one entry per feature
    wide = m.withColumn("values", values).groupBy("segment_id").agg(
        F.max("rows_n").alias("n_subscribers"), F.max("all_rows").alias("all_rows"),
        F.map_from_entries(F.collect_list(F.struct("feature", "values"))).alias("f"))
    pct = rnd(F.col("n_subscribers").cast("double") / F.col("all_rows").cast("double") * F.lit(100.0), 1)
    return wide.select("segment_id", "n_subscribers", pct.alias("pct_of_total"),
                       *[F.col("f")[c][k].alias(f"{k}_{c}") for c in features for k in ("mean", "zscore")])


def archetype_scores(columns: Sequence[str], features: Sequence[str],
                     archetypes: Mapping[str, Mapping[str, int]] = K.ARCHETYPES) -> list[tuple[str, Column]]:
    """(name, score) per archetype: sum of direction x z over the features present."""
    out = []
    for name, signature in archetypes.items():
        terms = [F.lit(float(d)) * F.col(f"zscore_{f}") for f, d in signature.items()
                 if f in features and f"zscore_{f}" in columns]
        out.append((name, reduce(lambda a, b: a + b, terms, F.lit(0.0))))
    return out


def match_archetype(profiles: DataFrame, features: Sequence[str],
                    archetypes: Mapping[str, Mapping[str, int]] = K.ARCHETYPES) -> DataFrame:
    """Adds ``archetype`` (best score, first declared on ties) and ``archetype_score``."""
    scores = archetype_scores(profiles.columns, features, archetypes)
    return profiles.withColumns({
        "archetype": F.coalesce(argmax_label(scores), F.lit(K.UNKNOWN_SEGMENT)),
        "archetype_score": F.greatest(*[s for _, s in scores])})


def name_segments(matched: DataFrame) -> DataFrame:
    """Adds the display name (second use of an archetype gets `` 2``), description and plans."""
    nth = F.row_number().over(Window.partitionBy("archetype").orderBy("segment_id"))
    suffix = F.when(nth > 1, F.concat(F.lit(" "), nth.cast("string"))).otherwise(F.lit(""))
    fallback = F.array(*[F.lit(p) for p in K.FALLBACK_PLANS])
    return matched.withColumns({
        "segment_name": F.concat("archetype", suffix),
        "segment_description": F.coalesce(F.try_element_at(literal_map(K.ARCHETYPE_DESCRIPTIONS), F.col("archetype")),
                                          F.lit(K.FALLBACK_DESCRIPTION)),
        "plans": F.coalesce(F.try_element_at(literal_map(K.ARCHETYPE_PLANS), F.col("archetype")), fallback)})


def profile_segments(df: DataFrame, features: Sequence[str] | None = None,
                     segment: str = "segment_id") -> DataFrame:
    """Profiles with names, descriptions and plans: one row per segment."""
    feats = list(features) if features is not None else profile_features(df)
    matched = match_archetype(segment_zscores(df, feats, segment), feats)
    return name_segments(matched).drop("archetype_score").orderBy("segment_id")


def segment_dimension(df: DataFrame, segment: str = "segment_id") -> DataFrame:
    """(segment_id, segment_name, segment_description, plans, n_subscribers, pct_of_total).

    Only the features the archetypes look at are read.
    """
    wanted = list(dict.fromkeys(f for sig in K.ARCHETYPES.values() for f in sig if f in df.columns))
    return profile_segments(df, wanted, segment).select(
        "segment_id", "segment_name", "segment_description", "plans", "n_subscribers", "pct_of_total")


def list_segments(dim: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    """Segments with size, share, first three plans and (empty) traits; unknown sizes are 0."""
    base = dim
    if profiles is not None:
        base = dim.drop("n_subscribers", "pct_of_total").join(
            profiles.select("segment_id", "n_subscribers", "pct_of_total"), "segment_id", "left")
    return base.select(
        "segment_id", "segment_name", F.coalesce("segment_description", F.lit("")).alias("description"),
        F.coalesce("n_subscribers", F.lit(0)).cast("bigint").alias("n_subscribers"),
        F.coalesce("pct_of_total", F.lit(0.0)).alias("pct_of_total"),
        F.slice("plans", 1, 3).alias("top_plans"), F.array().cast("array<string>").alias("key_traits"))


def label_segments(df: DataFrame, names: Mapping[int, str], descriptions: Mapping[int, str],
                   plans: Mapping[int, Sequence[str]], segment: str = "segment_id") -> DataFrame:
    """Name, description and first three plans per row from fixed lookups, with the usual fallbacks."""
    seg = F.col(segment)

    def look(mapping: Mapping, fallback: Column) -> Column:
        return F.coalesce(F.try_element_at(literal_map(mapping), seg), fallback) if mapping else fallback

    return df.withColumns({
        "segment_name": look(names, F.concat(F.lit("Segment "), seg.cast("string"))),
        "segment_description": look(descriptions, F.lit(K.SCORING_FALLBACK_DESCRIPTION)),
        "recommended_plans": F.slice(look(plans, F.array(F.lit("data_boost"))), 1, 3)})


def display_label(segment: Column, name: Column) -> Column:
    """``Noise`` below 0, else ``[id] name`` (``Seg <id>`` without a name)."""
    shown = F.coalesce(name, F.concat(F.lit("Seg "), segment.cast("string")))
    return F.when(segment < 0, F.lit("Noise")).otherwise(
        F.concat(F.lit("["), segment.cast("string"), F.lit("] "), shown))
