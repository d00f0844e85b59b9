"""Derived columns as Spark ML stages: mobility, time of day, POI affinity, usage."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.expr import argmax_label, clip, cut, flag, opt_col, rnd, shannon
from hexcohort.operators.quantiles import medians


def mobility_columns(df: DataFrame, median_distance: float) -> DataFrame:
    home, work = opt_col(df, "pct_time_at_home", 0.5), opt_col(df, "pct_time_at_work", 0.2)
    hw_dist = opt_col(df, "home_work_distance_km", 5.0)
    radius = opt_col(df, "travel_radius_km", 10.0)
    daily = opt_col(df, "avg_daily_distance_km", 8.0)
    entropy = opt_col(df, "mobility_entropy", 1.5)
    local = flag(F.col("same_h3_zone") == 1) if "same_h3_zone" in df.columns else flag(hw_dist < 2.0)
    return df.withColumns({
        "home_work_ratio": rnd(clip(home / (work + F.lit(1e-6)), 0, 20), 3),
        "other_time_ratio": rnd(clip(F.lit(1.0) - home - work, 0, 1), 3),
        "mobility_ratio": rnd(clip(radius / (hw_dist + F.lit(1.0)), 0, 20), 3),
        "commute_intensity": rnd(clip(F.try_divide(daily, F.lit(float(median_distance))), 0, 10), 3),
        "location_concentration": rnd(clip(F.lit(1.0) - entropy / F.lit(3.5), 0, 1), 3),
        "is_local_worker": local,
        "is_home_worker": flag(home > 0.70),
        "is_heavy_commuter": flag(daily > 18.0),
        "is_frequent_traveler": flag(radius > 40.0),
        "is_roamer": flag(opt_col(df, "roaming_days_monthly", 0.0) > 3),
    })


def temporal_columns(df: DataFrame) -> DataFrame:
    morning, afternoon, evening, night = (
        opt_col(df, f"{w}_data_ratio", 0.25) for w in ("morning", "afternoon", "evening", "night"))
    data = opt_col(df, "data_usage_gb", 10.0)
    return df.withColumns({
        "primary_usage_window": argmax_label([("morning", morning), ("afternoon", afternoon),
                                              ("evening", evening), ("night", night)]),
        "business_leisure_ratio": rnd(clip((morning + afternoon) / (evening + night + F.lit(1e-6)), 0, 10), 3),
        "is_evening_heavy": flag(evening > 0.38),
        "is_weekend_heavy": flag(opt_col(df, "weekend_data_ratio", 0.30) > 0.45),
        "is_peak_hour_user": flag(opt_col(df, "peak_hour_data_ratio", 0.30) > 0.42),
        "data_tier": cut(data, K.DATA_TIERS),
        "gb_per_dollar": rnd(clip(data / (opt_col(df, "monthly_charges", 50.0) + F.lit(1.0)), 0, 5), 3),
    })


def poi_columns(df: DataFrame) -> DataFrame:
    office, transit, mall = (opt_col(df, f"poi_{t}_score", 0.3) for t in ("office", "transit", "mall"))
    resi, fun = opt_col(df, "poi_residential_score", 0.5), opt_col(df, "poi_entertainment_score", 0.3)
    work = rnd(clip(F.lit(0.55) * office + F.lit(0.45) * transit, 0, 1), 3)
    # The entropy reads the five columns themselves: an absent one is an error.
    scores = [F.col(c) for c in K.POI_SCORES]
    return df.withColumns({
        "poi_work_affinity": work,
        "poi_leisure_affinity": rnd(clip(F.lit(0.5) * mall + F.lit(0.5) * fun, 0, 1), 3),
        "poi_stay_affinity": rnd(clip(F.lit(0.7) * resi + F.lit(0.3) * (F.lit(1.0) - transit), 0, 1), 3),
        "poi_transit_affinity": rnd(clip(transit, 0, 1), 3),
        "dominant_poi_type": argmax_label([("office", office), ("transit", transit), ("mall", mall),
                                           ("residential", resi), ("entertainment", fun)]),
        "poi_diversity_score": rnd(shannon(scores), 3) + F.lit(0.0),
        "is_office_worker_poi": flag(work > 0.55),
        "is_mall_visitor": flag(mall > 0.60),
        "is_transit_user": flag(transit > 0.55),
        "is_residential_anchor": flag(resi > 0.70),
    })


def usage_columns(df: DataFrame, med_data: float, med_calls: float, med_charges: float) -> DataFrame:
    data = opt_col(df, "data_usage_gb", med_data)
    calls = opt_col(df, "call_minutes_monthly", med_calls)
    charges = opt_col(df, "monthly_charges", med_charges)
    sms, tenure = opt_col(df, "sms_monthly", 50.0), opt_col(df, "tenure_months", 24.0)
    roaming = opt_col(df, "roaming_days_monthly", 0.0)
    dn = clip(data / F.lit(med_data + 1e-6), 0, 5)
    vn = clip(calls / F.lit(med_calls + 1e-6), 0, 5)
    ratio = rnd(clip(vn / (dn + F.lit(1e-6)), 0, 10), 3)
    roam = rnd(clip(roaming / F.lit(30.0), 0, 1), 3)
    sms_n = clip(sms / F.lit(100.0), 0, 3)
    engaged = (F.lit(0.4) * clip(dn, 0, 1) + F.lit(0.3) * clip(vn, 0, 1) + F.lit(0.2) * clip(sms_n, 0, 1)
               + F.lit(0.1) * roam)
    return df.withColumns({
        "voice_data_ratio": ratio,
        "is_voice_dominant": flag(ratio > 1.5),
        "is_data_dominant": flag(ratio < 0.5),
        "gb_per_dollar": rnd(clip(data / (charges + F.lit(1.0)), 0, 5), 3),
        "calls_per_dollar": rnd(clip(calls / (charges + F.lit(1.0)), 0, 30), 3),
        "arpu_normalised": rnd(clip(charges / F.lit(med_charges + 1e-6), 0, 5), 3),
        "data_per_tenure_month": rnd(data / clip(tenure, 1), 3),
        "calls_per_tenure_month": rnd(calls / clip(tenure, 1), 3),
        "roaming_intensity": roam,
        "is_roaming_user": flag(roaming > 2),
        "engagement_score": rnd(clip(engaged, 0, 1), 3),
        "data_tier": cut(data, K.DATA_TIERS),
        "arpu_tier": cut(charges, K.ARPU_TIERS),
        "sms_intensity": rnd(clip(sms / (clip(calls, 1) / F.lit(10.0)), 0, 10), 3),
    })


def encode_usage_categoricals(df: DataFrame, levels: dict[str, list[str]] | None = None) -> DataFrame:
    """0/1 column per tier level (none dropped); the tier columns go away.

    ``levels`` are the fixed bin labels; a level without rows keeps its zero
    column, so the schema does not depend on the data.
    """
    levels = levels or {"data_tier": [t for _, t in K.DATA_TIERS] + ["nan"],
                        "arpu_tier": [t for _, t in K.ARPU_TIERS] + ["nan"]}
    present = {c: v for c, v in levels.items() if c in df.columns}
    keep = [F.col(c) for c in df.columns if c not in present]
    dummies = [flag(F.col(c) == v).alias(f"{c}_{v}") for c, vals in present.items() for v in vals]
    return df.select(*keep, *dummies)


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    pass


class TemporalUsage(_Stage):
    """Time-of-day features; stateless."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return temporal_columns(dataset)


class PoiAffinity(_Stage):
    """POI affinity features; stateless."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return poi_columns(dataset)


class MobilityModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    medianDistance = Param(Params._dummy(), "medianDistance", "median daily distance", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, medianDistance: float = 10.0):
        super().__init__()
        self._setDefault(medianDistance=10.0)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return mobility_columns(dataset, self.getOrDefault(self.medianDistance))


class Mobility(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the median daily distance (10 km when the column is absent)."""

    def _fit(self, dataset: DataFrame) -> MobilityModel:
        med = 10.0
        if "avg_daily_distance_km" in dataset.columns:
            med = medians(dataset, ["avg_daily_distance_km"]).get("avg_daily_distance_km", 10.0)
        return MobilityModel(medianDistance=med)


class UsageModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    medianData = Param(Params._dummy(), "medianData", "median data volume", TypeConverters.toFloat)
    medianCalls = Param(Params._dummy(), "medianCalls", "median call minutes", TypeConverters.toFloat)
    medianCharges = Param(Params._dummy(), "medianCharges", "median charges", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, medianData: float = 15.0, medianCalls: float = 300.0, medianCharges: float = 60.0):
        super().__init__()
        self._setDefault(medianData=15.0, medianCalls=300.0, medianCharges=60.0)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return usage_columns(dataset, self.getOrDefault(self.medianData), self.getOrDefault(self.medianCalls),
                             self.getOrDefault(self.medianCharges))


class Usage(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the medians of data, calls and charges; an opt-in stage."""

    def _fit(self, dataset: DataFrame) -> UsageModel:
        wanted = ("data_usage_gb", "call_minutes_monthly", "monthly_charges")
        med = medians(dataset, [c for c in wanted if c in dataset.columns])
        return UsageModel(medianData=med.get(wanted[0], 15.0), medianCalls=med.get(wanted[1], 300.0),
                          medianCharges=med.get(wanted[2], 60.0))
