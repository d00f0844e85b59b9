from __future__ import annotations

import math

import numpy as np
import pytest
from frames import sample_frame
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.expr import argmax_label, clip, cut, flag, rnd
from hexcohort.operators.features import (Mobility, PoiAffinity, TemporalUsage, Usage, encode_usage_categoricals,
                                          mobility_columns)
from hexcohort.operators.scaling import MedianImpute, Scale
from hexcohort.plans.feature_pipeline import fit_features, selected_features


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (None,)], "x double")
    assert [r[0] for r in df.select(rnd(F.col("x"), 0)).collect()] == [0.0, 2.0, 2.0, -0.0, None]


def test_clip_keeps_null_and_flag_of_null_is_zero(spark):
    df = spark.createDataFrame([(-1.0,), (5.0,), (99.0,), (None,)], "x double")
    assert [tuple(r) for r in df.select(clip(F.col("x"), 0, 20), flag(F.col("x") > 1)).collect()] == [
        (0.0, 0), (5.0, 1), (20.0, 1), (None, 0)]


def test_argmax_takes_the_first_on_ties_and_skips_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 2.0), (None, 3.0), (None, None)], "a double, b double")
    got = [r[0] for r in df.select(argmax_label([("a", F.col("a")), ("b", F.col("b"))])).collect()]
    assert got == ["a", "b", "b", None]


def test_tier_edges(spark):
    vals = [0.0, -1.0, 0.1, 5.0, 5.01, 15.0, 30.0, 60.0, 1000.0, 1000.1, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert [r[0] for r in df.select(cut(F.col("x"), K.DATA_TIERS)).collect()] == [
        "nan", "nan", "very_low", "very_low", "low", "low", "medium", "high", "very_high", "nan", "nan"]


def test_mobility_columns_flags_and_ranges(sample):
    out = Mobility().fit(sample).transform(sample).toPandas()
    for c in ("home_work_ratio", "mobility_ratio", "commute_intensity", "location_concentration", "other_time_ratio"):
        assert out[c].notna().all()
    for c in ("is_local_worker", "is_home_worker", "is_heavy_commuter", "is_frequent_traveler", "is_roamer"):
        assert set(out[c].unique()) <= {0, 1}
    assert ((out.pct_time_at_home > 0.70).astype(int) == out.is_home_worker).all()
    assert out.location_concentration.between(0, 1).all()
    assert (out.is_local_worker == out.same_h3_zone).all()


def test_mobility_matches_direct_arithmetic(sample):
    out = Mobility().fit(sample).transform(sample).orderBy("subscriber_id").toPandas()
    src = sample_frame()
    med = src.avg_daily_distance_km.median()
    assert np.allclose(out.commute_intensity, (src.avg_daily_distance_km / med).clip(0, 10).round(3))
    assert np.allclose(out.home_work_ratio, (src.pct_time_at_home / (src.pct_time_at_work + 1e-6)).clip(0, 20).round(3))


def test_absent_columns_use_defaults_but_present_nulls_stay(spark):
    only = spark.createDataFrame([("a",)], "subscriber_id string")
    r = mobility_columns(only, 10.0).first()
    assert r["home_work_ratio"] == round(0.5 / (0.2 + 1e-6), 3) and r["is_local_worker"] == 0
    assert r["mobility_ratio"] == round(10 / 6, 3) and r["commute_intensity"] == 0.8
    gap = spark.createDataFrame([("a", None)], "subscriber_id string, pct_time_at_home double")
    r = mobility_columns(gap, 10.0).first()
    assert r["home_work_ratio"] is None and r["is_home_worker"] == 0


def test_mobility_fit_without_column_uses_ten(spark):
    model = Mobility().fit(spark.createDataFrame([("a",)], "subscriber_id string"))
    assert model.getOrDefault(model.medianDistance) == 10.0


def test_temporal(sample):
    out = TemporalUsage().transform(sample).toPandas()
    assert ((out.evening_data_ratio > 0.38).astype(int) == out.is_evening_heavy).all()
    assert set(out.data_tier) <= {t for _, t in K.DATA_TIERS} | {"nan"}
    assert (out.gb_per_dollar >= 0).all()
    assert set(out.primary_usage_window) <= {"morning", "afternoon", "evening", "night"}


def test_poi(sample):
    out = PoiAffinity().transform(sample).toPandas()
    for c in ("poi_work_affinity", "poi_leisure_affinity", "poi_stay_affinity", "poi_transit_affinity"):
        assert out[c].between(0, 1).all()
    assert set(out.dominant_poi_type) <= {"office", "transit", "mall", "residential", "entertainment"}
    assert (out.poi_diversity_score >= 0).all()
    x = sample_frame()[K.POI_SCORES].to_numpy()
    p = x / (x.sum(1, keepdims=True) + 1e-10)
    want = -(np.where(p > 0, p * np.log(np.where(p > 0, p, 1)), 0)).sum(1)
    assert np.allclose(out.sort_values("subscriber_id").poi_diversity_score, want.round(3), atol=1.1e-3)


def test_poi_entropy_of_null_is_zero_and_absent_column_fails(spark):
    cols = ", ".join(f"{c} double" for c in K.POI_SCORES)
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0, 0.0), (None, 0.1, 0.1, 0.1, 0.1)], cols)
    assert [r[0] for r in PoiAffinity().transform(df).select("poi_diversity_score").collect()] == [0.0, 0.0]
    with pytest.raises(Exception):
        PoiAffinity().transform(spark.createDataFrame([(1.0,)], "poi_office_score double")).collect()


def test_usage_and_onehot(sample):
    model = Usage().fit(sample)
    src = sample_frame()
    assert math.isclose(model.getOrDefault(model.medianData), src.data_usage_gb.median(), rel_tol=1e-12)
    out = model.transform(sample)
    hot = encode_usage_categoricals(out).toPandas()
    assert "data_tier" not in hot and "arpu_tier" not in hot
    assert (hot[[c for c in hot if c.startswith("data_tier_")]].sum(axis=1) == 1).all()
    assert (hot[[c for c in hot if c.startswith("arpu_tier_")]].sum(axis=1) == 1).all()


def test_selected_features_order():
    got = selected_features(["gb_per_dollar", "travel_radius_km", "avg_daily_distance_km", "other"])
    assert got == ["avg_daily_distance_km", "travel_radius_km", "gb_per_dollar"]


def test_impute_only_fills_missing(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,), (10.0,)], "x double")
    assert sorted(r[0] for r in MedianImpute(columns=["x"]).fit(df).transform(df).collect()) == [1.0, 3.0, 3.0, 10.0]


@pytest.mark.parametrize("method", ["standard", "minmax", "robust", "anything"])
def test_scalers(spark, sample, method):
    cols = ["data_usage_gb", "sms_monthly", "k"]
    df = sample.withColumn("k", F.lit(0.1))
    out = Scale(columns=cols, method=method, outputCol="", prefix="s_").fit(df).transform(df).orderBy("subscriber_id").toPandas()
    x = sample_frame().data_usage_gb
    want = {"minmax": (x - x.min()) / (x.max() - x.min()),
            "robust": (x - x.median()) / (x.quantile(.75) - x.quantile(.25))}.get(method, (x - x.mean()) / x.std(ddof=0))
    assert np.allclose(out.s_data_usage_gb, want)
    assert np.allclose(out.s_k, 0.0)


def test_pipeline_scales_35_features_and_reloads(spark, sample, tmp_path):
    holed = sample.withColumn("data_usage_gb", F.when(F.col("subscriber_id") != "SUB_00000003", F.col("data_usage_gb")))
    model, table = fit_features(holed)
    assert len(selected_features(table.columns)) == 35
    v = table.select("subscriber_id", "data_usage_gb", vector_to_array("features").alias("v"))
    arr = np.array([r["v"] for r in v.collect()])
    assert arr.shape == (200, 35) and np.allclose(arr.mean(0), 0, atol=1e-9) and np.allclose(arr.std(0), 1)
    # the table keeps the gap, only the vector is filled
    assert v.filter("data_usage_gb IS NULL").count() == 1
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(holed)
    assert np.allclose(np.array([r[0] for r in again.orderBy("subscriber_id").select(vector_to_array("features")).collect()]),
                       np.array([r["v"] for r in v.orderBy("subscriber_id").collect()]))
