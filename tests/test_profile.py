from __future__ import annotations

import numpy as np
import pytest
from frames import segmented_frame
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.operators import recommend as R
from hexcohort.operators.analysis import correlation_matrix, low_variance, mutual_information, top_correlations
from hexcohort.operators.density import cell_shares, distinct_over, distinct_sketches, segment_density
from hexcohort.operators.drift import drift
from hexcohort.operators.profile import (label_segments, match_archetype, name_segments, profile_segments,
                                         segment_zscores)
from hexcohort.sources.scratch import materialize


def test_profiles(segmented):
    p = profile_segments(segmented).toPandas()
    assert len(p) == 5 and {"n_subscribers", "pct_of_total", "segment_name", "segment_description"} <= set(p.columns)
    assert abs(p.pct_of_total.sum() - 100) < 0.5 and p.segment_name.is_unique
    src = segmented_frame()
    z = (src[src.segment_id == 2].data_usage_gb.mean() - src.data_usage_gb.mean()) / src.data_usage_gb.std()
    assert p.loc[p.segment_id == 2, "zscore_data_usage_gb"].item() == pytest.approx(round(z, 3), abs=1e-3)


def test_zscores_skip_noise_and_constant_columns(spark):
    df = spark.createDataFrame([(-1, 1.0, 0.1), (0, 2.0, 0.1), (0, 4.0, 0.1), (1, 9.0, 0.1)], "segment_id int, x double, k double")
    rows = {r["segment_id"]: r for r in segment_zscores(df, ["x", "k"]).collect()}
    assert set(rows) == {0, 1} and rows[0]["pct_of_total"] == 50.0
    assert rows[1]["zscore_x"] == round((9 - 4) / np.std([1, 2, 4, 9], ddof=1), 3) and rows[1]["zscore_k"] == 0.0


def frame(spark, rows):
    feats = sorted({f for r in rows for f in r})
    data = [(i, *[float(r.get(f, 0)) for f in feats]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "segment_id int, " + ", ".join(f"zscore_{f} double" for f in feats)), feats


def test_every_archetype_matches_its_own_signature(spark):
    df, feats = frame(spark, [{f: 2.0 * d for f, d in sig.items()} for sig in K.ARCHETYPES.values()])
    got = [r["archetype"] for r in match_archetype(df, feats).orderBy("segment_id").collect()]
    assert got == list(K.ARCHETYPES)


def test_archetype_ties_missing_and_unknown(spark):
    df, feats = frame(spark, [{"unused": 1.0}])
    assert match_archetype(df, feats).first()["archetype"] == "Urban Commuter"      # all 0: first declared
    all_feats = sorted({f for s in K.ARCHETYPES.values() for f in s})
    nulls = spark.createDataFrame([(0, *[None] * len(all_feats))], "segment_id int, " + ", ".join(f"zscore_{f} double" for f in all_feats))
    assert match_archetype(nulls, all_feats).first()["archetype"] == K.UNKNOWN_SEGMENT


def test_second_use_of_a_name_is_numbered(spark):
    df = spark.createDataFrame([(3, "Social Hub"), (1, "Social Hub"), (2, "Digital Nomad"), (7, "Social Hub"), (8, "Other")],
                               "segment_id int, archetype string")
    got = {r["segment_id"]: (r["segment_name"], r["plans"]) for r in name_segments(df).collect()}
    assert [got[i][0] for i in (1, 2, 3, 7)] == ["Social Hub", "Digital Nomad", "Social Hub 2", "Social Hub 3"]
    assert got[8][1] == K.FALLBACK_PLANS


def test_label_fallbacks(spark):
    df = spark.createDataFrame([(0,), (5,)], "segment_id int")
    rows = {r[0]: r for r in label_segments(df, {0: "A"}, {0: "d"}, {0: ["p1", "p2", "p3", "p4"]}).collect()}
    assert rows[0]["recommended_plans"] == ["p1", "p2", "p3"]
    assert (rows[5]["segment_name"], rows[5]["segment_description"], rows[5]["recommended_plans"]) == (
        "Segment 5", "Behavioral segment", ["data_boost"])


def test_drift(spark):
    cur = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("x", 0)], "subscriber_id string, segment_id int")
    old = spark.createDataFrame([("a", 1), ("b", 1), ("c", 3), ("y", 0)], "subscriber_id string, segment_id int")
    r = drift(cur, old).first()
    assert (r["n_matched"], r["n_changed"], round(r["drift_pct"], 4), r["alert"]) == (3, 1, 33.3333, True)
    assert drift(cur, None).first()["drift_pct"] == 0.0


def test_density_mode_tie_entropy_and_having(spark):
    rows = [("c1", s, 10.0, 1.0, -10.0) for s in (2, 2, 1, 1, 3)] + [("c2", 0, 1.0, 1.0, -1.0)] * 4 + [("c1", -1, 99.0, 99.0, 0.0)] \
        + [("c3", 4, 1.0, 2.0, -3.0)] * 5
    d = segment_density(spark.createDataFrame(rows, "home_h3 string, segment_id int, monthly_charges double, data_usage_gb double, home_zone_rsrq double"))
    got = {r["home_h3"]: r for r in d.collect()}
    assert set(got) == {"c1", "c3"} and got["c1"]["dominant_segment"] == 1 and got["c1"]["n_subscribers"] == 5
    p = np.array([.4, .4, .2])
    assert got["c1"]["segment_entropy"] == pytest.approx(-(p * np.log(p + 1e-10)).sum())
    assert got["c1"]["pct_seg_2"] == 0.4 and got["c1"]["pct_seg_0"] == 0.0 and got["c1"]["avg_monthly_charges"] == 10.0


def test_density_of_many_labels_and_of_some(spark):
    schema = "home_h3 string, segment_id int, monthly_charges double, data_usage_gb double, home_zone_rsrq double"
    rows = [(f"c{i % 3}", i * 7 % 2000, float(i % 5), None, -1.0) for i in range(6000)] + [("c0", 1234, 1.0, 1.0, 1.0)] * 3000
    df = spark.createDataFrame(rows, schema).repartition(6)
    got = {r["home_h3"]: r for r in cell_shares(df).collect()}
    assert got["c0"]["dominant_segment"] == 1234 and got["c0"]["n_subscribers"] == 5000 and got["c0"]["shares"][1234] == 0.6
    assert len(got["c1"]["shares"]) == len({i * 7 % 2000 for i in range(1, 6000, 3)}) and got["c1"]["avg_data_usage_gb"] is None
    with pytest.raises(ValueError, match="cell_shares"):
        segment_density(df)
    some = {r["home_h3"]: r for r in segment_density(df, segments=[7, 1234, 5]).collect()}
    assert some["c0"]["dominant_segment"] == 1234 and some["c0"]["n_subscribers"] == 5000 and some["c0"]["pct_seg_1234"] == 0.6


def test_sketches_merge_over_any_span(spark):
    days = spark.range(200_000).selectExpr("id % 10 AS day", "id % 60000 AS who", "id % 7 AS place")
    sketches = distinct_sketches(days, ["day", "place"], "who")
    assert sketches.count() == 70
    for df, keys in ((sketches, []), (sketches.filter("day < 3"), []), (sketches, ["place"])):
        left = days.filter("day < 3") if df is not sketches else days
        exact = {tuple(r[k] for k in keys): r["n"] for r in left.groupBy(*keys).agg(F.countDistinct("who").alias("n")).collect()}
        got = {tuple(r[k] for k in keys): r["n_distinct"] for r in distinct_over(df, keys).collect()}
        assert got.keys() == exact.keys() and all(abs(got[k] / exact[k] - 1) < 4 * 0.0082 for k in got)


# --- plans ------------------------------------------------------------------------
def test_rule_plans(spark):
    df = spark.createDataFrame([("Social Hub 2", None), ("Mystery", ["p1", "p2", "p3", "p4"]), (None, None)], "n string, stored array<string>")
    got = [r[0] for r in df.select(R.rule_plans(F.col("n"), F.col("stored"))).collect()]
    assert got == [K.ARCHETYPE_PLANS["Social Hub"], ["p1", "p2", "p3"], K.FALLBACK_PLANS]


def test_scored_recommendations(spark):
    dim = spark.createDataFrame([(0, "Senior Steady", K.ARCHETYPE_PLANS["Senior Steady"])], "segment_id int, segment_name string, plans array<string>")
    rows = R.scored_recommendations(dim).orderBy("rank").collect()
    assert [r["match_score"] for r in rows] == [1.0, 0.85, 0.7] and [r["rank"] for r in rows] == [1, 2, 3]
    assert rows[0]["price"] == 35.0 and "Senior Steady" in rows[0]["reason"]


def test_merge_blend_and_unknown_plan_name(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", "c"]), (["a"], None)], "r array<string>, c array<string>")
    assert [x[0] for x in df.select(R.merge_plans(F.col("r"), F.col("c"), 3)).collect()] == [["a", "b", "c"], ["a"]]
    assert df.select(R.blend_plans(F.col("r"), F.col("c"), 0.9, 2)).first()[0] == ["b", "c"]
    assert df.select(R.plan_name(F.lit("new_plan_x"))).first()[0] == "New Plan X"


def test_precision(spark):
    df = spark.createDataFrame([("Social Hub", K.ARCHETYPE_PLANS["Social Hub"]), ("Digital Nomad", ["x", "unlimited_rush", "y"]), ("?", ["a", "b", "c"])],
                               "true_persona_name string, recommended array<string>")
    r = R.precision_at_k(df).first()
    assert r["n_evaluated"] == 2 and r["precision"] == pytest.approx((1 + 1 / 3) / 2)


def drawn_interactions(df):
    """Plans of the persona weigh 3-5, others 0-1, by a hash of subscriber and plan."""
    persona = F.array(*[F.lit(p) for p in K.PLAN_IDS[:3]])
    primary = F.coalesce(R.plans_by_name(F.coalesce("true_persona_name", F.lit(""))), persona)
    plan = F.explode(F.array(*[F.lit(p) for p in K.PLAN_IDS]))
    h = F.pmod(F.xxhash64("subscriber_id", "plan_id"), F.lit(1000))
    weight = F.when(F.array_contains("primary", F.col("plan_id")), 3 + h % 3).otherwise(h % 2)
    return R.given_interactions(df.select("subscriber_id", "true_persona_name", primary.alias("primary")).select("*", plan.alias("plan_id"))
                                .select("subscriber_id", "plan_id", weight.alias("weight")))


def check_recommended(got, segmented):
    assert got.filter(F.size(F.array_distinct("cf_plans")) != 3).isEmpty() and got.count() == 501
    assert got.filter("subscriber_id = 'new'").first()["cf_plans"] == K.PLAN_IDS[:3]
    hit = got.join(segmented, "subscriber_id").select(F.size(F.array_intersect(
        "cf_plans", R.plans_by_name(F.col("true_persona_name")))).alias("h")).agg(F.avg("h")).first()[0]
    assert hit > 2.0


@pytest.fixture(scope="module")
def everyone(segmented):
    return segmented.select("subscriber_id").unionByName(segmented.sparkSession.createDataFrame([("new",)], "subscriber_id string"))


def test_ml_factorisation_prefers_persona_plans(segmented, everyone):
    inter = drawn_interactions(segmented)
    assert inter.filter("weight < 1 OR weight > 5").isEmpty()
    check_recommended(R.als_top_n(*R.fit_als(inter, iterations=5), everyone), segmented)


def test_narrow_factorisation_equals_dense_least_squares(segmented, everyone):
    prefs = R.preference_rows(drawn_interactions(segmented)).cache()
    items, patterns = R.fit_narrow(prefs, factors=4, iterations=4)
    check_recommended(R.narrow_top_n(items, patterns, prefs, everyone), segmented)
    w = np.array([r["weights"] for r in prefs.collect()])
    y = np.random.default_rng(42).normal(0.0, 0.1, (8, 4))
    for _ in range(4):
        x = np.array([np.linalg.solve(y.T @ y + (y.T * np.where(c > 0, c - 1, 0)) @ y + 0.1 * np.eye(4), y.T @ c) for c in w])
        y = np.array([np.linalg.solve(x.T @ x + (x.T * np.where(c > 0, c - 1, 0)) @ x + 0.1 * np.eye(4), x.T @ c) for c in w.T])
    assert np.allclose(items, y, rtol=1e-6, atol=1e-9)


def test_many_patterns_of_a_small_file_are_not_broadcast(spark):
    """Some hundred kilobytes of Parquet, but a row per subscriber: by their size Spark would send them all to the driver."""
    prefs = materialize(spark.range(20_000).selectExpr(
        "concat('s', id) AS subscriber_id", f"transform(sequence(1, {len(K.PLAN_IDS)}), i -> cast(pmod(id, i * 7 + 90) AS double)) AS weights"), "preferences")
    items, patterns = np.random.default_rng(1).normal(0, 1, (len(K.PLAN_IDS), 4)), prefs.select("weights", F.lit(1).alias("n"))
    top = R.narrow_top_n(items, patterns, prefs, prefs.select("subscriber_id"))
    assert "BroadcastHashJoin" not in top._jdf.queryExecution().executedPlan().toString()
    assert top.count() == 20_000 and top.filter(F.size("cf_plans") != 3).isEmpty()


def test_given_rows_catalog_and_dispatch(spark):
    rows = [("a", "x", 1.0), ("a", "x", 2.0), ("a", "old", 9.0), ("b", "y", 4.0), ("b", "z", 0.0), ("c", "x", 3.0), ("c", "y", 1.0)]
    given = R.given_interactions(spark.createDataFrame(rows, "subscriber_id string, plan_id string, weight double"), ["x", "y", "z"])
    assert sorted(map(tuple, given.collect())) == [("a", "x", 3.0), ("b", "y", 4.0), ("c", "x", 3.0), ("c", "y", 1.0)]
    weights = {r["subscriber_id"]: r["weights"] for r in R.preference_rows(given, ["x", "y", "z"]).collect()}
    assert weights == {"a": [3, 0, 0], "b": [0, 4, 0], "c": [3, 1, 0]}
    people = spark.createDataFrame([("a",), ("b",), ("c",), ("new",)], "subscriber_id string")
    for narrow in (64, 0):
        top = {r["subscriber_id"]: r["cf_plans"] for r in
               R.collaborative_top_n(given, people, 1, ["x", "y", "z"], narrow=narrow, factors=2, iterations=8).collect()}
        assert top == {"a": ["x"], "b": ["y"], "c": ["x"], "new": ["x"]}


# --- analysis -------------------------------------------------------------------------
def test_correlations(segmented):
    cols = ["data_usage_gb", "call_minutes_monthly", "sms_monthly"]
    src = segmented_frame()[cols].corr()
    for complete in (None, False):
        m = {(r["feature_a"], r["feature_b"]): r["corr"] for r in correlation_matrix(segmented, cols, complete).collect()}
        assert len(m) == 3 and all(v == pytest.approx(src.loc[a, b]) for (a, b), v in m.items())
    holes = segmented.withColumn("sms_monthly", F.when(F.col("sms_monthly") > 50, F.col("sms_monthly")))
    pdf = segmented_frame()[cols]
    want = pdf.assign(sms_monthly=pdf.sms_monthly.where(pdf.sms_monthly > 50)).corr()
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in correlation_matrix(holes, cols).collect()}
    assert all(v == pytest.approx(want.loc[a, b]) for (a, b), v in got.items())
    top = top_correlations(segmented, cols, 2).collect()
    assert len(top) == 2 and top[0]["abs_corr"] >= top[1]["abs_corr"]


def test_mutual_information_ranks_the_informative_feature(segmented):
    mi = {r["feature"]: r["mi"] for r in mutual_information(segmented, ["data_usage_gb", "tenure_months"], "true_persona_name").collect()}
    assert mi["data_usage_gb"] > 0.8 > 0.2 > mi["tenure_months"] >= 0


def test_low_variance_flags_constants(segmented):
    got = {r["feature"]: r["is_low"] for r in low_variance(segmented.withColumn("k", F.lit(0.3)), ["sms_monthly", "k"]).collect()}
    assert got == {"sms_monthly": False, "k": True}
