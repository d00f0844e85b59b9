"""Profiles, names, drift, analysis and reporting queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.expr import out
from hexcohort.operators import analysis
from hexcohort.operators.density import dominant_value
from hexcohort.operators.drift import drift, match_labels, match_segments, transitions
from hexcohort.operators.information import neighbour_information
from hexcohort.operators.features import PoiAffinity, TemporalUsage
from hexcohort.operators.profile import (label_segments, list_segments, match_archetype, profile_features,
                                         profile_segments, segment_moments, segment_zscores)
from hexcohort.operators.sampling import hash_sample
from hexcohort.plans import reports
from hexcohort.plans.scoring import metadata
from hexcohort.registry import sql as Q
from hexcohort.registry.core import dimension, query, stored_subscribers
from hexcohort.sources import sinks
from hexcohort.sources.derive import previous_labels, subscribers
from hexcohort.sources.readers import read_subscribers
from hexcohort.sources.scratch import scratch_path

_AF = Q.ARCHETYPE_FEATURES
_PERSONA = "true_persona_name"
_TEMPORAL = Q.sub(t=f"SELECT *, {Q.cols(Q.temporal())} FROM sub")


def _out(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: out(F.col(c)) for c in names})


@query("noise_filter", Q.sub() + "SELECT subscriber_id, segment_id FROM sub WHERE segment_id >= 0")
def noise_filter(spark: SparkSession, sf: str) -> DataFrame:
    return subscribers(spark, sf).filter(F.col("segment_id") >= 0).select("subscriber_id", "segment_id")


@query("segment_zscores", Q.sub(**Q.zscore_cte(_AF)) + "SELECT * FROM prof")
def zscores(spark: SparkSession, sf: str) -> DataFrame:
    return segment_zscores(subscribers(spark, sf), _AF)


@query("match_archetype", Q.sub(**Q.dim_ctes()) + f"SELECT segment_id, archetype, {Q.out('archetype_score', 3)} AS archetype_score FROM matched")
def archetypes(spark: SparkSession, sf: str) -> DataFrame:
    m = match_archetype(segment_zscores(subscribers(spark, sf), _AF), _AF)
    return m.select("segment_id", "archetype", out(F.col("archetype_score"), 3).alias("archetype_score"))


@query("segment_names", Q.sub(**Q.dim_ctes()) + "SELECT segment_id, archetype, segment_name FROM named")
def names(spark: SparkSession, sf: str) -> DataFrame:
    return profile_segments(subscribers(spark, sf), _AF).select("segment_id", "archetype", "segment_name")


_ALL = (["home_lat", "home_lon", "work_lat", "work_lon"] + K.CLUSTERING_FEATURES + ["monthly_charges", "tenure_months"])


@query("segment_profiles", Q.sub(**Q.zscore_cte(_ALL), **Q.matched_ctes(_ALL))
       + "SELECT * EXCLUDE (nth, archetype_score, plans), array_to_string(plans, ',') AS plans FROM named")
def profiles(spark: SparkSession, sf: str) -> DataFrame:
    subs = subscribers(spark, sf)
    assert set(profile_features(subs)) == set(_ALL)
    return profile_segments(subs).withColumn("plans", F.array_join("plans", ","))


@query("list_segments", Q.sub(**Q.dim_ctes()) + "SELECT segment_id, segment_name, segment_description AS description, n_subscribers, pct_of_total, "
       "array_to_string(plans, ',') AS top_plans, 0 AS n_traits FROM named")
def segments(spark: SparkSession, sf: str) -> DataFrame:
    return (list_segments(dimension(spark, sf)).withColumn("top_plans", F.array_join("top_plans", ","))
            .withColumn("n_traits", F.size("key_traits")).drop("key_traits"))


@query("segment_labels_join", Q.sub(**Q.dim_ctes()) + "SELECT s.subscriber_id, s.segment_id, coalesce(n.segment_name, 'Segment ' || s.segment_id) AS segment_name, "
       f"coalesce(n.segment_description, {Q.txt(K.SCORING_FALLBACK_DESCRIPTION)}) AS segment_description, "
       "coalesce(array_to_string(n.plans, ','), 'data_boost') AS plans FROM sub s LEFT JOIN named n USING (segment_id)")
def labels_join(spark: SparkSession, sf: str) -> DataFrame:
    named, described, plans = metadata(dimension(spark, sf))
    df = label_segments(subscribers(spark, sf).select("subscriber_id", "segment_id"), named, described, plans)
    return df.withColumn("plans", F.array_join("recommended_plans", ",")).drop("recommended_plans")


# --- drift -------------------------------------------------------------------
_PREV = Q.sub(prev=Q.PREVIOUS, t="SELECT p.segment_id AS previous, s.segment_id AS current, count(*) AS n FROM sub s JOIN prev p USING (subscriber_id) GROUP BY 1, 2")


@query("segment_transitions", _PREV + "SELECT * FROM t")
def segment_transitions(spark: SparkSession, sf: str) -> DataFrame:
    subs = subscribers(spark, sf)
    return transitions(subs, previous_labels(subs))


@query("segment_drift", _PREV + "SELECT cast(sum(n) AS BIGINT) AS n_matched, cast(sum(n) FILTER (previous <> current) AS BIGINT) AS n_changed, "
       f"{Q.out('100e0*sum(n) FILTER (previous <> current)/sum(n)')} AS drift_pct, 100e0*sum(n) FILTER (previous <> current)/sum(n) > 15e0 AS alert FROM t")
def segment_drift(spark: SparkSession, sf: str) -> DataFrame:
    subs = subscribers(spark, sf)
    return _out(drift(subs, previous_labels(subs)), "drift_pct")


# The new fit numbers its segments anew: every pairing of old and new ones is tried in SQL.
_MATCH = Q.sub(prev=Q.PREVIOUS, cur="SELECT subscriber_id, CASE WHEN segment_id >= 0 THEN (segment_id*3+2)%7 ELSE segment_id END AS segment_id FROM sub",
               t="SELECT p.segment_id AS previous, c.segment_id AS current, count(*) AS n FROM cur c JOIN prev p USING (subscriber_id) GROUP BY 1, 2",
               olds="SELECT previous, row_number() OVER (ORDER BY previous) AS r FROM (SELECT DISTINCT previous FROM t WHERE previous >= 0)",
               news="SELECT DISTINCT current FROM t WHERE current >= 0")
_WALK = ("walk(r, used, total) AS (SELECT cast(0 AS BIGINT), cast([] AS BIGINT[]), cast(0 AS BIGINT) UNION ALL SELECT w.r+1, list_append(w.used, cast(c.current AS BIGINT)), "
         "w.total + coalesce(t.n, 0) FROM walk w JOIN olds o ON o.r = w.r+1 JOIN news c ON NOT list_contains(w.used, c.current) "
         "LEFT JOIN t ON t.previous = o.previous AND t.current = c.current), best AS (SELECT used FROM walk WHERE r = (SELECT count(*) FROM olds) ORDER BY total DESC LIMIT 1), "
         "pairs AS (SELECT o.previous, t.current, t.n FROM olds o, best JOIN t ON t.previous = o.previous AND t.current = best.used[o.r]), "
         "d AS (SELECT sum(t.n) FILTER (pairs.n IS NULL AND NOT (t.previous < 0 AND t.current < 0)) AS n_changed, sum(t.n) AS n_matched FROM t LEFT JOIN pairs USING (previous, current))")


@query("drift_matched", "WITH RECURSIVE " + _MATCH.rstrip()[5:] + ", " + _WALK + " SELECT cast(previous AS BIGINT) AS previous, cast(current AS BIGINT) AS current, n AS n_shared, "
       f"cast(coalesce(n_changed, 0) AS BIGINT) AS n_changed, {Q.out('100e0*coalesce(n_changed, 0)/n_matched')} AS drift_pct FROM pairs, d")
def drift_matched(spark: SparkSession, sf: str) -> DataFrame:
    """Drift against a fit whose ids are permuted: segments are paired by the rows they share."""
    subs = stored_subscribers(spark, sf)
    moved = F.when(F.col("segment_id") >= 0, (F.col("segment_id") * 3 + 2) % 7).otherwise(F.col("segment_id"))
    current, previous = subs.select("subscriber_id", moved.alias("segment_id")), previous_labels(subs)
    found = _out(drift(match_labels(current, previous), previous), "drift_pct").first()
    pairs = match_segments(transitions(current, previous)).withColumnRenamed("n", "n_shared")
    return pairs.withColumns({"n_changed": F.lit(found["n_changed"]).cast("long"), "drift_pct": F.lit(found["drift_pct"])})


# --- folded tables -----------------------------------------------------------------
@query("value_counts", Q.sub() + "SELECT internet_service, count(*) AS n FROM sub GROUP BY 1")
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.value_counts(subscribers(spark, sf), "internet_service")


@query("size_pct", Q.sub() + f"SELECT segment_id, count(*) AS n, {Q.rnd('cast(count(*) AS DOUBLE)/cast(sum(count(*)) OVER () AS DOUBLE)*100e0', 1)} AS pct FROM sub GROUP BY 1")
def size_pct(spark: SparkSession, sf: str) -> DataFrame:
    return reports.size_pct(subscribers(spark, sf))


def _means(name: str, group: str, columns: list[str]) -> None:
    @query(name, Q.sub() + f"SELECT {group}, " + ", ".join(f"{Q.out(f'avg({c})')} AS mean_{c}" for c in columns) + " FROM sub GROUP BY 1")
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _out(reports.group_means(subscribers(spark, sf), group, columns), *[f"mean_{c}" for c in columns])


_means("segment_means", "segment_id", K.HEATMAP_FEATURES)
_means("persona_time_poi", _PERSONA, K.TEMPORAL[:5] + K.POI_SCORES)


@query("persona_medians", _TEMPORAL + f"SELECT {_PERSONA}, {Q.out('median(business_leisure_ratio)')} AS median_business_leisure_ratio FROM t GROUP BY 1")
def persona_medians(spark: SparkSession, sf: str) -> DataFrame:
    df = TemporalUsage().transform(subscribers(spark, sf))
    return _out(reports.group_medians(df, _PERSONA, "business_leisure_ratio"), "median_business_leisure_ratio")


@query("segment_revenue", Q.sub() + f"SELECT segment_id, {Q.out('sum(monthly_charges)', 4)} AS total_monthly_charges FROM sub GROUP BY 1")
def segment_revenue(spark: SparkSession, sf: str) -> DataFrame:
    df = reports.group_sums(subscribers(spark, sf), "segment_id", "monthly_charges")
    return df.withColumn("total_monthly_charges", out(F.col("total_monthly_charges"), 4))


_FLAGS = ["is_evening_heavy", "is_weekend_heavy", "is_peak_hour_user"]


@query("flag_rates", _TEMPORAL + f"SELECT {_PERSONA}, " + ", ".join(f"{Q.out(f'avg({c})')} AS rate_{c}" for c in _FLAGS) + " FROM t GROUP BY 1")
def flag_rates(spark: SparkSession, sf: str) -> DataFrame:
    df = reports.flag_rates(TemporalUsage().transform(subscribers(spark, sf)), _PERSONA, _FLAGS)
    return _out(df, *[f"rate_{c}" for c in _FLAGS])


_TIERS = [t for _, t in K.DATA_TIERS]


@query("tier_share_by_persona", _TEMPORAL + f"SELECT {_PERSONA}, " + ", ".join(
    Q.rnd(f"cast(count(*) FILTER (data_tier='{v}') AS DOUBLE)/cast(count(data_tier) AS DOUBLE)", 2) + f" AS data_tier_{v}" for v in _TIERS) + " FROM t GROUP BY 1")
def tier_share(spark: SparkSession, sf: str) -> DataFrame:
    return reports.category_shares(TemporalUsage().transform(subscribers(spark, sf)), _PERSONA, "data_tier", _TIERS)


@query("n_segments", Q.sub() + f"SELECT count(DISTINCT segment_id) AS n_segment_id, count(DISTINCT {_PERSONA}) AS n_{_PERSONA} FROM sub")
def n_segments(spark: SparkSession, sf: str) -> DataFrame:
    return reports.n_distinct(subscribers(spark, sf), ["segment_id", _PERSONA])


@query("kpi_overview", Q.sub() + f"SELECT count(*) AS n_subscribers, count(DISTINCT segment_id) AS n_segments, {Q.out('avg(monthly_charges)')} AS avg_monthly_charges, {Q.out('avg(data_usage_gb)')} AS avg_data_usage_gb FROM sub")
def kpi_overview(spark: SparkSession, sf: str) -> DataFrame:
    return _out(reports.kpi_overview(subscribers(spark, sf)), "avg_monthly_charges", "avg_data_usage_gb")


@query("geo_centre", Q.sub() + f"SELECT {_PERSONA}, {Q.out('avg(home_lat)')} AS centre_lat, {Q.out('avg(home_lon)')} AS centre_lon FROM sub GROUP BY 1 "
       f"UNION ALL SELECT 'all', {Q.out('avg(home_lat)')}, {Q.out('avg(home_lon)')} FROM sub")
def geo_centre(spark: SparkSession, sf: str) -> DataFrame:
    subs = subscribers(spark, sf)
    every = reports.geo_centre(subs).withColumn(_PERSONA, F.lit("all"))
    return _out(reports.geo_centre(subs, _PERSONA).unionByName(every), "centre_lat", "centre_lon")


@query("segment_persona_mode", Q.sub(c=f"SELECT segment_id, {_PERSONA} AS p, count(*) AS n FROM sub GROUP BY 1, 2")
       + "SELECT segment_id, p AS persona FROM (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY n DESC, p) AS rn FROM c) WHERE rn = 1")
def persona_mode(spark: SparkSession, sf: str) -> DataFrame:
    return dominant_value(subscribers(spark, sf), "segment_id", _PERSONA, "persona")


@query("seg_distribution", Q.sub(**Q.dim_ctes()) + "SELECT s.segment_id, count(*) AS n, coalesce(any_value(n.segment_name), 'Segment ' || s.segment_id) AS name FROM sub s LEFT JOIN named n USING (segment_id) GROUP BY s.segment_id")
def seg_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return reports.segment_distribution(subscribers(spark, sf), dimension(spark, sf))


@query("usage_by_segment", Q.sub(**Q.dim_ctes()) + f"SELECT s.segment_id, {Q.out('avg(s.data_usage_gb)')} AS avg_data_usage_gb, coalesce(any_value(n.segment_name), 'Seg ' || s.segment_id) AS name FROM sub s LEFT JOIN named n USING (segment_id) GROUP BY s.segment_id")
def usage_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    return _out(reports.usage_by_segment(subscribers(spark, sf), dimension(spark, sf)), "avg_data_usage_gb")


_BOX = {"min": "min(travel_radius_km)", "q1": "quantile_cont(travel_radius_km, 25e-2)", "median": "median(travel_radius_km)",
        "q3": "quantile_cont(travel_radius_km, 75e-2)", "max": "max(travel_radius_km)"}


@query("radius_box", Q.sub() + "SELECT segment_id, " + ", ".join(f'{Q.out(e)} AS "{n}"' for n, e in _BOX.items()) + " FROM sub GROUP BY 1")
def radius_box(spark: SparkSession, sf: str) -> DataFrame:
    return _out(reports.box_stats(subscribers(spark, sf), "travel_radius_km"), *_BOX)


@query("time_mix", Q.sub() + " UNION ALL ".join(
    f"SELECT segment_id, '{w}' AS time_window, 'Segment' AS grp, {Q.out(f'avg({c})')} AS data_ratio FROM sub WHERE segment_id >= 0 GROUP BY 1 UNION ALL "
    f"SELECT DISTINCT segment_id, '{w}', 'All Subs', (SELECT {Q.out(f'avg({c})')} FROM sub) FROM sub WHERE segment_id >= 0" for w, c in K.TIME_WINDOWS.items()))
def time_mix(spark: SparkSession, sf: str) -> DataFrame:
    return _out(reports.time_mix(subscribers(spark, sf)), "data_ratio")


@query("segment_heatmap", Q.sub(m="SELECT segment_id, " + ", ".join(f"avg({c}) AS {c}" for c in K.HEATMAP_FEATURES) + " FROM sub GROUP BY 1")
       + "SELECT segment_id, " + ", ".join(f"{Q.out(f'({c}-avg({c}) OVER ())/stddev_pop({c}) OVER ()')} AS z_{c}" for c in K.HEATMAP_FEATURES) + " FROM m")
def heatmap(spark: SparkSession, sf: str) -> DataFrame:
    return _out(reports.segment_heatmap(subscribers(spark, sf)), *[f"z_{c}" for c in K.HEATMAP_FEATURES])


_RADAR_POP = "SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in K.RADAR_FEATURES.values()) + " FROM sub"


@query("segment_radar", Q.sub(p=_RADAR_POP) + " UNION ALL ".join(
    f"SELECT segment_id, '{n}' AS dimension, {Q.out(Q.clip(f'(avg({c})-(any_value(m_{c})-2e0*any_value(s_{c})))/(4e0*any_value(s_{c})+1e-6)', 0, 1))} AS value, 5e-1 AS population FROM sub, p WHERE segment_id >= 0 GROUP BY segment_id"
    for n, c in K.RADAR_FEATURES.items()))
def radar(spark: SparkSession, sf: str) -> DataFrame:
    cols = list(K.RADAR_FEATURES.values())
    m = segment_moments(subscribers(spark, sf), cols)
    return _out(analysis.radar(m, K.RADAR_FEATURES), "value")


_REV = "SELECT segment_id, count(*) AS n, avg(monthly_charges) AS arpu, cast(count(*) AS DOUBLE)/(SELECT count(*) FROM sub)*100e0 AS pct FROM sub GROUP BY 1"


def _offer(i: int) -> str:
    p = f"plans[{i}]"
    return f"{Q.plan_name(p)} || ' ($' || cast(cast({Q.plan_price(p, '60e0')} AS INT) AS VARCHAR) || ')'"


@query("action_plan", Q.sub(**Q.dim_ctes(), rev=_REV) + f"SELECT n.segment_id, n.segment_name, r.n, {Q.rnd('r.pct', 1)} AS pct, {Q.out('r.arpu')} AS arpu, {Q.out('r.arpu*r.n', 3)} AS revenue, "
       f"{_offer(1)} || ' | ' || {_offer(2)} AS top_offers FROM named n LEFT JOIN rev r USING (segment_id)")
def action_plan(spark: SparkSession, sf: str) -> DataFrame:
    df = reports.action_plan(subscribers(spark, sf), dimension(spark, sf))
    return df.withColumns({"arpu": out(F.col("arpu")), "revenue": out(F.col("revenue"), 3)})


@query("upsell", Q.sub(**Q.dim_ctes(), rev=_REV, j=f"SELECT n.segment_id, n.segment_name, n.plans[1] AS plan_id, {Q.plan_price('n.plans[1]', '60e0')} - r.arpu AS gap, r.n FROM named n JOIN rev r USING (segment_id)")
       + f"SELECT segment_id, segment_name, plan_id, {Q.out('gap')} AS uplift_per_sub, n, {Q.out('gap*n', 3)} AS total_uplift FROM j WHERE gap > 0")
def upsell(spark: SparkSession, sf: str) -> DataFrame:
    df = reports.upsell(subscribers(spark, sf), dimension(spark, sf))
    return df.withColumns({"uplift_per_sub": out(F.col("uplift_per_sub")), "total_uplift": out(F.col("total_uplift"), 3)})


@query("uplift_estimate", Q.sub(rev=_REV) + f"SELECT segment_id, n, {Q.out('arpu*n', 3)} AS revenue, {Q.out('arpu*n*15e-2', 3)} AS uplift FROM rev WHERE segment_id >= 0")
def uplift(spark: SparkSession, sf: str) -> DataFrame:
    df = reports.uplift_estimate(subscribers(spark, sf))
    return df.withColumns({"revenue": out(F.col("revenue"), 3), "uplift": out(F.col("uplift"), 3)})


@query("heat_points", Q.sub(q="SELECT quantile_cont(data_usage_gb, 95e-2) AS p FROM sub") + f"SELECT subscriber_id, home_lat, home_lon, {Q.out('data_usage_gb/p')} AS weight FROM sub, q")
def heat_points(spark: SparkSession, sf: str) -> DataFrame:
    return _out(reports.heat_points(subscribers(spark, sf)), "weight")


# --- samples and plain sinks -------------------------------------------------------
@query("hash_sample", Q.sub() + f"SELECT subscriber_id, segment_id FROM sub ORDER BY {Q.hash_order()} LIMIT 1000")
def sample(spark: SparkSession, sf: str) -> DataFrame:
    return hash_sample(subscribers(spark, sf).select("subscriber_id", "segment_id"), 1000)


@query("usage_sample", Q.sub() + f"SELECT subscriber_id, segment_id, data_usage_gb, monthly_charges FROM sub ORDER BY {Q.hash_order()} LIMIT 3000")
def usage_sample(spark: SparkSession, sf: str) -> DataFrame:
    return reports.usage_sample(subscribers(spark, sf))


_COLOUR = f"CASE WHEN p.segment_id < 0 THEN '{K.NOISE_COLOUR}' ELSE {Q.strings(K.PALETTE)}[p.segment_id % 8 + 1] END"


@query("segment_points", Q.sub(**Q.dim_ctes(), p=f"SELECT * FROM sub ORDER BY {Q.hash_order()} LIMIT 4000")
       + f"SELECT p.subscriber_id, p.segment_id, p.home_lat, p.home_lon, {_COLOUR} AS color, CASE WHEN p.segment_id < 0 THEN 'Noise' ELSE '[' || p.segment_id || '] ' || coalesce(n.segment_name, 'Seg ' || p.segment_id) END AS label "
         "FROM p LEFT JOIN named n USING (segment_id)")
def segment_points(spark: SparkSession, sf: str) -> DataFrame:
    return reports.segment_points(subscribers(spark, sf), dimension(spark, sf))


@query("write_roundtrip", Q.sub() + "SELECT * FROM sub")
def write_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "subscribers")
    sinks.write_parquet(subscribers(spark, sf), path)
    return read_subscribers(spark, path)


@query("csv_sample", Q.sub() + "SELECT subscriber_id, true_persona_name, segment_id, data_usage_gb FROM sub ORDER BY subscriber_id LIMIT 2000")
def csv_sample(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "sample_csv")
    cols = "subscriber_id string, true_persona_name string, segment_id int, data_usage_gb double"
    sinks.write_csv_sample(subscribers(spark, sf).select("subscriber_id", _PERSONA, "segment_id", "data_usage_gb"), path)
    return spark.read.schema(cols).option("header", True).csv(path)


# --- exploratory measures ----------------------------------------------------------------
_PAIRS = [(a, b) for i, a in enumerate(K.CORRELATION_FEATURES) for b in K.CORRELATION_FEATURES[i + 1:]]
_CORR = " UNION ALL ".join(f"SELECT {i} AS pos, '{a}' AS feature_a, '{b}' AS feature_b, c{i} AS corr FROM c" for i, (a, b) in enumerate(_PAIRS))
_CORRS = Q.sub(c="SELECT " + ", ".join(f"corr({a}, {b}) AS c{i}" for i, (a, b) in enumerate(_PAIRS)) + " FROM sub", m=_CORR)


@query("corr_matrix", _CORRS + f"SELECT feature_a, feature_b, {Q.out('corr')} AS corr FROM m")
def corr_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return _out(analysis.correlation_matrix(subscribers(spark, sf)).drop("pos"), "corr")


@query("top_correlations", _CORRS + f"SELECT feature_a, feature_b, abs_corr FROM (SELECT feature_a, feature_b, {Q.rnd('abs(corr)', 6)} AS abs_corr, row_number() OVER (PARTITION BY {Q.rnd('abs(corr)', 6)} ORDER BY pos) AS rn FROM m) WHERE rn = 1 AND abs_corr < 1 ORDER BY abs_corr DESC LIMIT 10")
def top_correlations(spark: SparkSession, sf: str) -> DataFrame:
    return analysis.top_correlations(subscribers(spark, sf))


def _mi_sql(features: list[str]) -> dict[str, str]:
    probs = [i / 10 for i in range(1, 10)]
    lim = "SELECT " + ", ".join(f"quantile_cont({c}, {probs}) AS l_{c}" for c in features) + " FROM sub"
    long = " UNION ALL ".join(f"SELECT '{c}' AS feature, len(list_filter(l_{c}, lambda v: {c} > v)) AS bin, {_PERSONA} AS label FROM sub, lim" for c in features)
    joint = "SELECT feature, bin, label, cast(count(*) AS DOUBLE) AS n FROM long GROUP BY 1, 2, 3"
    mi = (f"SELECT feature, {Q.out('sum(n/a*ln(n*a/(b*l)))')} AS mi FROM (SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS a, sum(n) OVER (PARTITION BY feature, bin) AS b, "
          "sum(n) OVER (PARTITION BY feature, label) AS l FROM joint) GROUP BY feature")
    return {"lim": lim, "long": long, "joint": joint, "mi": mi}


@query("mi_features", Q.sub(**_mi_sql(K.CLUSTERING_FEATURES)) + "SELECT * FROM mi")
def mi_features(spark: SparkSession, sf: str) -> DataFrame:
    return _out(analysis.mutual_information(subscribers(spark, sf), K.CLUSTERING_FEATURES, _PERSONA), "mi")


# Neighbours in one dimension, all pairs of a feature in SQL; digamma(n) = 1 + 1/2 + ... + 1/(n-1) - Euler's constant.
_MI_NEAR = Q.sub(
    l=" UNION ALL ".join(f"SELECT '{c}' AS feature, subscriber_id AS i, {_PERSONA} AS y, cast({c} AS DOUBLE) AS x FROM sub WHERE {c} IS NOT NULL AND {_PERSONA} IS NOT NULL" for c in K.CLUSTERING_FEATURES),
    r="SELECT *, count(*) OVER (PARTITION BY feature, y) AS n_y FROM l QUALIFY n_y > 1",
    dist="SELECT a.feature, a.i, abs(a.x - b.x) AS d FROM r a JOIN r b ON a.feature = b.feature AND a.y = b.y AND a.i <> b.i",
    near="SELECT feature, i, max(d) AS d, count(*) AS k FROM (SELECT * FROM dist QUALIFY row_number() OVER (PARTITION BY feature, i ORDER BY d) <= 3) GROUP BY 1, 2",
    m="SELECT a.feature, a.i, a.n_y, n.k, count(*) AS m FROM r a JOIN near n ON n.feature = a.feature AND n.i = a.i JOIN r b ON b.feature = a.feature "
      "AND ((b.x > a.x - n.d AND b.x < a.x + n.d) OR (n.d = 0 AND b.x = a.x)) GROUP BY 1, 2, 3, 4",
    psi="SELECT n, coalesce(sum(1e0/(n-1)) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0e0) - 0.5772156649015329e0 AS p "
        "FROM (SELECT cast(unnest AS BIGINT) AS n FROM unnest(range(2, 20001))) UNION ALL SELECT 1, -0.5772156649015329e0",
    t="SELECT m.feature, count(*) AS n, avg(pk.p) - avg(py.p) - avg(pm.p) AS v FROM m JOIN psi pk ON pk.n = m.k JOIN psi py ON py.n = m.n_y JOIN psi pm ON pm.n = m.m GROUP BY 1")


@query("mi_neighbours", _MI_NEAR + f"SELECT feature, {Q.out('greatest(psi.p + v, 0e0)')} AS mi FROM t JOIN psi ON psi.n = t.n")
def mi_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return _out(neighbour_information(subscribers(spark, sf), K.CLUSTERING_FEATURES, _PERSONA), "mi")


_TINY = "data_usage_gb"


@query("mi_small_values", Q.sub(**_mi_sql([_TINY])) + "SELECT 'tiny' AS feature, mi FROM mi")
def mi_small_values(spark: SparkSession, sf: str) -> DataFrame:
    """Scaling a feature does not change what it tells: limits are taken as they are."""
    tiny = subscribers(spark, sf).withColumn("tiny", F.col(_TINY) * F.lit(1e-11))
    return _out(analysis.mutual_information(tiny, ["tiny"], _PERSONA), "mi")


@query("mi_topk", Q.sub(**_mi_sql(K.CLUSTERING_FEATURES)) + "SELECT * FROM mi ORDER BY mi DESC, feature LIMIT 15")
def mi_topk(spark: SparkSession, sf: str) -> DataFrame:
    return mi_features(spark, sf).orderBy(F.desc("mi"), "feature").limit(15)


_VAR = K.CLUSTERING_FEATURES + ["constant"]


@query("low_variance", Q.sub(k="SELECT *, 1e-1 AS constant FROM sub") + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {Q.out(f'var_samp({c})', 5)} AS raw_variance, {Q.out(f'CASE WHEN stddev_pop({c}) <= abs(avg({c}))*1e-12 THEN 0e0 ELSE var_samp({c})/var_pop({c}) END')} AS scaled_variance, "
    f"CASE WHEN stddev_pop({c}) <= abs(avg({c}))*1e-12 THEN 0e0 ELSE var_samp({c})/var_pop({c}) END < 5e-2 AS is_low FROM k" for c in _VAR))
def low_variance(spark: SparkSession, sf: str) -> DataFrame:
    df = analysis.low_variance(subscribers(spark, sf).withColumn("constant", F.lit(0.1)), _VAR)
    return df.withColumns({"raw_variance": out(F.col("raw_variance"), 5), "scaled_variance": out(F.col("scaled_variance"))})


_W = ["travel_radius_km", "avg_daily_distance_km"]


@query("winsor_bounds", Q.sub() + " UNION ALL ".join(
    f"SELECT {_PERSONA}, '{c}' AS feature, {Q.out(f'quantile_cont({c}, 1e-2)')} AS low, {Q.out(f'quantile_cont({c}, 99e-2)')} AS high FROM sub GROUP BY 1" for c in _W))
def winsor_bounds(spark: SparkSession, sf: str) -> DataFrame:
    return _out(analysis.winsor_bounds(subscribers(spark, sf), _W, _PERSONA), "low", "high")


@query("winsorize", Q.sub(b=Q.persona_quantiles("travel_radius_km", 0.02, 0.98))
       + f"SELECT subscriber_id, {_PERSONA}, {Q.out('least(greatest(travel_radius_km, low), high)')} AS travel_radius_km_w FROM sub JOIN b USING ({_PERSONA})")
def winsorize(spark: SparkSession, sf: str) -> DataFrame:
    subs = subscribers(spark, sf).select("subscriber_id", _PERSONA, "travel_radius_km")
    df = analysis.winsorize(subs, "travel_radius_km", _PERSONA, 0.02, 0.98)
    return _out(df.select("subscriber_id", _PERSONA, "travel_radius_km_w"), "travel_radius_km_w")


@query("persona_histogram", Q.sub(b=Q.persona_quantiles("travel_radius_km", 0.01, 0.99),
                                  x=f"SELECT {_PERSONA}, least(39, cast(floor((least(greatest(travel_radius_km, low), high)-low)/((high-low)/40e0)) AS INT)) AS bin, (high-low)/40e0 AS w FROM sub JOIN b USING ({_PERSONA})")
       + f"SELECT {_PERSONA}, bin, count(*) AS n, {Q.out(f'cast(count(*) AS DOUBLE)/(cast(sum(count(*)) OVER (PARTITION BY {_PERSONA}) AS DOUBLE)*max(w))')} AS density FROM x GROUP BY {_PERSONA}, bin")
def persona_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return _out(analysis.histogram(subscribers(spark, sf), "travel_radius_km", _PERSONA), "density")


@query("label_encode", Q.sub() + f"SELECT subscriber_id, cast(dense_rank() OVER (ORDER BY {_PERSONA}) - 1 AS INT) AS persona_code FROM sub")
def label_encode(spark: SparkSession, sf: str) -> DataFrame:
    df = analysis.label_encode(subscribers(spark, sf).select("subscriber_id", _PERSONA), _PERSONA, "persona_code")
    return df.select("subscriber_id", "persona_code")


@query("persona_poi_affinity", Q.sub(t=f"SELECT *, {Q.cols(Q.poi())} FROM sub") + f"SELECT {_PERSONA}, " + ", ".join(
    f"{Q.out(f'avg({c})')} AS mean_{c}" for c in ("poi_work_affinity", "poi_leisure_affinity", "poi_stay_affinity", "poi_diversity_score")) + " FROM t GROUP BY 1")
def poi_means(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["poi_work_affinity", "poi_leisure_affinity", "poi_stay_affinity", "poi_diversity_score"]
    return _out(reports.group_means(PoiAffinity().transform(subscribers(spark, sf)), _PERSONA, cols), *[f"mean_{c}" for c in cols])
