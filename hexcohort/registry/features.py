"""Derived columns, imputation, scaling, the feature pipeline."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.expr import nan_to_null, out
from hexcohort.operators.features import (Mobility, PoiAffinity, TemporalUsage, Usage, encode_usage_categoricals)
from hexcohort.operators.scaling import MedianImpute, Scale
from hexcohort.plans.feature_pipeline import fit_features, selected_features
from hexcohort.plans.scoring import fill_defaults
from hexcohort.registry import sql as Q
from hexcohort.registry.core import query, stored_subscribers
from hexcohort.sources.derive import subscribers


@query("scan_subscribers", Q.sub() + "SELECT * FROM sub")
def scan_subscribers(spark: SparkSession, sf: str) -> DataFrame:
    return nan_to_null(subscribers(spark, sf))


def _derived(name: str, named: dict[str, str], stage) -> None:
    @query(name, Q.sub() + f"SELECT subscriber_id, {Q.cols(named)} FROM sub")
    def run(spark: SparkSession, sf: str) -> DataFrame:
        subs = subscribers(spark, sf)
        s = stage()
        df = s.fit(subs).transform(subs) if hasattr(s, "fit") else s.transform(subs)
        return df.select("subscriber_id", *named)


_USAGE = Q.usage(*[f"(SELECT median({c}) FROM sub)" for c in
                   ("data_usage_gb", "call_minutes_monthly", "monthly_charges")])
_derived("mobility_features", Q.mobility(Q.MEDIAN_DISTANCE), Mobility)
_derived("temporal_features", Q.temporal(), TemporalUsage)
_derived("poi_features", Q.poi(), PoiAffinity)
_derived("usage_features", _USAGE, Usage)

_LEVELS = [("data_tier", v) for _, v in K.DATA_TIERS] + [("data_tier", "nan")] \
    + [("arpu_tier", v) for _, v in K.ARPU_TIERS] + [("arpu_tier", "nan")]


@query("onehot_tiers", Q.sub(u=f"SELECT subscriber_id, {_USAGE['data_tier']} AS data_tier, {_USAGE['arpu_tier']} AS arpu_tier FROM sub")
       + "SELECT subscriber_id, " + ", ".join(f"{Q.flag(f'{c} = {Q.txt(v)}')} AS {c}_{v}" for c, v in _LEVELS) + " FROM u")
def onehot_tiers(spark: SparkSession, sf: str) -> DataFrame:
    subs = subscribers(spark, sf)
    tiers = Usage().fit(subs).transform(subs).select("subscriber_id", "data_tier", "arpu_tier")
    return encode_usage_categoricals(tiers)


_HOLES = {"data_usage_gb": 10, "monthly_charges": 7, "mobility_entropy": 13}


def _with_holes(subs: DataFrame) -> DataFrame:
    """Every n-th value goes missing."""
    key = F.substring("subscriber_id", 5, 20).cast("bigint")
    return subs.withColumns({c: F.when(key % n != 0, F.col(c)) for c, n in _HOLES.items()})


_HOLED = ", ".join(f"CASE WHEN cast(substr(subscriber_id,5) AS BIGINT)%{n} <> 0 THEN {c} END AS {c}" for c, n in _HOLES.items())


@query("median_impute", Q.sub(h=f"SELECT subscriber_id, {_HOLED} FROM sub")
       + "SELECT subscriber_id, " + ", ".join(f"{Q.out(f'coalesce({c}, (SELECT median({c}) FROM h))')} AS {c}" for c in _HOLES) + " FROM h")
def median_impute(spark: SparkSession, sf: str) -> DataFrame:
    holed = _with_holes(subscribers(spark, sf))
    model = MedianImpute(columns=list(_HOLES)).fit(holed)
    return model.transform(holed).select("subscriber_id", *[out(F.col(c)).alias(c) for c in _HOLES])


@query("median_impute_whole", Q.sub(h="SELECT subscriber_id, CASE WHEN cast(substr(subscriber_id,5) AS BIGINT)%3 <> 0 THEN cast(floor(data_usage_gb) AS INT) END AS whole FROM sub")
       + f"SELECT subscriber_id, {Q.out('coalesce(cast(whole AS DOUBLE), (SELECT median(whole) FROM h))')} AS whole FROM h")
def median_impute_whole(spark: SparkSession, sf: str) -> DataFrame:
    """Whole numbers whose median may lie between two of them."""
    kept = F.when(F.substring("subscriber_id", 5, 20).cast("long") % 3 != 0, F.floor("data_usage_gb").cast("int"))
    holed = subscribers(spark, sf).select("subscriber_id", kept.alias("whole"))
    return MedianImpute(columns=["whole"]).fit(holed).transform(holed).select("subscriber_id", out(F.col("whole")).alias("whole"))


_SCALED = {
    "standard": ("avg({c})", "CASE WHEN stddev_pop({c}) <= 1e-12 THEN 1e0 ELSE stddev_pop({c}) END"),
    "minmax": ("min({c})", "CASE WHEN max({c})-min({c}) = 0 THEN 1e0 ELSE max({c})-min({c}) END"),
    "robust": ("median({c})", "CASE WHEN quantile_cont({c},75e-2)-quantile_cont({c},25e-2) <= 1e-12 THEN 1e0 "
                              "ELSE quantile_cont({c},75e-2)-quantile_cont({c},25e-2) END"),
}


def _scaler(method: str) -> None:
    centre, spread = _SCALED[method]
    feats = K.CLUSTERING_FEATURES
    st = "SELECT " + ", ".join(f"{centre.format(c=c)} AS o_{c}, {spread.format(c=c)} AS d_{c}" for c in feats) + " FROM sub"

    @query(f"scale_{method}", Q.sub(st=st) + "SELECT subscriber_id, "
           + ", ".join(f"{Q.out(f'({c}-o_{c})/d_{c}')} AS {c}" for c in feats) + " FROM sub, st")
    def run(spark: SparkSession, sf: str) -> DataFrame:
        subs = subscribers(spark, sf)
        model = Scale(columns=feats, method=method).fit(subs)
        return subs.select("subscriber_id", *[out(e).alias(c) for c, e in model.scaled().items()])


for _m in _SCALED:
    _scaler(_m)


@query("feature_pipeline", Q.sub(**Q.feature_ctes()) + "SELECT subscriber_id, "
       + ", ".join(f"{Q.out(f's_{c}')} AS s_{c}" for c in Q.FEATURES35) + " FROM scaled")
def feature_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    _, table = fit_features(stored_subscribers(spark, sf))
    vec = vector_to_array("features")
    return table.select("subscriber_id", *[out(vec[i]).alias(f"s_{c}") for i, c in enumerate(selected_features(table.columns))])


# Requests where every third lacks its volume and every fifth its charges.
_ABSENT = {"data_usage_gb": 3, "monthly_charges": 5, "senior_citizen": 4}
_DEFAULTS = {**K.SCORE_DEFAULTS, "senior_citizen": K.SENIOR_DEFAULT}


@query("score_defaults", Q.sub() + "SELECT subscriber_id, " + ", ".join(
    f"CASE WHEN cast(substr(subscriber_id,5) AS BIGINT)%{n} = 0 THEN {_DEFAULTS[c]!r} ELSE {c} END"
    f"::{'INTEGER' if c == 'senior_citizen' else 'DOUBLE'} AS {c}" for c, n in _ABSENT.items())
    + f", {Q.d(K.SCORE_DEFAULTS['sms_monthly'])} AS sms_monthly, home_lat, home_lon FROM sub")
def score_defaults(spark: SparkSession, sf: str) -> DataFrame:
    key = F.substring("subscriber_id", 5, 20).cast("bigint")
    req = subscribers(spark, sf).withColumns({c: F.when(key % n != 0, F.col(c)) for c, n in _ABSENT.items()})
    req = req.drop("sms_monthly").withColumnsRenamed({"home_lat": "location_lat", "home_lon": "location_lon"})
    return fill_defaults(req).select("subscriber_id", *_ABSENT, "sms_monthly", "home_lat", "home_lon")
