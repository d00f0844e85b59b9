"""Data-quality rules and request checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.operators.quality import (REQUIRED, Validator, request_errors, strict_subscriber_rules,
                                         subscriber_rules)
from hexcohort.registry import sql as Q
from hexcohort.registry.core import query
from hexcohort.sources.derive import subscribers

_FMT = "format('{:,}', n)"


def _row(rule: str, n: str, wrong: str, fine: str, severity: str = "ERROR") -> str:
    msg = f"CASE WHEN n > 0 THEN {_FMT} || {Q.txt(wrong)} ELSE {Q.txt(fine)} END"
    return f"SELECT {Q.txt(rule)} AS rule, n = 0 AS passed, n AS n_bad, {msg} AS message, '{severity}' AS severity FROM (SELECT cast({n} AS BIGINT) AS n FROM sub)"


def _count(minimum: int) -> str:
    return (f"SELECT 'row_count' AS rule, c >= {minimum} AS passed, greatest({minimum}-c, 0) AS n_bad, "
            f"format('{{:,}}', c) || ' rows (need >= {minimum:,})' AS message, 'ERROR' AS severity FROM (SELECT count(*) AS c FROM sub)")


def _nulls(c: str) -> str:
    return _row(f"no_nulls:{c}", f"count(*) FILTER ({c} IS NULL)", " nulls", "no nulls")


def _unique(c: str) -> str:
    return _row(f"unique:{c}", f"count(*)-count(DISTINCT {c})-coalesce(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END),0)",
                " duplicates", "all unique")


def _range(c: str, lo, hi, severity: str = "ERROR") -> str:
    return _row(f"range:{c}", f"count(*) FILTER ({c} < {float(lo)} OR {c} > {float(hi)})", f" values outside [{lo}, {hi}]",
                f"all in [{lo}, {hi}]", severity)


def _positive(c: str) -> str:
    return _row(f"positive:{c}", f"count(*) FILTER ({c} < 0)", " negative values", "all positive")


def _all(rows: list[str]) -> str:
    return Q.sub() + " UNION ALL ".join(rows)


@query("dq_row_count", _all([_count(1000)]))
def dq_row_count(spark: SparkSession, sf: str) -> DataFrame:
    return Validator(subscribers(spark, sf)).row_count_above(1000).results()


_GAPS = "SELECT *, CASE WHEN tenure_months > 90 THEN NULL ELSE home_lat END AS lat_gap FROM sub"


@query("dq_nulls", Q.sub(gaps=_GAPS) + " UNION ALL ".join(
    r.replace("FROM sub)", "FROM gaps)") for r in (_nulls("subscriber_id"), _nulls("home_lat"), _nulls("lat_gap"))))
def dq_nulls(spark: SparkSession, sf: str) -> DataFrame:
    df = subscribers(spark, sf).withColumn("lat_gap", F.when(F.col("tenure_months") <= 90, F.col("home_lat")))
    return Validator(df).no_nulls(["subscriber_id", "home_lat", "lat_gap", "not_there"]).results()


@query("dq_unique", _all([_unique("subscriber_id"), _unique("tenure_months")]))
def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    return Validator(subscribers(spark, sf)).unique("subscriber_id").unique("tenure_months").results()


@query("dq_range", _all([_range("home_lat", -11.0, 6.0), _range("data_usage_gb", 5, 50, "WARNING")]))
def dq_range(spark: SparkSession, sf: str) -> DataFrame:
    return (Validator(subscribers(spark, sf)).in_range("home_lat", -11.0, 6.0)
            .in_range("data_usage_gb", 5, 50, "WARNING").results())


@query("dq_values_in", Q.sub(bad="SELECT * FROM sub WHERE internet_service NOT IN ('fiber_optic', 'DSL') OR internet_service IS NULL")
       + "SELECT 'values_in:internet_service' AS rule, n = 0 AS passed, n AS n_bad, CASE WHEN n > 0 THEN format('{:,}', n) || ' unexpected: ' || "
         "(SELECT string_agg(coalesce(v, 'null'), ', ' ORDER BY v) FROM (SELECT DISTINCT internet_service AS v FROM bad ORDER BY v LIMIT 5)) "
         "ELSE 'all in [''DSL'', ''fiber_optic'']' END AS message, 'ERROR' AS severity FROM (SELECT count(*) AS n FROM bad)")
def dq_values_in(spark: SparkSession, sf: str) -> DataFrame:
    return Validator(subscribers(spark, sf)).values_in("internet_service", ["fiber_optic", "DSL"]).results()


_BALANCE = "SELECT *, monthly_charges - 60e0 AS margin FROM sub"


@query("dq_positive", Q.sub(m=_BALANCE) + " UNION ALL ".join(
    r.replace("FROM sub)", "FROM m)") for r in (_positive("monthly_charges"), _positive("margin"))))
def dq_positive(spark: SparkSession, sf: str) -> DataFrame:
    df = subscribers(spark, sf).withColumn("margin", F.col("monthly_charges") - F.lit(60.0))
    return Validator(df).positive("monthly_charges").positive("margin").results()


_COMMON = [_range("home_lat", -11.0, 6.0), _range("home_lon", 95.0, 141.0), _range("data_usage_gb", 0, 500),
           _range("home_zone_rsrq", -30, -3), _positive("avg_daily_distance_km"), _positive("monthly_charges")]
_BATCH = ([_count(1000), _unique("subscriber_id")]
          + [_nulls(c) for c in ("subscriber_id", "home_lat", "home_lon", "data_usage_gb", "monthly_charges")] + _COMMON
          + [_range(c, 0.0, 1.0, "WARNING") for c in ["pct_time_at_home", "pct_time_at_work"] + K.TEMPORAL + K.POI_SCORES[:3]])
_STRICT = ([_count(1000), f"SELECT 'required_columns' AS rule, true AS passed, 0 AS n_bad, 'all {len(REQUIRED)} required columns present' AS message, 'ERROR' AS severity",
            _unique("subscriber_id")] + [_nulls(c) for c in ("subscriber_id", "home_lat", "home_lon")] + _COMMON
           + [_range(c, 0, 1, "WARNING") for c in ["pct_time_at_home", "pct_time_at_work"] + K.TEMPORAL + K.POI_SCORES])


@query("dq_subscribers", _all(_BATCH))
def dq_subscribers(spark: SparkSession, sf: str) -> DataFrame:
    return subscriber_rules(subscribers(spark, sf)).results()


@query("dq_subscribers_strict", _all(_STRICT))
def dq_subscribers_strict(spark: SparkSession, sf: str) -> DataFrame:
    return strict_subscriber_rules(subscribers(spark, sf)).results()


@query("dq_report", Q.sub(r=" UNION ALL ".join(_BATCH)) + "SELECT count(*) FILTER (NOT passed AND severity='ERROR') = 0 AS ok, "
       "count(*) FILTER (passed) AS n_passed, count(*) FILTER (NOT passed AND severity='WARNING') AS n_warnings, "
       "count(*) FILTER (NOT passed AND severity='ERROR') AS n_errors FROM r")
def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    return subscriber_rules(subscribers(spark, sf)).report()


_SHIFT = {"pct_time_at_home": ("pct_time_at_home + 2e-1", 0.2), "avg_daily_distance_km": ("avg_daily_distance_km - 12e0", -12.0)}
_CHECKS = ["CASE WHEN subscriber_id IS NULL THEN 'subscriber_id' END"] + [
    "CASE WHEN " + " OR ".join(([f"{f} < {lo}"] if lo is not None else []) + ([f"{f} > {hi}"] if hi is not None else []))
    + f" THEN '{f}' END" for f, (lo, hi) in K.REQUEST_LIMITS.items()]


@query("request_validate", Q.sub(q="SELECT * REPLACE (" + ", ".join(f"{e} AS {c}" for c, (e, _) in _SHIFT.items()) + ") FROM sub",
                                 e=f"SELECT subscriber_id, list_filter([{', '.join(_CHECKS)}], lambda x: x IS NOT NULL) AS errs FROM q")
       + "SELECT subscriber_id, array_to_string(errs, ',') AS errors, len(errs) = 0 AS is_valid FROM e")
def request_validate(spark: SparkSession, sf: str) -> DataFrame:
    req = subscribers(spark, sf).withColumns({c: F.col(c) + v for c, (_, v) in _SHIFT.items()})
    return request_errors(req).select("subscriber_id", F.array_join("errors", ",").alias("errors"), "is_valid")
