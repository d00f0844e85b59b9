from __future__ import annotations

from frames import sample_frame

from hexcohort.operators.quality import Validator, request_errors, subscriber_rules
from hexcohort.plans.scoring import fill_defaults, split_requests


def by_rule(v):
    return {r["rule"]: r for r in v.results().collect()}


def test_duplicates_and_range_detected(spark):
    df = spark.createDataFrame([("A", -6.2, 106.8), ("A", 200.0, 106.8), ("B", -6.3, 106.8)],
                               "subscriber_id string, home_lat double, home_lon double")
    got = by_rule(Validator(df).unique("subscriber_id").in_range("home_lat", -11, 6))
    assert not got["unique:subscriber_id"]["passed"] and got["unique:subscriber_id"]["n_bad"] == 1
    assert got["range:home_lat"]["n_bad"] == 1 and got["range:home_lat"]["message"] == "1 values outside [-11, 6]"


def test_null_rules(spark):
    df = spark.createDataFrame([(None, None, "x"), (None, 0.0, None), ("a", -1.0, "y")], "id string, x double, kind string")
    got = by_rule(Validator(df).unique("id").no_nulls(["id", "x"]).in_range("x", 0, 1).positive("x")
                  .values_in("kind", ["x"]).in_range("absent", 0, 1).unique("absent"))
    assert got["unique:id"]["n_bad"] == 1                      # NULL counts as a value
    assert got["no_nulls:id"]["n_bad"] == 2 and got["no_nulls:x"]["n_bad"] == 1
    assert got["range:x"]["n_bad"] == 1                        # NULL does not violate
    assert got["positive:x"]["n_bad"] == 1
    assert got["values_in:kind"]["n_bad"] == 2 and got["values_in:kind"]["message"] == "2 unexpected: null, y"
    assert not any("absent" in r for r in got)


def test_report_levels(spark):
    df = spark.createDataFrame([(5.0,)], "x double")
    warn = Validator(df).in_range("x", 0, 1, "WARNING").positive("x").report().first()
    assert (warn["ok"], warn["n_passed"], warn["n_warnings"], warn["n_errors"]) == (True, 1, 1, 0)
    bad = Validator(df).columns(["x", "y"]).row_count_above(2).report().first()
    assert (bad["ok"], bad["n_errors"]) == (False, 2)


def test_too_few_subscribers_fail(spark, sample):
    assert subscriber_rules(sample).is_valid() is False        # 200 rows, 1000 needed


def test_request_checks(spark):
    pdf = sample_frame(4).drop(columns=["same_h3_zone"])
    pdf["senior_citizen"] = [0, 2, 0, 0]
    pdf.loc[0, "pct_time_at_home"] = 1.5
    pdf.loc[2, "avg_daily_distance_km"] = -5.0
    rows = {r["subscriber_id"]: r["errors"] for r in request_errors(spark.createDataFrame(pdf)).collect()}
    assert [rows[f"SUB_{i:08d}"] for i in range(4)] == [["pct_time_at_home"], ["senior_citizen"], ["avg_daily_distance_km"], []]
    ok, rejected = split_requests(spark.createDataFrame(pdf))
    assert ok.count() == 1 and rejected.count() == 3


def test_defaults(spark):
    r = fill_defaults(spark.createDataFrame([("a", None, 2.5)], "subscriber_id string, data_usage_gb double, location_lat double")).first()
    assert r["data_usage_gb"] == 15.0 and r["monthly_charges"] == 60.0 and r["senior_citizen"] == 0
    assert r["home_lat"] == 2.5 and r["home_lon"] is None
