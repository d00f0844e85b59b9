"""Subscriber, POI and tower tables derived from the generic star-schema tables.

The formulas are those of FIXTURES.md.  Line items are first reduced per order,
so an order or a customer that holds a large share of the rows is already
folded on the map side before anything is shuffled, and no join ever meets more
than one row per order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hash01(key: str, mult: int, mod: int) -> Column:
    return ((F.col(key) * F.lit(mult)) % F.lit(mod)).cast("double") / F.lit(float(mod))


def subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with the usage and mobility summary columns."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("ok"))
        .agg(F.count(F.lit(1)).alias("n"),
             F.sum("l_quantity").alias("q"),
             F.sum(F.round(F.col("l_discount") * F.lit(100.0)).cast("bigint")).alias("d"),
             F.sum(F.round(F.col("l_tax") * F.lit(100.0)).cast("bigint")).alias("t"),
             F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("r"))
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("ok"), F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("prio"))
    per_priority = (
        orders.join(lines, "ok", "left")
        .groupBy("k", "prio")
        .agg(F.count(F.lit(1)).alias("n_o"), F.sum("n").alias("n"), F.sum("q").alias("q"),
             F.sum("d").alias("d"), F.sum("t").alias("t"), F.sum("r").alias("r"))
    )
    per_customer = per_priority.groupBy("k").agg(
        F.sum("n_o").alias("n_o"), F.count("prio").alias("n_prio"), F.sum("n").alias("n_li"),
        F.sum("q").alias("qty"), F.sum("d").alias("d"), F.sum("t").alias("t"), F.sum("r").alias("r"))

    def ratio(num: str, scale: float, default: float) -> Column:
        val = F.col(num).cast("double") / (F.lit(scale) * F.col("n_li"))
        return F.when(F.col("n_li") > 0, val).otherwise(F.lit(default))

    base = (
        table(spark, sf_dir, "customer")
        .select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"),
                F.col("c_nationkey").alias("nat"), F.col("c_mktsegment").alias("seg"))
        .join(per_customer, "k", "left")
        .select("k", "bal", "nat", "seg",
                F.coalesce("n_li", F.lit(0)).alias("n_li"), F.coalesce("qty", F.lit(0.0)).alias("qty"),
                ratio("d", 100.0, 0.05).alias("disc"), ratio("t", 100.0, 0.04).alias("tax"),
                ratio("r", 1.0, 0.0).alias("ret"),
                F.coalesce("n_o", F.lit(0)).alias("n_o"), F.coalesce("n_prio", F.lit(0)).alias("n_prio"),
                _hash01("k", 7919, 10007).alias("u1"), _hash01("k", 104729, 10009).alias("u2"),
                _hash01("k", 15485863, 10037).alias("u3"))
    )
    return base.selectExpr(
        "concat('SUB_', lpad(cast(k AS string), 8, '0')) AS subscriber_id",
        "CASE seg WHEN 'AUTOMOBILE' THEN 'Urban Commuter' WHEN 'BUILDING' THEN 'Home Office Pro' "
        "WHEN 'FURNITURE' THEN 'Social Hub' WHEN 'MACHINERY' THEN 'Young Professional' "
        "ELSE 'Senior Steady' END AS true_persona_name",
        "cast(CASE WHEN k % 50 = 49 THEN -1 ELSE least(6, floor(7e0 * u1)) END AS int) AS segment_id",
        "-6.5e0 + 6e-1 * u1 AS home_lat",
        "106.6e0 + 5e-1 * u2 AS home_lon",
        "least(-5.9e0, greatest(-6.5e0, -6.5e0 + 6e-1 * u1 + 1e-1 * (u3 - 5e-1))) AS work_lat",
        "least(107.1e0, greatest(106.6e0, 106.6e0 + 5e-1 * u2 + 1e-1 * (u1 - 5e-1))) AS work_lon",
        "2e0 + n_o * 1.5e0 AS avg_daily_distance_km",
        "1e0 + 60e0 * u3 AS travel_radius_km",
        "5e-1 + 30e0 * u2 AS home_work_distance_km",
        "cast(1 + n_prio AS double) AS n_frequent_locations",
        "2e-1 + 7e-1 * u1 AS pct_time_at_home",
        "5e-2 + 3e-1 * u2 AS pct_time_at_work",
        "3e0 * u3 AS mobility_entropy",
        "qty / 47e0 AS data_usage_gb",
        "50e0 + 800e0 * u2 AS call_minutes_monthly",
        "cast(n_li * 3 AS double) AS sms_monthly",
        "10e0 * ret AS roaming_days_monthly",
        "1e-1 + disc AS morning_data_ratio",
        "1e-1 + tax AS afternoon_data_ratio",
        "15e-2 + 35e-2 * u1 AS evening_data_ratio",
        "5e-2 + 25e-2 * u3 AS night_data_ratio",
        "15e-2 + 45e-2 * u2 AS weekend_data_ratio",
        "15e-2 + 45e-2 * u3 AS peak_hour_data_ratio",
        "u1 AS poi_office_score",
        "u2 AS poi_transit_score",
        "u3 AS poi_mall_score",
        "1e0 - u1 AS poi_residential_score",
        "1e0 - u2 AS poi_entertainment_score",
        "-20e0 + 15e0 * u3 AS home_zone_rsrq",
        "-20e0 + 15e0 * u1 AS work_zone_rsrq",
        "1e0 + 99e0 * u2 AS avg_throughput_mbps",
        "20e0 + 130e0 * (bal + 1000e0) / 11000e0 AS monthly_charges",
        "cast(1 + k % 100 AS double) AS tenure_months",
        "cast(CASE WHEN k % 12 = 0 THEN 1 ELSE 0 END AS int) AS senior_citizen",
        "CASE WHEN nat % 3 = 0 THEN 'DSL' WHEN nat % 3 = 1 THEN 'fiber_optic' ELSE 'none' END AS internet_service",
    )


def previous_labels(subs: DataFrame) -> DataFrame:
    """Labels of an earlier refresh: every ninth labelled subscriber sat one segment lower."""
    key = F.substring("subscriber_id", 5, 20).cast("bigint")
    return subs.select(
        "subscriber_id",
        F.when((F.col("segment_id") >= 0) & (key % 9 == 0), (F.col("segment_id") + 1) % 7)
        .otherwise(F.col("segment_id")).cast("int").alias("segment_id"))


def pois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point of interest per part."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS osm_id",
        "CASE p_partkey % 10 WHEN 0 THEN 'office' WHEN 1 THEN 'transit' WHEN 2 THEN 'train_station' "
        "WHEN 3 THEN 'mall' WHEN 4 THEN 'entertainment' WHEN 5 THEN 'restaurant' WHEN 6 THEN 'education' "
        "WHEN 7 THEN 'healthcare' WHEN 8 THEN 'residential' ELSE 'park' END AS poi_type",
        "p_name AS name",
        "-6.5e0 + 6e-1 * cast((p_partkey * 7907) % 9973 AS double) / 9973e0 AS latitude",
        "106.6e0 + 5e-1 * cast((p_partkey * 7883) % 9967 AS double) / 9967e0 AS longitude",
    )


def raw_towers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw 14-column tower rows, one per order; some without latitude."""
    return table(spark, sf_dir, "orders").selectExpr(
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'GSM' WHEN '2-HIGH' THEN 'UMTS' WHEN '3-MEDIUM' THEN 'LTE' "
        "WHEN '5-LOW' THEN 'NR' ELSE 'CDMA' END AS radio",
        "cast(CASE WHEN o_orderkey % 4 = 0 THEN 525 ELSE 510 END AS int) AS mcc",
        "cast(o_orderkey % 100 AS int) AS net", "o_custkey AS area", "o_orderkey AS cell", "cast(0 AS int) AS unit",
        "106.5e0 + 7e-1 * cast((o_orderkey * 7877) % 9949 AS double) / 9949e0 AS lon",
        "CASE WHEN o_orderkey % 97 = 0 THEN cast(NULL AS double) "
        "ELSE -6.6e0 + 8e-1 * cast((o_orderkey * 7873) % 9941 AS double) / 9941e0 END AS lat",
        "cast(500 + o_orderkey % 5000 AS int) AS range", "cast(1 + o_orderkey % 50 AS int) AS samples",
        "cast(1 AS int) AS changeable", "1262304000 + o_orderkey * 60 AS created",
        "1577836800 + o_orderkey * 60 AS updated", "cast(-(50 + o_orderkey % 60) AS int) AS averageSignal",
    )
