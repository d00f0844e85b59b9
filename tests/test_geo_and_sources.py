from __future__ import annotations

import gzip
import json

import pytest
from frames import sample_frame
from pyspark.sql import functions as F

from hexcohort import schema as S
from hexcohort.functions.joins import join_small
from hexcohort.functions.hexgrid import haversine_km, hex_boundary, hex_cell, hex_centre, side_km
from hexcohort.operators.mobility_events import home_work
from hexcohort.operators.poi_density import add_poi_density
from hexcohort.operators.towers import clean_towers, filter_towers
from hexcohort.sources import sinks
from hexcohort.sources.readers import (read_optional, read_poi_documents, read_subscribers, read_towers, select_city)
from hexcohort.sources.scratch import materialize, small_table


def test_points_of_a_cell_are_within_one_side(spark):
    pts = spark.range(2000).select((F.lit(-6.5) + F.rand(1) * 0.6).alias("lat"), (F.lit(106.6) + F.rand(2) * 0.5).alias("lon"))
    c = pts.withColumn("cell", hex_cell(F.col("lat"), F.col("lon"), 8))
    far = c.select(haversine_km(F.col("lat"), F.col("lon"), *hex_centre(F.col("cell"))).alias("d")).agg(F.max("d")).first()[0]
    assert far <= side_km(8) * 1.01
    # the centre of a cell lies in it
    same = c.select("cell", hex_cell(*hex_centre(F.col("cell")), 8).alias("again"))
    assert same.filter("cell != again").isEmpty()
    assert spark.range(1).select(hex_cell(F.lit(None).cast("double"), F.lit(1.0), 8)).first()[0] is None


def test_boundary_is_a_closed_ring(spark):
    r = spark.range(1).select(hex_boundary(hex_cell(F.lit(-6.2), F.lit(106.8), 8)).alias("b")).first()["b"]
    assert len(r) == 7 and r[0] == r[6] and all(106 < p[0] < 107.5 and -7 < p[1] < -6 for p in r)


def test_poi_join_counts_and_no_ops(spark):
    subs = spark.createDataFrame([("a", -6.2, 106.8), ("b", -6.4, 107.0)], "subscriber_id string, la double, lo double")
    subs = subs.withColumn("home_h3", hex_cell(F.col("la"), F.col("lo"), 8))
    pois = spark.createDataFrame([("mall", -6.2, 106.8), ("mall", -6.2, 106.8), ("park", -6.2, 106.8), ("park", None, 1.0)],
                                 "poi_type string, latitude double, longitude double")
    got = {r["subscriber_id"]: r for r in add_poi_density(subs, pois).collect()}
    assert (got["a"]["h3_poi_mall_count"], got["a"]["h3_poi_park_count"], got["b"]["h3_poi_mall_count"]) == (2.0, 1.0, 0.0)
    assert add_poi_density(subs, None) is subs and add_poi_density(subs.drop("home_h3"), pois).columns == ["subscriber_id", "la", "lo"]


def test_towers_from_gzip_csv(spark, tmp_path):
    rows = ["LTE,510,1,2,3,0,106.8,-6.2,1000,5,1,1500000000,1600000000,-70", "GSM,525,1,2,4,0,103.8,1.3,500,5,1,1500000000,oops,0",
            "CDMA,510,1,2,5,0,106.8,,500,5,1,1500000000,1600000000,0", "NR,510,1,2,6,0,200.0,-6.0,500,5,1,1,2,0"]
    with gzip.open(tmp_path / "t.csv.gz", "wt") as f:
        f.write("\n".join(rows) + "\n")
    raw = read_towers(spark, str(tmp_path / "t.csv.gz"))
    got = {r["cell_id"]: r for r in clean_towers(raw).collect()}
    assert set(got) == {3, 4} and got[3]["generation"] == "4G" and got[4]["updated"] is None
    assert [r["cell"] for r in filter_towers(raw, "ID").collect()] == [3]
    assert [r["cell"] for r in filter_towers(raw, "SG").collect()] == [4]


def test_poi_documents(spark, tmp_path):
    doc = {"elements": [{"type": "node", "id": 1, "lat": -6.2, "lon": 106.8, "tags": {"amenity": "cafe", "leisure": "garden"}},
                        {"type": "way", "id": 2, "lat": -6.2, "lon": 106.8}, {"type": "node", "id": 3, "lat": -6.2},
                        {"type": "node", "id": 4, "lat": 50.0, "lon": 8.0, "tags": {"office": "diplomatic", "name": "x"}},
                        {"type": "node", "id": 5, "lat": -6.3, "lon": 106.9, "tags": {"office": "it", "name": "Hub"}}]}
    (tmp_path / "d.json").write_text(json.dumps(doc, indent=1))
    stamped = read_poi_documents(spark, str(tmp_path / "d.json"), "mall", multi_line=True)
    assert sorted((r["osm_id"], r["name"]) for r in stamped.collect()) == [(1, ""), (4, "x"), (5, "Hub")]
    found = read_poi_documents(spark, str(tmp_path / "d.json"), multi_line=True)
    assert sorted((r["osm_id"], r["poi_type"]) for r in found.collect()) == [(1, "park"), (1, "restaurant"), (5, "office")]
    assert select_city(found, "Jakarta").count() == 3
    with pytest.raises(ValueError):
        select_city(found, "Atlantis")


def test_sinks(spark, sample, tmp_path):
    sinks.write_csv_sample(sample, str(tmp_path / "csv"), n=7)
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 7
    dens = spark.createDataFrame([("hx8_1_2", 1, 5, 1.0, 2.0, -3.0, 0.5, 0.25), ("bad", 1, 5, 1.0, 2.0, -3.0, 0.5, 0.1)],
                                 "home_h3 string, dominant_segment int, n_subscribers long, avg_monthly_charges double, "
                                 "avg_data_usage_gb double, avg_rsrq double, segment_entropy double, pct_seg_1 double")
    feats = [json.loads(r["feature"]) for r in sinks.density_features(dens, {0: "A"}).collect()]
    assert len(feats) == 1 and feats[0]["properties"]["segment_name"] == "Segment 1" and feats[0]["properties"]["pct_seg_1"] == 0.25
    assert json.loads(sinks.density_features(dens).first()["feature"])["properties"]["segment_name"] == "Unknown"
    assert len(feats[0]["geometry"]["coordinates"][0]) == 7


def test_nan_becomes_null_and_optional_input(spark, tmp_path):
    pdf = sample_frame(5)
    pdf.loc[2, "data_usage_gb"] = float("nan")
    spark.createDataFrame(pdf).write.parquet(str(tmp_path / "subs_1"))
    assert read_subscribers(spark, str(tmp_path / "subs_1")).filter("data_usage_gb IS NULL").count() == 1
    assert set(read_subscribers(spark, str(tmp_path / "subs_1"), fixed_schema=False).columns) == set(pdf.columns)
    assert read_optional(spark, str(tmp_path / "none_*")) is None
    assert read_optional(spark, str(tmp_path / "subs_*")).count() == 5
    assert len(S.SUBSCRIBER) == 39


def test_small_table_says_when_it_is_not_small(spark):
    assert small_table(spark.range(5), 10)[1] is True
    rows, fits = small_table(spark.range(50), 10)
    assert fits is False and len(rows) == 11
    assert materialize(spark.range(3), "x").count() == 3


def test_home_and_work_from_positions(spark):
    rows = []
    for day in range(1, 6):            # Monday to Friday
        rows += [("u", f"2024-01-0{day} {h:02d}:00:00", -6.20, 106.80) for h in (0, 1, 2, 22, 23)]
        rows += [("u", f"2024-01-0{day} {h:02d}:00:00", -6.30, 106.90) for h in (10, 11, 12)]
    df = spark.createDataFrame(rows, "user_id string, ts string, lat double, lon double").withColumn("ts", F.to_timestamp("ts"))
    r = home_work(df).first()
    home, work = spark.range(1).select(hex_cell(F.lit(-6.2), F.lit(106.8)), hex_cell(F.lit(-6.3), F.lit(106.9))).first()
    assert (r["home_h3"], r["work_h3"]) == (home, work)
    assert r["pct_time_at_home"] == 25 / 40 and r["pct_time_at_work"] == 15 / 40 and r["n_frequent_locations"] == 2
    assert r["home_work_distance_km"] == pytest.approx(15.7, abs=1.0) and r["avg_daily_distance_km"] > 25


def test_join_small_gives_the_same_rows_by_broadcast_and_by_salt(spark):
    df = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5).cast("int").alias("k"))
    dim = spark.createDataFrame([(0, "zero"), (1, "one"), (2, "two")], "k int, name string")
    for how in ("left", "inner"):
        fast = join_small(df, dim, "k", how)
        salted = join_small(df, dim, "k", how, max_rows=1)
        plan = salted._jdf.queryExecution().optimizedPlan().toString()
        assert "salt_" in plan
        assert sorted(map(tuple, fast.select("id", "k", "name").collect()), key=str) == \
            sorted(map(tuple, salted.select("id", "k", "name").collect()), key=str)


def test_equal_rows_use_all_salts(spark):
    df = spark.range(200_000, numPartitions=4).select(F.lit("a").alias("k"), F.lit(1).alias("v"))
    dim = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, name string")
    salted = join_small(df, dim, "k", max_rows=1)
    assert salted.count() == 200_000 and salted.filter("name = 'x'").count() == 200_000
    mix = F.pmod(F.monotonically_increasing_id(), F.lit(32))
    assert df.select(mix.alias("s")).distinct().count() == 32


def test_salted_join_of_a_table_with_nothing_but_its_key(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    dim = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    rows = sorted(map(tuple, join_small(df, dim, "k", max_rows=1).collect()), key=str)
    assert rows == [("a", 1), ("a", 1), (None, None)]


def test_join_small_never_broadcasts_what_did_not_fit(spark):
    df = spark.range(50).withColumnRenamed("id", "k")
    dim = materialize(spark.range(20_000).selectExpr("id AS k", "id % 3 AS v"), "dim")
    joined = join_small(df, dim, "k")
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.filter("v = k % 3").count() == 50
