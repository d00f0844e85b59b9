"""Cells, density, towers, points of interest, GeoJSON."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.expr import out
from hexcohort.functions.hexgrid import hex_boundary, hex_cell, side_km
from hexcohort.operators.density import cell_concentration, cell_shares, dominant_value, group_entropy, segment_density
from hexcohort.operators.poi_density import add_poi_density, poi_counts
from hexcohort.operators.towers import clean_towers, filter_towers, tower_density
from hexcohort.plans import reports
from hexcohort.plans.scoring import metadata
from hexcohort.registry import sql as Q
from hexcohort.registry.core import RES, dimension, query, sub_cells
from hexcohort.sources import sinks
from hexcohort.sources.derive import pois, raw_towers, subscribers
from hexcohort.sources.readers import classify_pois, read_optional, read_poi_documents, read_towers, select_box, select_city
from hexcohort.sources.scratch import scratch_path

_CELLS = Q.hexed("sub", "home_lat", "home_lon", RES)
_DENS = {"cells": _CELLS, **Q.density_ctes("cells")}
_DENS_COLS = ("home_h3, n_subscribers, dominant_segment, avg_monthly_charges, avg_data_usage_gb, avg_rsrq, "
              f"{Q.out('segment_entropy')} AS segment_entropy, " + ", ".join(f"pct_seg_{k}" for k in range(7)))


def _density(spark: SparkSession, sf: str, res: int = RES) -> DataFrame:
    return segment_density(sub_cells(spark, sf, res))


@query("segment_density", Q.sub(**_DENS) + f"SELECT {_DENS_COLS} FROM dens")
def density(spark: SparkSession, sf: str) -> DataFrame:
    return _density(spark, sf).withColumn("segment_entropy", out(F.col("segment_entropy")))


_MANY = {"cells": _CELLS, "l": "SELECT home_h3, cast(substr(subscriber_id, 5) AS BIGINT) % 300 AS k FROM cells WHERE home_h3 IS NOT NULL",
         "cnt": "SELECT home_h3, k, count(*) AS n FROM l GROUP BY 1, 2",
         "tot": "SELECT home_h3, sum(n) AS t, arg_min(k, -1000*n+k) AS best FROM cnt GROUP BY 1 HAVING sum(n) >= 5"}


@query("segment_density_many", Q.sub(**_MANY) + "SELECT home_h3, cast(any_value(t) AS BIGINT) AS n_subscribers, cast(any_value(best) AS INT) AS dominant_segment, "
       f"{Q.out('-sum(cast(n AS DOUBLE)/t*ln(cast(n AS DOUBLE)/t+1e-10))')} AS segment_entropy, "
       f"string_agg(k || ':' || cast(round(1000*{Q.rnd('cast(n AS DOUBLE)/t', 3)}) AS INT), ',' ORDER BY k) AS shares FROM cnt JOIN tot USING (home_h3) GROUP BY 1")
def density_of_many_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Three hundred labels, shares in thousandths."""
    many = sub_cells(spark, sf, RES).withColumn("segment_id", F.expr("cast(cast(substr(subscriber_id, 5) AS BIGINT) % 300 AS INT)"))
    pairs = F.transform(F.array_sort(F.map_entries("shares")), lambda e: F.concat_ws(":", e["key"].cast("string"), F.round(e["value"] * 1000).cast("int").cast("string")))
    return cell_shares(many).select("home_h3", "n_subscribers", "dominant_segment", out(F.col("segment_entropy")).alias("segment_entropy"),
                                    F.array_join(pairs, ",").alias("shares"))


@query("hex_cell", Q.sub(c8=Q.hexed("sub", "home_lat", "home_lon", 8), c=Q.hexed("c8", "work_lat", "work_lon", 8, "work_h3"))
       + "SELECT subscriber_id, home_h3, work_h3 FROM c")
def cell_ids(spark: SparkSession, sf: str) -> DataFrame:
    return subscribers(spark, sf).select(
        "subscriber_id", hex_cell(F.col("home_lat"), F.col("home_lon")).alias("home_h3"),
        hex_cell(F.col("work_lat"), F.col("work_lon")).alias("work_h3"))


@query("same_zone", Q.sub(h=_CELLS, w=Q.hexed("h", "work_lat", "work_lon", RES, "work_h3"))
       + f"SELECT subscriber_id, {Q.flag('home_h3 = work_h3')} AS same_h3_zone FROM w")
def same_zone(spark: SparkSession, sf: str) -> DataFrame:
    work = hex_cell(F.col("work_lat"), F.col("work_lon"), RES)
    return sub_cells(spark, sf).select("subscriber_id", (F.col("home_h3") == work).cast("int").alias("same_h3_zone"))


def _corner(k: int) -> tuple[str, str]:
    a = math.radians(30 + 60 * (k % 6))
    s = repr(side_km(RES))
    lon = f"clon + degrees({s}::DOUBLE*{math.cos(a)!r}::DOUBLE/(6371.0088e0*cos(radians(-6.2e0))))"
    lat = f"clat + degrees({s}::DOUBLE*{math.sin(a)!r}::DOUBLE/6371.0088e0)"
    return Q.out(lon, 5), Q.out(lat, 5)


_RING = " UNION ALL ".join(f"SELECT home_h3, {k} AS corner, {_corner(k)[0]} AS lon, {_corner(k)[1]} AS lat FROM centre" for k in range(7))


@query("hex_boundary", Q.sub(cells=_CELLS, ids="SELECT DISTINCT home_h3, cast(split_part(home_h3,'_',2) AS DOUBLE) AS hq, cast(split_part(home_h3,'_',3) AS DOUBLE) AS hr FROM cells",
                             centre=f"SELECT home_h3, degrees({side_km(RES)!r}::DOUBLE*15e-1*hr/6371.0088e0) AS clat, degrees({side_km(RES)!r}::DOUBLE*sqrt(3e0)*(hq+hr/2e0)/(6371.0088e0*cos(radians(-6.2e0)))) AS clon FROM ids")
       + _RING)
def boundary(spark: SparkSession, sf: str) -> DataFrame:
    ring = sub_cells(spark, sf).select("home_h3").distinct().select(
        "home_h3", F.posexplode(hex_boundary(F.col("home_h3"), digits=9)).alias("corner", "p"))
    return ring.select("home_h3", "corner", out(F.col("p")[0], 5).alias("lon"), out(F.col("p")[1], 5).alias("lat"))


@query("cell_entropy", Q.sub(cells=_CELLS, **{k: v for k, v in Q.density_ctes("cells").items() if k in ("cnt", "ent")})
       + f"SELECT home_h3, {Q.out('segment_entropy')} AS entropy FROM ent")
def cell_entropy(spark: SparkSession, sf: str) -> DataFrame:
    df = sub_cells(spark, sf).filter("segment_id >= 0")
    return group_entropy(df, "home_h3", "segment_id").withColumn("entropy", out(F.col("entropy")))


@query("dominant_segment", Q.sub(cells=_CELLS, **{k: v for k, v in Q.density_ctes("cells").items() if k in ("cnt", "mode")})
       + "SELECT * FROM mode")
def dominant(spark: SparkSession, sf: str) -> DataFrame:
    return dominant_value(sub_cells(spark, sf).filter("segment_id >= 0"), "home_h3", "segment_id", "dominant_segment")


@query("dominant_counts", Q.sub(**_DENS) + "SELECT dominant_segment, count(*) AS n_cells FROM dens GROUP BY 1")
def dominant_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.dominant_counts(_density(spark, sf))


@query("density_kpis", Q.sub(**_DENS) + f"SELECT count(*) AS n_cells, coalesce(cast(sum(n_subscribers) AS BIGINT), 0) AS covered_subscribers, {Q.out('avg(avg_monthly_charges)')} AS avg_arpu FROM dens")
def density_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return reports.density_kpis(_density(spark, sf)).withColumn("avg_arpu", out(F.col("avg_arpu")))


@query("cell_heat_top20", Q.sub(**_DENS, **Q.dim_ctes(),
                                long="SELECT * FROM (UNPIVOT (SELECT home_h3, " + ", ".join(f"pct_seg_{k}" for k in range(7))
                                + " FROM dens ORDER BY home_h3 LIMIT 20) ON COLUMNS('pct_seg_.*') INTO NAME seg VALUE share)")
       + "SELECT l.home_h3, n.segment_name, l.share FROM long l JOIN named n ON l.seg = 'pct_seg_' || n.segment_id")
def cell_heat_top20(spark: SparkSession, sf: str) -> DataFrame:
    names, _, _ = metadata(dimension(spark, sf))
    heat = reports.cell_heat(_density(spark, sf), names)
    shares = [c for c in heat.columns if c != "home_h3"]
    return heat.unpivot("home_h3", shares, "segment_name", "share")


@query("cell_concentration", Q.sub(cells=_CELLS, n="SELECT home_h3, count(*) AS n FROM cells GROUP BY 1",
                                   r="SELECT n, row_number() OVER (ORDER BY n DESC, home_h3) AS rn, count(*) OVER () AS c FROM n")
       + f"SELECT max(c) AS n_cells, cast(ceil(max(c)*2e-1) AS BIGINT) AS top_cells, {Q.out('cast(sum(n) FILTER (rn <= ceil(c*2e-1)) AS DOUBLE)/cast(sum(n) AS DOUBLE)')} AS subscriber_share FROM r")
def concentration(spark: SparkSession, sf: str) -> DataFrame:
    return cell_concentration(sub_cells(spark, sf)).withColumn("subscriber_share", out(F.col("subscriber_share")))


# --- points of interest ---------------------------------------------------------
_POI_CELLS = Q.hexed("poi", "latitude", "longitude", RES, "home_h3")
_POI_COUNTS = ("SELECT home_h3, " + ", ".join(f"count(*) FILTER (poi_type='{t}') AS h3_poi_{t}_count" for t in K.POI_TYPES)
               + " FROM pc WHERE home_h3 IS NOT NULL GROUP BY home_h3")


@query("poi_density", Q.with_(poi=Q.POI, pc=_POI_CELLS) + _POI_COUNTS)
def poi_density(spark: SparkSession, sf: str) -> DataFrame:
    return poi_counts(pois(spark, sf), RES)


_WITH_SHOPS = "SELECT * REPLACE (CASE WHEN osm_id % 7 = 0 THEN 'shop' ELSE poi_type END AS poi_type) FROM poi"


@query("poi_density_types", Q.with_(poi=Q.POI, shops=_WITH_SHOPS, pc=Q.hexed("shops", "latitude", "longitude", RES, "home_h3"))
       + _POI_COUNTS.replace(" FROM pc", ", count(*) FILTER (poi_type='shop') AS h3_poi_shop_count FROM pc"))
def poi_density_types(spark: SparkSession, sf: str) -> DataFrame:
    """A type beyond the usual ten gets a column as well."""
    kind = F.when(F.col("osm_id") % 7 == 0, F.lit("shop")).otherwise(F.col("poi_type"))
    return poi_counts(pois(spark, sf).withColumn("poi_type", kind), RES)


@query("poi_density_join", Q.sub(poi=Q.POI, pc=_POI_CELLS, cells=_CELLS, counts=_POI_COUNTS)
       + "SELECT subscriber_id, home_h3, " + ", ".join(f"cast(coalesce(h3_poi_{t}_count, 0) AS DOUBLE) AS h3_poi_{t}_count" for t in K.POI_TYPES)
       + " FROM cells LEFT JOIN counts USING (home_h3)")
def poi_density_join(spark: SparkSession, sf: str) -> DataFrame:
    subs = sub_cells(spark, sf).select("subscriber_id", "home_h3")
    return add_poi_density(subs, pois(spark, sf), res=RES)


@query("poi_city_filter", Q.with_(poi=Q.POI) + "SELECT 'Jakarta' AS city, poi_type, count(*) AS n FROM poi WHERE latitude BETWEEN -65e-1 AND -59e-1 AND longitude BETWEEN 1066e-1 AND 1071e-1 GROUP BY poi_type "
       "UNION ALL SELECT 'custom', poi_type, count(*) FROM poi WHERE latitude BETWEEN -63e-1 AND -61e-1 AND longitude BETWEEN 1067e-1 AND 1069e-1 GROUP BY poi_type")
def poi_city_filter(spark: SparkSession, sf: str) -> DataFrame:
    p = pois(spark, sf)
    parts = [("Jakarta", select_city(p, "Jakarta")), ("custom", select_box(p, (-6.3, 106.7, -6.1, 106.9)))]
    a, b = [d.groupBy("poi_type").agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("city"), "poi_type", "n")
            for c, d in parts]
    return a.unionByName(b)


# Tags that make each type recognisable; a cafe in a park and a diplomatic office test the rules.
_TAGS = {"office": ("office", "company"), "transit": ("public_transport", "stop_position"),
         "train_station": ("railway", "subway_entrance"), "mall": ("shop", "department_store"),
         "entertainment": ("amenity", "cinema"), "restaurant": ("amenity", "fast_food"),
         "education": ("amenity", "college"), "healthcare": ("amenity", "clinic"),
         "residential": ("place", "suburb"), "park": ("leisure", "garden")}


def _nodes(spark: SparkSession, sf: str) -> DataFrame:
    tags = F.map_from_arrays(
        F.array(F.lit("name"), F.element_at(F.create_map(*[F.lit(x) for t, (k, _) in _TAGS.items() for x in (t, k)]), F.col("poi_type"))),
        F.array(F.col("name"), F.element_at(F.create_map(*[F.lit(x) for t, (_, v) in _TAGS.items() for x in (t, v)]), F.col("poi_type"))))
    return pois(spark, sf).select(F.lit("node").alias("type"), F.col("osm_id").alias("id"), F.col("latitude").alias("lat"),
                                  F.col("longitude").alias("lon"), tags.alias("tags"))


@query("poi_from_json", Q.with_(poi=Q.POI) + "SELECT osm_id, poi_type, name, latitude, longitude FROM poi WHERE osm_id % 50 <> 1")
def poi_from_json(spark: SparkSession, sf: str) -> DataFrame:
    """Overpass-shaped documents, one line each, written and read back; ways carry no position of a node."""
    node = _nodes(spark, sf).withColumn("type", F.when(F.col("id") % 50 == 1, F.lit("way")).otherwise(F.col("type")))
    docs = node.select(F.to_json(F.struct(F.array(F.struct("*")).alias("elements"))).alias("value"))
    path = scratch_path(spark, "poi_docs")
    docs.write.text(path)
    return read_poi_documents(spark, path)


@query("poi_classify", Q.with_(poi=Q.POI) +
       "SELECT osm_id, t AS poi_type, name FROM (SELECT osm_id, name, unnest(list_filter([CASE WHEN poi_type = 'office' AND osm_id % 3 = 0 THEN NULL ELSE poi_type END, "
       "CASE WHEN poi_type = 'restaurant' AND osm_id % 4 = 1 THEN 'park' END], lambda x: x IS NOT NULL)) AS t FROM poi)")
def poi_classify(spark: SparkSession, sf: str) -> DataFrame:
    node = _nodes(spark, sf)
    diplomatic = (F.col("tags")["office"].isNotNull()) & (F.col("id") % 3 == 0)
    garden = (F.col("tags")["amenity"] == "fast_food") & (F.col("id") % 4 == 1)
    tags = (F.when(diplomatic, F.map_from_arrays(F.array(F.lit("name"), F.lit("office")), F.array(F.col("tags")["name"], F.lit("diplomatic"))))
            .when(garden, F.map_concat("tags", F.create_map(F.lit("leisure"), F.lit("park")))).otherwise(F.col("tags")))
    return classify_pois(node.withColumn("tags", tags)).select("osm_id", "poi_type", "name")


@query("poi_union", Q.with_(poi=Q.POI) + "SELECT poi_type, count(*) AS n FROM poi GROUP BY poi_type")
def poi_union(spark: SparkSession, sf: str) -> DataFrame:
    """Tables of single types written apart and read back as one by a glob."""
    root = scratch_path(spark, "poi_parts")
    for t in K.POI_TYPES:
        sinks.write_parquet(pois(spark, sf).filter(F.col("poi_type") == t), f"{root}/osm_pois_{t}")
    return reports.value_counts(read_optional(spark, f"{root}/osm_pois_*"), "poi_type")


# --- towers --------------------------------------------------------------------------
_CLEAN = ("SELECT radio, mcc, net AS mnc, area AS lac, cell AS cell_id, unit, lon AS longitude, lat AS latitude, \"range\" AS range_m, samples, changeable, "
          "created AS created_s, updated AS updated_s, averageSignal AS avg_signal, "
          + Q.lookup("radio", K.RADIO_GENERATION, "'Unknown'") + " AS generation FROM tower WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180")


@query("tower_scan", Q.with_(tower=Q.TOWER) + "SELECT * FROM tower")
def tower_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Headerless gzip CSV written and read back."""
    path = scratch_path(spark, "towers")
    raw_towers(spark, sf).write.option("header", False).option("compression", "gzip").csv(path)
    return read_towers(spark, path)


@query("tower_clean", Q.with_(tower=Q.TOWER) + _CLEAN)
def tower_clean(spark: SparkSession, sf: str) -> DataFrame:
    t = clean_towers(raw_towers(spark, sf))
    return t.withColumns({"created_s": F.unix_seconds("created"), "updated_s": F.unix_seconds("updated")}).drop("created", "updated")


@query("tower_filter", Q.with_(tower=Q.TOWER) + "SELECT country, mcc, count(*) AS n FROM ("
       "SELECT 'ID' AS country, mcc FROM tower WHERE mcc IN (510) AND lat BETWEEN -11 AND 6 AND lon BETWEEN 95 AND 141 UNION ALL "
       "SELECT 'XX', mcc FROM tower WHERE lat BETWEEN -11 AND 6 AND lon BETWEEN 95 AND 141 UNION ALL "
       "SELECT 'SG', mcc FROM tower WHERE mcc IN (525) AND lat BETWEEN 1.15 AND 1.48 AND lon BETWEEN 103.6 AND 104.1) GROUP BY country, mcc")
def tower_filter(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_towers(spark, sf)
    parts = [filter_towers(raw, c).groupBy("mcc").agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("country"), "mcc", "n")
             for c in ("ID", "XX", "SG")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("tower_density", Q.with_(tower=Q.TOWER, clean=_CLEAN, tc=Q.hexed("clean", "latitude", "longitude", RES, "h3_cell"))
       + f"SELECT h3_cell, count(*) AS tower_count, count(*) FILTER (generation='4G') AS lte_count, count(*) FILTER (generation='5G') AS nr_count, {Q.out('avg(range_m)')} AS avg_range_m FROM tc GROUP BY h3_cell")
def towers_per_cell(spark: SparkSession, sf: str) -> DataFrame:
    return tower_density(clean_towers(raw_towers(spark, sf)), RES).withColumn("avg_range_m", out(F.col("avg_range_m")))


# --- GeoJSON ---------------------------------------------------------------------------
_PALETTE = "CASE dominant_segment % 8 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(K.PALETTE)) + " END"


@query("density_geojson", Q.sub(**_DENS, **Q.dim_ctes()) + "SELECT d.home_h3 AS h3_cell, 'Polygon' AS geometry, 7 AS ring_points, d.dominant_segment, n.segment_name, "
       f"d.n_subscribers, d.avg_rsrq, {_PALETTE} AS color, d.pct_seg_0 FROM dens d LEFT JOIN named n ON n.segment_id = d.dominant_segment")
def density_geojson(spark: SparkSession, sf: str) -> DataFrame:
    """Cell polygons written as GeoJSON lines, read back and taken apart."""
    names, _, _ = metadata(dimension(spark, sf))
    path = scratch_path(spark, "density_geojson")
    sinks.write_features(sinks.density_features(_density(spark, sf), names), path)
    parsed = spark.read.text(path).select(F.from_json("value", (
        "type string, geometry struct<type: string, coordinates: array<array<array<double>>>>, properties struct<h3_cell: string, "
        "dominant_segment: int, segment_name: string, n_subscribers: bigint, avg_rsrq: double, color: string, pct_seg_0: double>")).alias("f"))
    return parsed.select("f.properties.h3_cell", F.col("f.geometry.type").alias("geometry"),
                         F.size(F.col("f.geometry.coordinates")[0]).alias("ring_points"), "f.properties.dominant_segment",
                         "f.properties.segment_name", "f.properties.n_subscribers", "f.properties.avg_rsrq", "f.properties.color",
                         "f.properties.pct_seg_0")


@query("points_geojson", Q.with_(poi=Q.POI) + "SELECT osm_id, poi_type, 'Point' AS geometry, longitude AS lon, latitude AS lat FROM poi")
def points_geojson(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "points_geojson")
    sinks.write_features(sinks.point_features(pois(spark, sf)), path)
    parsed = spark.read.text(path).select(F.from_json("value", (
        "geometry struct<type: string, coordinates: array<double>>, properties struct<osm_id: bigint, poi_type: string>")).alias("f"))
    return parsed.select("f.properties.osm_id", "f.properties.poi_type", F.col("f.geometry.type").alias("geometry"),
                         F.col("f.geometry.coordinates")[0].alias("lon"), F.col("f.geometry.coordinates")[1].alias("lat"))
