"""Clustering, its measures, and scoring."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.expr import out
from hexcohort.functions.joins import join_small
from hexcohort.operators import metrics
from hexcohort.operators.dbscan import dbscan, hdb_flat, project_km
from hexcohort.operators.hierarchy import Hierarchy, hdbscan
from hexcohort.operators.kmeans import fit_kmeans, pca_2d, tune_k
from hexcohort.operators.metric import core_flags, dbscan_metric
from hexcohort.operators.nearest import NearestIndex, core_points
from hexcohort.operators.profile import segment_dimension
from hexcohort.plans.feature_pipeline import fit_features
from hexcohort.plans.scoring import Scorer, scorer_from
from hexcohort.plans.segmentation import run, write_outputs
from hexcohort.registry import sql as Q
from hexcohort.registry.core import SQL, query, stored_subscribers
from hexcohort.sources.derive import subscribers
from hexcohort.sources.scratch import materialize, scratch_path

# Measured on five raw columns of comparable size, with the labels given.
_M = ["pct_time_at_home", "pct_time_at_work", "evening_data_ratio", "weekend_data_ratio", "poi_mall_score"]
_SQ = "+".join(f"({c}-c_{c})*({c}-c_{c})" for c in _M)
_CENT = {"v": "SELECT * FROM sub WHERE segment_id >= 0",
         "cent": "SELECT segment_id, count(*) AS cn, " + ", ".join(f"avg({c}) AS c_{c}" for c in _M) + " FROM v GROUP BY 1",
         "tot": "SELECT " + ", ".join(f"avg({c}) AS t_{c}" for c in _M) + " FROM v",
         "within": f"SELECT sum({_SQ}) AS w FROM v JOIN cent USING (segment_id)",
         "betw": "SELECT sum(cn*(" + "+".join(f"(c_{c}-t_{c})*(c_{c}-t_{c})" for c in _M) + ")) AS b, count(*) AS k, sum(cn) AS n, max(cn) AS big FROM cent, tot",
         "spread": f"SELECT segment_id, avg(sqrt({_SQ})) AS s, " + ", ".join(f"any_value(c_{c}) AS c_{c}" for c in _M) + " FROM v JOIN cent USING (segment_id) GROUP BY 1",
         "db": "SELECT avg(r) AS d FROM (SELECT a.segment_id, max((a.s+b.s)/sqrt(" + "+".join(f"(a.c_{c}-b.c_{c})*(a.c_{c}-b.c_{c})" for c in _M) + ")) AS r FROM spread a JOIN spread b ON a.segment_id <> b.segment_id GROUP BY 1)"}
_SMP = {"smp": f"SELECT * FROM v ORDER BY {Q.hash_order()} LIMIT 500",
        "pd": "SELECT a.subscriber_id, a.segment_id AS own, b.segment_id AS other, sum(sqrt(" + "+".join(f"(a.{c}-b.{c})*(a.{c}-b.{c})" for c in _M) + ")) AS t, count(*) AS n FROM smp a, smp b GROUP BY 1, 2, 3",
        "ab": "SELECT subscriber_id, max(CASE WHEN own = other THEN t/greatest(n-1, 1) END) AS a, max(CASE WHEN own = other THEN n END) AS n, min(CASE WHEN own <> other THEN t/n END) AS b FROM pd GROUP BY 1",
        "sil": "SELECT avg(CASE WHEN n > 1 THEN (b-a)/greatest(a, b) ELSE 0e0 END) AS s, count(*) AS c FROM ab"}
# all rows, squared distances: the mean over a cluster of n with spread w is |x-c|^2 + w/n, without the row itself (n|x-c|^2+w)/(n-1)
_SIL = {"wc": f"SELECT segment_id, cast(count(*) AS DOUBLE) AS n, sum({_SQ}) AS w FROM v JOIN cent USING (segment_id) GROUP BY 1",
        "pd": f"SELECT v.subscriber_id, v.segment_id AS own, wc.segment_id AS other, wc.n, wc.w, {_SQ} AS d FROM v, cent JOIN wc ON wc.segment_id = cent.segment_id",
        "ab": "SELECT subscriber_id, max(CASE WHEN own = other THEN n END) AS n, max(CASE WHEN own = other THEN (n*d+w)/greatest(n-1, 1) END) AS a, min(CASE WHEN own <> other THEN d+w/n END) AS b FROM pd GROUP BY 1",
        "sil": "SELECT avg(CASE WHEN n > 1 AND greatest(a, b) > 0 THEN (b-a)/greatest(a, b) ELSE 0e0 END) AS s, count(*) AS c FROM ab"}
_CH = "b*cast(n-k AS DOUBLE)/(w*cast(k-1 AS DOUBLE))"


@query("inertia", Q.sub(**_CENT) + f"SELECT k AS n_clusters, {Q.out('w')} AS inertia FROM within, betw")
def inertia(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.inertia(subscribers(spark, sf), _M).withColumn("inertia", out(F.col("inertia")))


@query("calinski_harabasz", Q.sub(**_CENT) + f"SELECT {Q.out(_CH)} AS calinski_harabasz FROM within, betw")
def calinski(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.calinski_harabasz(subscribers(spark, sf), _M).select(out(F.col("calinski_harabasz")).alias("calinski_harabasz"))


@query("davies_bouldin", Q.sub(**_CENT) + f"SELECT {Q.out('d')} AS davies_bouldin FROM db")
def davies(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.davies_bouldin(stored_subscribers(spark, sf), _M).select(out(F.col("davies_bouldin")).alias("davies_bouldin"))


@query("silhouette", Q.sub(**_CENT, **_SIL) + f"SELECT c AS n_rows, {Q.out('s')} AS silhouette FROM sil")
def silhouette(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.silhouette(stored_subscribers(spark, sf), _M).withColumn("silhouette", out(F.col("silhouette")))


@query("silhouette_sample", Q.sub(**_CENT, **_SMP) + f"SELECT c AS n_sampled, {Q.out('s')} AS silhouette FROM sil")
def silhouette_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The sample is the feature here; 500 rows cut the test tables as well."""
    return metrics.silhouette_sample(stored_subscribers(spark, sf), _M, sample_size=500).withColumn("silhouette", out(F.col("silhouette")))


_METRICS = (f"SELECT {Q.rnd('s', 4)} AS silhouette, {Q.rnd('d', 4)} AS davies_bouldin, {Q.rnd(_CH, 2)} AS calinski_harabasz, k AS n_clusters, "
            f"(SELECT count(*) FROM sub WHERE segment_id = -1) AS n_noise, {Q.rnd('cast(big AS DOUBLE)/cast(n AS DOUBLE)', 3)} AS largest_cluster_pct")


@query("cluster_metrics", Q.sub(**_CENT, **_SIL) + _METRICS + " FROM sil, db, within, betw")
def all_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.cluster_metrics(stored_subscribers(spark, sf), _M)


@query("quality_gate", Q.sub(**_CENT, **_SIL) + _METRICS + f", {Q.rnd('s', 4)} >= 3e-1 AS promote FROM sil, db, within, betw")
def gate(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.quality_gate(all_metrics(spark, sf))


@query("adjusted_rand", Q.sub(v="SELECT segment_id AS a, true_persona_name AS b FROM sub", v2="SELECT * FROM v WHERE a >= 0") + " UNION ALL ".join(
    f"SELECT '{tag}' AS rows_used, {Q.out('(s-r*c/t)/((r+c)/2e0-r*c/t)')} AS adjusted_rand FROM (SELECT "
    f"(SELECT sum(n*(n-1)/2e0) FROM (SELECT cast(count(*) AS DOUBLE) AS n FROM {v} GROUP BY a, b)) AS s, "
    f"(SELECT sum(n*(n-1)/2e0) FROM (SELECT cast(count(*) AS DOUBLE) AS n FROM {v} GROUP BY a)) AS r, "
    f"(SELECT sum(n*(n-1)/2e0) FROM (SELECT cast(count(*) AS DOUBLE) AS n FROM {v} GROUP BY b)) AS c, "
    f"(SELECT cast(count(*) AS DOUBLE)*(count(*)-1)/2e0 FROM {v}) AS t)" for tag, v in (("all", "v"), ("without noise", "v2"))))
def adjusted_rand(spark: SparkSession, sf: str) -> DataFrame:
    subs = subscribers(spark, sf)
    parts = [metrics.adjusted_rand(df, "segment_id", "true_persona_name")
             .select(F.lit(tag).alias("rows_used"), out(F.col("adjusted_rand")).alias("adjusted_rand"))
             for tag, df in (("all", subs), ("without noise", subs.filter("segment_id >= 0")))]
    return parts[0].unionByName(parts[1])


@query("kmeans_segments")
def kmeans_segments(spark: SparkSession, sf: str) -> DataFrame:
    _, table = fit_features(stored_subscribers(spark, sf).drop("segment_id"))
    table = materialize(table, "features")
    return fit_kmeans(table).transform(table).select("subscriber_id", "segment_id")


@query("kmeans_fixed_point", Q.sub() + "SELECT count(*) AS n_rows, 7 AS n_segments, 0 AS n_nearer_elsewhere FROM sub")
def kmeans_fixed_point(spark: SparkSession, sf: str) -> DataFrame:
    """What any k-means result has to be: every row with the mean that is nearest to it, and no segment empty.

    Means and distances are computed anew from the labels.
    """
    _, table = fit_features(stored_subscribers(spark, sf).drop("segment_id"))
    table = materialize(table, "features")
    labelled = fit_kmeans(table).transform(table).select("subscriber_id", "segment_id", vector_to_array("features").alias("x"))
    width = labelled.select(F.size("x")).first()[0]
    means = labelled.groupBy("segment_id").agg(F.array(*[F.avg(F.col("x")[i]) for i in range(width)]).alias("m")).orderBy("segment_id").collect()
    off = [F.sqrt(F.aggregate(F.zip_with("x", F.array(*map(F.lit, r["m"])), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, v: t + v)) for r in means]
    rows = labelled.withColumn("off", F.array(*off))
    elsewhere = F.col("off")[F.col("segment_id")] > F.array_min("off") + 1e-3
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("segment_id").cast("int").alias("n_segments"),
                    F.count_if(elsewhere).cast("int").alias("n_nearer_elsewhere"))


@query("tune_k")
def search_k(spark: SparkSession, sf: str) -> DataFrame:
    _, table = fit_features(stored_subscribers(spark, sf).drop("segment_id"))
    return tune_k(materialize(table, "features"))


@query("pca_2d")
def projection(spark: SparkSession, sf: str) -> DataFrame:
    _, table = fit_features(stored_subscribers(spark, sf))
    return pca_2d(table, keep=("subscriber_id", "segment_id", "true_persona_name"))


# Density clustering of home positions, radius in kilometres.
_EPS, _MIN, _SIZE = 2.0, 10, 50
_POS = "SELECT subscriber_id, 6371.0088e0*radians(work_lon)*cos(radians(-6.2e0)) AS x, 6371.0088e0*radians(work_lat) AS y FROM sub"
_GRAPH = {
    "p": _POS,
    "nb": f"SELECT a.subscriber_id AS i, b.subscriber_id AS j FROM p a JOIN p b ON abs(a.x-b.x) <= {_EPS} AND abs(a.y-b.y) <= {_EPS} AND sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)) <= {_EPS}",
    "core": f"SELECT i FROM nb GROUP BY i HAVING count(*) >= {_MIN}",
    "ok": "SELECT DISTINCT nb.i FROM nb JOIN core ON nb.j = core.i",
    "ce": "SELECT nb.i, nb.j FROM nb JOIN core a ON a.i = nb.i JOIN core b ON b.i = nb.j"}
_COMPONENTS = ("WITH RECURSIVE " + Q.sub(**_GRAPH)[5:] + ", cc(i, root) AS (SELECT i, i FROM core UNION SELECT ce.j, cc.root FROM cc JOIN ce ON ce.i = cc.i WHERE ce.j >= cc.root), "
               "comp AS (SELECT i, min(root) AS c FROM cc GROUP BY 1) ")


def _work_km(spark: SparkSession, sf: str) -> DataFrame:
    return project_km(subscribers(spark, sf).select("subscriber_id", "work_lat", "work_lon"), "work_lat", "work_lon")


@query("dbscan_geo", Q.sub(**_GRAPH) + "SELECT p.subscriber_id, ok.i IS NULL AS is_noise FROM p LEFT JOIN ok ON ok.i = p.subscriber_id")
def dbscan_geo(spark: SparkSession, sf: str) -> DataFrame:
    found = dbscan(_work_km(spark, sf), ["x_km", "y_km"], _EPS, _MIN)
    return found.select("subscriber_id", (F.col("segment_id") < 0).alias("is_noise"))


@query("dbscan_segments", _COMPONENTS + "SELECT (SELECT count(DISTINCT c) FROM comp) AS n_clusters, (SELECT count(*) FROM p) - (SELECT count(*) FROM ok) AS n_noise")
def dbscan_segments(spark: SparkSession, sf: str) -> DataFrame:
    found = dbscan(_work_km(spark, sf), ["x_km", "y_km"], _EPS, _MIN)
    sizes = found.groupBy("segment_id").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.count_if(F.col("segment_id") >= 0).alias("n_clusters"),
                     F.coalesce(F.sum(F.when(F.col("segment_id") < 0, F.col("n"))), F.lit(0)).alias("n_noise"))


@query("hdb_flat", _COMPONENTS + f", big AS (SELECT c, count(*) AS n FROM comp GROUP BY 1 HAVING count(*) >= {_SIZE}) "
       "SELECT p.subscriber_id, coalesce(big.n, -1) AS cluster_size FROM p LEFT JOIN comp ON comp.i = p.subscriber_id LEFT JOIN big ON big.c = comp.c")
def hdb(spark: SparkSession, sf: str) -> DataFrame:
    found = hdb_flat(_work_km(spark, sf), ["x_km", "y_km"], _SIZE, _MIN, _EPS).select("subscriber_id", "segment_id")
    sizes = found.filter("segment_id >= 0").groupBy("segment_id").agg(F.count(F.lit(1)).alias("n"))
    return join_small(found, sizes, "segment_id").select("subscriber_id", F.coalesce("n", F.lit(-1)).alias("cluster_size"))


# Density clustering of the 35 scaled features.
_WIDE_EPS, _WIDE_MIN = 5.5, 10
_WIDE = {**Q.feature_ctes(),
         "nb": "SELECT a.subscriber_id AS i, b.subscriber_id AS j FROM scaled a JOIN scaled b ON sqrt("
               + "+".join(f"(a.s_{c}-b.s_{c})*(a.s_{c}-b.s_{c})" for c in Q.FEATURES35) + f") <= {_WIDE_EPS}",
         "core": f"SELECT i FROM nb GROUP BY i HAVING count(*) >= {_WIDE_MIN}",
         "ok": "SELECT DISTINCT nb.i FROM nb JOIN core ON nb.j = core.i",
         "ce": "SELECT nb.i, nb.j FROM nb JOIN core a ON a.i = nb.i JOIN core b ON b.i = nb.j"}


@query("dbscan_features", "WITH RECURSIVE " + Q.sub(**_WIDE)[5:] + ", cc(i, root) AS (SELECT i, i FROM core UNION SELECT ce.j, cc.root FROM cc JOIN ce ON ce.i = cc.i WHERE ce.j >= cc.root), "
       "comp AS (SELECT i, min(root) AS c FROM cc GROUP BY 1) "
       "SELECT s.subscriber_id, ok.i IS NULL AS is_noise, (SELECT count(DISTINCT c) FROM comp) AS n_clusters FROM scaled s LEFT JOIN ok ON ok.i = s.subscriber_id")
def dbscan_features(spark: SparkSession, sf: str) -> DataFrame:
    _, table = fit_features(stored_subscribers(spark, sf))
    x, width = vector_to_array("features"), len(Q.FEATURES35)
    columns = table.select("subscriber_id", *[x[i].alias(f"f{i}") for i in range(width)])
    found = materialize(dbscan_metric(materialize(columns, "features"), [f"f{i}" for i in range(width)], _WIDE_EPS, _WIDE_MIN), "clusters")
    n = found.agg((F.coalesce(F.max("segment_id"), F.lit(-1)) + 1).cast("long").alias("n")).first()["n"]
    return found.select("subscriber_id", (F.col("segment_id") < 0).alias("is_noise"), F.lit(n).cast("long").alias("n_clusters"))


# Density hierarchy: its spanning tree in the scaled features, its labels by work positions (brute force in the tests).
_TREE = {**Q.feature_ctes(),
         "gap": "SELECT a.subscriber_id AS i, b.subscriber_id AS j, sqrt("
                + "+".join(f"(a.s_{c}-b.s_{c})*(a.s_{c}-b.s_{c})" for c in Q.FEATURES35) + ") AS d FROM scaled a JOIN scaled b ON a.subscriber_id <> b.subscriber_id",
         "core": "SELECT i, max(d) AS core FROM (SELECT i, d FROM gap QUALIFY row_number() OVER (PARTITION BY i ORDER BY d) <= 10) GROUP BY i",
         "link": "SELECT gap.i, min(greatest(d, a.core, b.core)) AS link FROM gap JOIN core a ON a.i = gap.i JOIN core b ON b.i = gap.j GROUP BY gap.i"}


@query("hdbscan_tree", Q.sub(**_TREE) + " SELECT core.i AS subscriber_id, round(core, 6) AS core, round(link, 6) AS link, "
       "(SELECT count(*) - 1 FROM (SELECT DISTINCT " + ", ".join(f"s_{c}" for c in Q.FEATURES35) + " FROM scaled)) AS n_edges FROM core JOIN link ON link.i = core.i")
def hdbscan_tree(spark: SparkSession, sf: str) -> DataFrame:
    """Core distance of every subscriber and its shortest edge of the tree: no other row may be nearer by mutual reachability."""
    _, table = fit_features(stored_subscribers(spark, sf))
    x, width = vector_to_array("features"), len(Q.FEATURES35)
    columns = materialize(table.select("subscriber_id", *[x[i].alias(f"f{i}") for i in range(width)]), "features")
    h = Hierarchy(columns, [f"f{i}" for i in range(width)], 50, 10)
    ends = h.tree.select(F.col("a").alias("pid"), "w").unionByName(h.tree.select(F.col("b").alias("pid"), "w"))
    link = ends.groupBy("pid").agg(F.min("w").alias("edge"))
    near = (h.points.withColumnRenamed("w", "n").join(h.cores, "pid").join(link, "pid", "left")
            .select("x", "core", F.when(F.col("n") > 1, F.col("core")).otherwise(F.col("edge")).alias("link")))
    of = columns.select("subscriber_id", F.array(*[F.col(f"f{i}") + F.lit(0.0) for i in range(width)]).alias("x"))
    return of.join(near, "x").select("subscriber_id", F.round("core", 6).alias("core"), F.round("link", 6).alias("link"), F.lit(h.tree.count()).alias("n_edges"))


@query("hdbscan_segments")
def hdbscan_segments(spark: SparkSession, sf: str) -> DataFrame:
    return hdbscan(_work_km(spark, sf), ["x_km", "y_km"], 15, 5, 0.0).select("subscriber_id", "segment_id")


# --- scoring with centroids taken from the given labels -----------------------------
def labelled_scorer(spark: SparkSession, sf: str) -> Scorer:
    """Feature numbers, per-segment centroids and segment metadata learned from the labelled table."""
    subs = stored_subscribers(spark, sf)
    model, _ = fit_features(subs)
    scorer = scorer_from(model, None, segment_dimension(subs))
    exprs = scorer.scale.scaled()
    table = model.transform(subs).select("segment_id", *[e.alias(c) for c, e in exprs.items()])
    cents = metrics.centroids(table, scorer.features).orderBy("segment_id").collect()   # one row per segment
    scorer.centers = [list(r["centre"]) for r in cents]
    return scorer


_F = Q.FEATURES35
SCORE_CTES = {**Q.feature_ctes(), **Q.dim_ctes(),
              "ctr": "SELECT segment_id AS seg, " + ", ".join(f"avg(s_{c}) AS k_{c}" for c in _F) + " FROM scaled WHERE segment_id >= 0 GROUP BY 1",
              "dist": "SELECT subscriber_id, home_lat, home_lon, seg, sqrt(" + "+".join(f"(s_{c}-k_{c})*(s_{c}-k_{c})" for c in _F) + ") AS dd FROM scaled, ctr",
              "near": "SELECT subscriber_id, any_value(home_lat) AS home_lat, any_value(home_lon) AS home_lon, arg_min(seg, dd) AS segment_id, min(dd) AS lo, max(dd) AS hi FROM dist GROUP BY 1",
              "cells": Q.hexed("near", "home_lat", "home_lon", 8, "h3_home_cell")}
SCORE_SQL = (Q.sub(**SCORE_CTES) + "SELECT c.subscriber_id, c.segment_id, coalesce(n.segment_name, 'Segment ' || c.segment_id) AS segment_name, "
             f"{Q.rnd('greatest(0e0, least(1e0, 1e0-c.lo/(c.hi+1e-6)))', 3)} AS confidence, n.segment_description, "
             "array_to_string(n.plans, ',') AS recommended_plans, c.h3_home_cell FROM cells c LEFT JOIN named n USING (segment_id)")


@query("score_subscribers", SCORE_SQL)
def score_subscribers(spark: SparkSession, sf: str) -> DataFrame:
    scored = labelled_scorer(spark, sf).score(subscribers(spark, sf))
    return scored.withColumn("recommended_plans", F.array_join("recommended_plans", ","))


@query("score_loaded", SCORE_SQL)
def score_loaded(spark: SparkSession, sf: str) -> DataFrame:
    """The same scores from a scorer that was saved and loaded again."""
    path = scratch_path(spark, "model")
    labelled_scorer(spark, sf).save(spark, path)
    scored = Scorer.load(spark, path).score(subscribers(spark, sf))
    return scored.withColumn("recommended_plans", F.array_join("recommended_plans", ","))


# --- many references as a table --------------------------------------------------------
_NEAR = {"ref": "SELECT CAST(c_custkey AS BIGINT) AS id, CAST(c_acctbal AS DOUBLE) / 1000e0 AS a, CAST(c_nationkey AS DOUBLE) AS b FROM customer",
         "q": "SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, CAST(s_acctbal AS DOUBLE) / 1000e0 AS a, CAST(s_nationkey AS DOUBLE) AS b FROM supplier",
         "d": "SELECT s_suppkey, id, sqrt((q.a-ref.a)*(q.a-ref.a)+(q.b-ref.b)*(q.b-ref.b)) AS d FROM q, ref"}


@query("nearest_reference", "WITH ref AS (" + _NEAR["ref"] + "), q AS (" + _NEAR["q"] + "), d AS (" + _NEAR["d"] + ") "
       "SELECT s_suppkey, arg_min(id, (d, id)) AS id, round(min(d), 6) AS near, round(max(d), 6) AS far FROM d GROUP BY s_suppkey")
def nearest_reference(spark: SparkSession, sf: str) -> DataFrame:
    """The nearest customer of every supplier by balance and nation, and the distance to the farthest, through the index."""
    def place(table: str, p: str, key: str) -> DataFrame:
        balance = F.col(f"{p}_acctbal").cast("double") / 1000
        return spark.read.parquet(f"{sf}/{table}.parquet").select(F.col(f"{p}_{table[:4]}key").cast("long").alias(key), F.array(balance, F.col(f"{p}_nationkey").cast("double")).alias("x"))

    found = NearestIndex(place("customer", "c", "id"), "id", "x").search(place("supplier", "s", "key"), "x", farthest=True)
    return found.select(F.col("key").alias("s_suppkey"), "id", F.round("near", 6).alias("near"), F.round("far", 6).alias("far"))


@query("score_references", SCORE_SQL)
def score_references(spark: SparkSession, sf: str) -> DataFrame:
    """The scores of the labelled centroids, held as a table."""
    scorer = labelled_scorer(spark, sf)
    rows = [(i, c) for i, c in enumerate(scorer.centers)]
    scorer.centers, scorer.references = None, spark.createDataFrame(rows, "segment_id int, centre array<double>")
    scored = scorer.score(subscribers(spark, sf))
    return scored.withColumn("recommended_plans", F.array_join("recommended_plans", ","))


_REACH = {**_WIDE, "far": "SELECT a.subscriber_id, min(sqrt(" + "+".join(f"(a.s_{c}-b.s_{c})*(a.s_{c}-b.s_{c})" for c in Q.FEATURES35)
          + ")) AS near FROM scaled a JOIN core ON true JOIN scaled b ON b.subscriber_id = core.i GROUP BY 1"}


@query("score_density", Q.sub(**_REACH) + " SELECT s.subscriber_id, coalesce(near, 1e9) > " + str(_WIDE_EPS) + " AS is_noise, CASE WHEN near <= "
       + str(_WIDE_EPS) + f" THEN {Q.rnd(f'greatest(0e0, least(1e0, 1e0-near/({_WIDE_EPS}e0+1e-6)))', 3)} ELSE 0e0 END AS confidence FROM scaled s LEFT JOIN far USING (subscriber_id)")
def score_density(spark: SparkSession, sf: str) -> DataFrame:
    """Every subscriber scored by a DBSCAN model of the table: nearest core point within the radius, else noise."""
    model, table = fit_features(stored_subscribers(spark, sf))
    x, width = vector_to_array("features"), len(Q.FEATURES35)
    cols = [f"f{i}" for i in range(width)]
    columns = materialize(table.select("subscriber_id", *[x[i].alias(c) for i, c in enumerate(cols)]), "features")
    known = core_flags(columns, cols, _WIDE_EPS, _WIDE_MIN)
    labelled = materialize(dbscan_metric(columns, cols, _WIDE_EPS, _WIDE_MIN, known=known), "labelled")
    cores = core_points(labelled, cols, _WIDE_EPS, _WIDE_MIN, known=known).withColumnRenamed("x", "centre")
    scored = scorer_from(model, None, references=materialize(cores, "cores"), radius=_WIDE_EPS).score(subscribers(spark, sf))
    return scored.select("subscriber_id", (F.col("segment_id") < 0).alias("is_noise"), "confidence")


@query("batch_job", SQL["dbscan_features"])
def batch_job(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job by density: noise flags from its written labels, the number of clusters from its measures."""
    result = run(stored_subscribers(spark, sf), algorithm="dbscan", eps=_WIDE_EPS, min_samples=_WIDE_MIN, check=False)
    path = scratch_path(spark, "job")
    write_outputs(result, path)
    n = result.metrics.first()["n_clusters"]
    labels = spark.read.parquet(f"{path}/segment_labels")
    return labels.select("subscriber_id", (F.col("segment_id") < 0).alias("is_noise"), F.lit(n).cast("long").alias("n_clusters"))
