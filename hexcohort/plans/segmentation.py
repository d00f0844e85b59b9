"""The batch job end to end: check, derive, cluster, measure, name, recommend, map."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.hexgrid import hex_cell
from hexcohort.operators.hierarchy import hdbscan
from hexcohort.operators.density import segment_density
from hexcohort.operators.kmeans import Segmentation, fit_kmeans, tune_k
from hexcohort.operators.metric import core_flags, dbscan_metric
from hexcohort.operators.metrics import cluster_metrics, quality_gate
from hexcohort.operators.nearest import core_points
from hexcohort.operators.profile import profile_segments, segment_dimension
from hexcohort.operators.quality import subscriber_rules
from hexcohort.operators.recommend import scored_recommendations
from hexcohort.plans.feature_pipeline import fit_features, selected_features
from hexcohort.plans.scoring import Scorer, scorer_from
from hexcohort.sources.scratch import materialize


@dataclass
class Result:
    features: PipelineModel
    segmentation: Segmentation | None
    segmented: DataFrame
    metrics: DataFrame
    profiles: DataFrame
    dimension: DataFrame
    recommendations: DataFrame
    density: DataFrame | None
    scorer: Scorer


def run(subs: DataFrame, pois: DataFrame | None = None, algorithm: str = "kmeans", scaler: str = "standard",
        k: int = K.KMEANS_PARAMS["n_clusters"], n_init: int = K.KMEANS_PARAMS["n_init"], tune: bool = False,
        eps: float | None = None, min_samples: int | None = None, check: bool = True) -> Result:
    """Segment a subscriber table with ``kmeans``, ``dbscan`` or ``hdbscan``.

    The feature table is written once; every later step reads it.  A missing
    ``home_h3`` is derived from the home position.  The scorer of a DBSCAN run
    holds its core points: a new row joins the nearest within the radius.
    """
    if "home_h3" not in subs.columns and {"home_lat", "home_lon"} <= set(subs.columns):
        subs = subs.withColumn("home_h3", hex_cell(F.col("home_lat"), F.col("home_lon"), 8))
    if check and not subscriber_rules(subs).is_valid():
        raise ValueError("subscriber table failed validation")
    model, table = fit_features(subs, pois, scaler)
    table = materialize(table, "features")
    feats = selected_features(table.columns)
    cols = [f"s_{c}" for c in feats]
    arr = vector_to_array("features")
    seg, centers, model_of = None, None, {}
    if algorithm == "kmeans":
        if tune:
            k = tune_k(table).filter("is_best").first()["k"]
        seg = fit_kmeans(table, k, n_init)
        labelled = seg.transform(table)
        centers = seg.centers
    else:
        scaled = table.select("*", *[arr[i].alias(c) for i, c in enumerate(cols)])
        if algorithm == "dbscan":
            reach, least = eps or K.DBSCAN_PARAMS["eps"], min_samples or K.DBSCAN_PARAMS["min_samples"]
            scaled = materialize(scaled, "scaled")
            known = core_flags(scaled, cols, reach, least)
            labelled = materialize(dbscan_metric(scaled, cols, reach, least, known=known), "labelled")
            cores = core_points(labelled, cols, reach, least, known=known).withColumnRenamed("x", "centre")
            model_of = {"references": materialize(cores, "cores"), "radius": reach}
        else:
            labelled = hdbscan(scaled, cols, epsilon=K.HDB_PARAMS["epsilon"] if eps is None else eps,
                               min_samples=min_samples or K.HDB_PARAMS["min_samples"])
        labelled = labelled.drop(*cols)
    segmented = materialize(labelled, "segmented")
    vectors = segmented.select("subscriber_id", "segment_id", *[arr[i].alias(c) for i, c in enumerate(cols)])
    metrics = quality_gate(cluster_metrics(vectors, cols))
    dim = materialize(segment_dimension(segmented), "segments")
    return Result(model, seg, segmented, metrics, profile_segments(segmented, feats), dim, scored_recommendations(dim),
                  segment_density(segmented) if "home_h3" in segmented.columns else None,
                  scorer_from(model, centers, dim, **model_of))


def write_outputs(result: Result, path: str, refresh: str | None = None) -> None:
    """Named outputs; the label history is split by refresh so that drift reads two partitions only."""
    labels = result.segmented.select("subscriber_id", "segment_id")
    target = f"{path}/segment_labels" + (f"/refresh={refresh}" if refresh else "")
    labels.write.mode("overwrite").parquet(target)
    result.segmented.drop("features").write.mode("overwrite").parquet(f"{path}/features_segmented")
    result.profiles.write.mode("overwrite").parquet(f"{path}/segment_profiles")
    result.recommendations.write.mode("overwrite").parquet(f"{path}/recommendations")
    if result.density is not None:
        result.density.write.mode("overwrite").parquet(f"{path}/segment_density")
    result.scorer.save(result.segmented.sparkSession, f"{path}/model")

