"""Cluster quality: inertia, Calinski-Harabasz, Davies-Bouldin, silhouette, sizes.

The sums of squares come from per-cluster moments, one pass over the rows.
Davies-Bouldin needs the centroids first, so a second pass.  The silhouette
covers every row in linear time: it uses squared distances, whose mean over a
cluster follows from the cluster's centre and spread.  The Euclidean silhouette
of a seeded sample is an operator of its own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.expr import rnd
from hexcohort.functions.joins import join_small
from hexcohort.operators.moments import complete_moments, with_totals
from hexcohort.operators.sampling import hash_sample
from hexcohort.sources.scratch import materialize


def _sum(terms) -> Column:
    return reduce(lambda a, b: a + b, terms)


def distance(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return F.sqrt(_sum([(x - y) * (x - y) for x, y in zip(a, b)]))


def _valid(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col(label) >= 0)


def cluster_sums(df: DataFrame, features: Sequence[str], label: str = "segment_id") -> DataFrame:
    """One row: clusters, rows, within (inertia) and between sums of squares, largest cluster."""
    m = with_totals(complete_moments(_valid(df, label).select(label, *features), features, label))
    per = m.groupBy(label).agg(F.max("rows_n").alias("n"), F.sum(F.col("n") * F.col("v")).alias("w"),
                               F.sum(F.col("n") * F.pow(F.col("m") - F.col("all_m"), 2)).alias("b"))
    return per.agg(F.count(F.lit(1)).alias("n_clusters"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                   F.coalesce(F.sum("w"), F.lit(0.0)).alias("inertia"), F.coalesce(F.sum("b"), F.lit(0.0)).alias("between"),
                   F.coalesce(F.max("n"), F.lit(0)).alias("largest"))


def calinski_harabasz(df: DataFrame, features: Sequence[str], label: str = "segment_id") -> DataFrame:
    s = cluster_sums(df, features, label)
    k, n = F.col("n_clusters").cast("double"), F.col("n_rows").cast("double")
    ch = F.when(F.col("inertia") == 0, F.lit(1.0)).otherwise(
        F.try_divide(F.col("between") * (n - k), F.col("inertia") * (k - F.lit(1.0))))
    return s.select(ch.alias("calinski_harabasz"))


def inertia(df: DataFrame, features: Sequence[str], label: str = "segment_id") -> DataFrame:
    """Sum of squared distances to the cluster means of the given labels."""
    return cluster_sums(df, features, label).select("n_clusters", "inertia")


def centroids(df: DataFrame, features: Sequence[str], label: str = "segment_id") -> DataFrame:
    """``(label, centre)``: mean vector per cluster as an array."""
    vec = array_to_vector(F.array(*[F.col(c).cast("double") for c in features]))
    return _valid(df, label).groupBy(label).agg(vector_to_array(Summarizer.mean(vec)).alias("centre"))


#: Pivots, as the square root of the clusters allows, and clusters of a block.
DB_PIVOTS, DB_BLOCK = 512, 1024
#: Spreads of one class are within a factor of two of each other.
CLASSES = 64


def _gaps(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances by plain differences, a dimension at a time."""
    d = np.zeros((len(x), len(y)))
    for k in range(x.shape[1]):
        d += (x[:, k][:, None] - y[:, k][None, :]) ** 2
    return np.sqrt(d)


def _worst(ids: np.ndarray, c: np.ndarray, s: np.ndarray, other_ids: np.ndarray, other_c: np.ndarray, other_s: np.ndarray) -> np.ndarray:
    """For each cluster the largest (spread + spread) / distance to one of the others; coincident centroids count as 0."""
    d = _gaps(c, other_c)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where((d > 0) & (ids[:, None] != other_ids[None, :]), (s[:, None] + other_s[None, :]) / d, 0.0)
    return ratio.max(axis=1, initial=0.0)


def worst_ratios(spread: DataFrame, label: str, block: int = DB_BLOCK) -> DataFrame:
    """``(label, r, compared)``: each cluster's worst ratio among all clusters of ``spread(label, spread, centre)``.

    A bounded number of clusters are pivots; each cluster belongs to the cell of its nearest one,
    which is split by the power of two of the spread.  Its ratio to the pivots is
    a lower bound ``r`` of its worst one, so only clusters nearer than ``(s_i + s_j) / r`` can be worse.  By the triangle
    inequality a whole cell is too far if its pivot is farther than that plus the cell's radius, or if half the difference of
    the distances to both pivots is; ``s_j`` is at most the cell's largest spread.  What is left is compared block by block.
    """
    table = materialize(spread.select(F.col(label).cast("long").alias("i"), "spread", "centre").withColumn("centre", F.col("centre").cast("array<double>")), "spreads")
    k = table.count()
    near = table.orderBy(F.xxhash64("i"), "i").limit(int(min(DB_PIVOTS, max(1, 3 * k ** 0.5)))).collect()         # bounded
    p_id, p_s = np.array([r["i"] for r in near], np.int64), np.array([r["spread"] for r in near], float)
    p_c = np.array([r["centre"] for r in near], float)

    def columns(b: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        centre = b.column("centre")
        centre = centre.combine_chunks() if isinstance(centre, pa.ChunkedArray) else centre
        return (b.column("i").to_numpy(), centre.flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1), b.column("spread").to_numpy())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                ids, c, s = columns(b)
                d = _gaps(c, p_c)
                pivot = d.argmin(1)
                cell = pivot * CLASSES + np.clip(np.frexp(s)[1] + CLASSES // 2, 0, CLASSES - 1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int64()), pa.array(d[np.arange(len(c)), pivot]), pa.array(_worst(ids, c, s, p_id, p_c, p_s))],
                                                 names=["i", "spread", "centre", "cell", "own", "r"])

    placed = materialize(table.mapInArrow(place, "i long, spread double, centre array<double>, cell long, own double, r double"), "placed")
    cells = placed.groupBy("cell").agg(F.max("own").alias("radius"), F.max("spread").alias("top"), F.ceil(F.count(F.lit(1)) / block).cast("int").alias("mb"))
    held = {r["cell"]: (r["radius"], r["top"]) for r in cells.collect()}            # pivots x classes at most
    c_at = np.array(sorted(held), np.int64)
    c_rad, c_top = (np.array([held[c][j] for c in c_at.tolist()], float) for j in (0, 1))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                _, c, s = columns(b)
                own, r = b.column("own").to_numpy(), b.column("r").to_numpy()
                d = _gaps(c, p_c[c_at // CLASSES])
                with np.errstate(divide="ignore"):
                    reach = (s[:, None] + c_top[None]) / r[:, None]
                least = np.maximum(d - c_rad[None], (d - own[:, None]) / 2)
                q, at = np.nonzero(least <= reach * (1 + 1e-9) + 1e-12)
                yield pa.RecordBatch.from_arrays([*(b.column(n).take(pa.array(q)) for n in ("i", "spread", "centre")), pa.array(c_at[at])],
                                                 names=["i", "spread", "centre", "cell"])

    visits = materialize(placed.mapInArrow(visit, "i long, spread double, centre array<double>, cell long"), "visits")
    blocks = materialize(visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("vb")).join(cells.select("cell", "mb"), "cell"), "cells")
    name = F.xxhash64("i")
    sides = []
    for rows, mine, theirs, flag in ((placed.select("i", "spread", "centre", "cell"), "mb", "vb", True), (visits, "vb", "mb", False)):
        spread_out = rows.join(blocks, "cell").withColumn("x", F.pmod(name, F.col(mine)).cast("int")).withColumn("y", F.explode(F.sequence(F.lit(0), F.col(theirs) - 1)))
        m, v = ("x", "y") if flag else ("y", "x")
        sides.append(spread_out.select("i", "spread", "centre", "cell", F.col(m).alias("m"), F.col(v).alias("v"), F.lit(flag).alias("is_member")))

    def compare(group: pa.Table) -> pa.Table:
        flag = group.column("is_member")
        members, visitors = columns(group.filter(flag)), columns(group.filter(pc.invert(flag)))
        r = _worst(*visitors, *members) if len(members[0]) and len(visitors[0]) else np.zeros(len(visitors[0]))
        return pa.table({"i": pa.array(visitors[0], pa.int64()), "r": pa.array(r, pa.float64()), "compared": pa.array(np.full(len(r), len(members[0])), pa.int64())})

    found = sides[0].unionByName(sides[1]).groupBy("cell", "m", "v").applyInArrow(compare, "i long, r double, compared long")
    known = placed.select("i", "r", F.lit(0).cast("long").alias("compared"))
    return found.unionByName(known).groupBy(F.col("i").alias(label)).agg(F.max("r").alias("r"), F.sum("compared").alias("compared"))


def davies_bouldin(df: DataFrame, features: Sequence[str], label: str = "segment_id") -> DataFrame:
    """Mean over clusters of the worst (spread_i + spread_j) / distance(centroid_i, centroid_j); see ``worst_ratios``."""
    cents = centroids(df, features, label)
    rows = join_small(_valid(df, label).select(label, *features), cents, label, "inner")
    off = distance([F.col(f) for f in features], [F.col("centre")[i] for i in range(len(features))])
    spread = rows.groupBy(label).agg(F.avg(off).alias("spread"), F.first("centre").alias("centre"))
    return worst_ratios(spread, label).agg(F.avg("r").alias("davies_bouldin"))


def silhouette(df: DataFrame, features: Sequence[str], label: str = "segment_id") -> DataFrame:
    """Squared-distance silhouette over every row: one row ``(n_rows, silhouette)``; -1 below two clusters.

    A row alone in its cluster counts as 0.
    """
    valid = _valid(df, label).select(array_to_vector(F.array(*[F.col(f).cast("double") for f in features])).alias("features"),
                                     F.col(label).cast("double").alias("prediction"))
    sizes = valid.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))
    n_clusters, n_rows = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    value = ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(valid) if n_clusters >= 2 else -1.0
    return df.sparkSession.createDataFrame([(n_rows, float(value))], "n_rows long, silhouette double")


def silhouette_sample(df: DataFrame, features: Sequence[str], label: str = "segment_id", key: str = "subscriber_id",
                      sample_size: int = 5000, seed: int = 42) -> DataFrame:
    """Euclidean silhouette of a seeded sample, one row ``(n_sampled, silhouette)``.

    At most ``sample_size`` rows are read and shared with the tasks; each task
    measures its share of the sample against all of it.
    """
    spark = df.sparkSession
    sample = hash_sample(_valid(df, label).select(key, label, *features), sample_size, key, seed).collect()
    if not sample:
        return spark.createDataFrame([(0, -1.0)], "n_sampled long, silhouette double")
    x = np.array([[r[f] for f in features] for r in sample], dtype=float)
    labels = np.array([r[label] for r in sample])
    ids, codes = np.unique(labels, return_inverse=True)
    if len(ids) < 2:
        return spark.createDataFrame([(len(sample), -1.0)], "n_sampled long, silhouette double")
    shared = spark.sparkContext.broadcast((x, codes, np.bincount(codes)))

    def widths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pts, code, size = shared.value
        member = np.eye(len(size))[code]
        for pdf in batches:
            i = pdf["i"].to_numpy()
            # in slices, so that the difference cube stays small
            dist = np.vstack([np.sqrt(((pts[j, None, :] - pts[None, :, :]) ** 2).sum(-1))
                              for j in np.array_split(i, max(1, len(i) // 64))]) if len(i) else np.zeros((0, len(pts)))
            total = dist @ member
            own = code[i]
            rows = np.arange(len(i))
            a = total[rows, own] / np.maximum(size[own] - 1, 1)
            other = total / size
            other[rows, own] = np.inf
            b = other.min(axis=1)
            s = np.where(size[own] > 1, (b - a) / np.maximum(np.maximum(a, b), 1e-300), 0.0)
            yield pd.DataFrame({"s": s})

    idx = spark.range(len(sample)).withColumnRenamed("id", "i").repartition(
        max(1, min(spark.sparkContext.defaultParallelism, len(sample) // 64 + 1)))
    return idx.mapInPandas(widths, "s double").agg(F.count("s").alias("n_sampled"), F.avg("s").alias("silhouette"))


def cluster_metrics(df: DataFrame, features: Sequence[str], label: str = "segment_id") -> DataFrame:
    """One row with every measure; fixed sentinels when there is nothing to compare."""
    noise = df.agg(F.count_if(F.col(label) == -1).alias("n_noise"))
    base = cluster_sums(df, features, label)
    k, n = F.col("n_clusters"), F.col("n_rows")
    enough = (k >= 2) & (n >= k + 1)
    ch = F.when(F.col("inertia") == 0, F.lit(1.0)).otherwise(F.try_divide(
        F.col("between") * (n - k).cast("double"), F.col("inertia") * (k - 1).cast("double")))
    db = davies_bouldin(df, features, label).scalar()
    sil = silhouette(df, features, label).select("silhouette").scalar()
    return base.select(
        F.when(enough, rnd(sil, 4)).otherwise(F.lit(-1.0)).alias("silhouette"),
        F.when(enough, rnd(db, 4)).otherwise(F.lit(999.0)).alias("davies_bouldin"),
        F.when(enough, rnd(ch, 2)).otherwise(F.lit(0.0)).alias("calinski_harabasz"),
        k.alias("n_clusters"), noise.scalar().alias("n_noise"),
        F.when(enough, rnd(F.try_divide(F.col("largest").cast("double"), n), 3)).otherwise(F.lit(1.0))
        .alias("largest_cluster_pct"))


def quality_gate(metrics: DataFrame, minimum: float = K.MIN_SILHOUETTE) -> DataFrame:
    """Adds ``promote``: the silhouette reaches the minimum."""
    return metrics.withColumn("promote", F.col("silhouette") >= F.lit(float(minimum)))


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index of two labelings: one pass to the contingency table, then its margins."""
    cont = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    margins = cont.cube(a, b).agg(F.sum("n").cast("double").alias("n"), F.grouping_id().alias("g"))
    pairs = F.col("n") * (F.col("n") - F.lit(1.0)) / F.lit(2.0)

    def of(g: int) -> Column:
        return F.sum(F.when(F.col("g") == g, pairs).otherwise(F.lit(0.0)))

    s = margins.agg(of(0).alias("both"), of(1).alias("rows"), of(2).alias("cols"), of(3).alias("all"))
    expected = F.try_divide(F.col("rows") * F.col("cols"), F.col("all"))
    half = (F.col("rows") + F.col("cols")) / F.lit(2.0)
    return s.select(F.coalesce(F.try_divide(F.col("both") - expected, half - expected), F.lit(1.0))
                    .alias("adjusted_rand"))
