from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from hexcohort.operators import kmeans
from hexcohort.operators.components import connected_components
from hexcohort.operators.dbscan import dbscan, hdb_flat
from hexcohort.operators.kmeans import assign, fit_kmeans, pca_2d, tune_k
from hexcohort.operators.metrics import adjusted_rand, cluster_metrics, quality_gate, silhouette, silhouette_sample, worst_ratios
from hexcohort.operators.numbering import number_rows


def blobs(d=2, per=100, sigma=0.1, seed=1):
    r = np.random.default_rng(seed)
    centres = np.zeros((4, d))
    centres[1, 0], centres[2, 1], centres[3, :2] = 5, 5, 5
    x = np.vstack([r.normal(c, sigma, (per, d)) for c in centres])
    pdf = pd.DataFrame(x, columns=[f"f{i}" for i in range(d)])
    pdf["subscriber_id"] = [f"s{i:05d}" for i in range(len(pdf))]
    pdf["truth"] = np.repeat(np.arange(4), per).astype("int32")
    return pdf


@pytest.fixture(scope="module")
def four(spark):
    df = spark.createDataFrame(blobs())
    return df.withColumn("features", array_to_vector(F.array("f0", "f1"))).cache()


def test_separated_blobs(four):
    m = quality_gate(cluster_metrics(four.withColumnRenamed("truth", "segment_id"), ["f0", "f1"])).first()
    assert m["silhouette"] > 0.5 and m["promote"] and m["n_clusters"] == 4 and m["largest_cluster_pct"] == 0.25


def test_noise_is_counted(spark):
    r = np.random.default_rng(3)
    pdf = pd.DataFrame(r.normal(0, 1, (200, 3)), columns=["a", "b", "c"])
    pdf["segment_id"] = np.repeat([-1, 0, 1, 2], [20, 60, 60, 60]).astype("int32")
    pdf["subscriber_id"] = [str(i) for i in range(200)]
    m = cluster_metrics(spark.createDataFrame(pdf), ["a", "b", "c"]).first()
    assert m["n_noise"] == 20 and -1 <= m["silhouette"] <= 1 and m["largest_cluster_pct"] == round(60 / 180, 3)


def test_sentinels(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("b", 0, 2.0), ("c", -1, 3.0)], "subscriber_id string, segment_id int, x double")
    m = cluster_metrics(df, ["x"]).first()
    assert (m["silhouette"], m["davies_bouldin"], m["calinski_harabasz"], m["n_clusters"], m["n_noise"],
            m["largest_cluster_pct"]) == (-1.0, 999.0, 0.0, 1, 1, 1.0)


def test_kmeans_finds_blobs_and_numbers_them_by_centroid(four):
    seg = fit_kmeans(four, k=4, n_init=3)
    out = seg.transform(four)
    assert sorted(r[0] for r in out.select("segment_id").distinct().collect()) == [0, 1, 2, 3]
    assert seg.centers == sorted(seg.centers)
    assert adjusted_rand(out, "segment_id", "truth").first()[0] == pytest.approx(1.0)
    scored = assign(four, [F.col("f0"), F.col("f1")], seg.centers, "again").join(out.select("subscriber_id", "segment_id"), "subscriber_id")
    assert scored.filter("again != segment_id OR confidence < 0 OR confidence > 1").isEmpty()
    assert silhouette(out, ["f0", "f1"]).first()["silhouette"] > 0.9


def test_kmeans_seeds_come_from_all_rows(spark):
    r = np.random.default_rng(5)
    rare = np.vstack([r.normal(0, 0.1, (30_000, 2)), np.full((3, 2), 1000.0)])            # one row in 10,000
    copies = np.vstack([np.repeat([[0.0, 0.0], [0.0, 1.0]], 20_000, axis=0), r.normal((5, 5), 0.01, (40, 2)), r.normal((9, 0), 0.01, (40, 2))])
    for x, k, want in ((rare, 2, [[0, 0], [1000, 1000]]), (copies, 4, [[0, 0], [0, 1], [5, 5], [9, 0]])):
        df = spark.createDataFrame(pd.DataFrame(x, columns=["f0", "f1"])).select(array_to_vector(F.array("f0", "f1")).alias("features"))
        seg = fit_kmeans(df, k, n_init=3)
        assert np.allclose(seg.centers, want, atol=0.01)
        assert np.allclose(fit_kmeans(df.repartition(13), k, n_init=3).centers, seg.centers, atol=1e-9)


def test_kmeans_steps_in_one_task_and_by_passes_end_alike(spark, monkeypatch):
    r = np.random.default_rng(8)
    x = np.vstack([r.normal(0, 1, (900, 6)), r.normal(1.5, 1, (500, 6)), np.repeat(r.normal(0, 2, (1, 6)), 600, axis=0)])
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcdef"))).select(array_to_vector(F.array(*"abcdef")).alias("features"))
    small = fit_kmeans(df, 5, n_init=4)
    monkeypatch.setattr(kmeans, "IN_TASK", 0)
    passes = []
    one_pass = kmeans._pass
    monkeypatch.setattr(kmeans, "_pass", lambda *a: passes.append(1) or one_pass(*a))
    large = fit_kmeans(df.repartition(5), 5, n_init=4)
    assert passes and np.allclose(small.centers, large.centers, atol=1e-6) and small.inertia == pytest.approx(large.inertia)
    distances = ((x[:, None] - np.array(small.centers)[None]) ** 2).sum(-1)
    assert distances.min(1).sum() == pytest.approx(small.inertia)
    assert np.allclose([x[distances.argmin(1) == i].mean(0) for i in range(5)], small.centers, atol=1e-3)


def test_kmeans_with_fewer_distinct_rows_than_centroids(spark):
    df = spark.createDataFrame([(0.0,)] * 30 + [(4.0,)] * 5, "a double").select(array_to_vector(F.array("a")).alias("features"))
    assert sorted({c[0] for c in fit_kmeans(df, 3, n_init=2).centers}) == [0.0, 4.0]


def test_without_centroids_segment_is_zero(four):
    r = assign(four, [F.col("f0")], None, "s").first()
    assert r["s"] == 0 and r["confidence"] == 0.75


def test_k_search_prefers_the_true_number(four):
    t = tune_k(four, (3, 5), n_init=2).toPandas()
    assert t.loc[t.is_best, "k"].tolist() == [4]
    assert t.sort_values("k").inertia.is_monotonic_decreasing


def test_projection(four):
    out = pca_2d(four).toPandas()
    assert set(out.columns) == {"subscriber_id", "x", "y"} and len(out) == 400


@pytest.mark.parametrize("k,d,block", [(3000, 3, 100), (700, 8, 1024), (2, 2, 1024), (1, 2, 1024)])
def test_worst_ratios_of_many_clusters_without_all_pairs(spark, k, d, block):
    r = np.random.default_rng(k)
    c, s = r.uniform(0, 100, (k, d)), r.gamma(2, 1, k)
    c[1:k // 50] = c[0]                                             # some centroids coincide
    off = np.sqrt(((c[:, None] - c[None]) ** 2).sum(-1))
    with np.errstate(divide="ignore", invalid="ignore"):
        want = np.where(off > 0, (s[:, None] + s[None]) / off, 0).max(1)
    df = spark.createDataFrame([(i, float(s[i]), c[i].tolist()) for i in range(k)], "segment_id int, spread double, centre array<double>")
    got = worst_ratios(df.repartition(6), "segment_id", block).toPandas().sort_values("segment_id")
    assert np.allclose(got.r, want, rtol=1e-12) and len(got) == k
    if k == 3000:
        assert got.compared.sum() < 0.3 * k * k


def brute(x, eps, m):
    near = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) <= eps
    core = near.sum(1) >= m
    lab, c = np.full(len(x), -1), 0
    for i in np.where(core)[0]:
        if lab[i] >= 0:
            continue
        lab[i], todo = c, [i]
        while todo:
            for k in np.where(near[todo.pop()] & core & (lab < 0))[0]:
                lab[k] = c
                todo.append(k)
        c += 1
    return near, core, lab


@pytest.mark.parametrize("d,eps,m,leaf", [(1, 0.2, 5, 4), (2, 0.3, 5, 2), (3, 0.6, 5, 8), (5, 1.0, 5, 4)])
def test_density_clusters_match_brute_force(spark, d, eps, m, leaf):
    r = np.random.default_rng(d)
    x = np.vstack([r.normal(0, 0.4, (90, d)), r.normal(2, 0.3, (60, d)), r.uniform(-2, 4, (40, d)),
                   np.repeat(r.uniform(-2, 4, (1, d)), 60, 0)])        # a third-sized group of copies
    cols = [f"f{i}" for i in range(d)]
    pdf = pd.DataFrame(x, columns=cols).assign(id=range(len(x)))
    got = dbscan(spark.createDataFrame(pdf), cols, eps, m, leaf=leaf).toPandas().sort_values("id").segment_id.to_numpy()
    near, core, lab = brute(x, eps, m)
    number = {lab[i]: got[i] for i in np.where(core)[0]}
    assert len(set(number.values())) == len(number) and min(number.values()) == 0
    for i in range(len(x)):
        reach = [number[lab[k]] for k in np.where(near[i] & core)[0]]
        assert got[i] == (number[lab[i]] if core[i] else min(reach, default=-1))


def test_points_with_many_copies_take_the_broadcast_way(spark, monkeypatch):
    import hexcohort.operators.dbscan as D
    df = spark.createDataFrame([(0.0, 0.0)] * 30 + [(0.1, 0.0), (9.0, 9.0), (None, 1.0)], "a double, b double")
    want = sorted(map(str, dbscan(df, ["a", "b"], 0.5, 3).collect()))
    monkeypatch.setattr(D, "HOT", 10)
    assert sorted(map(str, dbscan(df, ["a", "b"], 0.5, 3).collect())) == want and len(want) == 33


def test_flat_hierarchy_drops_border_and_small(spark):
    r = np.random.default_rng(9)
    x = np.vstack([r.normal(0, 0.3, (80, 2)), r.normal(5, 0.2, (15, 2)), r.uniform(-3, 8, (30, 2))])
    pdf = pd.DataFrame(x, columns=["a", "b"]).assign(id=range(len(x)))
    got = hdb_flat(spark.createDataFrame(pdf), ["a", "b"], 40, 5, 0.5).toPandas().sort_values("id").segment_id.to_numpy()
    _, core, lab = brute(x, 0.5, 5)
    size = np.bincount(lab[core])
    assert ((got >= 0) == np.array([core[i] and size[lab[i]] >= 40 for i in range(len(x))])).all()


def test_all_noise(spark):
    pdf = blobs()
    got = dbscan(spark.createDataFrame(pdf), ["f0", "f1"], 0.01, 200)
    assert [r[0] for r in got.select("segment_id").distinct().collect()] == [-1]


def test_missing_coordinate_is_noise(spark):
    df = spark.createDataFrame([(0.0, 0.0)] * 5 + [(None, 0.0)], "a double, b double")
    got = [(r["a"], r["segment_id"]) for r in dbscan(df, ["a", "b"], 1.0, 3).collect()]
    assert (None, -1) in got and got.count((0.0, 0)) == 5


def test_components_on_a_long_path(spark):
    n = 40
    nodes = spark.createDataFrame([(f"n{i:03d}",) for i in range(n)] + [("z1",), ("z2",)], "node string")
    edges = spark.createDataFrame([(f"n{i:03d}", f"n{(i + 1):03d}") for i in range(n - 1)] + [("z2", "z1")], "a string, b string")
    got = dict(connected_components(nodes, edges).collect())
    assert {got[f"n{i:03d}"] for i in range(n)} == {"n000"} and got["z1"] == got["z2"] == "z1"


def test_numbers_are_consecutive_and_ordered(spark):
    df = spark.range(1000).repartition(7)
    rows = number_rows(df, "no", [F.desc("id")]).collect()
    assert all(r["id"] + r["no"] == 999 for r in rows) and len(rows) == 1000


def test_starts_of_one_step_match_their_own_steps():
    """Several starts at once, with a tie, an empty centroid and counts, as one after the other."""
    r = np.random.default_rng(0)
    x, n = np.round(r.normal(0, 2, (900, 3)), 1), r.integers(1, 4, 900).astype(float)
    starts = {0: x[:4].copy(), 1: np.array([x[5], x[5], x[6], [99.0, 99, 99]]), 2: x[10:14].copy()}
    group = kmeans._Group(4, [0, 1, 2], starts, 3)
    for at in (0, 300):
        group.add(np.concatenate([n[:, None], x], axis=1)[at:300 if at == 0 else None])
    for s, m in group.sums():
        want = kmeans._folded_step(x, n, starts[s])
        assert np.allclose(m[:, :-1], want[:, :-1]) and m[:, -1].sum() == pytest.approx(want[:, -1].sum())
