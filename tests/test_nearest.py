"""Nearest references from a table, against brute force."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from test_clustering import brute

from hexcohort.operators.metric import MetricTiles, core_flags, dbscan_metric
from hexcohort.operators.nearest import NearestIndex, assign_nearest, core_points
from hexcohort.plans.segmentation import run


def table(spark, x, name):
    return spark.createDataFrame(pd.DataFrame({name: range(len(x)), "x": [list(map(float, v)) for v in x]}))


def gaps(x, y):
    return np.sqrt(((x[:, None, :] - y[None, :, :]) ** 2).sum(2))


def points(d, n, seed):
    r = np.random.default_rng(seed)
    return np.round(np.vstack([r.normal(0, 1, (n // 2, d)), r.normal(4, 0.2, (n - n // 2 - 1, d)), np.full((1, d), 60.0)]), 2)


@pytest.mark.parametrize("d,k,block", [(1, 40, 8), (2, 300, 16), (35, 5000, 1024)])
def test_nearest_and_farthest_match_brute_force(spark, d, k, block):
    ref, q = points(d, k, 1), np.vstack([points(d, 200, 2), np.zeros((150, d)), points(d, k, 1)[:20]])     # copies and hits
    index = NearestIndex(table(spark, ref, "segment_id").repartition(3), "segment_id", "x", block=block)
    got = index.search(table(spark, q, "key").repartition(4), "x", farthest=True).toPandas().set_index("key").sort_index()
    want = gaps(q, ref)
    assert list(got.index) == list(range(len(q)))
    assert np.allclose(got.near, want.min(1), atol=1e-12) and np.allclose(got.far, want.max(1), atol=1e-9)
    assert np.allclose(want[np.arange(len(q)), got.id], want.min(1), atol=1e-12)


def test_ties_take_the_smallest_id(spark):
    ref = spark.createDataFrame([(7, [1.0, 0.0]), (3, [-1.0, 0.0]), (5, [0.0, 1.0]), (2, [9.0, 9.0]), (1, [9.0, 9.0])], "segment_id int, x array<double>")
    got = assign_nearest(spark.createDataFrame([("a", [0.0, 0.0]), ("b", [9.0, 9.0]), ("c", [0.0, -0.0])], "n string, x array<double>"), "x", NearestIndex(ref, "segment_id", "x"))
    assert {r.n: (r.segment_id, r.confidence) for r in got.collect()} == {"a": (3, 0.921), "b": (1, 1.0), "c": (3, 0.921)}


@pytest.mark.parametrize("d,eps,block", [(12, 2.5, 50)])
def test_density_model_reaches_as_far_as_its_radius(spark, d, eps, block):
    x = points(d, 300, 5)
    cols = [f"f{i}" for i in range(d)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=cols))
    labelled = dbscan_metric(df, cols, eps, 5).persist()
    cores = core_points(labelled, cols, eps, 5)
    _, core, _ = brute(x, eps, 5)
    assert core.any() and {tuple(r.x) for r in cores.collect()} == {tuple(v) for v in x[core]}
    ref = cores.toPandas()
    q = points(d, 250, 6)
    got = assign_nearest(table(spark, q, "n"), "x", NearestIndex(cores, "segment_id", "x", eps, block)).toPandas().sort_values("n")
    g = gaps(q, np.array(ref.x.tolist()))
    near = g.min(1)
    for i, (seg, sure) in enumerate(zip(got.segment_id, got.confidence)):
        at = np.flatnonzero(np.abs(g[i] - near[i]) < 1e-12)
        assert seg in (set(ref.segment_id[at]) if near[i] <= eps else {-1})
        assert sure == pytest.approx(max(0, 1 - near[i] / (eps + 1e-6)) if near[i] <= eps else 0, abs=5.1e-4)
    own = assign_nearest(labelled.selectExpr("segment_id AS was", f"array({','.join(cols)}) AS x"), "x", NearestIndex(cores, "segment_id", "x", eps, block))
    assert own.filter("(segment_id < 0) <> (was < 0)").count() == 0


def test_rows_and_references_without_a_place(spark):
    ref = spark.createDataFrame([(0, [1.0, 1.0]), (1, None), (2, [float("nan"), 0.0])], "segment_id int, x array<double>")
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, None), (3, [None, 1.0]), (4, [float("inf"), 1.0])], "n int, x array<double>")
    for index in (NearestIndex(ref, "segment_id", "x"), NearestIndex(ref, "segment_id", "x", 2.0)):
        assert {r.n: r.segment_id for r in assign_nearest(df, "x", index).collect()} == {1: 0, 2: -1, 3: -1, 4: -1}
        assert assign_nearest(df.limit(0), "x", index).collect() == []
    assert [r.segment_id for r in assign_nearest(df, "x", NearestIndex(ref.limit(0), "segment_id", "x")).collect()] == [-1] * 4


def test_shared_core_flags_give_the_same_labels_and_model(spark):
    """Copies, nulls, a border point and a lone one: what the labels and the model share changes neither."""
    rows = [(0.0, 0.0)] * 3 + [(0.4, 0.0), (0.9, 0.0), (9.0, 9.0), (5.0, 5.0), (5.0, 5.1), (5.1, 5.0), (None, 0.0), (float("nan"), 0.0)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, a double, b double").repartition(3)
    known = core_flags(df, ["a", "b"], 0.5, 3)
    shared = dbscan_metric(df, ["a", "b"], 0.5, 3, known=known).persist()
    assert shared.exceptAll(dbscan_metric(df, ["a", "b"], 0.5, 3)).isEmpty() and shared.count() == len(rows)
    model = {(r.segment_id, *r.x) for r in core_points(shared, ["a", "b"], 0.5, 3, known=known).collect()}
    assert model == {(r.segment_id, *r.x) for r in core_points(shared, ["a", "b"], 0.5, 3).collect()}
    assert model == {(0, 0.0, 0.0), (0, 0.4, 0.0), (1, 5.0, 5.0), (1, 5.0, 5.1), (1, 5.1, 5.0)}


def test_the_job_by_density_counts_neighbours_once(spark, sample, monkeypatch):
    counted, cores = [], MetricTiles.cores
    monkeypatch.setattr(MetricTiles, "cores", lambda self, least: counted.append(least) or cores(self, least))
    result = run(sample.drop("same_h3_zone"), algorithm="dbscan", eps=6.0, min_samples=4, check=False)
    assert counted == [4] and result.scorer.references.count() > 0


def test_rows_that_are_references_visit_no_ring(spark, monkeypatch):
    looked, visits = [], NearestIndex._visits
    monkeypatch.setattr(NearestIndex, "_visits", lambda self, rows, *a, **b: looked.append(rows.count()) or visits(self, rows, *a, **b))
    ref = points(3, 200, 1)
    ref[0, 0] = -0.0
    q = np.vstack([ref + 0.0, ref[:50] + 0.05])
    index = NearestIndex(table(spark, ref, "segment_id"), "segment_id", "x", 1.0, block=32)
    got = index.search(table(spark, q, "key").repartition(3), "x").toPandas().set_index("key").sort_index()
    near = gaps(q, ref).min(1)
    assert list(got.index) == np.flatnonzero(near <= 1).tolist() and np.allclose(got.near, near[near <= 1], atol=1e-12)
    assert looked and max(looked) <= 50
