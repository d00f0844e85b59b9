"""Neighbourhoods by pivots, and DBSCAN on them, against brute force."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from test_clustering import brute

from hexcohort.operators import blocks, metric
from hexcohort.operators.metric import MetricTiles, dbscan_metric


def cloud(d, n, seed):
    r = np.random.default_rng(seed)
    part = n // 4
    return np.vstack([r.normal(0, 0.4, (part, d)), r.normal(2, 0.3, (part, d)), r.uniform(-2, 4, (n - 3 * part, d)),
                      np.repeat(r.uniform(-2, 4, (1, d)), part, 0)])        # a group of copies


def frame(spark, x):
    cols = [f"f{i}" for i in range(x.shape[1])]
    return spark.createDataFrame(pd.DataFrame(x, columns=cols).assign(id=range(len(x)))), cols


@pytest.mark.parametrize("d,eps,m,block", [(1, 0.2, 5, 1024), (3, 0.6, 5, 7), (12, 1.6, 5, 40), (35, 3.2, 6, 1024)])
def test_clusters_match_brute_force(spark, d, eps, m, block):
    x = cloud(d, 300, d)
    df, cols = frame(spark, x)
    got = dbscan_metric(df.repartition(5), cols, eps, m, block=block).toPandas().sort_values("id").segment_id.to_numpy()
    near, core, lab = brute(x, eps, m)
    assert core.any()
    number = {lab[i]: got[i] for i in np.flatnonzero(core)}
    assert len(set(number.values())) == len(number) and min(number.values()) == 0
    for i in range(len(x)):
        reach = [number[lab[k]] for k in np.flatnonzero(near[i] & core)]
        assert got[i] == (number[lab[i]] if core[i] else min(reach, default=-1))


@pytest.mark.parametrize("d", [12, 35])
def test_compared_pairs_grow_about_as_the_rows(spark, d):
    """Forty groups of rows, more rows in the same number of neighbours each: groups grow in number with the rows."""
    compared = []
    for n in (1000, 2000, 4000):
        r = np.random.default_rng(d)
        centres = r.normal(0, 10, (n // 25, d))
        x = centres.repeat(25, axis=0) + r.normal(0, 0.05, (n, d))
        df, cols = frame(spark, x)
        compared.append(MetricTiles(df, cols, 1.0).counts().agg({"compared": "sum"}).first()[0])
    assert compared[2] < 6 * compared[0] and compared[0] < 60 * 1000


def test_rows_without_a_place_are_noise(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.1), (3, None, 0.0), (4, float("nan"), 0.0), (5, 0.0, -0.0)], "id int, a double, b double")
    got = {r.id: r.segment_id for r in dbscan_metric(df, ["a", "b"], 0.5, 3).collect()}
    assert got == {1: 0, 2: 0, 3: -1, 4: -1, 5: 0}
    assert dbscan_metric(df.limit(0), ["a", "b"], 0.5, 3).collect() == []


@pytest.mark.parametrize("d", [2, 12])
def test_wide_blocks_meet_only_in_reach_and_match_brute_force(spark, monkeypatch, d):
    """Twelve far groups and blocks of 64 points: a block meets its neighbours, no copy of a point is dealt out."""
    monkeypatch.setattr(metric, "VISITS", -1)
    monkeypatch.setattr(blocks, "CHUNK", 16)
    monkeypatch.setattr(metric, "CHUNK", 16)
    r = np.random.default_rng(d)
    x = r.normal(0, 30, (12, d)).repeat(60, axis=0) + r.normal(0, 1, (720, d))
    df, cols = frame(spark, x)
    tiles = MetricTiles(df.repartition(5), cols, 1.5, wide=64)
    assert tiles.dense and tiles.layout.depth > 3
    counts = tiles.counts().join(tiles.points, "pid").toPandas()
    want = {tuple(v): n for v, n in zip(x + 0.0, (np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) <= 1.5).sum(1))}
    assert len(counts) == 720 and all(want[tuple(v)] == n for v, n in zip(counts.x, counts.near))
    assert counts.compared.sum() < 720 * 720 / 4
    seen = tiles.seen_by(tiles.points.filter("pid % 7 = 0")).counts().join(tiles.points, "pid").toPandas()
    assert 0 < len(seen) < 720 and all(want[tuple(v)] == n for v, n in zip(seen.x, seen.near))
    got = dbscan_metric(df, cols, 1.5, 4, wide=64).toPandas().sort_values("id").segment_id.to_numpy()
    near, core, lab = brute(x, 1.5, 4)
    number = {lab[i]: got[i] for i in np.flatnonzero(core)}
    assert len(set(number.values())) == len(number)
    for i in range(len(x)):
        reach = [number[lab[k]] for k in np.flatnonzero(near[i] & core)]
        assert got[i] == (number[lab[i]] if core[i] else min(reach, default=-1))
