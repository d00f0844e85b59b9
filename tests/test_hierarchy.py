"""The density hierarchy against a plain top-down one, whatever the partitioning and the task bounds."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from hexcohort.operators import metric
from hexcohort.operators.hierarchy import Hierarchy, core_distances, hdbscan, spanning_tree
from hexcohort.registry import QUERIES
from hexcohort.registry.clustering import _work_km


def blobs(d, n, seed):
    r = np.random.default_rng(seed)
    part = n // 5
    return np.vstack([r.normal(0, 0.3, (part, d)), r.normal(1.6, 0.2, (part, d)), r.normal([4] + [0] * (d - 1), 0.5, (part, d)),
                      r.uniform(-3, 6, (n - 4 * part, d)), np.repeat(r.uniform(-2, 4, (1, d)), part, 0)])        # a group of copies


def prim(reach):
    """Lengths of the shortest tree."""
    best, out, i = reach[0].copy(), [], 0
    open_ = np.ones(len(reach), bool)
    for _ in range(len(reach) - 1):
        open_[i] = False
        best = np.minimum(best, reach[i])
        i = np.argmin(np.where(open_, best, np.inf))
        out.append(best[i])
    return np.array(out)


def plain(x, least, k, epsilon=0.0):
    """Top-down by its definition: (core distances, reachability, parts as (rows, birth, stability, children), labels)."""
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = np.sort(dist, 1)[:, k]
    reach = np.maximum(dist, np.maximum(core[:, None], core[None]))

    def parts(rows, below):
        """Rows joined by lengths under ``below``; a row whose own copies are farther than that is alone."""
        left, out = np.array(sorted(rows)), []
        while len(left):
            part = np.zeros(len(left), bool)
            new = np.arange(len(left)) == 0
            while new.any():
                part |= new
                new = (reach[np.ix_(left[new], left)] < below).any(0) & ~part
            out.append(left[part].tolist())
            left = left[~part]
        return out

    def longest(rows):
        """Length at which the rows fall apart."""
        return prim(reach[np.ix_(rows, rows)]).max(initial=0)

    def grow(rows, birth):
        now, mass, size = list(rows), 0.0, len(rows)
        dense = 0.0 if birth is None else 1 / max(birth, 1e-12)
        while True:
            at = longest(now)
            lam = 1 / max(at, 1e-12)
            split = parts(now, at)
            large = [p for p in split if len(p) >= least]
            if len(large) == 1:
                mass += (len(now) - len(large[0])) * (lam - dense)
                now = large[0]
                continue
            mass += len(now) * (lam - dense)
            return dict(rows=set(rows), birth=birth, stability=mass, children=[grow(p, at) for p in large] if len(large) > 1 else [], size=size)

    root = grow(range(len(x)), None)

    def choose(c):
        found = [f for child in c["children"] for f in choose(child)]
        c["below"] = sum(child["best"] for child in c["children"])
        if c is not root and c["stability"] >= c["below"]:
            c["best"] = c["stability"]
            return [c]
        c["best"] = c["below"]
        return found

    up = {}

    def link(c):
        for child in c["children"]:
            up[id(child)] = c
            link(child)

    link(root)
    chosen = choose(root)
    final = {}
    for c in chosen:
        while c["birth"] < epsilon and up[id(c)] is not root:
            c = up[id(c)]
        final[id(c)] = c
    lab = np.full(len(x), -1)
    for n, c in enumerate(final.values()):
        lab[list(c["rows"])] = n
    return core, reach, root, lab


def same_groups(a, b):
    pairs = set(zip(a.tolist(), b.tolist()))
    return len(pairs) == len({p[0] for p in pairs}) == len({p[1] for p in pairs}) and all((p == -1) == (q == -1) for p, q in pairs)


def flat(c):
    return [c] + [f for k in c["children"] for f in flat(k)]


@pytest.mark.parametrize("d,n,least,k,eps,block,bound", [(2, 500, 12, 5, 0.0, 1024, 2_000_000), (3, 300, 10, 4, 0.0, 16, 40),
                                                         (12, 250, 8, 3, 0.0, 1024, 30), (2, 300, 6, 3, 0.5, 64, 2_000_000)])
def test_tree_and_labels_match_a_plain_hierarchy(spark, d, n, least, k, eps, block, bound):
    x = blobs(d, n, d)
    cols = [f"f{i}" for i in range(d)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=cols).assign(id=range(n))).repartition(3 if bound > 100 else 7)
    core, reach, root, lab = plain(x, least, k, eps)
    h = Hierarchy(df, cols, least, k, block, bound)
    got = h.labels(epsilon=eps).toPandas().sort_values("id").segment_id.to_numpy()
    assert lab.max() >= 1 and (lab < 0).any()
    assert same_groups(got, lab)
    sizes = np.bincount(got[got >= 0])
    assert (np.diff(sizes) <= 0).all()

    place = {tuple(r.x): r.pid for r in h.points.collect()}
    pid = np.array([place[tuple(v)] for v in x + 0.0])
    cores = {r.pid: r.core for r in h.cores.collect()}
    assert np.allclose([cores[p] for p in pid], core, rtol=1e-12, atol=1e-12)
    tree = sorted(r.w for r in h.tree.collect())
    first = np.unique(pid, return_index=True)[1]
    assert np.allclose(tree, sorted(prim(reach[np.ix_(first, first)])), rtol=1e-12)

    want = sorted((c["size"], c["birth"] or -1, c["stability"]) for c in flat(root))
    have = sorted((r["size"], -1 if r.length is None else r.length, r.stability) for r in h.clusters.collect())
    assert np.allclose(have, want, rtol=1e-9)


def test_few_rows_copies_and_rows_without_a_place(spark):
    schema = "id int, a double, b double"
    assert hdbscan(spark.createDataFrame([], schema), ["a", "b"], 3, 2).collect() == []
    few = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 0.1)], schema)
    assert {r.segment_id for r in hdbscan(few, ["a", "b"], 3, 2).collect()} == {-1}
    rows = [(i, 0.0, -0.0) for i in range(9)] + [(20 + i, 5.0, 5.0) for i in range(6)] + [(40, None, 1.0), (41, float("nan"), 1.0), (42, 2.0, 2.5)]
    got = {r.id: r.segment_id for r in hdbscan(spark.createDataFrame(rows, schema), ["a", "b"], 4, 2, 0.0).collect()}
    assert {got[i] for i in range(9)} == {0} and {got[20 + i] for i in range(6)} == {1}
    assert {got[40], got[41]} == {-1} and got[42] == 0      # joins the larger cluster before the two meet
    same = spark.createDataFrame([(i, 1.0, 1.0) for i in range(9)], schema)
    assert {r.segment_id for r in hdbscan(same, ["a", "b"], 4, 2).collect()} == {-1}       # a root alone is no cluster


def test_query_matches_a_plain_hierarchy(spark):
    sf = "/root/testdata/sf0.001"
    got = QUERIES["hdbscan_segments"](spark, sf).toPandas().sort_values("subscriber_id")
    at = _work_km(spark, sf).select("subscriber_id", "x_km", "y_km").toPandas().sort_values("subscriber_id")
    assert same_groups(got.segment_id.to_numpy(), plain(at[["x_km", "y_km"]].to_numpy() + 0.0, 15, 5)[3])


def test_tree_by_wide_blocks(spark, monkeypatch):
    """The same core distances and tree where blocks of 50 points meet."""
    monkeypatch.setattr(metric, "VISITS", -1)
    x = blobs(12, 250, 4)
    cols = [f"f{i}" for i in range(12)]
    tiles = metric.MetricTiles(spark.createDataFrame(pd.DataFrame(x, columns=cols)).repartition(3), cols, None, wide=50)
    tiles = tiles.at(2.0)
    assert tiles.dense
    cores = core_distances(tiles, 3)
    core, reach, _, _ = plain(x, 8, 3)
    place = {tuple(r.x): r.pid for r in tiles.points.collect()}
    pid = np.array([place[tuple(v)] for v in x + 0.0])
    of = {r.pid: r.core for r in cores.collect()}
    assert np.allclose([of[p] for p in pid], core, rtol=1e-12, atol=1e-12)
    first = np.unique(pid, return_index=True)[1]
    assert np.allclose(sorted(r.w for r in spanning_tree(tiles, cores).collect()), sorted(prim(reach[np.ix_(first, first)])), rtol=1e-12)
