"""Hierarchical density clustering: spanning tree of mutual reachability, condensed tree, selection by excess of mass.

* **Core distance** of a row: the distance to its ``min_samples``-th nearest other row.  Found exactly in tiles of a radius;
  points with too few rows in reach look again with a longer radius.
* **Spanning tree.**  Two points are as far apart as the largest of their distance and both core distances.  Of the pairs within
  a radius a tile keeps its own spanning forest (an edge that closes a circle in a tile closes one everywhere), so tiles write
  fewer edges than they have points.  Borůvka rounds make one forest of them; while it has several parts the radius grows,
  and places that hold a single part are not visited again.
* **Condensed tree.**  Edges are taken in order of length, in stages of a bounded number.  All edges of one length count at
  once, so the tree does not depend on the order of equal lengths.  Parts below ``min_cluster_size`` rows fall out of the part
  they meet; two larger parts that meet are children of a new cluster.
* **Selection.**  Rows leave a cluster at ``1 / length``; a cluster's stability is the sum of how much longer than its birth its
  rows stay.  A cluster is selected if it is at least as stable as the best of what is below it; the root never is.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.joins import join_small
from hexcohort.operators.components import connected_components
from hexcohort.operators.metric import MetricTiles, _distances, _within
from hexcohort.operators.numbering import number_rows
from hexcohort.sources.scratch import materialize

#: Edges that one task may hold: of a contracted forest, and of a stage of the condensed tree.
TASK_EDGES = 2_000_000
#: How much longer the next radius is in up to three dimensions, and in more, where pairs in reach grow with a high power of it.
GROWTH, WIDE_GROWTH = 2.0, 2 ** 0.5
#: Lengths below this count as this, so copies have a finite density.
LEAST_LENGTH = 1e-12


def _longer(tiles: MetricTiles) -> float:
    return tiles.eps * (GROWTH if len(tiles.features) <= 3 else WIDE_GROWTH)


def _first_radius(tiles: MetricTiles, k: int) -> float:
    """Median of the distances from a pivot to its ``k``-th nearest row: a pass that keeps ``k`` rows per pivot and batch."""
    pivots = tiles.pivots

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                d = np.sort(_distances(pivots, x), axis=1)[:, :k + 1]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(pivots)).repeat(d.shape[1])), pa.array(d.ravel())], names=["pivot", "d"])

    near = tiles.points.select("x").mapInArrow(nearest, "pivot long, d double")
    rank = F.row_number().over(Window.partitionBy("pivot").orderBy("d"))
    far = near.withColumn("r", rank).filter(F.col("r") <= k + 1).groupBy("pivot").agg(F.max("d").alias("d"))
    return float(far.filter("d > 0").agg(F.median("d")).first()[0] or 1.0)


def core_distances(tiles: MetricTiles, k: int) -> DataFrame:
    """``(pid, core)``: distance to the ``k``-th nearest other row of each point; needs more than ``k`` rows."""
    done, open_ = None, None
    while True:
        eps, pivots, chunks = tiles.eps, tiles.tried, tiles.dense

        def run(members: dict, visitors: dict, eps: float = eps, pivots: np.ndarray | None = pivots, chunks: bool = chunks) -> pa.Table:
            i, j, _ = _within(visitors["x"], members["x"], eps, pivots, chunks=chunks)
            d = _lengths(visitors["x"], members["x"], i, j)
            rows = members["w"][j] - (visitors["pid"][i] == members["pid"][j])
            i, d, rows = i[rows > 0], d[rows > 0], rows[rows > 0]
            order = np.lexsort((d, i))
            i, d, rows = i[order], d[order], rows[order]
            near = np.arange(len(i)) - np.searchsorted(i, i) < k
            return pa.table({"pid": pa.array(visitors["pid"][i[near]]), "d": pa.array(d[near]), "n": pa.array(rows[near])})

        by_distance = Window.partitionBy("pid").orderBy("d")
        found = tiles.run(run, "pid long, d double, n long").withColumn("r", F.row_number().over(by_distance)).filter(F.col("r") <= k)
        reached = F.sum("n").over(by_distance.rowsBetween(Window.unboundedPreceding, 0))
        found = found.withColumn("reached", reached).filter(F.col("reached") >= k).groupBy("pid").agg(F.min("d").alias("core"))
        found = materialize(found, "cores")
        done = found if done is None else done.unionByName(found)
        open_ = (tiles.points.select("pid") if open_ is None else open_).join(found, "pid", "left_anti")
        open_ = materialize(open_, "open")
        if open_.isEmpty():
            return done
        tiles = tiles.at(_longer(tiles), open_)


def _lengths(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i))
    for at in range(0, len(i), 1 << 16):
        s = slice(at, at + (1 << 16))
        out[s] = np.sqrt(((x[i[s]] - y[j[s]]) ** 2).sum(1))
    return out


def _forest(u: np.ndarray, v: np.ndarray, w: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Borůvka in memory: (places of the chosen edges, nodes, root node of each); equal lengths go by (a, b)."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    order = np.lexsort((b, a, w))
    u, v = at[:len(u)][order], at[len(u):][order]
    root, left, chosen = np.arange(len(nodes)), np.flatnonzero(u != v), []
    while len(left):
        best = np.full(len(nodes), -1)
        back = left[::-1]                                   # the last write to a place is the shortest edge
        best[root[u[back]]] = back
        second = np.full(len(nodes), -1)
        second[root[v[back]]] = back
        best = np.where(best < 0, second, np.where(second < 0, best, np.minimum(best, second)))
        tops = np.flatnonzero(best >= 0)
        edge = best[tops]
        chosen.append(np.unique(edge))
        ru, rv = root[u[edge]], root[v[edge]]
        up = np.arange(len(nodes))
        up[tops] = np.where(ru == tops, rv, ru)
        two = tops[(up[up[tops]] == tops) & (tops < up[tops])]   # both chose the same edge: the smaller one is the root
        up[two] = two
        while (up[up] != up).any():
            up = up[up]
        root = up[root]
        left = left[root[u[left]] != root[v[left]]]
    picked = order[np.concatenate(chosen)] if chosen else np.zeros(0, int)
    least = np.full(len(nodes), len(nodes))
    np.minimum.at(least, root, np.arange(len(nodes)))
    return picked, nodes, nodes[least[root]]


def spanning_forest(edges: DataFrame, task_edges: int = TASK_EDGES) -> tuple[DataFrame, DataFrame]:
    """Shortest forest of ``edges(ca, cb, w, a, b)`` between parts: ``(a, b, w)`` chosen and ``(comp, root)`` of the parts.

    A Borůvka round takes the shortest edge of every part and joins the parts along them, which at least halves the parts with
    edges; what is left of at most ``task_edges`` edges is finished in one task.
    """
    chosen, roots = None, None
    edges = materialize(edges, "edges")
    while edges.count() > task_edges:
        ends = edges.unionByName(edges.select(F.col("cb").alias("ca"), F.col("ca").alias("cb"), "w", "a", "b"))
        best = materialize(ends.groupBy("ca").agg(F.min(F.struct("w", "a", "b", "cb")).alias("e")).select("ca", "e.*"), "best")
        comp = connected_components(best.select(F.col("ca").alias("node")), best.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        comp = comp.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        picked = best.select("a", "b", "w").distinct()
        chosen = picked if chosen is None else chosen.unionByName(picked)
        roots = comp if roots is None else _follow(roots, comp)
        left, right = comp.select(F.col("comp").alias("ca"), F.col("root").alias("ra")), comp.select(F.col("comp").alias("cb"), F.col("root").alias("rb"))
        moved = edges.join(left, "ca").join(right, "cb").filter("ra != rb").groupBy(F.least("ra", "rb").alias("ca"), F.greatest("ra", "rb").alias("cb"))
        edges = materialize(moved.agg(F.min(F.struct("w", "a", "b")).alias("e")).select("ca", "cb", "e.*"), "edges")

    def finish(t: pa.Table) -> pa.Table:
        ca, cb, w, a, b = (t.column(c).to_numpy() for c in ("ca", "cb", "w", "a", "b"))
        at, nodes, root = _forest(ca, cb, w, a, b)
        return pa.table({"a": pa.array(np.concatenate([a[at], nodes])), "b": pa.array(np.concatenate([b[at], root])),
                         "w": pa.array(np.concatenate([w[at], np.full(len(nodes), -1.0)]))})

    last = materialize(edges.groupBy(F.lit("all")).applyInArrow(finish, "a long, b long, w double"), "forest")
    picked, comp = last.filter("w >= 0"), last.filter("w < 0").select(F.col("a").alias("comp"), F.col("b").alias("root"))
    return (picked if chosen is None else chosen.unionByName(picked)), (comp if roots is None else _follow(roots, comp))


def _follow(roots: DataFrame, comp: DataFrame) -> DataFrame:
    nxt = comp.select(F.col("comp").alias("root"), F.col("root").alias("top"))
    return materialize(roots.join(nxt, "root", "left").select("comp", F.coalesce("top", "root").alias("root")), "roots")


def spanning_tree(tiles: MetricTiles, cores: DataFrame, task_edges: int = TASK_EDGES) -> DataFrame:
    """``(a, b, w)``: the shortest tree over all points by mutual reachability; one edge fewer than points."""
    comp = materialize(cores.withColumn("comp", F.col("pid")), "parts")
    tree, n = None, comp.count()
    while True:
        eps, pivots, chunks = tiles.eps, tiles.tried, tiles.dense

        def run(members: dict, visitors: dict, eps: float = eps, pivots: np.ndarray | None = pivots, chunks: bool = chunks) -> pa.Table:
            i, j, _ = _within(visitors["x"], members["x"], eps, pivots, (visitors["comp"], members["comp"]), chunks)
            w = np.maximum(_lengths(visitors["x"], members["x"], i, j), np.maximum(visitors["core"][i], members["core"][j]))
            a, b, ca, cb = visitors["pid"][i], members["pid"][j], visitors["comp"][i], members["comp"][j]
            a, b = np.minimum(a, b), np.maximum(a, b)
            at, _, _ = _forest(ca, cb, w, a, b)
            return pa.table({"ca": ca[at], "cb": cb[at], "w": w[at], "a": a[at], "b": b[at]})

        found = tiles.run(run, "ca long, cb long, w double, a long, b long", comp.filter(F.col("core") <= eps), "comp")
        chosen, roots = spanning_forest(found.filter(F.col("w") <= eps), task_edges)
        tree = chosen if tree is None else tree.unionByName(chosen)
        comp = materialize(comp.join(roots, "comp", "left").select("pid", "core", F.coalesce("root", "comp").alias("comp")), "parts")
        largest = comp.groupBy("comp").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "comp").limit(2).collect()
        if len(largest) < 2:
            return materialize(tree, "tree")
        # an edge between two parts has an end outside the largest one
        tiles = tiles.at(_longer(tiles), comp.filter(F.col("comp") != largest[0]["comp"]))


class _Merging:
    """One stage of the condensed tree: parts that meet along edges in order of length."""

    def __init__(self, least: int, stage: int):
        self.least, self.next_id = least, stage << 40
        self.up, self.size, self.cluster, self.members = {}, {}, {}, {}
        self.out = []

    def add(self, part: int, size: int, cluster: int) -> None:
        if part not in self.up:
            self.up[part], self.size[part], self.cluster[part] = part, size, cluster
            self.members[part] = [part] if cluster < 0 else []

    def root(self, part: int) -> int:
        while self.up[part] != part:
            self.up[part] = self.up[self.up[part]]
            part = self.up[part]
        return part

    def level(self, edges: list[tuple[int, int]], length: float) -> None:
        """All edges of one length at once."""
        before = {self.root(p) for e in edges for p in e}
        for a, b in edges:
            a, b = self.root(a), self.root(b)
            if a != b:
                self.up[max(a, b)] = min(a, b)
        groups: dict[int, list[int]] = {}
        for r in sorted(before):
            groups.setdefault(self.root(r), []).append(r)
        for top, parts in groups.items():
            total = sum(self.size[p] for p in parts)
            large = [p for p in parts if self.cluster[p] >= 0]
            loose = [m for p in parts for m in self.members[p]]
            cluster = self.cluster[large[0]] if len(large) == 1 else -1
            if cluster < 0 and total >= self.least:
                cluster, self.next_id = self.next_id, self.next_id + 1
                self.out += [("child", self.cluster[p], cluster, length, self.size[p]) for p in large]
            if cluster >= 0:
                self.out += [("leaves", m, cluster, length, 0) for m in loose]
                loose = []
            for p in parts:
                self.members[p] = []
            self.size[top], self.cluster[top], self.members[top] = total, cluster, loose

    def parts(self) -> list[tuple]:
        tops = {p: self.root(p) for p in self.up}
        return [("part", p, t, float(self.cluster[t]), self.size[t]) for p, t in tops.items()]


def condensed_tree(points: DataFrame, tree: DataFrame, cores: DataFrame, min_cluster_size: int, stage_edges: int = TASK_EDGES) -> tuple[DataFrame, DataFrame]:
    """``(pid, w, cluster, length)`` of every point that is ever in a cluster, and ``(cluster, parent, length, size)`` of the clusters.

    ``length`` is where the point, or the cluster, leaves its (parent) cluster; the root has no parent.  Edges come in stages of
    about ``stage_edges``; edges of one length are never separated.
    """
    alone = points.filter(F.col("w") >= min_cluster_size).join(cores, "pid").select(F.col("pid").alias("a"), F.col("pid").alias("b"), F.col("core").alias("w"))
    edges = materialize(tree.unionByName(alone), "lengths")     # enough copies of one point are a cluster of their own
    stages = max(1, -(-edges.count() // stage_edges))
    cuts = sorted(set(edges.approxQuantile("w", [i / stages for i in range(1, stages)], 0.1 / stages))) if stages > 1 else []
    nodes = points.select("pid", "w", F.col("pid").alias("part"), F.lit(None).cast("long").alias("cluster"), F.lit(None).cast("double").alias("length"))
    state = points.select(F.col("pid").alias("part"), F.col("w").alias("size"), F.lit(-1).cast("long").alias("open"))
    clusters = None
    for stage, (low, high) in enumerate(zip([-1.0, *cuts], [*cuts, float("inf")])):
        def merge(t: pa.Table) -> pa.Table:
            t = t.sort_by("w")
            w = t.column("w").to_numpy()
            ends = [[t.column(f"{c}_{side}").to_numpy().tolist() for c in ("part", "size", "open")] for side in "ab"]
            m = _Merging(min_cluster_size, stage)
            for side in ends:
                for row in zip(*side):
                    m.add(*row)
            edge = np.concatenate([[0], np.flatnonzero(np.diff(w)) + 1, [len(w)]]) if len(w) else np.zeros(1, int)
            for i, k in zip(edge[:-1], edge[1:]):
                m.level(list(zip(ends[0][0][i:k], ends[1][0][i:k])), float(w[i]))
            kind, a, b, length, size = zip(*(m.out + m.parts()))
            return pa.table({"kind": pa.array(kind), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "length": pa.array(length), "size": pa.array(size, pa.int64())})

        now = edges.filter((F.col("w") > low) & (F.col("w") <= high))
        for side in "ab":
            names = {c: f"{c}_{side}" for c in ("part", "size", "open")}
            of = nodes.select(F.col("pid").alias(side), "part").join(state, "part").withColumnsRenamed(names)
            now = now.join(of, side)
        made = now.drop("a", "b").groupBy(F.lit("all")).applyInArrow(merge, "kind string, a long, b long, length double, size long")
        made = materialize(made, "stage")
        found = made.filter("kind = 'child'").select(F.col("a").alias("cluster"), F.col("b").alias("parent"), "length", "size")
        clusters = found if clusters is None else clusters.unionByName(found)
        left = made.filter("kind = 'leaves'").select(F.col("a").alias("part"), F.col("b").alias("c_"), F.col("length").alias("l_"))
        moved = made.filter("kind = 'part'").select(F.col("a").alias("part"), F.col("b").alias("top"), F.col("length").cast("long").alias("open"), "size")
        nodes = materialize(nodes.join(left, "part", "left").join(moved.select("part", "top"), "part", "left").select(
            "pid", "w", F.coalesce("top", "part").alias("part"), F.coalesce("cluster", "c_").alias("cluster"), F.coalesce("length", "l_").alias("length")), "nodes")
        if stage < len(cuts):
            tops = moved.filter("part = top").select("part", "size", "open")
            state = materialize(state.join(moved.select("part"), "part", "left_anti").unionByName(tops), "state")
    rooted = nodes.filter("cluster IS NOT NULL").select("pid", "w", "cluster", "length")
    top = rooted.select("cluster").unionByName(clusters.select(F.col("parent").alias("cluster"))).distinct().join(clusters, "cluster", "left_anti")
    size = points.agg(F.sum("w")).first()[0] or 0
    root = top.select("cluster", F.lit(None).cast("long").alias("parent"), F.lit(None).cast("double").alias("length"), F.lit(size).cast("long").alias("size"))
    return rooted, materialize(clusters.unionByName(root), "clusters")


def stabilities(nodes: DataFrame, clusters: DataFrame) -> DataFrame:
    """``(cluster, parent, length, size, stability)`` of every cluster of the condensed tree."""
    density = F.when(F.col("length").isNotNull(), F.lit(1.0) / F.greatest("length", F.lit(LEAST_LENGTH)))
    leaving = nodes.select("cluster", (F.col("w") * density).alias("mass"), F.col("w").alias("n")).unionByName(
        clusters.filter("parent IS NOT NULL").select(F.col("parent").alias("cluster"), (F.col("size") * density).alias("mass"), F.col("size").alias("n")))
    mass = leaving.groupBy("cluster").agg(F.sum("mass").alias("mass"), F.sum("n").alias("n"))
    birth = F.coalesce(density, F.lit(0.0))
    return clusters.join(mass, "cluster").select("cluster", "parent", "length", "size", (F.col("mass") - F.col("n") * birth).alias("stability"))


def select_clusters(stable: DataFrame, epsilon: float = 0.0) -> DataFrame:
    """``(cluster, chosen)``: the selected cluster each cluster of the condensed tree lies in, null for none.

    Clusters born at a length below ``epsilon`` give way to their first ancestor born above it.  One task reads the folded tree:
    at most two rows for every ``min_cluster_size`` rows of the table.
    """
    def choose(t: pa.Table) -> pa.Table:
        ids = t.column("cluster").to_numpy()
        at = {int(c): i for i, c in enumerate(ids)}
        up = np.array([-1 if p is None else at[p] for p in t.column("parent").to_pylist()], int)
        born = np.array([np.inf if v is None else v for v in t.column("length").to_pylist()])
        stability = t.column("stability").to_numpy()
        below, best, own = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), bool)
        rising = np.argsort(born, kind="stable")            # children are born at shorter lengths than their parents
        for i in rising:
            own[i] = up[i] >= 0 and stability[i] >= below[i]
            best[i] = stability[i] if own[i] else below[i]
            if up[i] >= 0:
                below[up[i]] += best[i]
        chosen = np.full(len(ids), -1)
        for i in rising[::-1]:
            above = chosen[up[i]] if up[i] >= 0 else -1
            chosen[i] = above if above >= 0 else i if own[i] else -1
        merged = set()
        for i in np.unique(chosen[chosen >= 0]):
            k = i
            while born[k] < epsilon and up[up[k]] >= 0:
                k = up[k]
            merged.add(int(k))
        for i in rising[::-1]:
            above = chosen[up[i]] if up[i] >= 0 else -1
            chosen[i] = above if above >= 0 else i if int(i) in merged else -1
        return pa.table({"cluster": ids, "chosen": pa.array([None if c < 0 else int(ids[c]) for c in chosen], pa.int64())})

    return stable.groupBy(F.lit("all")).applyInArrow(choose, "cluster long, chosen long")


class Hierarchy:
    """All steps on one table: ``points``, ``cores``, ``tree``, ``nodes``, ``clusters`` (with stabilities)."""

    def __init__(self, df: DataFrame, features: Sequence[str], min_cluster_size: int, min_samples: int, block: int = 1024, task_edges: int = TASK_EDGES):
        self.df, self.features = df, list(features)
        tiles = MetricTiles(df, features, None, block)
        self.points = tiles.points
        rows = self.points.agg(F.sum("w"), F.count(F.lit(1))).first()
        self.empty = (rows[0] or 0) <= min_samples
        if self.empty:
            return
        tiles = tiles.at(_first_radius(tiles, min_samples))
        self.cores = core_distances(tiles, min_samples)
        self.tree = spanning_tree(tiles, self.cores, task_edges) if rows[1] > 1 else df.sparkSession.createDataFrame([], "a long, b long, w double")
        self.nodes, clusters = condensed_tree(self.points, self.tree, self.cores, min_cluster_size, task_edges)
        self.clusters = materialize(stabilities(self.nodes, clusters), "stable")

    def labels(self, label: str = "segment_id", epsilon: float = 0.0) -> DataFrame:
        if self.empty:
            return self.df.withColumn(label, F.lit(-1))
        chosen = materialize(select_clusters(self.clusters, epsilon), "chosen")
        of = join_small(self.nodes.select("pid", "w", "cluster"), chosen, "cluster").filter("chosen IS NOT NULL").join(self.points.select("pid", "x"), "pid")
        of = materialize(of.select("x", "w", "chosen"), "members")
        sizes = of.groupBy("chosen").agg(F.sum("w").alias("size"), F.min("x").alias("first"))
        numbers = number_rows(sizes, "seg_", [F.desc("size"), "first"]).select("chosen", F.col("seg_").cast("int").alias("seg_"))
        of = join_small(of, numbers, "chosen").select(F.col("x").alias("x_"), "seg_")
        xs = F.array(*[F.col(f"`{f}`").cast("double") + F.lit(0.0) for f in self.features])
        return self.df.withColumn("x_", xs).join(of, "x_", "left").withColumn(label, F.coalesce("seg_", F.lit(-1))).drop("x_", "seg_")


def hdbscan(df: DataFrame, features: Sequence[str], min_cluster_size: int = K.HDB_PARAMS["min_cluster_size"],
            min_samples: int = K.HDB_PARAMS["min_samples"], epsilon: float = K.HDB_PARAMS["epsilon"], label: str = "segment_id") -> DataFrame:
    """Adds ``label``: selected clusters numbered from 0 by falling size, noise -1.

    Equal rows are one point with a weight.  Rows with a null or non-finite feature are noise, and so is every row of a table
    with at most ``min_samples`` usable rows, or one whose tree never splits (the root is no cluster).
    """
    return Hierarchy(df, features, min_cluster_size, min_samples).labels(label, epsilon)
