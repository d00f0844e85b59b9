"""Exact density clustering (DBSCAN) and its flat hierarchical variant.

Rows with the same coordinates are folded to one weighted point.  Points fall
into cells so small that any two points of a cell are neighbours; a cell with
``min_samples`` rows is *dense*: all its points are core and connected, and no
pair inside it is ever looked at.  What is left are pairs of nearby cells.  They
are settled by bounding boxes (all of it in reach / none of it in reach), and
only pairs that stay open are split into smaller boxes, down to single points.
The work therefore follows the outline of dense areas, not the square of their
size.  Components are found on dense cells and the remaining core points.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.operators.components import connected_components
from hexcohort.operators.numbering import number_rows
from hexcohort.sources.scratch import materialize, small_table

LEAF = 32          # a box with at most this many distinct points is split into points
FAN = 4            # pieces per dimension when a box is split
GROUP = 3          # dimensions split at a time
WIDE = 4           # dimensions up to which expressions are written out
HOT = 1_000_000    # copies of one point from which on it is joined by broadcast


def _axes(d: int) -> list[list[int]]:
    return [list(range(i, min(i + GROUP, d))) for i in range(0, d, GROUP)]


class _Grid:
    """Cell geometry for ``d`` dimensions and radius ``eps``."""

    def __init__(self, d: int, eps: float):
        self.d, self.eps = d, eps
        self.side = eps / math.sqrt(d) * (1 - 1e-9)   # cell diagonal stays within eps
        self.reach = math.ceil(math.sqrt(d)) + 1      # cells per coarse block, so that neighbours differ by <= 1 block
        self.groups = _axes(d)

    def x(self, j: int) -> Column:
        return F.col("x")[j]

    def index(self, j: int) -> Column:
        return F.floor(self.x(j) / F.lit(self.side))

    def cell(self) -> Column:
        return F.concat_ws(",", *[self.index(j).cast("string") for j in range(self.d)])

    def piece(self, level: int) -> Column:
        """Name of the piece of a cell at a split level, relative to the level before."""
        axes = self.groups[level % len(self.groups)]
        fine = FAN ** (1 + level // len(self.groups))
        inside = [F.floor((self.x(j) / F.lit(self.side) - self.index(j)) * F.lit(float(fine))) for j in axes]
        return F.concat_ws(",", *[i.cast("string") for i in inside])

    def path(self, level: int) -> Column:
        """Box name after ``level`` splits."""
        return F.concat_ws("/", F.col("cell"), *[self.piece(k) for k in range(level)])

    def _squares(self, term) -> Column:
        """Sum of squares over the dimensions; many of them as a loop, so that the code stays small."""
        if self.d <= WIDE:
            parts = [term(F.lit(j)) * term(F.lit(j)) for j in range(self.d)]
            return sum(parts[1:], parts[0])
        return F.aggregate(F.sequence(F.lit(0), F.lit(self.d - 1)), F.lit(0.0), lambda acc, j: acc + term(j) * term(j))

    def gap2(self, a: str, b: str) -> Column:
        """Squared smallest distance between two boxes."""
        return self._squares(lambda j: F.greatest(F.lit(0.0), F.get(f"{b}lo", j) - F.get(f"{a}hi", j),
                                                  F.get(f"{a}lo", j) - F.get(f"{b}hi", j)))

    def span2(self, a: str, b: str) -> Column:
        """Squared largest distance between two boxes."""
        return self._squares(lambda j: F.greatest(F.abs(F.get(f"{b}hi", j) - F.get(f"{a}lo", j)),
                                                  F.abs(F.get(f"{a}hi", j) - F.get(f"{b}lo", j))))

    def bounds(self, lo: str = "x", hi: str = "x") -> list[Column]:
        """Bounding box of the rows of a group as ``lo`` and ``hi`` arrays."""
        if self.d <= WIDE:
            mins = F.array(*[F.min(F.col(lo)[j]) for j in range(self.d)])
            maxs = F.array(*[F.max(F.col(hi)[j]) for j in range(self.d)])
        else:
            mins = vector_to_array(Summarizer.min(array_to_vector(lo)))
            maxs = vector_to_array(Summarizer.max(array_to_vector(hi)))
        return [mins.alias("lo"), maxs.alias("hi")]


def _points(df: DataFrame, features: Sequence[str], grid: _Grid) -> DataFrame:
    """Distinct points with their weight and cell."""
    xs = [F.col(f).cast("double") + F.lit(0.0) for f in features]
    complete = df.filter(F.lit(True) if not features else
                         sum((F.col(f).isNull().cast("int") for f in features), F.lit(0)) == 0)
    pts = complete.groupBy(F.array(*xs).alias("x")).agg(F.count(F.lit(1)).alias("w"))
    return materialize(pts.withColumn("cell", grid.cell())
                       .withColumn("pid", F.concat(F.lit("p:"), F.col("x").cast("string"))), "points")


def _nearby_cells(cells: DataFrame, grid: _Grid) -> DataFrame:
    """Ordered pairs of different cells whose boxes come within reach.

    Found top-down over blocks of cells, a few dimensions at a time, so that no
    more than the truly adjacent blocks are ever paired.
    """
    eps2 = F.lit(grid.eps * grid.eps)
    block = [F.floor(F.col("idx")[j] / F.lit(float(grid.reach))) for j in range(grid.d)]
    fine = [F.col("idx")[j] for j in range(grid.d)]
    splits = [[block[j] for j in axes] for axes in grid.groups] + [[fine[j] for j in axes] for axes in grid.groups]
    keyed = cells.withColumn("k0", F.lit(""))
    for i, cols in enumerate(splits):
        keyed = keyed.withColumn(f"k{i + 1}", F.concat_ws(";", F.col(f"k{i}"), *[c.cast("string") for c in cols]))
    keyed = materialize(keyed, "cells")

    def boxes(i: int) -> DataFrame:
        first = [F.first(c).alias(f"b{n}") for n, c in enumerate(splits[0])] if i == 1 else []
        return keyed.groupBy(f"k{i - 1}", f"k{i}").agg(*grid.bounds("lo", "hi"), *first)

    def side(i: int, tag: str, parent: bool) -> DataFrame:
        cols = [F.col(f"k{i}").alias(f"{tag}k"), F.col("lo").alias(f"{tag}lo"), F.col("hi").alias(f"{tag}hi")]
        return boxes(i).select(*([F.col(f"k{i - 1}").alias(f"{tag}p")] if parent else []), *cols)

    top = boxes(1)
    m = len(splits[0])
    steps = F.array(*[F.array(*[F.lit(o) for o in off]) for off in itertools.product((-1, 0, 1), repeat=m)])
    left = (top.withColumn("o", F.explode(steps))
            .select(F.col("k1").alias("ak"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"),
                    *[(F.col(f"b{n}") + F.col("o")[n]).alias(f"b{n}") for n in range(m)]))
    right = top.select(F.col("k1").alias("bk"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"),
                       *[f"b{n}" for n in range(m)])
    pairs = left.join(right, [f"b{n}" for n in range(m)]).filter(grid.gap2("a", "b") <= eps2).select("ak", "bk")
    for i in range(2, len(splits) + 1):
        pairs = materialize(pairs, "pairs")
        pairs = (pairs.join(side(i, "a", True).withColumnRenamed("ak", "an"), F.col("ak") == F.col("ap"))
                 .join(side(i, "b", True).withColumnRenamed("bk", "bn"), F.col("bk") == F.col("bp"))
                 .filter(grid.gap2("a", "b") <= eps2).select(F.col("an").alias("ak"), F.col("bn").alias("bk")))
    last = f"k{len(splits)}"
    names = keyed.select(last, "cell")
    return (pairs.filter(F.col("ak") != F.col("bk"))
            .join(names.select(F.col(last).alias("ak"), F.col("cell").alias("a")), "ak")
            .join(names.select(F.col(last).alias("bk"), F.col("cell").alias("b")), "bk").select("a", "b"))


def _children(pts: DataFrame, need: DataFrame, level: int, grid: _Grid, leaf: int) -> DataFrame:
    """Pieces of the boxes in ``need(box, n)``: single points for small boxes, sub-boxes otherwise."""
    inside = pts.withColumn("box", grid.path(level)).join(need, "box")
    as_points = (inside.filter(F.col("n") <= leaf)
                 .select("box", F.col("pid").alias("child"), F.col("x").alias("lo"), F.col("x").alias("hi"), "w",
                         F.lit(1).cast("bigint").alias("cn"), F.lit(True).alias("pt")))
    as_boxes = (inside.filter(F.col("n") > leaf).groupBy("box", grid.path(level + 1).alias("child"))
                .agg(*grid.bounds(), F.sum("w").alias("w"), F.count(F.lit(1)).alias("cn"))
                .withColumn("pt", F.lit(False)))
    return materialize(as_points.unionByName(as_boxes), "boxes")


def _settle(open_: DataFrame, pts: DataFrame, grid: _Grid, leaf: int) -> list[DataFrame]:
    """Settle (query box, target box) pairs; returns the pairs found in reach.

    ``open_`` columns: owner, qcell_dense, q, qpt, qlo, qhi, qn, tcell, tdense,
    t, tpt, tlo, thi, tn, tw.  A pair counts as found when all of it is in
    reach; for a sparse target cell only single points count.
    """
    found = []
    eps2 = F.lit(grid.eps * grid.eps)
    level = 0
    while True:
        span, gap = grid.span2("q", "t"), grid.gap2("q", "t")
        whole = (span <= eps2) & (F.col("tpt") | F.col("tdense"))
        state = materialize(open_.filter(gap <= eps2).withColumn("yes", whole), "open")
        hits = state.filter("yes").select("owner", "odense", "tcell", "tdense", "t", "tw")
        found.append(hits)
        still = state.filter(~F.col("yes")).drop("yes")
        # a dense owner only asks whether anything of the target is in reach
        done = hits.filter("odense").select("owner", "tcell").distinct()
        still = materialize(still.join(done, ["owner", "tcell"], "left_anti"), "open")
        if still.isEmpty():
            return found
        need = (still.filter(~F.col("qpt")).select(F.col("q").alias("box"), F.col("qn").alias("n"))
                .unionByName(still.filter(~F.col("tpt")).select(F.col("t").alias("box"), F.col("tn").alias("n")))
                .distinct())
        kids = _children(pts, need, level, grid, leaf)
        q = kids.select(F.col("box").alias("q"), F.col("child").alias("q2"), F.col("lo").alias("ql2"),
                        F.col("hi").alias("qh2"), F.col("cn").alias("qn2"), F.col("pt").alias("qp2"))
        t = kids.select(F.col("box").alias("t"), F.col("child").alias("t2"), F.col("lo").alias("tl2"),
                        F.col("hi").alias("th2"), F.col("cn").alias("tn2"), F.col("w").alias("tw2"),
                        F.col("pt").alias("tp2"))
        # single points have no pieces and stay as they are
        both = still.join(q, "q", "left").join(t, "t", "left")
        open_ = both.select(
            "owner", "odense", "tcell", "tdense",
            F.coalesce("q2", "q").alias("q"), F.coalesce("ql2", "qlo").alias("qlo"), F.coalesce("qh2", "qhi").alias("qhi"),
            F.coalesce("qn2", "qn").alias("qn"), F.coalesce("qp2", "qpt").alias("qpt"),
            F.coalesce("t2", "t").alias("t"), F.coalesce("tl2", "tlo").alias("tlo"), F.coalesce("th2", "thi").alias("thi"),
            F.coalesce("tn2", "tn").alias("tn"), F.coalesce("tw2", "tw").alias("tw"), F.coalesce("tp2", "tpt").alias("tpt"))
        level += 1


def _neighbourhood(df: DataFrame, features: Sequence[str], eps: float, min_samples: int, leaf: int):
    grid = _Grid(len(features), float(eps))
    pts = _points(df, features, grid)
    idx = F.array(*[grid.index(j) for j in range(grid.d)])
    cells = materialize(
        pts.groupBy("cell").agg(*grid.bounds(), F.first(idx).alias("idx"), F.sum("w").alias("w"),
                                F.count(F.lit(1)).alias("n"))
        .withColumn("dense", F.col("w") >= min_samples), "cells")
    near = materialize(_nearby_cells(cells.select("cell", "idx", "lo", "hi"), grid), "near")
    info = cells.select("cell", "lo", "hi", "w", "n", "dense")
    target = info.select(F.col("cell").alias("b"), F.col("lo").alias("tlo"), F.col("hi").alias("thi"),
                         F.col("w").alias("tw"), F.col("n").alias("tn"), F.col("dense").alias("tdense"))
    owner = info.select(F.col("cell").alias("a"), F.col("lo").alias("qlo"), F.col("hi").alias("qhi"),
                        F.col("n").alias("qn"), F.col("dense").alias("odense"))
    pairs = near.join(owner, "a").join(target, "b")
    tcols = [F.col("b").alias("tcell"), "tdense", F.col("b").alias("t"), "tlo", "thi", "tn", "tw",
             F.lit(False).alias("tpt")]
    dense_pairs = (pairs.filter(F.col("odense") & F.col("tdense") & (F.col("a") < F.col("b")))
                   .select(F.col("a").alias("owner"), "odense", F.col("a").alias("q"), "qlo", "qhi", "qn",
                           F.lit(False).alias("qpt"), *tcols))
    sparse_pts = pts.join(info.filter(~F.col("dense")).select("cell"), "cell")
    point_pairs = (sparse_pts.select(F.col("cell").alias("a"), "pid", "x")
                   .join(pairs.filter(~F.col("odense")).drop("qlo", "qhi", "qn"), "a")
                   .select(F.col("pid").alias("owner"), F.lit(False).alias("odense"), F.col("pid").alias("q"),
                           F.col("x").alias("qlo"), F.col("x").alias("qhi"), F.lit(1).cast("bigint").alias("qn"),
                           F.lit(True).alias("qpt"), *tcols))
    found = _settle(dense_pairs.unionByName(point_pairs), pts, grid, leaf)
    hits = found[0]
    for f in found[1:]:
        hits = hits.unionByName(f)
    return pts, cells, sparse_pts, hits


def _core_graph(pts, cells, sparse_pts, hits, min_samples: int):
    """Core flags, graph nodes and links."""
    outside = hits.filter(~F.col("odense")).groupBy(F.col("owner").alias("pid")).agg(F.sum("tw").alias("out"))
    own = cells.select("cell", F.col("w").alias("cell_w"))
    sparse = materialize(
        sparse_pts.join(own, "cell").join(outside, "pid", "left")
        .withColumn("core", F.col("cell_w") + F.coalesce("out", F.lit(0)) >= min_samples)
        .select("pid", "cell", "x", "w", "core"), "sparse")
    core = sparse.filter("core").select("pid", "cell", "w")
    dense_name = F.concat(F.lit("c:"), F.col("cell"))
    nodes = (cells.filter("dense").select(dense_name.alias("node"), F.col("w").alias("w"))
             .unionByName(core.select(F.col("pid").alias("node"), "w")))
    to_dense = F.concat(F.lit("c:"), F.col("tcell"))
    dd = hits.filter("odense").select(F.concat(F.lit("c:"), F.col("owner")).alias("a"), to_dense.alias("b"))
    mine = core.select(F.col("pid").alias("owner"))
    pd_ = hits.filter(~F.col("odense") & F.col("tdense")).join(mine, "owner").select(F.col("owner").alias("a"),
                                                                                      to_dense.alias("b"))
    other = core.select(F.col("pid").alias("t"))
    pp = (hits.filter(~F.col("odense") & ~F.col("tdense")).join(mine, "owner").join(other, "t")
          .select(F.col("owner").alias("a"), F.col("t").alias("b")))
    lead = core.groupBy("cell").agg(F.min("pid").alias("a"))
    same = core.join(lead, "cell").select("a", F.col("pid").alias("b"))
    links = dd.unionByName(pd_).unionByName(pp).unionByName(same).distinct()
    return sparse, nodes, links


def _labels(df: DataFrame, features: Sequence[str], pts: DataFrame, per_point: DataFrame, label: str) -> DataFrame:
    """Labels back on the rows; rows with a missing coordinate are noise and need no join.

    Points with very many copies are few, so they are broadcast; the rest meet
    in a shuffle that no single point can dominate.
    """
    known = sum((F.col(f).isNull().cast("int") for f in features), F.lit(0)) == 0
    xs = F.array(*[F.col(f).cast("double") + F.lit(0.0) for f in features])
    rows = df.filter(known).withColumn("x_", xs)
    found = per_point.select(F.col("x").alias("x_"), "seg_")
    hot = pts.filter(F.col("w") >= HOT).select(F.col("x").alias("x_"))
    hot_rows, fits = small_table(hot, 1_000_000)          # at most rows / HOT of them
    if hot_rows and fits:
        keys = df.sparkSession.createDataFrame(hot_rows, hot.schema)
        hot_found = F.broadcast(keys.join(found, "x_", "left"))
        joined = rows.join(hot_found, "x_", "inner").unionByName(
            rows.join(F.broadcast(keys), "x_", "left_anti").join(found, "x_", "left"))
    else:
        joined = rows.join(found, "x_", "left")
    joined = joined.withColumn(label, F.coalesce("seg_", F.lit(-1)).cast("int")).drop("x_", "seg_")
    return joined.unionByName(df.filter(~known).withColumn(label, F.lit(-1)))


def _cluster(df: DataFrame, features: Sequence[str], eps: float, min_samples: int, min_size: int, border: bool,
             label: str, leaf: int) -> DataFrame:
    pts, cells, sparse_pts, hits = _neighbourhood(df, features, eps, min_samples, leaf)
    sparse, nodes, links = _core_graph(pts, cells, sparse_pts, hits, min_samples)
    comp = connected_components(nodes.select("node"), links)
    sizes = comp.join(nodes, "node").groupBy("comp").agg(F.sum("w").alias("size")).filter(F.col("size") >= min_size)
    ids = number_rows(sizes, "seg_", [F.desc("size"), "comp"]).select("comp", F.col("seg_").cast("int").alias("seg_"))
    node_seg = materialize(comp.join(ids, "comp").select("node", "seg_"), "segments")
    in_dense = (pts.join(cells.filter("dense").select("cell"), "cell", "left_semi")
                .withColumn("node", F.concat(F.lit("c:"), F.col("cell"))).join(node_seg, "node").select("x", "seg_"))
    in_sparse = sparse.filter("core").join(node_seg.withColumnRenamed("node", "pid"), "pid").select("x", "seg_")
    per_point = in_dense.unionByName(in_sparse)
    if border:
        loose = sparse.filter(~F.col("core")).select("pid", "cell", "x")
        reach = (hits.filter(~F.col("odense"))
                 .select(F.col("owner").alias("pid"),
                         F.when(F.col("tdense"), F.concat(F.lit("c:"), F.col("tcell"))).otherwise(F.col("t")).alias("node")))
        mates = sparse.filter("core").select("cell", F.col("pid").alias("node"))
        options = (loose.join(reach, "pid").select("pid", "x", "node")
                   .unionByName(loose.join(mates, "cell").select("pid", "x", "node")))
        edge = options.join(node_seg, "node").groupBy("pid", "x").agg(F.min("seg_").alias("seg_"))
        per_point = per_point.unionByName(edge.select("x", "seg_"))
    return _labels(df, features, pts, per_point, label)


def dbscan(df: DataFrame, features: Sequence[str], eps: float = K.DBSCAN_PARAMS["eps"],
           min_samples: int = K.DBSCAN_PARAMS["min_samples"], label: str = "segment_id", leaf: int = LEAF) -> DataFrame:
    """Adds ``label``: clusters numbered from 0 by falling size of their core, noise -1.

    A point counts itself.  A border point in reach of several clusters joins
    the one with the smallest number.
    """
    return _cluster(df, features, eps, min_samples, 1, True, label, leaf)


def hdb_flat(df: DataFrame, features: Sequence[str], min_cluster_size: int = K.HDB_PARAMS["min_cluster_size"],
             min_samples: int = K.HDB_PARAMS["min_samples"], epsilon: float = K.HDB_PARAMS["epsilon"],
             label: str = "segment_id", leaf: int = LEAF) -> DataFrame:
    """Mutual-reachability clusters cut at ``epsilon``: core points only, small clusters become noise."""
    return _cluster(df, features, epsilon, min_samples, min_cluster_size, False, label, leaf)


def project_km(df: DataFrame, lat: str = "home_lat", lon: str = "home_lon", ref_lat: float | None = None) -> DataFrame:
    """Adds planar ``x_km``/``y_km``, so that ``eps`` is in kilometres."""
    from hexcohort.functions.hexgrid import EARTH_KM, REF_LAT

    ref = F.lit(math.cos(math.radians(REF_LAT if ref_lat is None else ref_lat)))
    return df.withColumns({"x_km": F.lit(EARTH_KM) * F.radians(lon) * ref, "y_km": F.lit(EARTH_KM) * F.radians(lat)})
