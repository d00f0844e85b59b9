"""Exact neighbourhoods within a radius in any number of dimensions, by pivots and the triangle inequality, and DBSCAN on them.

A bounded number of rows are pivots.  A point belongs to the cell of its nearest pivot and, by its distance to it, to a ring
as wide as the radius.  A point ``q`` has to look at a point ``p`` of another cell only if

* the difference of their distances to that cell's pivot is within the radius, so it visits at most four rings of the cell, and
* half the difference of ``q``'s distances to that pivot and to its own is within the radius (``p`` is nearer to its pivot).

Visits are copies of points at such borders.  A ring is cut into blocks of members, and its visitors into blocks as well, so a
task compares two bounded blocks whatever the size of a ring.  Where the pivots cut so little that a point would be copied to more
than ``VISITS`` rings, wide blocks meet instead (``operators/blocks.py``): a point is written once, and no copy of it is shuffled.

Tasks write no pairs: a count per visitor, or one link for two parts that meet in the block.

DBSCAN needs few of these visits.  Points that have enough rows in their own block are core points, the others look around; core
points of a block are joined inside it, then one point of every part looks around, then the points outside the largest part do
(two parts meet at a point that is not in the largest), and so do the points that are no core points.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexcohort.operators.blocks import CHUNK, Layout, discard, meet
from hexcohort.operators.components import connected_components
from hexcohort.operators.numbering import number_rows
from hexcohort.sources.scratch import materialize

#: Pivots grow with the square root of the points, between these bounds; points of a block, and of a block where pivots cut little.
LEAST_PIVOTS, MOST_PIVOTS, BLOCK, WIDE = 16, 512, 1024, 4096
#: Rings that a point may visit on average before wide blocks meet instead; more where all points are one wide block.
VISITS, VISITS_OF_ONE = 4, 8
#: Pairs that a task looks at together; pivots that all of them are tried by, and the most that are tried on those left.
PAIRS, FIRST_PIVOTS, TRIED_PIVOTS = 1 << 22, 4, 32


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All distances by one product of the matrices; small ones, which that rounds most, by differences."""
    centre = y.mean(0) if len(y) else 0.0
    x, y = x - centre, y - centre
    xx, yy = (x * x).sum(1), (y * y).sum(1)
    d = np.maximum(xx[:, None] - 2 * x @ y.T + yy, 0)
    i, j = np.nonzero(d <= 1e-4 * (xx.max(initial=0) + yy.max(initial=0)))
    for at in range(0, len(i), 1 << 16):
        s = slice(at, at + (1 << 16))
        d[i[s], j[s]] = ((x[i[s]] - y[j[s]]) ** 2).sum(1)
    return np.sqrt(d)


def _boxes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest coordinates of every ``CHUNK`` rows."""
    at = np.arange(0, len(x), CHUNK)
    return np.minimum.reduceat(x, at), np.maximum.reduceat(x, at)


def _gap(low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Distance of every row to a box."""
    off = np.maximum(np.maximum(low - x, x - high), 0)
    return np.sqrt(np.einsum("ij,ij->i", off, off))


def _within_chunks(x: np.ndarray, y: np.ndarray, eps: float, others: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, int]:
    """What ``_within`` finds where neighbouring rows lie together: a chunk of ``x`` meets the rows of ``y`` in reach of its box."""
    empty = np.zeros(0, np.int64)
    if not len(x) or not len(y):
        return empty, empty, 0
    (low, high), (y_low, y_high) = _boxes(x), _boxes(y)
    found_i, found_j, compared = [empty], [empty], 0
    reach = eps * (1 + 1e-9) + 1e-9 * (1 + max(np.abs(x).max(), np.abs(y).max()))
    for k in range(len(low)):
        own = slice(k * CHUNK, (k + 1) * CHUNK)
        off = np.maximum(np.maximum(y_low - high[k], low[k] - y_high), 0)
        near = np.flatnonzero((off * off).sum(1) <= reach * reach)
        if not len(near):
            continue
        rows = (near[:, None] * CHUNK + np.arange(CHUNK)).ravel()
        rows = rows[rows < len(y)]
        if others is not None and (others[0][own] == others[0][own.start]).all():
            rows = rows[others[1][rows] != others[0][own.start]]
        rows = rows[_gap(low[k], high[k], y[rows]) <= reach]
        if not len(rows):
            continue
        mine = np.arange(own.start, min(own.stop, len(x)))
        mine = mine[_gap(y[rows].min(0), y[rows].max(0), x[mine]) <= reach]
        if not len(mine):
            continue
        i, j, n = _within(x[mine], y[rows], eps)
        i, j = mine[i], rows[j]
        if others is not None:
            other = others[0][i] != others[1][j]
            i, j = i[other], j[other]
        found_i.append(i)
        found_j.append(j)
        compared += n
    return np.concatenate(found_i), np.concatenate(found_j), compared


def _within(x: np.ndarray, y: np.ndarray, eps: float, pivots: np.ndarray | None = None,
            others: tuple[np.ndarray, np.ndarray] | None = None, chunks: bool = False) -> tuple[np.ndarray, np.ndarray, int]:
    """(i, j) of all pairs with a distance of at most ``eps``, and how many pairs the pivots left to compare.

    A pair counts by its plain difference, so none depends on what else is there: the product of the matrices settles the pairs
    that rounding cannot turn.  With ``others``, a part per row of ``x`` and of ``y``, pairs of one part are left out.  ``chunks``
    says that the rows are in the order of a ``Layout``.
    """
    if chunks:
        return _within_chunks(x, y, eps, others)
    step = max(1, PAIRS // max(1, len(y)))
    dy = None if pivots is None else _distances(y, pivots[:TRIED_PIVOTS])
    found_i, found_j, compared = [], [], 0
    for at in range(0, len(x), step):
        own = None if others is None else (others[0][at:at + step], others[1])
        i, j, n = _some_within(x[at:at + step], y, eps, pivots, dy, own)
        found_i.append(i + at)
        found_j.append(j)
        compared += n
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *found_i]), np.concatenate([empty, *found_j]), compared


def _some_within(x: np.ndarray, y: np.ndarray, eps: float, pivots: np.ndarray | None, dy: np.ndarray | None,
                 others: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, int]:
    open_ = None
    if others is not None:
        open_ = others[0][:, None] != others[1][None, :]
    if pivots is not None:
        dx = _distances(x, pivots[:TRIED_PIVOTS])
        slack = eps * (1 + 1e-9) + 1e-9 * (1 + max(dx.max(initial=0), dy.max(initial=0)))
        for k in range(min(FIRST_PIVOTS, dx.shape[1])):
            left = np.abs(dx[:, k][:, None] - dy[:, k][None, :]) <= slack
            open_ = left if open_ is None else open_ & left
    compared = x.shape[0] * y.shape[0] if open_ is None else int(np.count_nonzero(open_))
    if pivots is not None and compared * 10 < len(x) * len(y):
        i, j = np.nonzero(open_)
        for k in range(FIRST_PIVOTS, dx.shape[1]):
            left = np.abs(dx[i, k] - dy[j, k]) <= slack
            i, j = i[left], j[left]
        compared, near = len(i), np.zeros(len(i), bool)
    else:
        centre = y.mean(0) if len(y) else 0.0
        xc, yc = x - centre, y - centre
        xx, yy = (xc * xc).sum(1)[:, None], (yc * yc).sum(1)[:, None]
        square = np.concatenate([-2 * xc, xx, np.ones_like(xx)], axis=1) @ np.concatenate([yc, np.ones_like(yy), yy], axis=1).T
        doubt = 1e-12 * (x.shape[1] + 8) * (xx.max(initial=0) + yy.max(initial=0) + eps * eps)
        reach = square <= eps * eps + doubt
        at = np.flatnonzero(reach if open_ is None else reach & open_)
        i, j = np.divmod(at, max(1, len(y)))
        near = square.ravel()[at] < eps * eps - doubt
    for at in range(0, len(i), 1 << 16):
        s = at + np.flatnonzero(~near[at:at + (1 << 16)])
        near[s] = np.sqrt(((x[i[s]] - y[j[s]]) ** 2).sum(1)) <= eps
    return i[near], j[near], compared


def _spans(x: np.ndarray, pivots: np.ndarray, top: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows and the cells they visit, with the first and the last ring there; ``top`` has the last ring of every cell."""
    d = _distances(x, pivots)
    slack = 1e-9 * (1 + d.max())
    q, c = np.nonzero((d - d.min(1)[:, None]) / 2 <= width + slack)
    low = np.floor(np.maximum(d[q, c] - width - slack, 0) / width).astype(np.int64)
    high = np.minimum(np.floor((d[q, c] + width + slack) / width).astype(np.int64), top[c])
    some = low <= high
    return q[some], c[some], low[some], high[some]


class MetricTiles:
    """The points of a table in tiles: a block of a ring and a block of its visitors."""

    dense = False       # whether wide blocks meet instead of rings and their visitors

    def __init__(self, df: DataFrame, features: Sequence[str], eps: float | None, block: int = BLOCK, wide: int = WIDE):
        """Rows with a null or non-finite coordinate take no part; equal rows are one point with a weight.  Without a radius the
        tiles are made by ``at``.
        """
        self.features, self.block, self.wide = list(features), block, wide
        xs = F.array(*[F.col(f"`{f}`").cast("double") + F.lit(0.0) for f in features])
        finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        folded = df.select(xs.alias("x")).filter(finite).groupBy("x").agg(F.count(F.lit(1)).alias("w"))
        self.points = materialize(folded.withColumn("pid", F.monotonically_increasing_id()), "points")
        self.n = self.points.count()
        wanted = int(min(MOST_PIVOTS, max(LEAST_PIVOTS, self.n ** 0.5 / 2)))
        self.pivots = np.array([r[0] for r in self.points.orderBy(F.xxhash64("x"), "pid").limit(wanted).select("x").collect()])     # bounded
        self.layout, self.cells = Layout(self.points, self.n, wide), None
        if eps is not None:
            self._place(float(eps))
            self._look(None)

    def at(self, eps: float, visitors: DataFrame | None = None) -> MetricTiles:
        """The same points and pivots for another radius; only the points of ``visitors(pid)`` look for neighbours."""
        other = copy.copy(self)
        other._place(float(eps))
        other._look(visitors)
        return other

    def seen_by(self, visitors: DataFrame) -> MetricTiles:
        """The same tiles for the points of ``visitors(pid)`` alone."""
        other = copy.copy(self)
        other._look(visitors)
        return other

    def _place(self, eps: float) -> None:
        self.eps = eps
        pivots, block = self.pivots, self.block

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    d = _distances(b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1), pivots)
                    cell = d.argmin(1)
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(d[np.arange(len(d)), cell])], names=["pid", "x", "w", "cell", "off"])

        if self.cells is None:      # the same for every radius
            spec = "pid long, x array<double>, w long, cell long, off double"
            self.cells = materialize(self.points.select("pid", "x", "w").mapInArrow(place, spec), "placed")
        self.placed = self.cells.select("pid", "x", "w", "cell", F.floor(F.col("off") / F.lit(eps)).cast("long").alias("ring"))
        self.rings = materialize(self.placed.groupBy("cell", "ring").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("mb")), "rings")
        self.top = np.full(len(pivots), -1)
        for cell, ring in self.rings.groupBy("cell").agg(F.max("ring")).collect():      # one row per pivot
            self.top[cell] = ring

    def _look(self, visitors: DataFrame | None) -> None:
        looking = self.placed if visitors is None else self.placed.join(visitors.select("pid"), "pid", "left_semi")
        looking = looking.select("pid", "x")
        pivots, top, width = self.pivots, self.top, self.eps

        def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = visits = 0
            for b in batches:
                if b.num_rows:
                    _, _, low, high = _spans(b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1), pivots, top, width)
                    rows, visits = rows + b.num_rows, visits + int((high - low + 1).sum())
            yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([visits])], names=["rows", "visits"])

        rows, visits = looking.mapInArrow(number, "rows long, visits long").agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("visits"), F.lit(0))).first()
        self.dense = visits > rows * (VISITS if self.n > self.wide else VISITS_OF_ONE)
        if self.dense:
            self.looking, self.visitors = None if visitors is None else looking.select("pid"), rows
            return

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    q, c, low, high = _spans(b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1), pivots, top, width)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(q)), pa.array(c), pa.array(low), pa.array(high)], names=["pid", "cell", "low", "high"])

        visits = looking.mapInArrow(visit, "pid long, cell long, low long, high long")
        visits = visits.select("pid", "cell", F.explode(F.sequence("low", "high")).alias("ring")).join(self.rings, ["cell", "ring"])     # rings that have members
        visits = materialize(visits, "visits")
        blocks = visits.groupBy("cell", "ring").agg(F.first("mb").alias("mb"), F.ceil(F.count(F.lit(1)) / self.block).cast("int").alias("vb"))
        self.blocks = materialize(blocks, "rings")
        self.visits = visits.drop("mb")

    def run(self, fn, out: str, extra: DataFrame | None = None, part: str | None = None) -> DataFrame:
        """``fn(members, visitors)`` per tile; both are dicts of numpy arrays.

        ``extra(pid, ...)`` adds columns and names the points that take part.  With ``part``, one of these columns, a visit to a
        ring that holds nothing but the visitor's own part is left out.
        """
        columns = ["pid", "x", "w"]
        points = self.placed.select("pid", "x", "w", "cell", "ring")
        if extra is not None:
            points, columns = points.join(extra, "pid"), [*columns, *[c for c in extra.columns if c != "pid"]]
        if self.dense:
            return self._blocks(fn, out, points.select(*columns), columns)
        rings, other = self.blocks, F.lit(True)
        if part is not None:
            rings = rings.join(points.groupBy("cell", "ring").agg(F.min(part).alias("low_"), F.max(part).alias("high_")), ["cell", "ring"])
            other = (F.col("low_") != F.col("high_")) | (F.col("low_") != F.col(part))
        of = F.pmod(F.xxhash64("pid"), F.col("mb")).cast("int")
        member = (points.join(self.blocks, ["cell", "ring"]).withColumn("m", of).withColumn("v", F.explode(F.sequence(F.lit(0), F.col("vb") - 1)))
                  .select(*columns, "cell", "ring", "m", "v"))
        seen = F.pmod(F.xxhash64("pid"), F.col("vb")).cast("int")
        visitor = (self.visits.join(points.drop("cell", "ring").hint("merge"), "pid").join(rings, ["cell", "ring"]).filter(other).withColumn("v", seen)
                   .withColumn("m", F.explode(F.sequence(F.lit(0), F.col("mb") - 1)))
                   .select(*columns, "cell", "ring", "m", "v"))
        return self._tiles(fn, out, member, visitor, columns)

    def own_blocks(self, fn, out: str, extra: DataFrame | None = None) -> DataFrame:
        """``fn(members, members)`` per block of a ring: what points find without any copy."""
        columns = ["pid", "x", "w"]
        points = self.placed
        if extra is not None:
            points, columns = points.join(extra, "pid"), [*columns, *[c for c in extra.columns if c != "pid"]]
        of = F.pmod(F.xxhash64("pid"), F.col("mb")).cast("int")
        member = points.join(self.rings, ["cell", "ring"]).select(*columns, "cell", "ring", of.alias("m"), F.lit(0).alias("v"))
        return self._tiles(fn, out, member, None, columns)

    def _blocks(self, fn, out: str, points: DataFrame, columns: list[str]) -> DataFrame:
        """``fn(members, visitors)`` per two wide blocks of ``points`` that are in reach of each other."""
        side, empty, reach = self._side(columns), self._empty(out), self.eps
        members = self.layout.packed(points, columns, self.n)
        visitors = members if self.looking is None else self.layout.packed(points.join(self.looking.hint("merge"), "pid", "left_semi"), columns, self.visitors)

        def tile(m: pa.Table, v: pa.Table) -> pa.Table:
            return fn(side(m), side(v)) if m.num_rows and v.num_rows else empty

        found = meet(members, visitors, reach, tile, out)
        discard(members)
        if visitors is not members:
            discard(visitors)
        return found

    def _side(self, columns: list[str]):
        width = len(self.features)

        def side(t: pa.Table) -> dict:
            arrays = {c: t.column(c).to_numpy() for c in columns if c != "x"}
            arrays["x"] = t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            return arrays

        return side

    @staticmethod
    def _empty(out: str) -> pa.Table:
        return pa.table({n: pa.array([], {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[t]) for n, t in (c.split(" ") for c in out.split(", "))})

    def _tiles(self, fn, out: str, member: DataFrame, visitor: DataFrame | None, columns: list[str]) -> DataFrame:
        side, empty, alone = self._side(columns), self._empty(out), visitor is None

        def tile(group: pa.Table) -> pa.Table:
            if alone:
                own = side(group)
                return fn(own, own)
            flag = group.column("is_member").to_numpy()
            members, visitors = side(group.filter(pa.array(flag))), side(group.filter(pa.array(~flag)))
            return fn(members, visitors) if len(members["pid"]) and len(visitors["pid"]) else empty

        both = member.withColumn("is_member", F.lit(True))
        if visitor is not None:
            both = both.unionByName(visitor.withColumn("is_member", F.lit(False)))
        return both.groupBy("cell", "ring", "m", "v").applyInArrow(tile, out)

    @property
    def tried(self) -> np.ndarray | None:
        """Pivots that are worth trying on the pairs of a tile."""
        return None if self.dense else self.pivots

    def _counted(self, own: bool = False):
        eps, pivots, chunks = self.eps, self.tried, self.dense and not own

        def run(members: dict, visitors: dict) -> pa.Table:
            i, j, compared = _within(visitors["x"], members["x"], eps, pivots, chunks=chunks)
            near = np.bincount(i, members["w"][j], minlength=len(visitors["pid"])).astype(np.int64)
            share = np.zeros(len(near), np.int64)
            share[0] = compared
            return pa.table({"pid": pa.array(visitors["pid"]), "near": pa.array(near), "compared": pa.array(share)})

        return run, "pid long, near long, compared long"

    def counts(self) -> DataFrame:
        """``(pid, near, compared)``: rows within the radius of each visitor, itself included, and pairs that were compared."""
        found = self.run(*self._counted())
        return found.groupBy("pid").agg(F.sum("near").alias("near"), F.sum("compared").alias("compared"))

    def cores(self, min_samples: int) -> DataFrame:
        """``(pid, core)``: whether a point has ``min_samples`` rows within the radius, itself included.

        Most have them in their own block; only the others look around.
        """
        first = materialize(self.own_blocks(*self._counted(own=True)).select("pid", (F.col("near") >= min_samples).alias("core")), "cores")
        rest = self.seen_by(first.filter("NOT core")).counts().select("pid", (F.col("near") >= min_samples).alias("core"))
        return materialize(first.filter("core").unionByName(rest), "cores")

    def parts(self, cores: DataFrame) -> DataFrame:
        """``(node, comp)`` of the core points of ``cores(pid, core)``: what steps of at most the radius join."""
        eps = self.eps
        alone = cores.filter("core").select("pid")

        def join(members: dict, _: dict) -> pa.Table:
            pid, x = members["pid"], members["x"]
            part, left = np.full(len(pid), -1), np.argsort(pid, kind="stable")
            while len(left):
                least, new = pid[left[0]], left[:1]
                part[new], left = least, left[1:]
                while len(new) and len(left):
                    _, j, _ = _within(x[new], x[left], eps)
                    hit = np.zeros(len(left), bool)
                    hit[j] = True
                    new, left = left[hit], left[~hit]
                    part[new] = least
            return pa.table({"pid": pa.array(pid), "comp": pa.array(part)})

        comp = materialize(self.own_blocks(join, "pid long, comp long", alone), "parts")
        one = comp.groupBy("comp").agg(F.min("pid").alias("pid"))
        comp = self._joined(comp, one)
        sizes = comp.groupBy("comp").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "comp").limit(2).collect()
        if len(sizes) > 1:
            comp = self._joined(comp, comp.filter(F.col("comp") != sizes[0]["comp"]))
        return comp.select(F.col("pid").alias("node"), "comp")

    def _joined(self, comp: DataFrame, visitors: DataFrame) -> DataFrame:
        """Parts ``(pid, comp)`` after the points of ``visitors(pid)`` have looked for other parts."""
        tiles = self.seen_by(visitors)
        eps, pivots, chunks = self.eps, tiles.tried, tiles.dense

        def link(members: dict, visitors: dict) -> pa.Table:
            i, j, _ = _within(visitors["x"], members["x"], eps, pivots, (visitors["comp"], members["comp"]), chunks)
            a, b = visitors["comp"][i], members["comp"][j]
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
            return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

        links = materialize(tiles.run(link, "a long, b long", comp, "comp").distinct(), "links")
        top = connected_components(comp.select(F.col("comp").alias("node")).distinct(), links)
        return materialize(comp.join(top.select(F.col("node").alias("comp"), F.col("comp").alias("top_")), "comp").select("pid", F.col("top_").alias("comp")), "parts")

    def border(self, cores: DataFrame, of_core: DataFrame) -> DataFrame:
        """``(node, seg)``: the smallest ``seg`` of ``of_core(node, seg)`` in reach of the points that are no core points."""
        tiles = self.seen_by(cores.filter("NOT core"))
        eps, pivots, chunks = self.eps, tiles.tried, tiles.dense
        seg = cores.select("pid", "core").join(of_core.select(F.col("node").alias("pid"), F.col("seg").cast("long").alias("seg")), "pid", "left")

        def least(members: dict, visitors: dict) -> pa.Table:
            core = members["core"].astype(bool)
            i, j, _ = _within(visitors["x"], members["x"][core], eps, pivots, chunks=chunks)
            best = np.full(len(visitors["pid"]), np.iinfo(np.int64).max)
            np.minimum.at(best, i, members["seg"][core][j].astype(np.int64))
            some = np.unique(i)
            return pa.table({"node": pa.array(visitors["pid"][some]), "seg": pa.array(best[some])})

        found = tiles.run(least, "node long, seg long", seg.withColumn("seg", F.coalesce("seg", F.lit(-1).cast("long"))))
        return found.groupBy("node").agg(F.min("seg").cast("int").alias("seg"))


def core_flags(df: DataFrame, features: Sequence[str], eps: float, min_samples: int, block: int = BLOCK, wide: int = WIDE) -> tuple[MetricTiles, DataFrame]:
    """The tiles of a table and ``(pid, core)`` of their points; the labels and the model of one DBSCAN run share them."""
    tiles = MetricTiles(df, features, None, block, wide)
    tiles._place(float(eps))
    return tiles, tiles.cores(min_samples)


def dbscan_metric(df: DataFrame, features: Sequence[str], eps: float, min_samples: int, label: str = "segment_id", block: int = BLOCK, wide: int = WIDE,
                  known: tuple[MetricTiles, DataFrame] | None = None) -> DataFrame:
    """DBSCAN in many dimensions: adds ``label``, clusters numbered from 0 by falling size of their core, noise -1.

    A point counts itself.  A border point in reach of several clusters joins the one with the smallest number.  Rows with a
    null or non-finite feature are noise.  ``known`` is what ``core_flags`` found for the same table and numbers.
    """
    tiles, cores = known or core_flags(df, features, eps, min_samples, block, wide)
    comp = tiles.parts(cores)
    weights = tiles.points.select(F.col("pid").alias("node"), "w")
    sizes = comp.join(weights, "node").groupBy("comp").agg(F.sum("w").alias("size"), F.min("node").alias("first"))
    ids = number_rows(sizes, "seg", [F.desc("size"), "first"]).select("comp", F.col("seg").cast("int").alias("seg"))
    of_core = materialize(comp.join(ids, "comp").select("node", "seg"), "segments")
    loose = tiles.border(cores, of_core)
    of_point = tiles.points.withColumnRenamed("pid", "node").join(of_core.unionByName(loose), "node").select("x", "seg")
    of_point = materialize(of_point, "labels")
    xs = F.array(*[F.col(f"`{f}`").cast("double") + F.lit(0.0) for f in features])
    joined = df.withColumn("x_", xs).join(of_point.select(F.col("x").alias("x_"), F.col("seg").alias("seg_")), "x_", "left")
    return joined.withColumn(label, F.coalesce("seg_", F.lit(-1)).cast("int")).drop("x_", "seg_")
