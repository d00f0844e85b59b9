"""Nearest reference of every row, for references too many to inline: many centroids, or the core points of a density model.

The references are a table.  A bounded number of them are pivots; a reference belongs to the cell of its nearest pivot and to a
ring of it by its distance.  Per cell a task knows the span of these distances only.  A row that is a reference itself is settled by
an equality join, unless the farthest one is asked for.  Another row looks into a ring if the triangle
inequality leaves room for something nearer than what is known already: its nearest pivot, then the best of the ring it falls
into, then all rings still open; a radius is one more bound, but a wide one leaves most rings open.  References of a single block
go to the tasks of the rows instead.  Rings are cut into blocks of references, their visitors into blocks as well, so a task compares
two bounded blocks and writes one row per visitor.  No references reach the driver but the pivots, or the single block.

Distances are sums over the coordinates in their order, so a result does not depend on blocks or partitions.  Of references at
the same distance the smallest id is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexcohort.functions.expr import clip, rnd
from hexcohort.operators.metric import MetricTiles, core_flags
from hexcohort.sources.scratch import materialize

#: References and visitors of a block; bounds of the number of pivots, which are one for every half block of references.
BLOCK, LEAST_PIVOTS, MOST_PIVOTS = 1024, 8, 512
_LAST = 1 << 40     # a ring behind all others


def _gaps(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), len(y)))
    for k in range(x.shape[1]):
        out += (x[:, k][:, None] - y[:, k][None, :]) ** 2
    return np.sqrt(out)


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _usable(x: str) -> Column:
    return F.col(x).isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


class NearestIndex:
    """References ``(id, x)`` in cells and rings; ``radius`` bounds the search, references farther away do not count."""

    def __init__(self, references: DataFrame, label: str, vector: str, radius: float | None = None, block: int = BLOCK):
        """References with a null or non-finite coordinate take no part; equal ones are one with the smallest id."""
        if radius is not None and not radius > 0:
            raise ValueError("the radius must be positive")
        self.radius, self.block = radius, block
        rows = references.select(F.col(label).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x")).filter(_usable("x"))
        rows = materialize(rows.withColumn("x", F.transform("x", lambda v: v + F.lit(0.0))).groupBy("x").agg(F.min("id").alias("id")), "references")
        self.references, n = rows, rows.count()
        wanted = int(min(MOST_PIVOTS, max(LEAST_PIVOTS, -(-n * 2 // block))))
        self.pivots = pivots = np.array([r[0] for r in rows.orderBy(F.xxhash64("x"), "x").limit(wanted).select("x").collect()])      # bounded

        self.one = None
        if n <= block:                  # bounded: one block, which goes to every task instead of rows to it
            few = rows.orderBy("id").collect()
            self.one = np.array([r["id"] for r in few], np.int64), np.array([r["x"] for r in few])
            return

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    d = _gaps(_vectors(b.column(1)), pivots)
                    cell = d.argmin(1)
                    yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cell), pa.array(d[np.arange(len(d)), cell])], names=["id", "x", "cell", "off"])

        placed = materialize(rows.select("id", "x").mapInArrow(place, "id long, x array<double>, cell long, off double"), "placed")
        spans = placed.groupBy("cell").agg(F.min("off"), F.max("off"), F.count(F.lit(1))).collect()                                 # one row per pivot
        self.low, self.high, self.width = (np.full(len(pivots), v) for v in (np.inf, -np.inf, 1.0))
        for cell, low, high, n in spans:
            self.low[cell], self.high[cell] = low, high
            self.width[cell] = min(radius or np.inf, max((high - low) / max(1, -(-n // block)), 1e-6 * (1 + high)))
        low = F.element_at(F.array(*[F.lit(float(v)) for v in self.low]), (F.col("cell") + 1).cast("int")) if len(pivots) else F.lit(0.0)
        width = F.element_at(F.array(*[F.lit(float(v)) for v in self.width]), (F.col("cell") + 1).cast("int")) if len(pivots) else F.lit(1.0)
        self.members = materialize(placed.select("id", "x", "cell", F.floor((F.col("off") - low) / width).alias("ring")), "rings")
        self.rings = materialize(self.members.groupBy("cell", "ring").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("mb")), "ring_sizes")

    def search(self, df: DataFrame, vector: str, farthest: bool = False) -> DataFrame:
        """``(key, id, near, far)`` for ``df(key, vector)``; ``far`` is the greatest distance if asked for, else null.

        Rows without a usable vector, and rows with nothing within the radius, are absent.
        """
        if farthest and self.radius is not None:
            raise ValueError("the farthest reference has no radius")
        rows = df.select("key", F.col(vector).cast("array<double>").alias("x")).filter(_usable("x"))
        rows = rows.withColumn("x", F.transform("x", lambda v: v + F.lit(0.0)))
        if not len(self.pivots):
            return rows.select("key", F.lit(0).cast("long").alias("id"), F.lit(0.0).alias("near"), F.lit(0.0).alias("far")).limit(0)
        if self.one is not None:
            found = self._in_place(rows, farthest)
        else:
            same = None
            if not farthest:            # a row that is a reference has nothing nearer
                hit = materialize(rows.join(self.references.select("x", "id"), "x", "left").select("key", "x", "id"), "hits")
                same = hit.filter("id IS NOT NULL").select("key", "id", F.lit(0.0).alias("near"), F.lit(None).cast("double").alias("far"))
                rows = hit.filter("id IS NULL").select("key", "x")
            reach = F.lit(float("inf") if self.radius is None else float(self.radius))
            bound = rows.select("key", "x", reach.alias("bound"))
            first = materialize(self._compare(self._visits(bound, own=True), False), "near")
            bound = rows.join(first.select("key", "near"), "key", "left").select("key", "x", F.least("near", reach).alias("bound"))
            found = self._compare(self._visits(bound, farthest=farthest), farthest).unionByName(first)
            found = found if same is None else found.unionByName(same)
        best = found.groupBy("key").agg(F.min(F.struct("near", "id")).alias("best"), F.max("far").alias("far"))
        best = best.select("key", "best.id", "best.near", "far")
        return best if self.radius is None else best.filter(F.col("near") <= self.radius)

    def _in_place(self, rows: DataFrame, farthest: bool) -> DataFrame:
        """``(key, id, near, far)`` of all rows where all references are one block: every task holds it, no vector is shuffled."""
        ids, x, radius = *self.one, self.radius

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, BLOCK):
                    part = b.slice(at, BLOCK)
                    gaps = _gaps(_vectors(part.column(1)), x)
                    far = pa.array(gaps.max(1)) if farthest else pa.nulls(len(gaps), pa.float64())
                    found = pa.RecordBatch.from_arrays([part.column(0), pa.array(ids[gaps.argmin(1)]), pa.array(gaps.min(1)), far], names=["key", "id", "near", "far"])
                    yield found if radius is None else found.filter(pa.array(gaps.min(1) <= radius))

        return rows.mapInArrow(compare, "key long, id long, near double, far double")

    def _visits(self, rows: DataFrame, own: bool = False, farthest: bool = False) -> DataFrame:
        """``(key, x, cell, ring)`` of the rings that ``rows(key, x, bound)`` have to look into; ``own``: the one they fall into."""
        pivots, low, high, width = self.pivots, self.low, self.high, self.width

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                d = _gaps(_vectors(b.column(1)), pivots)
                nearest = d.min(1)
                slack = 1e-9 * (1 + d.max())
                if own:
                    q = np.arange(len(d))
                    c = d.argmin(1)
                    start = stop = np.clip(d[q, c], low[c], high[c])
                else:
                    bound = np.minimum(b.column(2).to_numpy(), nearest) + slack
                    reach = np.maximum(low - d, d - high) <= bound[:, None]
                    reach &= (d - nearest[:, None]) / 2 <= bound[:, None]
                    start, stop = np.maximum(d - bound[:, None], low), np.minimum(d + bound[:, None], high)
                    if farthest:
                        out = d + high >= d.max(1)[:, None] - slack            # the outer rings from which a farther one may come
                        start = np.where(out, np.where(reach, np.minimum(start, d.max(1)[:, None] - slack - d), d.max(1)[:, None] - slack - d), start)
                        stop, reach = np.where(out, high, stop), reach | out
                        start = np.maximum(start, low)
                    q, c = np.nonzero(reach & (high >= low))
                    start, stop = start[q, c], stop[q, c]
                one = np.maximum(np.floor((start - slack - low[c]) / width[c]), 0).astype(np.int64)
                two = np.minimum(np.floor((np.maximum(stop, start) + slack - low[c]) / width[c]), _LAST).astype(np.int64)
                edge = np.concatenate([[0], np.cumsum(np.bincount(q, minlength=len(d)))]).astype(np.int32)
                spans = pa.ListArray.from_arrays(pa.array(edge), pa.StructArray.from_arrays([pa.array(c), pa.array(one), pa.array(two)], names=["cell", "low", "high"]))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), spans], names=["key", "x", "spans"])

        spec = "key long, x array<double>, spans array<struct<cell:long,low:long,high:long>>"
        placed = rows.select("key", "x", "bound").mapInArrow(place, spec)
        return placed.select("key", "x", F.explode("spans").alias("s")).select("key", "x", F.col("s.cell").alias("cell"), F.explode(F.sequence("s.low", "s.high")).alias("ring"))

    def _compare(self, visits: DataFrame, farthest: bool) -> DataFrame:
        visits = materialize(visits.join(self.rings, ["cell", "ring"]), "visits")
        blocks = materialize(visits.groupBy("cell", "ring").agg(F.first("mb").alias("mb"), F.ceil(F.count(F.lit(1)) / self.block).cast("int").alias("vb")), "blocks")
        split = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")      # noqa: E731
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))           # noqa: E731
        member = self.members.join(blocks, ["cell", "ring"]).withColumn("m", split("x", "mb")).withColumn("v", every("vb"))
        visitor = visits.drop("mb").join(blocks, ["cell", "ring"]).withColumn("v", split("key", "vb")).withColumn("m", every("mb"))
        columns = ["x", "cell", "ring", "m", "v"]
        both = (member.select(F.col("id").alias("key"), *columns, F.lit(True).alias("is_member"))
                .unionByName(visitor.select("key", *columns, F.lit(False).alias("is_member"))))

        def tile(group: pa.Table) -> pa.Table:
            flag = group.column("is_member").to_numpy()
            key = group.column("key").to_numpy()
            x = _vectors(group.column("x").combine_chunks())
            if flag.all() or not flag.any():
                return pa.table({"key": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "near": pa.array([], pa.float64()), "far": pa.array([], pa.float64())})
            order = np.argsort(key[flag], kind="stable")         # the first of equal distances is the smallest id
            ids, gaps = key[flag][order], _gaps(x[~flag], x[flag][order])
            far = gaps.max(1) if farthest else None
            return pa.table({"key": pa.array(key[~flag]), "id": pa.array(ids[gaps.argmin(1)]), "near": pa.array(gaps.min(1)),
                             "far": pa.array(far) if farthest else pa.nulls(int((~flag).sum()), pa.float64())})

        return both.groupBy("cell", "ring", "m", "v").applyInArrow(tile, "key long, id long, near double, far double")


def core_points(df: DataFrame, features: list[str], eps: float, min_samples: int, label: str = "segment_id",
                known: tuple[MetricTiles, DataFrame] | None = None) -> DataFrame:
    """``(label, x)``: the distinct core points of a table that DBSCAN has labelled, the references of its model.

    ``known`` is what ``core_flags`` found for the same table and numbers; without it the neighbours are counted here.
    """
    tiles, flags = known or core_flags(df, features, eps, min_samples)
    cores = flags.filter("core").join(tiles.points, "pid").select("x")
    xs = F.array(*[F.col(f"`{f}`").cast("double") + F.lit(0.0) for f in features])
    labels = df.select(xs.alias("x"), label).groupBy("x").agg(F.min(label).alias(label))       # equal rows have one label
    return cores.join(labels, "x").select(label, "x")


def assign_nearest(df: DataFrame, vector: str, index: NearestIndex, label: str = "segment_id") -> DataFrame:
    """Adds the id of the nearest reference and a confidence of 0..1 (3 digits).

    Without a radius the confidence is ``1 - nearest / farthest``; with one it is ``1 - nearest / radius``, and rows out of
    reach, or without a usable vector, are noise: -1 with confidence 0.
    """
    rows = materialize(df.withColumn("key_", F.monotonically_increasing_id()), "rows")
    found = index.search(rows.select(F.col("key_").alias("key"), vector), vector, farthest=index.radius is None)
    scale = F.col("far_") if index.radius is None else F.lit(float(index.radius))
    found = found.select(F.col("key").alias("key_"), F.col("id").alias("id_"), F.col("near").alias("near_"), F.col("far").alias("far_"))
    sure = rnd(clip(F.lit(1.0) - F.col("near_") / (scale + F.lit(1e-6)), 0, 1), 3)
    return (rows.join(found, "key_", "left")
            .withColumns({label: F.coalesce("id_", F.lit(-1)).cast("int"), "confidence": F.when(F.col("id_").isNull(), F.lit(0.0)).otherwise(sure)})
            .drop("key_", "id_", "near_", "far_"))
