"""Wide blocks of points that lie together, and tasks that compare two of them without a copy of a point on any disk.

A layout halves the points again and again along the principal axis in which they spread most; a bounded sample of the points
tells where.  It only says which points are neighbours in a block, never which pairs count.  A block is one row, its columns packed
as bytes.  The blocks of two tables meet as a Cartesian product whose tasks read the written rows of both sides, so nothing is
shuffled; two blocks whose boxes are farther apart than the reach are left out before their bytes go anywhere.  Inside a block rows
keep the order of the layout, so every ``CHUNK`` of them has a small box of its own.
"""

from __future__ import annotations

import contextlib
import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexcohort.sources.scratch import forget, materialize

#: Pairs of blocks that a task holds as bytes.
HELD = 8
#: Rows of a block that share a small box; leaves of a layout at most, and sampled rows for each.
CHUNK, LEAVES, SAMPLED = 256, 4096, 8


class Layout:
    """An order of points in which neighbours lie together, learned from ``points(pid, x, w)``."""

    def __init__(self, points: DataFrame, n: int, wide: int):
        self.wide = wide
        self.depth = int(np.ceil(np.log2(min(LEAVES, max(1, n / CHUNK)))))
        if not self.depth:
            return
        every = max(1, n // (SAMPLED << self.depth))
        drawn = points.filter(F.pmod(F.xxhash64("pid"), F.lit(every)) == 0).select("x").toArrow()       # bounded
        x = drawn.column(0).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(drawn.num_rows, -1)
        if not len(x):
            self.depth = 0
            return
        self.axes = np.linalg.eigh(np.cov(x.T).reshape(x.shape[1], -1))[1] if len(x) > 1 else np.eye(x.shape[1])
        y, inner = x @ self.axes, (1 << self.depth) - 1
        self.axis, self.cut, held = np.zeros(inner, np.int64), np.zeros(inner), {0: y}
        for node in range(inner):
            y = held.pop(node)
            if len(y):
                axis = int(y.var(0).argmax())
                self.axis[node], self.cut[node] = axis, np.median(y[:, axis])
            right = y[:, self.axis[node]] > self.cut[node]
            held[2 * node + 1], held[2 * node + 2] = y[~right], y[right]

    def leaf(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        if not self.depth:
            return node
        y, row = x @ self.axes, np.arange(len(x))
        for _ in range(self.depth):
            node = 2 * node + 1 + (y[row, self.axis[node]] > self.cut[node])
        return node - ((1 << self.depth) - 1)

    def packed(self, points: DataFrame, columns: list[str], n: int) -> DataFrame:
        """``(low, high, rows)``: the blocks of ``points``, about ``n``, with their boxes; ``columns`` include ``pid`` and ``x``."""
        leaf_of, wide = self.leaf, self.wide
        shift = max(0, self.depth - int(np.ceil(np.log2(max(1, n / wide)))))

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    leaf = leaf_of(b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1))
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf), pa.array(leaf >> shift)], names=[*columns, "leaf_", "block_"])

        def pack(t: pa.Table) -> pa.Table:
            t = t.take(pa.array(np.argsort(t.column("leaf_").to_numpy(), kind="stable")))
            x, low, high, rows = t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1), [], [], []
            for at in range(0, t.num_rows, wide):           # a block is bounded, however many points a place holds
                sink, part = io.BytesIO(), t.select(columns).slice(at, wide).combine_chunks()
                with pa.ipc.new_stream(sink, part.schema) as out:
                    out.write_table(part)
                rows.append(sink.getvalue())
                low.append(x[at:at + wide].min(0))
                high.append(x[at:at + wide].max(0))
            vectors = pa.list_(pa.float64())
            return pa.table({"low": pa.array([v.tolist() for v in low], vectors), "high": pa.array([v.tolist() for v in high], vectors), "rows": pa.array(rows, pa.binary())})

        spec = ", ".join(f"{c} {t}" for c, t in points.select(*columns).dtypes)
        placed = points.select(*columns).mapInArrow(place, f"{spec}, leaf_ long, block_ long")
        return materialize(placed.groupBy("block_").applyInArrow(pack, "low array<double>, high array<double>, rows binary"), "blocks")


def discard(blocks: DataFrame) -> None:
    """Removes what ``packed`` has written, once everything that read it is written itself."""
    forget(blocks)


def _apart(low: str, high: str, other_low: str, other_high: str) -> Column:
    """Squared distance of two boxes."""
    gaps = F.zip_with(F.zip_with(low, other_high, lambda a, b: a - b), F.zip_with(other_low, high, lambda a, b: a - b),
                      lambda a, b: F.greatest(a, b, F.lit(0.0)))
    return F.aggregate(gaps, F.lit(0.0), lambda t, v: t + v * v)


def meet(members: DataFrame, visitors: DataFrame, reach: float, fn: Callable[[pa.Table, pa.Table], pa.Table], out: str) -> DataFrame:
    """``fn(members, visitors)`` of every two blocks whose boxes are at most ``reach`` apart, written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for m, v in zip(b.column(0), b.column(1)):
                yield from fn(*(pa.ipc.open_stream(side.as_buffer()).read_all() for side in (m, v))).to_batches()

    one = members.select(F.col("low").alias("m_low"), F.col("high").alias("m_high"), F.col("rows").alias("m_rows"))
    two = visitors.select(F.col("low").alias("v_low"), F.col("high").alias("v_high"), F.col("rows").alias("v_rows"))
    near = F.sqrt(_apart("m_low", "m_high", "v_low", "v_high")) <= F.lit(reach * (1 + 1e-9) + 1e-9) + F.lit(1e-9) * F.abs(F.array_max("m_high"))
    pairs = one.hint("shuffle_replicate_nl").join(two, near)
    with _rows_per_batch(pairs, HELD):
        return materialize(pairs.select("m_rows", "v_rows").mapInArrow(run, out), "met")


@contextlib.contextmanager
def _rows_per_batch(df: DataFrame, rows: int) -> Iterator[None]:
    """Rows of wide columns go to Python a few at a time."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    conf.set(name, str(rows))
    try:
        yield
    finally:
        conf.set(name, before)
