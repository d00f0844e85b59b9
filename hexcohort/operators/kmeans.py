"""K-means segmentation, search for k, projection, and centroid scoring."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.expr import clip, rnd
from hexcohort.operators.metrics import cluster_metrics

#: The movement below which a start has settled.
TOLERANCE = 1e-4


@dataclass
class Segmentation:
    """Fitted centroids, ordered by their coordinates, so that refits keep their numbers."""

    centers: list[list[float]]     # by segment id
    inertia: float
    features: str = "features"

    def transform(self, df: DataFrame, label: str = "segment_id") -> DataFrame:
        """Adds the number of the nearest centroid (the first one on ties); one array literal, whatever their number."""
        rows = F.array(*[F.array(*[F.lit(v) for v in c]) for c in self.centers])
        x = vector_to_array(self.features)

        def squared(c: Column) -> Column:
            return F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, v: t + v)

        near = df.withColumn("off_", F.transform(rows, squared))
        return near.withColumn(label, (F.array_position("off_", F.array_min("off_")) - 1).cast("int")).drop("off_")


#: Rounds of oversampling, and rows drawn in each: at least so many, and so many per centroid.
ROUNDS, DRAWN, DRAWN_PER_K = 4, 64, 16


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)


def _exponentials(code: np.ndarray, number: int) -> np.ndarray:
    """One exponential number per 64-bit code; another one for each ``number``."""
    x = code ^ (np.uint64((number + 1) * 0x9E3779B97F4A7C15 % 2 ** 64))
    for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(m)
    x = x ^ (x >> np.uint64(33))
    return -np.log(((x >> np.uint64(12)) + 0.5) * 2.0 ** -52)


def _candidates(folded: DataFrame, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """k-means||: candidates for first centroids drawn from all rows, and the number of rows nearest to each.

    ``folded(x, n, code)`` holds distinct vectors with their counts.  A vector of weight ``n x squared distance`` to the
    candidates so far gets an exponential number divided by its weight; those with the smallest ones are drawn.  That draws
    by weight without a pass for the sum of weights, and does not depend on how rows are spread.  One pass for the first
    candidate, ``ROUNDS`` for the others and one for the counts, whatever ``k``; the driver gets the drawn rows only.
    """
    context, ell = folded.sparkSession.sparkContext, max(DRAWN, DRAWN_PER_K * k)
    found = np.empty((0, 0))
    for step in range(ROUNDS + 1):
        shared, wanted = context.broadcast(found), ell if step else 1

        def run(batches: Iterator[pa.RecordBatch], step: int = step, shared=shared, wanted: int = wanted) -> Iterator[pa.RecordBatch]:
            keys, rows = np.empty(0), None
            for b in batches:
                if b.num_rows:
                    x, weight = _matrix(b), b.column(1).to_numpy()
                    if len(shared.value):
                        near = _squared(x, shared.value).min(1)
                        weight = weight * np.where(near > 1e-12 * (x * x).sum(1), near, 0)
                    with np.errstate(divide="ignore"):
                        key = _exponentials(b.column(2).to_numpy().view(np.uint64), seed * 100_003 + step) / weight
                    keys, rows = np.concatenate([keys, key]), x if rows is None else np.concatenate([rows, x])
                    least = np.argsort(keys, kind="stable")[:wanted]
                    least = least[np.isfinite(keys[least])]
                    keys, rows = keys[least], rows[least]
            if len(keys):
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(rows.tolist(), pa.list_(pa.float64()))], names=["key", "x"])

        drawn = folded.mapInArrow(run, "key double, x array<double>").orderBy("key", "x").limit(wanted).collect()
        shared.destroy()
        if not drawn:
            break           # every vector is a candidate
        more = np.array([r["x"] for r in drawn])
        found = np.concatenate([found, more]) if len(found) else more
    shared = context.broadcast(found)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(shared.value))
        for b in batches:
            if b.num_rows:
                held += np.bincount(_squared(_matrix(b), shared.value).argmin(1), b.column(1).to_numpy(), minlength=len(held))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held))), pa.array(held)], names=["at", "n"])

    counts = folded.mapInArrow(count, "at long, n double").groupBy("at").agg(F.sum("n").alias("n")).collect()      # one row per candidate
    shared.destroy()
    weights = np.zeros(len(found))
    for r in counts:
        weights[r["at"]] = r["n"]
    return found, weights


def _start(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Weighted k-means++ over the candidates, then Lloyd steps over them until they settle."""
    rng = np.random.default_rng(seed)
    centers = points[[rng.choice(len(points), p=weights / weights.sum())]]
    for _ in range(min(k, len(points)) - 1):
        chance = weights * _squared(points, centers).min(1)
        at = rng.choice(len(points), p=chance / chance.sum()) if chance.sum() > 0 else rng.integers(len(points))
        centers = np.concatenate([centers, points[[at]]])
    for _ in range(100):
        near = _squared(points, centers).argmin(1)
        n = np.bincount(near, weights, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, near, points * weights[:, None])
        moved = np.where(n[:, None] > 0, sums / np.maximum(n, 1e-300)[:, None], centers)
        if np.allclose(moved, centers, rtol=0, atol=1e-9):
            break
        centers = moved
    return centers


#: Bytes of distinct vectors up to which a start takes its steps inside one task.
IN_TASK = 64 << 20


def _folded_step(x: np.ndarray, n: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Per centroid the sum of its rows, their number and their cost."""
    off = _squared(x, centers)
    near = off.argmin(1)
    member = np.eye(len(centers))[near]
    return np.concatenate([member.T @ (x * n[:, None]), (member.T @ n)[:, None], (member.T @ (n * off[np.arange(len(x)), near]))[:, None]], axis=1)


def _moved(sums: np.ndarray, old: np.ndarray) -> np.ndarray:
    """New centroids; an empty cluster stays where it is."""
    n = sums[:, -2:-1]
    return np.where(n > 0, sums[:, :-2] / np.maximum(n, 1e-300), old)


def _off(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.sqrt(((a - b) ** 2).sum(1)).max())


def _walk_in_tasks(folded: DataFrame, starts: dict[int, np.ndarray], width: int, max_iter: int, tol: float) -> dict[int, np.ndarray]:
    """Where each start settles; the (few) vectors go to one task per start, which takes all its steps.

    The same steps as in ``_walk_together``, without a pass over the cluster for each.
    """
    first = {s: c.tolist() for s, c in starts.items()}           # starts x k x features numbers

    def run(group: pa.Table) -> pa.Table:
        s = group.column("start")[0].as_py()
        x = group.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        n, centers = group.column("n").to_numpy(), np.array(first[s])
        for _ in range(max_iter):
            old, centers = centers, _moved(_folded_step(x, n, centers), centers)
            if _off(old, centers) <= tol:
                break
        return pa.table({"start": pa.array([s], pa.int64()), "centers": pa.array([centers.tolist()], pa.list_(pa.list_(pa.float64())))})

    spread = folded.select("x", "n", F.explode(F.array(*[F.lit(s).cast("long") for s in first])).alias("start"))
    ends = spread.groupBy("start").applyInArrow(run, "start long, centers array<array<double>>").collect()      # one row per start
    return {r["start"]: np.array(r["centers"]) for r in ends}


def _walk_together(packed: DataFrame, starts: dict[int, np.ndarray], width: int, max_iter: int, tol: float) -> dict[int, np.ndarray]:
    """Where each start settles; all starts move together, a pass over all rows per step.

    A start that has come to where another one with as many centroids is goes the same way from there, and is dropped.
    """
    moving, settled = starts, {}
    for _ in range(max_iter):
        alone: dict[int, np.ndarray] = {}
        for s, centers in moving.items():
            if not _meets(centers, [c for c in (*alone.values(), *settled.values()) if len(c) == len(centers)], tol):
                alone[s] = centers
        if not alone:
            return settled
        moving = {}
        for s, (centers, _) in _pass(packed, alone, width).items():
            (settled if _off(centers, alone[s]) <= tol else moving)[s] = centers
    return settled | moving


#: Rows in one packed value, rows a task steps through together, numbers of a step that stay near the processor, and bytes of rows in a partition.
PACKED, CHUNK, IN_CACHE, PARTITION = 64, 4096, 1 << 16, 64 << 20


def _packed(folded: DataFrame, width: int) -> DataFrame:
    """``folded`` as bytes, count and coordinates of ``PACKED`` rows in a value, which every pass reads without unpacking arrays."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                rows = np.concatenate([b.column(1).to_numpy()[:, None], _matrix(b)], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([rows[i:i + PACKED].tobytes() for i in range(0, len(rows), PACKED)], pa.binary())], names=["rows"])

    parts = max(folded.sparkSession.sparkContext.defaultParallelism, -(-folded.count() * (width + 1) * 8 // PARTITION))
    return folded.mapInArrow(pack, "rows binary").repartition(parts).persist(StorageLevel.MEMORY_AND_DISK)


def _unpacked(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The rows of a batch of packed values, which lie one after the other in its buffer."""
    column = batch.column(0)
    edge = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[edge[0]:edge[-1]].view(np.float64).reshape(-1, width + 1)


class _Group:
    """Starts with as many centroids, which look at rows together: an array per step has all starts and some rows."""

    def __init__(self, k: int, starts: list[int], centers: dict[int, np.ndarray], width: int):
        self.k, self.starts = k, starts
        c = np.concatenate([centers[s] for s in starts])
        self.left = np.concatenate([-2 * c, (c * c).sum(1)[:, None]], axis=1)
        self.total, self.cost = np.zeros((len(c), width + 1)), np.zeros(len(starts))
        self.step = max(64, min(CHUNK, IN_CACHE // len(c)))

    def add(self, rows: np.ndarray) -> None:
        """``rows`` have their count first."""
        for at in range(0, len(rows), self.step):
            n, x = rows[at:at + self.step, 0], rows[at:at + self.step, 1:]
            one = np.ones((len(x), 1))
            off = (self.left @ np.concatenate([x, one], axis=1).T).reshape(len(self.starts), self.k, len(x))     # without the square of the row
            best = off.min(1)
            member = off == best[:, None, :]
            if np.count_nonzero(member) > best.size:                             # the first one on ties
                member &= np.cumsum(member, axis=1) == 1
            member = member.astype(float)
            self.total += member.reshape(-1, len(x)) @ (np.concatenate([x, one], axis=1) * n[:, None])
            self.cost += np.maximum(best + (x * x).sum(1), 0) @ n

    def sums(self) -> Iterator[tuple[int, np.ndarray]]:
        """Per start and centroid the sum of its rows and their number; the cost of the start stands at its first centroid."""
        for i, s in enumerate(self.starts):
            m = np.zeros((self.k, self.total.shape[1] + 1))
            m[:, :-1], m[0, -1] = self.total[i * self.k:(i + 1) * self.k], self.cost[i]
            yield s, m


def _pass(packed: DataFrame, starts: dict[int, np.ndarray], width: int) -> dict[int, tuple[np.ndarray, float]]:
    """One Lloyd step of every start in a single pass over all rows: new centroids, and the cost of the old ones."""
    shared = packed.sparkSession.sparkContext.broadcast(starts)      # starts x k x features numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        groups = [_Group(k, [s for s, c in own.items() if len(c) == k], own, width) for k in sorted({len(c) for c in own.values()})]
        for b in batches:
            if b.num_rows:
                rows = _unpacked(b, width)
                for group in groups:
                    group.add(rows)
        for group in groups:
            for s, m in group.sums():
                yield pa.RecordBatch.from_pydict({"start": [s] * len(m), "cluster": list(range(len(m))), "m": m.tolist()})

    parts = packed.mapInArrow(run, "start long, cluster long, m array<double>")
    cells = parts.groupBy("start", "cluster").agg(F.array(*[F.sum(F.col("m")[i]) for i in range(width + 2)]).alias("m")).collect()
    shared.destroy()
    sums = {s: np.zeros((len(c), width + 2)) for s, c in starts.items()}
    for r in cells:
        sums[r["start"]][r["cluster"]] = r["m"]
    return {s: (_moved(m, starts[s]), float(m[:, -1].sum())) for s, m in sums.items()}


def _meets(centers: np.ndarray, others: list[np.ndarray], tol: float) -> bool:
    """Whether the centroids, in any order, are where those of another start are."""
    for o in others:
        off = _squared(centers, o)
        near = off.argmin(1)
        if len(set(near.tolist())) == len(o) and off.min(1).max() <= tol * tol:
            return True
    return False


def _fit(vectors: DataFrame, ks: Sequence[int], n_init: int, max_iter: int, seed: int, tol: float, features: str) -> dict[int, Segmentation]:
    """The best of ``n_init`` starts for each k."""
    plan = [(k, i) for k in ks for i in range(n_init)]
    folded = (vectors.groupBy("x").agg(F.count(F.lit(1)).cast("double").alias("n"))
              .select("x", "n", F.xxhash64("x").alias("code")).persist(StorageLevel.MEMORY_AND_DISK))
    packed = None
    try:
        points, weights = _candidates(folded, max(ks), seed)
        width = points.shape[1]
        starts = {s: _start(points, weights, k, seed + i) for s, (k, i) in enumerate(plan)}
        whole = folded.count() * (width + 1) * 8
        packed = _packed(folded, width)
        if whole <= IN_TASK:
            settled = _walk_in_tasks(folded, starts, width, max_iter, tol)
        else:
            settled = _walk_together(packed, starts, width, max_iter, tol)
        costs = {s: cost for s, (_, cost) in _pass(packed, settled, width).items()}
    finally:
        folded.unpersist()
        if packed is not None:
            packed.unpersist()
    found = {}
    for k in ks:
        best = min((s for s in settled if plan[s][0] == k), key=lambda s: (costs[s], s))
        found[k] = Segmentation(sorted(settled[best].tolist()), costs[best], features)
    return found


def _stored(df: DataFrame, features: str) -> DataFrame:
    return df.select(vector_to_array(features).alias("x")).persist(StorageLevel.MEMORY_AND_DISK)


def fit_kmeans(df: DataFrame, k: int = K.KMEANS_PARAMS["n_clusters"], n_init: int = K.KMEANS_PARAMS["n_init"],
               max_iter: int = K.KMEANS_PARAMS["max_iter"], seed: int = K.KMEANS_PARAMS["seed"],
               features: str = "features", tol: float = TOLERANCE) -> Segmentation:
    """Lloyd's iteration over all rows from ``n_init`` starts; the one with the lowest cost wins.

    Starts are k-means++ draws, re-clustered, from the weighted candidates of k-means||; seeding and everything after use
    every row.  Equal rows are one with a count.
    """
    vectors = _stored(df, features)
    try:
        return _fit(vectors, [k], n_init, max_iter, seed, tol, features)[k]
    finally:
        vectors.unpersist()


def tune_k(df: DataFrame, k_range: tuple[int, int] = K.K_RANGE, n_init: int = K.KMEANS_PARAMS["n_init"],
           max_iter: int = K.KMEANS_PARAMS["max_iter"], seed: int = K.KMEANS_PARAMS["seed"],
           features: str = "features") -> DataFrame:
    """Every k of the range with inertia and all measures over all rows; ``is_best`` marks the top silhouette.

    Each k is fitted with the settings of the final training.

    The range holds a handful of whole numbers, so trying all of them covers
    what a sampled search would, and all their starts share each pass.
    """
    width = len(df.select(features).first()[0])
    cols = [f"x{i}" for i in range(width)]
    vectors, kept = _stored(df, features), df.select(features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = []
        for k, seg in _fit(vectors, range(k_range[0], k_range[1] + 1), n_init, max_iter, seed, TOLERANCE, features).items():
            arr = vector_to_array(features)
            labelled = seg.transform(kept).select("segment_id", *[arr[i].alias(c) for i, c in enumerate(cols)])
            m = cluster_metrics(labelled, cols).first()
            rows.append((k, seg.inertia, m["silhouette"], m["davies_bouldin"], m["calinski_harabasz"]))
    finally:
        vectors.unpersist()
        kept.unpersist()
    best = max(rows, key=lambda r: (r[2], -r[0]))[0]
    return df.sparkSession.createDataFrame(
        [(*r, r[0] == best) for r in rows],
        "k int, inertia double, silhouette double, davies_bouldin double, calinski_harabasz double, is_best boolean")


def pca_2d(df: DataFrame, features: str = "features", keep: Sequence[str] = ("subscriber_id",)) -> DataFrame:
    """Two principal components next to the kept columns (input is scaled, hence centred)."""
    model = PCA(k=2, inputCol=features, outputCol="pc").fit(df.select(features))
    xy = vector_to_array("pc")
    return model.transform(df).select(*keep, xy[0].alias("x"), xy[1].alias("y"))


def centroid_distances(columns: Sequence[Column], centers: Sequence[Sequence[float]]) -> list[Column]:
    """Distance to every centroid as plain arithmetic (stays in generated code)."""
    return [F.sqrt(reduce(lambda a, b: a + b, [(x - F.lit(c)) * (x - F.lit(c)) for x, c in zip(columns, cen)]))
            for cen in centers]


def assign(df: DataFrame, columns: Sequence[Column], centers: Sequence[Sequence[float]] | None,
           label: str = "segment_id") -> DataFrame:
    """Adds the nearest centroid and a confidence ``1 - nearest / farthest`` (0..1, 3 digits).

    Without centroids (density models) the segment is 0 and the confidence 0.75.
    """
    if not centers:
        return df.withColumns({label: F.lit(0), "confidence": F.lit(0.75)})
    df = df.withColumn("dist_", F.array(*centroid_distances(columns, centers)))
    near, far = F.array_min("dist_"), F.array_max("dist_")
    return df.withColumns({
        label: (F.array_position("dist_", near) - 1).cast("int"),
        "confidence": rnd(clip(F.lit(1.0) - near / (far + F.lit(1e-6)), 0, 1), 3)}).drop("dist_")
