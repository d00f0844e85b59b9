"""Nearest neighbours with a vantage-point tree per shard.

Rows are dealt into shards by their id, queries into blocks; a task gets one shard and one block, builds the shard's tree
and sends back at most k neighbours per query, of which the nearest over all shards are kept.  Shards and blocks have
bounded sizes, so a task's memory does not grow with the table.  Building takes about ten distances per row, a block of
queries a thousand times as many, so trees are built where they are used and never stored.

A node keeps the ranges of distances from its vantage point to its two halves.  By the triangle inequality nothing in a
half can be nearer to a query than the gap between the query's own distance and that range.  A half is passed over when
``relax`` times the gap exceeds the k-th best distance so far: 1 is exact, more is faster and may miss neighbours.
(Where all distances are alike, as among random directions in many dimensions, gaps are small and factors below about 5
change little; the exact search then costs what comparing with every row costs.)

Defined cases: vectors that are null, empty, all zero, or hold a null or non-finite component take no part, nor do rows
without id; rows equal in id and vector count once; vectors are compared with those of the same length only; ties go to
the smaller id; copies of a query's vector under other ids are its nearest neighbours at distance 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hexcohort.llm.common import bound_batches

K, EVERY = 10, 100
#: Most rows of a shard and most queries of a block.
SHARD, BLOCK = 1 << 16, 1 << 14
LEAF = 64
EXACT = 1.0


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances (queries by rows); components are summed in order, in double precision."""
    out = np.zeros((len(q), len(x)))
    for j in range(q.shape[1]):
        gap = q[:, j, None] - x[None, :, j]
        out += gap * gap
    return np.sqrt(out, out=out)


@dataclass
class Node:
    rows: np.ndarray                       # of a leaf; of an inner node its vantage point alone
    inner: Node | None = None
    outer: Node | None = None
    inner_range: tuple[float, float] = (0.0, 0.0)
    outer_range: tuple[float, float] = (0.0, 0.0)


def build(x: np.ndarray, rows: np.ndarray, leaf: int = LEAF) -> Node:
    """The tree over ``x[rows]``; halves are cut by rank, so equal distances do not unbalance it."""
    root = Node(rows)
    todo = [root]
    while todo:
        node = todo.pop()
        if len(node.rows) <= leaf:
            continue
        # a point far from an arbitrary one lies at the rim, which separates best
        point = int(np.argmax(distances(x[node.rows[:1]], x[node.rows])[0]))
        vantage, rest = node.rows[point:point + 1], np.delete(node.rows, point)
        d = distances(x[vantage], x[rest])[0]
        order = np.argsort(d, kind="stable")
        half = len(order) // 2
        near, far = order[:half], order[half:]
        node.rows = vantage
        node.inner, node.outer = Node(rest[near]), Node(rest[far])
        node.inner_range, node.outer_range = (d[near[0]], d[near[-1]]), (d[far[0]], d[far[-1]])
        todo += [node.inner, node.outer]
    return root


class Search:
    """The k nearest of each query, best first; ties by id."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, q: np.ndarray, names: np.ndarray, k: int, relax: float):
        self.x, self.ids, self.q, self.names, self.k, self.relax = x, ids, q, names, k, relax
        self.best = np.full((len(q), k), np.inf)
        self.found = np.full((len(q), k), np.iinfo(np.int64).max)
        self.seen = 0

    def look(self, rows: np.ndarray, queries: np.ndarray, chunk: int = 2048) -> None:
        for a in range(0, len(queries), chunk):
            own = queries[a:a + chunk]
            d = distances(self.q[own], self.x[rows])
            self.seen += d.size
            name = np.broadcast_to(self.ids[rows], d.shape)
            d = np.where(name == self.names[own, None], np.inf, d)
            some = np.flatnonzero((d <= self.best[own, -1:]).any(axis=1))
            if not len(some):
                continue
            own = own[some]
            d = np.concatenate([self.best[own], d[some]], axis=1)
            name = np.concatenate([self.found[own], np.where(np.isinf(d[:, self.k:]), np.iinfo(np.int64).max, name[some])], axis=1)
            order = np.lexsort((name, d), axis=-1)[:, :self.k]
            self.best[own], self.found[own] = np.take_along_axis(d, order, 1), np.take_along_axis(name, order, 1)

    def run(self, root: Node) -> None:
        # first each query's own leaf, which gives it a first k-th distance; then the whole tree, pruned by it
        first: set[int] = set()
        todo = [(root, np.arange(len(self.q)))]
        home = np.zeros(len(self.q), np.int64)
        while todo:
            node, queries = todo.pop()
            if node.inner is None:
                self.look(node.rows, queries)
                first.add(id(node))
                home[queries] = id(node)
                continue
            d = distances(self.q[queries], self.x[node.rows])[:, 0]
            near = d <= (node.inner_range[1] + node.outer_range[0]) / 2
            todo += [(child, queries[side]) for child, side in ((node.inner, near), (node.outer, ~near)) if side.any()]
        todo = [(root, np.arange(len(self.q)))]
        while todo:
            node, queries = todo.pop()
            if node.inner is None:
                rest = queries[home[queries] != id(node)] if id(node) in first else queries
                if len(rest):
                    self.look(node.rows, rest)
                continue
            self.look(node.rows, queries)
            d = distances(self.q[queries], self.x[node.rows])[:, 0]
            for child, (low, high) in ((node.inner, node.inner_range), (node.outer, node.outer_range)):
                gap = np.maximum(d - high, low - d) * (1 - 1e-12)
                on = self.relax * gap <= self.best[queries, -1]
                if on.any():
                    todo.append((child, queries[on]))


def usable(vector: Column) -> Column:
    x = vector.cast("array<double>")
    return (F.coalesce(F.size(x), F.lit(0)) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists(x, lambda v: v != 0)


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def nearest(vectors: DataFrame, k: int = K, every: int = EVERY, relax: float = EXACT, vec_id: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row with an id divisible by ``every`` its k nearest other rows."""
    spark = vectors.sparkSession
    bound_batches(spark)
    rows = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
            .filter(F.col("vec_id").isNotNull() & usable(F.col("v"))).dropDuplicates(["vec_id", "v"])
            .withColumn("size", F.size("v")))
    is_query = F.col("vec_id") % every == 0
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()      # two numbers
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(-(-n // SHARD), min(2 * partitions, -(-n // 256)), 1)
    blocks = max(-(-n_queries // BLOCK), 1)

    def run(shard: pa.Table, block: pa.Table) -> pa.Table:
        size = (shard if shard.num_rows else block).column("size")[0].as_py()
        x, q = _matrix(shard.column("v"), size), _matrix(block.column("v"), size)
        ids, names = shard.column("vec_id").to_numpy(), block.column("query_id").to_numpy()
        order = np.argsort(ids, kind="stable")        # the tree does not depend on the order of arrival
        search = Search(x[order], ids[order], q, names, k, relax)
        if len(x) and len(q):
            search.run(build(search.x, np.arange(len(x))))
        ok = np.isfinite(search.best)
        return pa.table({"query_id": np.broadcast_to(names[:, None], ok.shape)[ok], "vec_id": search.found[ok], "score": search.best[ok]})

    def spread(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    home = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    held = rows.withColumn("shard", home).withColumn("block", spread(blocks))
    asked = (rows.filter(is_query).withColumnRenamed("vec_id", "query_id")
             .withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).withColumn("shard", spread(shards)))
    keys = ["size", "shard", "block"]
    found = held.groupBy(keys).cogroup(asked.groupBy(keys)).applyInArrow(run, "query_id long, vec_id long, score double")
    best = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
