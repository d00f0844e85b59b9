"""Change of segment membership between two refreshes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.joins import join_small
from hexcohort.operators.components import connected_components
from hexcohort.sources.scratch import materialize


def transitions(current: DataFrame, previous: DataFrame, key: str = "subscriber_id",
                label: str = "segment_id") -> DataFrame:
    """Subscribers per (previous, current) label among those present in both.

    One shuffle on the unique key (none when both are bucketed by it); counts
    are folded before the second.
    """
    old = previous.select(key, F.col(label).alias("previous"))
    return (current.select(key, F.col(label).alias("current")).join(old, key, "inner")
            .groupBy("previous", "current").agg(F.count(F.lit(1)).alias("n")))


def drift(current: DataFrame, previous: DataFrame | None, key: str = "subscriber_id", label: str = "segment_id",
          limit_pct: float = K.DRIFT_LIMIT_PCT) -> DataFrame:
    """``(n_matched, n_changed, drift_pct, alert)``; without previous labels the drift is 0.

    Where ids may be renumbered between fits, ``match_labels`` first or pass segment names as ``label``.
    """
    if previous is None:
        return current.agg(F.lit(0).cast("bigint").alias("n_matched"), F.lit(0).cast("bigint").alias("n_changed"),
                           F.lit(0.0).alias("drift_pct"), F.lit(False).alias("alert"))
    # <=> keeps a label that went missing as a change
    changed = ~F.col("previous").eqNullSafe(F.col("current"))
    t = transitions(current, previous, key, label).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_matched"),
        F.coalesce(F.sum(F.when(changed, F.col("n"))), F.lit(0)).alias("n_changed"))
    pct = F.coalesce(F.try_divide(F.col("n_changed").cast("double") * F.lit(100.0), F.col("n_matched")), F.lit(0.0))
    return t.withColumn("drift_pct", pct).withColumn("alert", F.col("drift_pct") > F.lit(limit_pct))


def _assignment(weight: np.ndarray) -> np.ndarray:
    """Column of each row with the largest total of whole-number weights; no more rows than columns.

    Rows enter one by one along a cheapest augmenting path under row and column prices, so a row costs rows x columns at most.
    """
    rows, cols = weight.shape
    cost = weight.max(initial=0) - weight
    far = np.iinfo(np.int64).max // 4
    price_row, price_col = np.zeros(rows, np.int64), np.zeros(cols, np.int64)
    row_of = np.full(cols, -1)
    for new in range(rows):
        slack, came, seen = np.full(cols, far), np.full(cols, -1), np.zeros(cols, bool)
        row, col, path = new, -1, []
        while row >= 0:
            reduced = cost[row] - price_row[row] - price_col
            better = ~seen & (reduced < slack)
            slack[better], came[better] = reduced[better], col
            col = int(np.argmin(np.where(seen, far, slack)))
            step = slack[col]
            price_row[[new, *row_of[path]]] += step
            price_col[path] -= step
            slack[~seen] -= step
            seen[col] = True
            path.append(col)
            row = row_of[col]
        while col >= 0:
            before = came[col]
            row_of[col] = new if before < 0 else row_of[before]
            col = before
    out = np.full(rows, -1)
    taken = np.flatnonzero(row_of >= 0)
    out[row_of[taken]] = taken
    return out


def match_segments(moves: DataFrame) -> DataFrame:
    """``(previous, current, n)``: old and new segments paired one to one so that the most rows stay, from ``transitions``.

    Noise (negative labels) and missing labels are never paired, nor are segments that share no row.  Among equally good pairings
    one that keeps more ids is taken.  Segments linked by shared rows are one group; a task solves a group, whose size follows
    the segments and not the rows.
    """
    t = materialize(moves.filter("previous >= 0 AND current >= 0").select(F.col("previous").cast("long"), F.col("current").cast("long"), "n"), "moves")
    links = t.select((F.col("previous") * 2).alias("a"), (F.col("current") * 2 + 1).alias("b"))
    comp = connected_components(links.select(F.col("a").alias("node")).union(links.select("b")).distinct(), links)

    def solve(g: pa.Table) -> pa.Table:
        p, c, n = (g.column(x).to_numpy() for x in ("previous", "current", "n"))
        (old, i), (new, j) = np.unique(p, return_inverse=True), np.unique(c, return_inverse=True)
        weight = np.zeros((len(old), len(new)), np.int64)
        weight[i, j] = n * (min(weight.shape) + 1) + (p == c)
        shared = np.zeros(weight.shape, np.int64)
        shared[i, j] = n
        flip = len(old) > len(new)
        at = _assignment(weight.T if flip else weight)
        i, j = (at, np.arange(len(at))) if flip else (np.arange(len(at)), at)
        kept = shared[i, j] > 0
        return pa.table({"previous": old[i[kept]], "current": new[j[kept]], "n": shared[i[kept], j[kept]]})

    grouped = t.withColumn("node", F.col("previous") * 2).join(comp, "node").select("comp", "previous", "current", "n")
    return grouped.groupBy("comp").applyInArrow(solve, "previous long, current long, n long")


def match_labels(current: DataFrame, previous: DataFrame, key: str = "subscriber_id", label: str = "segment_id") -> DataFrame:
    """``current`` with its segments renamed to the old ones they are paired with.

    Segments without a partner get new numbers above all old and new ones; noise and missing labels stay.
    """
    pairs = materialize(match_segments(transitions(current, previous, key, label)), "pairs")
    top = current.agg(F.max(label)).first()[0], previous.agg(F.max(label)).first()[0]
    above = max([v for v in top if v is not None], default=0) + 1
    names = pairs.select(F.col("current").alias(label), F.col("previous").alias("renamed_"))
    joined = join_small(current.withColumn(label, F.col(label).cast("long")), names, label)
    new = F.when(F.col(label) >= 0, F.coalesce("renamed_", F.col(label) + F.lit(above))).otherwise(F.col(label))
    return joined.withColumn(label, new).drop("renamed_").select(*current.columns)
