"""Consecutive numbers without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexcohort.sources.scratch import materialize

_LOW = (1 << 33) - 1


def number_rows(df: DataFrame, name: str, order: Sequence[Column | str] | None = None) -> DataFrame:
    """Adds ``name`` = 0, 1, 2 ... in the given order (any order without one).

    Rows are range-sorted, numbered inside their partition and shifted by the
    sizes of the partitions before; one count per partition reaches the driver.
    """
    sorted_ = df.orderBy(*order) if order else df
    rows = materialize(sorted_.withColumn("mid_", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("mid_", 33)
    sizes = rows.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()
    starts, total = [], 0
    for r in sizes:
        starts.append((r["p"], total))
        total += r["n"]
    offsets = df.sparkSession.createDataFrame(starts or [(0, 0)], "part_ long, start_ long")
    return (rows.withColumn("part_", part).join(F.broadcast(offsets), "part_")
            .withColumn(name, F.col("start_") + F.col("mid_").bitwiseAND(F.lit(_LOW)))
            .drop("part_", "start_", "mid_"))
