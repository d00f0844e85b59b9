"""Joins of a large table with one that should be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexcohort.sources.scratch import small_table


def join_small(df: DataFrame, dim: DataFrame, key: str, how: str = "left", max_rows: int = 10_000,
               max_bytes: int = 8 << 20, salts: int = 32) -> DataFrame:
    """Broadcast ``dim`` once its size is known to be small, shuffle otherwise.

    The bounded read also means that an expensive ``dim`` is computed once.
    The other way is a salted shuffle join: the rows of ``dim`` are repeated per
    salt, so a key that holds a large share of ``df`` is spread over tasks.  The
    salt is a row's position, so equal rows spread as well; whatever salt a row
    gets, it meets all of ``dim``.  The hint keeps Spark from a broadcast by the
    size of a file, which says little about a long table of few distinct values.
    """
    rows, fits = small_table(dim, max_rows)
    if fits and sum(len(str(tuple(r))) for r in rows) <= max_bytes:
        return df.join(F.broadcast(df.sparkSession.createDataFrame(rows, dim.schema)), key, how)
    salted = dim.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    mix = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    return df.withColumn("salt_", mix).join(salted.hint("merge"), [key, "salt_"], how).drop("salt_")
