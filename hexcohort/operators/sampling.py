"""Seeded sample without replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hash_sample(df: DataFrame, n: int, key: str = "subscriber_id", seed: int = 42) -> DataFrame:
    """``n`` rows in the order of a hash of key and seed: the same rows on every run and engine.

    A top-n, so each task keeps at most ``n`` rows.
    """
    order = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(order, key).limit(n)
