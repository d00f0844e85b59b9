"""Registry of runnable queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexcohort.functions.hexgrid import hex_cell
from hexcohort.operators.profile import segment_dimension
from hexcohort.sources.derive import subscribers
from hexcohort.sources.scratch import materialize

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

RES = 6   # at this resolution the cells of the derived table hold several subscribers


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def stored_subscribers(spark: SparkSession, sf: str) -> DataFrame:
    """Subscribers written once, for queries that read the table several times."""
    return materialize(subscribers(spark, sf), "subscribers")


def sub_cells(spark: SparkSession, sf: str, res: int = RES) -> DataFrame:
    """Subscribers with their home cell."""
    return subscribers(spark, sf).withColumn("home_h3", hex_cell(F.col("home_lat"), F.col("home_lon"), res))


def dimension(spark: SparkSession, sf: str) -> DataFrame:
    return segment_dimension(subscribers(spark, sf))
