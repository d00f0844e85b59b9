"""POI counts per hexagonal cell and their join onto subscribers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.hexgrid import hex_cell
from hexcohort.functions.joins import join_small
from hexcohort.sources.scratch import small_table

# Types become columns; as many as Spark's own pivot allows.
MOST_TYPES = 10_000


def present_types(pois: DataFrame) -> list[str]:
    """The usual types, then all others that occur."""
    rows, fits = small_table(pois.select("poi_type").filter(F.col("poi_type").isNotNull()).distinct(), MOST_TYPES)
    if not fits:
        raise ValueError(f"more than {MOST_TYPES} POI types cannot become columns")
    return K.POI_TYPES + sorted({r["poi_type"] for r in rows} - set(K.POI_TYPES))


def poi_counts(pois: DataFrame, res: int = 8, types: list[str] | None = None, cell: str = "home_h3") -> DataFrame:
    """One row per cell with ``h3_poi_<type>_count`` columns; POIs without a cell drop out.

    Without a list of types, all that are present count (one more pass).
    """
    types = types or present_types(pois)
    counts = [F.count_if(F.col("poi_type") == t).alias(f"h3_poi_{t}_count") for t in types]
    return (pois.select(hex_cell(F.col("latitude"), F.col("longitude"), res).alias(cell), "poi_type")
            .filter(F.col(cell).isNotNull()).groupBy(cell).agg(*counts))


def add_poi_density(subs: DataFrame, pois: DataFrame | None, cell: str = "home_h3", res: int = 8,
                    types: list[str] | None = None) -> DataFrame:
    """Left join of the counts on the cell, missing counts 0; unchanged without POIs or the cell column."""
    if pois is None or cell not in subs.columns:
        return subs
    counts = poi_counts(pois, res, types, cell)
    new = [c for c in counts.columns if c != cell]
    joined = join_small(subs, counts, cell)
    return joined.select(*subs.columns, *[F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in new])
