"""Cell-tower cleaning, filtering and density."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.expr import literal_map
from hexcohort.functions.hexgrid import hex_cell
from hexcohort.sources.readers import select_box

_RENAMED = {"net": "mnc", "area": "lac", "cell": "cell_id", "lon": "longitude", "lat": "latitude",
            "range": "range_m", "averageSignal": "avg_signal"}


def filter_towers(raw: DataFrame, country: str = "ID") -> DataFrame:
    """Country codes (none known: no filter) and the inclusive country box."""
    codes = K.COUNTRY_MCC.get(country, [])
    df = raw.filter(F.col("mcc").isin(codes)) if codes else raw
    return select_box(df, K.COUNTRY_BOXES.get(country, K.DEFAULT_BOX), "lat", "lon")


def clean_towers(raw: DataFrame) -> DataFrame:
    """Own column names, valid positions only, timestamps, network generation."""
    df = raw.withColumnsRenamed(_RENAMED).filter(
        F.col("latitude").between(-90.0, 90.0) & F.col("longitude").between(-180.0, 180.0))
    generation = F.coalesce(F.try_element_at(literal_map(K.RADIO_GENERATION), F.col("radio")), F.lit("Unknown"))
    return df.withColumns({"created": F.timestamp_seconds("created"), "updated": F.timestamp_seconds("updated"),
                           "generation": generation})


def tower_density(towers: DataFrame, res: int = 8) -> DataFrame:
    """Towers per cell: all, 4G, 5G, mean range."""
    cell = hex_cell(F.col("latitude"), F.col("longitude"), res)
    return towers.groupBy(cell.alias("h3_cell")).agg(
        F.count(F.lit(1)).alias("tower_count"),
        F.count_if(F.col("generation") == "4G").alias("lte_count"),
        F.count_if(F.col("generation") == "5G").alias("nr_count"),
        F.avg("range_m").alias("avg_range_m"))
