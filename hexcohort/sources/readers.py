"""Scans: subscriber Parquet, tower CSV, POI JSON documents and raw nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort import schema as S
from hexcohort.functions.expr import nan_to_null


def read_subscribers(spark: SparkSession, path: str, fixed_schema: bool = False) -> DataFrame:
    """Subscriber table; NaN becomes NULL at the scan."""
    reader = spark.read.schema(S.SUBSCRIBER) if fixed_schema else spark.read
    return nan_to_null(reader.parquet(path))


def read_optional(spark: SparkSession, pattern: str) -> DataFrame | None:
    """Every Parquet table that matches a glob, as one; None when nothing matches."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(p)
    if found is None or len(found) == 0:
        return None
    return spark.read.parquet(*[st.getPath().toString() for st in found])


def read_towers(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Headerless 14-column CSV, plain or gzip.

    One gzip file is one task; ``partitions`` spreads the rows after it.
    """
    df = spark.read.schema(S.TOWER).option("header", False).option("mode", "PERMISSIVE").csv(path)
    return df.repartition(partitions) if partitions else df


def read_poi_documents(spark: SparkSession, path: str, poi_type: str | None = None,
                       multi_line: bool = False) -> DataFrame:
    """JSON documents with an ``elements`` array -> POI rows.

    One document per line splits over tasks; ``multi_line`` reads a file as one
    document.  Without a type to stamp, nodes are classified by their tags.
    """
    docs = spark.read.schema(S.POI_DOCUMENT).option("multiLine", multi_line).json(path)
    nodes = docs.select(F.explode("elements").alias("e")).select("e.*")
    return poi_rows(nodes, poi_type) if poi_type else classify_pois(nodes)


def poi_rows(nodes: DataFrame, poi_type: str) -> DataFrame:
    """Nodes that carry a position, stamped with one type; a missing name is ''."""
    return (
        nodes.filter((F.col("type") == "node") & F.col("lat").isNotNull() & F.col("lon").isNotNull())
        .select(F.col("id").alias("osm_id"), F.lit(poi_type).alias("poi_type"),
                F.coalesce(F.col("tags").getItem("name"), F.lit("")).alias("name"),
                F.col("lat").alias("latitude"), F.col("lon").alias("longitude"))
    )


def classify_pois(nodes: DataFrame, types: list[str] | None = None) -> DataFrame:
    """Raw nodes -> one row per matching POI type (a node may match several)."""
    hits = []
    for poi_type, (key, pattern) in K.POI_RULES.items():
        if types is not None and poi_type not in types:
            continue
        value = F.col("tags").getItem(key)
        hit = (value != K.OFFICE_EXCLUDED) if pattern is None else value.rlike(pattern)
        hits.append(F.when(F.coalesce(hit, F.lit(False)), F.lit(poi_type)))
    return (
        nodes.filter((F.col("type") == "node") & F.col("lat").isNotNull() & F.col("lon").isNotNull())
        .select(F.col("id").alias("osm_id"), F.explode(F.array_compact(F.array(*hits))).alias("poi_type"),
                F.coalesce(F.col("tags").getItem("name"), F.lit("")).alias("name"),
                F.col("lat").alias("latitude"), F.col("lon").alias("longitude"))
    )


def select_box(df: DataFrame, box: tuple[float, float, float, float], lat: str = "latitude",
               lon: str = "longitude") -> DataFrame:
    """Inclusive (south, west, north, east) box; reaches the scan as a pushed filter."""
    south, west, north, east = box
    return df.filter(F.col(lat).between(south, north) & F.col(lon).between(west, east))


def select_city(df: DataFrame, city: str) -> DataFrame:
    if city not in K.CITY_BOXES:
        raise ValueError(f"unknown city {city!r}; known: {sorted(K.CITY_BOXES)}")
    return select_box(df, K.CITY_BOXES[city])
