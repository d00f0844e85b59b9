"""Writers: Parquet, CSV sample, GeoJSON features, Kafka-shaped JSON rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.expr import literal_map
from hexcohort.functions.hexgrid import hex_boundary


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv_sample(df: DataFrame, path: str, key: str = "subscriber_id", n: int = 2000) -> None:
    """First ``n`` rows by key with a header; top-n, not a full sort."""
    df.orderBy(key).limit(n).write.mode("overwrite").option("header", True).csv(path)


def colour(segment: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in K.PALETTE]), F.pmod(segment, F.lit(len(K.PALETTE))) + 1)


def segment_name(segment: Column, names: dict[int, str] | None) -> Column:
    """``Unknown`` without names, ``Segment <id>`` for an id that has none."""
    if not names:
        return F.lit("Unknown")
    fallback = F.concat(F.lit("Segment "), segment.cast("string"))
    return F.coalesce(F.try_element_at(literal_map(names), segment), fallback)


def density_features(density: DataFrame, names: dict[int, str] | None = None, cell: str = "home_h3") -> DataFrame:
    """One GeoJSON Feature text per hexagonal cell; rows without a readable cell are left out."""
    seg = F.col("dominant_segment").cast("int")
    shares = [c for c in density.columns if c.startswith("pct_seg_")]
    props = F.struct(
        F.col(cell).alias("h3_cell"), seg.alias("dominant_segment"), segment_name(seg, names).alias("segment_name"),
        F.col("n_subscribers").cast("bigint").alias("n_subscribers"),
        *[F.col(c).cast("double").alias(c) for c in
          ("avg_monthly_charges", "avg_data_usage_gb", "avg_rsrq", "segment_entropy")],
        colour(seg).alias("color"), *[F.col(c).cast("double").alias(c) for c in shares])
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(hex_boundary(F.col(cell))).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), props.alias("properties"))
    return (density.filter(F.col(cell).rlike("^hx[0-9]+_-?[0-9]+_-?[0-9]+$"))
            .select(F.col(cell), F.to_json(feature).alias("feature")))


def point_features(df: DataFrame, lat: str = "latitude", lon: str = "longitude",
                   properties: list[str] | None = None) -> DataFrame:
    """One GeoJSON Point Feature text per row."""
    props = properties or [c for c in df.columns if c not in (lat, lon)]
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array(F.col(lon), F.col(lat)).alias("coordinates")).alias("geometry"),
        F.struct(*[F.col(c) for c in props]).alias("properties"))
    return df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.to_json(feature).alias("feature"))


def write_features(features: DataFrame, path: str) -> None:
    """Newline-delimited GeoJSON: every task writes its own part file."""
    features.select("feature").write.mode("overwrite").text(path)
