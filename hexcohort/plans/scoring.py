"""Scoring: the same plan for one request, a billion rows, or a stream.

defaults -> checks -> features -> scaling -> nearest centroid -> names and
plans.  Every lookup (centroids, names, plans, scaling numbers) is a literal in
the projection, so scoring neither joins nor shuffles.  Names and plans of more
than ``MAX_SEGMENTS`` segments stay a table that is joined.

More than ``MAX_CENTRES`` centroids, and the core points of a DBSCAN model, are
a table of ``references`` that rows look up through an index; streams do so per
micro-batch (``foreachBatch``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.hexgrid import hex_cell
from hexcohort.functions.joins import join_small
from hexcohort.operators.features import mobility_columns, poi_columns, temporal_columns
from hexcohort.operators.kmeans import assign
from hexcohort.operators.nearest import NearestIndex, assign_nearest
from hexcohort.operators.profile import label_segments
from hexcohort.operators.quality import request_errors
from hexcohort.operators.scaling import ScaleModel
from hexcohort.sources.scratch import materialize, small_table

#: Segments whose names and plans are inlined; more of them are joined.
MAX_SEGMENTS = 10_000
#: Centroids that are inlined as literals; more of them are a table.
MAX_CENTRES = 256
DIMENSION = ("segment_name", "segment_description", "plans")
ALGORITHMS = ("kmeans", "dbscan", "hdbscan")   # order in which saved models are looked for


@dataclass
class Scorer:
    features: list[str]
    scale: ScaleModel
    median_distance: float
    centers: Sequence[Sequence[float]] | None
    names: Mapping[int, str] = field(default_factory=dict)
    descriptions: Mapping[int, str] = field(default_factory=dict)
    plans: Mapping[int, Sequence[str]] = field(default_factory=dict)
    fill: str = "median"        # or "zero": absent and missing model inputs count as 0
    res: int = 8
    dimension: DataFrame | None = None      # names, descriptions and plans as a table, where they are too many to inline
    references: DataFrame | None = None     # (segment_id, centre): many centroids, or the core points of a density model
    radius: float | None = None             # how far a core point reaches; rows beyond are noise (-1)
    _index: NearestIndex | None = field(default=None, repr=False)

    def _assigned(self, df: DataFrame) -> DataFrame:
        scaled = self.scale.scaled()
        columns = [scaled[c] for c in self.features]
        if self.references is None:
            return assign(df, columns, self.centers)
        if self._index is None:
            self._index = NearestIndex(self.references, "segment_id", "centre", self.radius)
        return assign_nearest(df.withColumn("vector_", F.array(*columns)), "vector_", self._index).drop("vector_")

    def score(self, requests: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        df = poi_columns(temporal_columns(mobility_columns(fill_defaults(requests), self.median_distance)))
        for c in self.features:
            if c not in df.columns:
                df = df.withColumn(c, F.lit(0.0 if self.fill == "zero" else None).cast("double"))
        if self.fill == "zero":
            df = df.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in self.features})
        df = self._assigned(df)
        df = label_segments(df, self.names, self.descriptions, self.plans)
        if self.dimension is not None:
            df = joined_labels(df, self.dimension)
        return df.select("subscriber_id", "segment_id", "segment_name", "confidence", "segment_description",
                         "recommended_plans", hex_cell(F.col("home_lat"), F.col("home_lon"), self.res)
                         .alias("h3_home_cell"), *keep)

    def save(self, spark: SparkSession, path: str, algorithm: str = "kmeans") -> None:
        """Model numbers and segment metadata as small Parquet tables."""
        self.scale.write().overwrite().save(f"{path}/scale")
        spark.createDataFrame([(self.features, float(self.median_distance), self.fill, self.res, self.radius)],
                              "features array<string>, median_distance double, fill string, res int, radius double") \
            .write.mode("overwrite").parquet(f"{path}/settings")
        cen = [(i, [float(v) for v in c]) for i, c in enumerate(self.centers or [])]
        table = spark.createDataFrame(cen, "segment_id int, centre array<double>") if self.references is None else self.references.select(
            F.col("segment_id").cast("int").alias("segment_id"), F.col("centre").cast("array<double>").alias("centre"))
        # written elsewhere first: it may have been read from the same path
        materialize(table, "centres").write.mode("overwrite").parquet(f"{path}/centers_{algorithm}")
        if self.dimension is not None:
            # written elsewhere first: it may have been read from the same path
            materialize(self.dimension, "segments").write.mode("overwrite").parquet(f"{path}/segments")
            return
        ids = sorted(set(self.names) | set(self.descriptions) | set(self.plans))
        meta = [(i, self.names.get(i), self.descriptions.get(i), self.plans.get(i)) for i in ids]
        spark.createDataFrame(meta, "segment_id int, segment_name string, segment_description string, "
                                    "plans array<string>").write.mode("overwrite").parquet(f"{path}/segments")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Scorer:
        """The first saved model in the order k-means, DBSCAN, HDBSCAN."""
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()

        def there(p: str) -> bool:
            hp = jvm.org.apache.hadoop.fs.Path(p)
            return hp.getFileSystem(conf).exists(hp)

        found = next((a for a in ALGORITHMS if there(f"{path}/centers_{a}")), None)
        if found is None:
            raise FileNotFoundError(f"no saved model below {path}")
        s = spark.read.parquet(f"{path}/settings").first()
        return cls(list(s["features"]), ScaleModel.load(f"{path}/scale"), s["median_distance"],
                   **centres(spark.read.parquet(f"{path}/centers_{found}"), s.asDict().get("radius")),
                   fill=s["fill"], res=s["res"], **lookups(spark.read.parquet(f"{path}/segments")))


def centres(table: DataFrame, radius: float | None = None) -> dict:
    """Centroids as a scorer takes them: literals if they are few and numbered from 0, else the table ``(segment_id, centre)``."""
    rows, fits = small_table(table.select("segment_id", "centre"), MAX_CENTRES)
    rows = sorted(rows, key=lambda r: r["segment_id"])
    if radius is None and fits and [r["segment_id"] for r in rows] == list(range(len(rows))):
        return {"centers": [list(r["centre"]) for r in rows] or None}
    return {"centers": None, "references": table.select("segment_id", "centre"), "radius": radius}


def lookups(dim: DataFrame) -> dict:
    """The segment dimension as a scorer takes it: fixed lookups, or a table if there are more than ``MAX_SEGMENTS``."""
    dim = dim.select("segment_id", *DIMENSION)
    if small_table(dim.select("segment_id"), MAX_SEGMENTS)[1]:
        return dict(zip(("names", "descriptions", "plans"), metadata(dim, MAX_SEGMENTS), strict=True))
    return {"dimension": dim}


def joined_labels(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Names, descriptions and plans from the dimension where it has them; ``df`` holds the fallbacks."""
    own = [f"{c}_" for c in DIMENSION]
    dim = dim.dropDuplicates(["segment_id"]).select("segment_id", *[F.col(c).alias(o) for c, o in zip(DIMENSION, own, strict=True)])
    # the salt of join_small is no expression for a stream
    df = df.join(dim, "segment_id", "left") if df.isStreaming else join_small(df, dim, "segment_id", max_rows=MAX_SEGMENTS)
    name, description, plans = own
    return df.withColumns({
        "segment_name": F.coalesce(F.nullif(name, F.lit("")), "segment_name"),
        "segment_description": F.coalesce(F.nullif(description, F.lit("")), "segment_description"),
        "recommended_plans": F.when(F.size(plans) > 0, F.slice(plans, 1, 3)).otherwise(F.col("recommended_plans"))}).drop(*own)


def metadata(dim: DataFrame, max_segments: int = MAX_SEGMENTS) -> tuple[dict, dict, dict]:
    """Names, descriptions and plans by segment id from the (small, checked) segment dimension."""
    rows, fits = small_table(dim.select("segment_id", "segment_name", "segment_description", "plans"), max_segments)
    if not fits:
        raise ValueError(f"more than {max_segments} segments; join the dimension instead of inlining it")
    return ({r[0]: r[1] for r in rows if r[1]}, {r[0]: r[2] for r in rows if r[2]},
            {r[0]: list(r[3]) for r in rows if r[3]})


def fill_defaults(df: DataFrame) -> DataFrame:
    """Absent or missing request fields get their defaults; position names of events are understood."""
    def either(*names: str):
        present = [F.col(c).cast("double") for c in names if c in df.columns]
        return F.coalesce(*present, F.lit(None).cast("double"))

    cols = {"subscriber_id": F.coalesce(F.col("subscriber_id"), F.lit("unknown")) if "subscriber_id" in df.columns
            else F.lit("unknown")}
    for c, v in K.SCORE_DEFAULTS.items():
        names = (c, "call_minutes") if c == "call_minutes_monthly" else (c,)
        cols[c] = F.coalesce(either(*names), F.lit(v))
    cols["senior_citizen"] = (F.coalesce(F.col("senior_citizen").cast("int"), F.lit(K.SENIOR_DEFAULT))
                              if "senior_citizen" in df.columns else F.lit(K.SENIOR_DEFAULT))
    cols["home_lat"], cols["home_lon"] = either("home_lat", "location_lat"), either("home_lon", "location_lon")
    return df.withColumns(cols)


def split_requests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with ``errors``) requests."""
    checked = request_errors(df)
    return checked.filter("is_valid").drop("errors", "is_valid"), checked.filter("NOT is_valid").drop("is_valid")


def scorer_from(model: PipelineModel, centers: Sequence[Sequence[float]] | None, dim: DataFrame | None = None,
                **kw) -> Scorer:
    """Scorer from a fitted feature pipeline, centroids and the segment dimension."""
    scale = next(s for s in model.stages if isinstance(s, ScaleModel))
    mobility = next(s for s in model.stages if s.__class__.__name__ == "MobilityModel")
    return Scorer(scale.getOrDefault(scale.columns), scale, mobility.getOrDefault(mobility.medianDistance), centers,
                  **(lookups(dim) if dim is not None else {}), **kw)
