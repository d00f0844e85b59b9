"""Shared scratch space for written intermediate tables.

The folder comes from ``spark.checkpoint.dir`` of the session.  Only a local
session without that setting (tests) gets a temporary folder of its own.
Writing a table cuts lineage, survives the loss of executors, and gives the
planner true sizes for its broadcast decisions.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="hexcohort-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch root."""
    return f"{scratch_root(spark)}/hexcohort/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write once as Parquet and read back: one evaluation, known size, no lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Removes the files of a materialized table that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def small_table(df: DataFrame, max_rows: int = 10_000) -> tuple[list, bool]:
    """Rows of a table meant to be small, and whether it really is.

    At most ``max_rows + 1`` rows ever reach the driver; a caller that gets
    ``False`` has to take the shuffled way.
    """
    rows = df.limit(max_rows + 1).collect()
    return rows, len(rows) <= max_rows
