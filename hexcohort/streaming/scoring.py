"""Streaming twin of batch scoring: JSON events in, JSON scores out."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from hexcohort import schema as S
from hexcohort.plans.scoring import Scorer


def read_kafka(spark: SparkSession, servers: str, topic: str = "cdr-events", max_per_trigger: int | None = None,
               starting: str = "latest") -> DataFrame:
    """``value`` as text.  Needs the Kafka connector on the class path."""
    reader = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic).option("startingOffsets", starting))
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def read_text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """JSON lines from a folder, one event per line."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def decode(raw: DataFrame) -> DataFrame:
    """Adds ``event`` (NULL when the text is not a JSON object of the event schema) and ``is_bad``.

    A broken text fails in permissive mode into a corrupt-record column, which
    tells it apart from an object whose fields are all absent.
    """
    ddl = T.StructType(S.EVENT.fields + [T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json("value", ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    bad = F.col("value").isNull() | F.col("event").isNull() | F.col("event._corrupt").isNotNull()
    return raw.withColumn("event", parsed).withColumn("is_bad", bad)


def events_of(decoded: DataFrame) -> DataFrame:
    return decoded.filter(~F.col("is_bad")).select("event.*").drop("_corrupt")


def dead_letters(decoded: DataFrame) -> DataFrame:
    return decoded.filter("is_bad").select("value")


def score_events(events: DataFrame, scorer: Scorer) -> DataFrame:
    """Scores with ``event_time`` and ``scored_at``; works on batch and streaming frames alike."""
    scored = scorer.score(events, keep=["event_time"])
    return (scored.withColumn("event_time", F.coalesce("event_time", F.lit("")))
            .withColumn("scored_at", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
                                                   "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")))


def as_messages(scored: DataFrame) -> DataFrame:
    """Kafka-shaped rows: key and JSON value."""
    return scored.select(F.col("subscriber_id").alias("key"), F.to_json(F.struct("*")).alias("value"))


def write_kafka(scored: DataFrame, servers: str, checkpoint: str, topic: str = "segment-scores",
                seconds: float = 1.0) -> StreamingQuery:
    """At-least-once delivery: acknowledged by all replicas, offsets kept in the checkpoint."""
    return (as_messages(scored).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("kafka.acks", "all").option("kafka.retries", "3")
            .option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start())


def run_to_files(raw: DataFrame, scorer: Scorer, out: str, dead: str, checkpoint: str,
                 available_now: bool = True, seconds: float = 1.0) -> StreamingQuery:
    """Scores and dead letters to Parquet, exactly once per micro-batch number.

    Both sinks get the batch in one go; a batch that is replayed after a crash
    overwrites its own folder.  Counters are taken in the same pass.
    """
    def write(batch: DataFrame, number: int) -> None:
        decoded = decode(batch).persist(StorageLevel.MEMORY_AND_DISK)       # read and parse the source once for both sinks
        try:
            seen = Observation()
            counted = decoded.observe(seen, F.count(F.lit(1)).alias("processed"), F.count_if("is_bad").alias("errors"))
            score_events(events_of(counted), scorer).write.mode("overwrite").parquet(f"{out}/batch={number}")
            dead_letters(decoded).write.mode("overwrite").parquet(f"{dead}/batch={number}")
            progress.append({"batch": number, **seen.get})
        finally:
            decoded.unpersist()

    progress: list[dict] = []
    writer = raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{seconds} seconds")
    query = writer.start()
    query.counters = progress
    return query
