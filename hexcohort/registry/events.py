"""Summaries of raw events, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexcohort.functions.expr import out
from hexcohort.operators import mobility_events as M
from hexcohort.operators.density import distinct_over, distinct_sketches
from hexcohort.registry import sql as Q
from hexcohort.registry.clustering import SCORE_SQL, labelled_scorer
from hexcohort.registry.core import query
from hexcohort.sources.derive import subscribers, table
from hexcohort.sources.scratch import materialize, scratch_path
from hexcohort.streaming import scoring as S
from hexcohort.streaming.usage_windows import time_bucket_stream

_PARTS = ("morning", "afternoon", "evening", "night")
_PART = ("CASE WHEN hour(ts) >= 6 AND hour(ts) < 12 THEN 'morning' WHEN hour(ts) >= 12 AND hour(ts) < 18 THEN 'afternoon' "
         "WHEN hour(ts) >= 18 AND hour(ts) < 22 THEN 'evening' ELSE 'night' END")
_RATIOS = ", ".join(f"{Q.out(f'coalesce(sum(value) FILTER (part = {Q.txt(p)}), 0e0)/sum(value)')} AS {p}_data_ratio" for p in _PARTS)


@query("time_bucket_ratios", Q.with_(e=f"SELECT *, {_PART} AS part FROM events") + f"SELECT user_id, {_RATIOS} FROM e GROUP BY user_id")
def time_bucket_ratios(spark: SparkSession, sf: str) -> DataFrame:
    df = M.time_bucket_ratios(table(spark, sf, "events"))
    return df.withColumns({f"{p}_data_ratio": out(F.col(f"{p}_data_ratio")) for p in _PARTS})


@query("weekend_ratio", f"SELECT user_id, {Q.out('coalesce(sum(value) FILTER (dayofweek(ts) IN (0, 6)), 0e0)/sum(value)')} AS weekend_data_ratio FROM events GROUP BY user_id")
def weekend_ratio(spark: SparkSession, sf: str) -> DataFrame:
    df = M.weekend_ratio(table(spark, sf, "events"))
    return df.withColumn("weekend_data_ratio", out(F.col("weekend_data_ratio")))


@query("visit_entropy", Q.with_(c="SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2",
                                p="SELECT user_id, cast(n AS DOUBLE)/sum(n) OVER (PARTITION BY user_id) AS p FROM c")
       + f"SELECT user_id, {Q.out('-sum(p*ln(p+1e-10))')} AS mobility_entropy FROM p GROUP BY 1")
def visit_entropy(spark: SparkSession, sf: str) -> DataFrame:
    df = M.visit_entropy(table(spark, sf, "events"))
    return df.withColumn("mobility_entropy", out(F.col("mobility_entropy")))


@query("home_work_cells")
def home_work_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Home and work from positions given to each user's events by kind and hour."""
    e = table(spark, sf, "events")
    kind = F.pmod(F.xxhash64("user_id", F.when(F.hour("ts").between(9, 16), "event_type").otherwise("home")), F.lit(97)).cast("double")
    ping = e.select("user_id", "ts", (F.lit(-6.5) + F.lit(0.006) * kind).alias("lat"), (F.lit(106.6) + F.lit(0.005) * kind).alias("lon"))
    return M.home_work(ping, res=7)


# --- streams: the batch tables arrive as files and run through a query to the end ----------
def _event_lines(spark: SparkSession, sf: str) -> DataFrame:
    subs = subscribers(spark, sf).withColumnsRenamed(
        {"home_lat": "location_lat", "home_lon": "location_lon", "call_minutes_monthly": "call_minutes"})
    drop = [c for c in ("true_persona_name", "segment_id", "work_lat", "work_lon", "internet_service")]
    return subs.drop(*drop).withColumn("event_time", F.lit("2024-01-01T00:00:00Z")).select(F.to_json(F.struct("*")).alias("value"))


def _streamed(spark: SparkSession, lines: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    lines.write.text(path)
    return path


@query("stream_score", SCORE_SQL)
def stream_score(spark: SparkSession, sf: str) -> DataFrame:
    """All subscribers as JSON events through the streaming scorer; equals batch scoring."""
    src = _streamed(spark, _event_lines(spark, sf), "events_in")
    done, dead, ckpt = (scratch_path(spark, n) for n in ("scores", "dead", "ckpt"))
    q = S.run_to_files(S.read_text_stream(spark, src, max_files=4), labelled_scorer(spark, sf), done, dead, ckpt)
    q.awaitTermination()
    return spark.read.parquet(done).drop("batch", "event_time", "scored_at").withColumn(
        "recommended_plans", F.array_join("recommended_plans", ","))


@query("stream_decode", "SELECT is_bad, count(*) AS n FROM (SELECT cast(substr(concat('SUB_', lpad(cast(c_custkey AS VARCHAR(20)),8,'0')),5) AS BIGINT)%50 = 7 AS is_bad FROM customer) GROUP BY 1")
def stream_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Every 50th event is cut off and has to land among the dead letters."""
    key = F.regexp_extract("value", "SUB_0*([0-9]+)", 1).cast("bigint")
    lines = _event_lines(spark, sf)
    cut = F.col("value").substr(F.lit(1), F.length("value") - F.lit(9))
    src = _streamed(spark, lines.select(F.when(key % 50 == 7, cut).otherwise(F.col("value")).alias("value")), "events_cut")
    out_, ckpt = scratch_path(spark, "decoded"), scratch_path(spark, "ckpt")
    (S.decode(S.read_text_stream(spark, src)).select("is_bad").writeStream.format("parquet").option("path", out_)
     .option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out_).groupBy("is_bad").agg(F.count(F.lit(1)).alias("n"))


@query("stream_time_buckets", Q.with_(e=f"SELECT *, {_PART} AS part, time_bucket(INTERVAL 1 DAY, ts) AS w FROM events")
       + f"SELECT cast(epoch(w) AS BIGINT) AS window_start, user_id, {_RATIOS} FROM e GROUP BY w, user_id")
def stream_time_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """Daily shares by a watermarked streaming aggregation over the event table."""
    src = scratch_path(spark, "events_stream")
    e = table(spark, sf, "events")
    e.write.parquet(src)
    out_, ckpt = scratch_path(spark, "buckets"), scratch_path(spark, "ckpt")
    stream = spark.readStream.schema(e.schema).parquet(src)
    agg = time_bucket_stream(stream, "1 day", "7 days")

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_}/batch={number}")

    # update mode: a batch carries the windows it changed, closed windows leave the state
    (agg.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", ckpt)
     .trigger(availableNow=True).start().awaitTermination())
    shares = [f"{p}_data_ratio" for p in _PARTS]
    last = spark.read.parquet(out_).groupBy("window_start", "user_id").agg(F.max_by(F.struct(*shares), "batch").alias("s"))
    return last.select(F.unix_seconds("window_start").alias("window_start"), "user_id",
                       *[out(F.col(f"s.{c}")).alias(c) for c in shares])


# Events arrive in three parts by time; every tenth comes one part later, another tenth in the last part.  A row is too late if
# its day ended five days or more before the newest row of the parts before; a day is final five days after its end.
_ARRIVAL = Q.with_(
    span="SELECT min(epoch_us(ts)) AS lo, (max(epoch_us(ts)) - min(epoch_us(ts))) // 3 + 1 AS third FROM events",
    e=f"SELECT *, {_PART} AS part, (epoch_us(ts) - lo) // third AS p, epoch_us(time_bucket(INTERVAL 1 DAY, ts)) + 86400000000 AS ends FROM events, span",
    a="SELECT *, CASE event_id % 10 WHEN 0 THEN least(p + 1, 2) WHEN 1 THEN 2 ELSE p END AS arrives FROM e",
    seen="SELECT arrives, max(max(epoch_us(ts))) OVER (ORDER BY arrives) - 432000000000 AS mark FROM a GROUP BY arrives",
    kept="SELECT a.* FROM a LEFT JOIN seen ON seen.arrives = a.arrives - 1 WHERE seen.mark IS NULL OR a.ends > seen.mark")


@query("stream_late_events", _ARRIVAL + f"SELECT (ends - 86400000000) // 1000000 AS window_start, user_id, {_RATIOS} FROM kept "
       "WHERE ends <= (SELECT max(mark) FROM seen) GROUP BY ends, user_id")
def stream_late_events(spark: SparkSession, sf: str) -> DataFrame:
    """Final daily shares of a stream that is stopped and restarted twice while late and too late rows come in.

    Each part is written, taken by a new run of the query on the same checkpoint, and followed by the next.  State of a day
    leaves when the watermark passes its end, and its shares are appended once.
    """
    src, out_, ckpt = (scratch_path(spark, n) for n in ("late_in", "late_out", "ckpt"))
    e = table(spark, sf, "events")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = e.agg(F.min(us), F.max(us)).first()
    part = F.floor((us - F.lit(lo)) / F.lit((hi - lo) // 3 + 1))
    late = F.col("event_id") % 10
    arrives = F.when(late == 0, F.least(part + 1, F.lit(2))).when(late == 1, F.lit(2)).otherwise(part)
    shares = [f"{p}_data_ratio" for p in _PARTS]
    for number in range(3):
        e.filter(arrives == number).write.mode("append").parquet(src)
        agg = time_bucket_stream(spark.readStream.schema(e.schema).parquet(src), "1 day", "5 days")
        (agg.writeStream.outputMode("append").format("parquet").option("path", out_).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out_).select(F.unix_seconds("window_start").alias("window_start"), "user_id", *[out(F.col(c)).alias(c) for c in shares])


@query("distinct_users_span", "SELECT count(DISTINCT user_id) AS n_users, true AS sketch_is_close FROM events")
def distinct_users_span(spark: SparkSession, sf: str) -> DataFrame:
    """Users of all days together from one sketch per day, next to the exact number: within four standard errors of it."""
    events = spark.read.parquet(f"{sf}/events.parquet").select("user_id", F.to_date("ts").alias("day"))
    sketches = materialize(distinct_sketches(events, ["day"], "user_id"), "sketches")
    estimate = distinct_over(sketches).first()[0]
    close = F.abs(F.lit(estimate) - F.col("n_users")) <= 4 * 1.04 / 2 ** 7 * F.col("n_users")
    return events.agg(F.count_distinct("user_id").alias("n_users")).select("n_users", close.alias("sketch_is_close"))
