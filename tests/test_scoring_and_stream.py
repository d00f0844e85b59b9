from __future__ import annotations

import json

import pytest
from frames import sample_frame
from pyspark.sql import functions as F

from hexcohort.operators.kmeans import fit_kmeans
from hexcohort.plans.feature_pipeline import fit_features
from hexcohort.plans.scoring import Scorer, scorer_from
from hexcohort.plans.segmentation import run, write_outputs
from hexcohort.streaming import scoring as ST
from hexcohort.streaming.usage_windows import time_bucket_stream


@pytest.fixture(scope="module")
def scorer(spark, sample):
    model, table = fit_features(sample.drop("same_h3_zone"))
    dim = spark.createDataFrame([(0, "Social Hub", "d0", ["social_unlimited", "young_pro", "weekend_explorer", "x"])],
                                "segment_id int, segment_name string, segment_description string, plans array<string>")
    return scorer_from(model, fit_kmeans(table, 3, 2).centers, dim)


def test_scores(spark, sample, scorer):
    s = scorer.score(sample.drop("same_h3_zone")).toPandas()
    assert set(s.segment_id) <= {0, 1, 2} and s.confidence.between(0, 1).all()
    assert set(s.segment_name) <= {"Social Hub", "Segment 1", "Segment 2"}
    assert s.loc[s.segment_id == 0, "recommended_plans"].map(len).eq(3).all()


def test_minimal_request_is_scored_with_defaults(spark, scorer):
    r = scorer.score(spark.createDataFrame([("only",)], "subscriber_id string")).first()
    assert r["subscriber_id"] == "only" and r["h3_home_cell"] is None


def test_save_and_load(spark, sample, scorer, tmp_path):
    scorer.save(spark, str(tmp_path / "m"))
    again = Scorer.load(spark, str(tmp_path / "m"))
    req = sample.drop("same_h3_zone")
    assert again.score(req).exceptAll(scorer.score(req)).isEmpty()
    dens = Scorer(scorer.features, scorer.scale, scorer.median_distance, None, fill="zero")
    dens.save(spark, str(tmp_path / "d"), "dbscan")
    assert Scorer.load(spark, str(tmp_path / "d")).score(req).select("segment_id", "confidence").distinct().collect()[0][:] == (0, 0.75)
    with pytest.raises(FileNotFoundError):
        Scorer.load(spark, str(tmp_path / "none"))


def test_many_segments_are_joined(spark, sample, scorer, tmp_path):
    few = spark.createDataFrame([(0, "Zero", "d0", ["a", "b", "c", "d"]), (1, "", None, [])],
                                "segment_id int, segment_name string, segment_description string, plans array<string>")
    many = few.union(spark.range(3, 10_100).selectExpr("cast(id AS int)", "'n' || id", "'d'", "array('p')"))
    model, _ = fit_features(sample.drop("same_h3_zone"))
    req = sample.drop("same_h3_zone")
    want, got = scorer_from(model, scorer.centers, few), scorer_from(model, scorer.centers, many)
    assert want.score(req).count() == req.count() and got.score(req).exceptAll(want.score(req)).isEmpty()
    assert got.score(req).count() == req.count()
    got.save(spark, str(tmp_path / "m"))
    again = Scorer.load(spark, str(tmp_path / "m"))
    again.save(spark, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m/segments")).count() == many.count()
    assert Scorer.load(spark, str(tmp_path / "m")).score(req).exceptAll(want.score(req)).isEmpty()


def test_scoring_plan_has_no_python_join_or_shuffle(spark, sample, scorer):
    plan = scorer.score(sample)._jdf.queryExecution().executedPlan().toString()
    for word in ("BatchEvalPython", "ArrowEvalPython", "Join", "Exchange"):
        assert word not in plan


def lines(n, start=0):
    pdf = sample_frame(n + start).iloc[start:].drop(columns=["same_h3_zone"])
    return [json.dumps({**r, "event_time": "2024-05-01T10:00:00Z", "location_lat": -6.2, "location_lon": 106.8})
            for r in pdf.to_dict("records")]


def test_stream_equals_batch_and_survives_restart(spark, scorer, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text("\n".join(lines(20) + ['{"subscriber_id": "cut', "not json"]) + "\n")
    args = (scorer, str(tmp_path / "out"), str(tmp_path / "dead"), str(tmp_path / "ck"))
    q = ST.run_to_files(ST.read_text_stream(spark, str(src)), *args)
    q.awaitTermination()
    assert sum(c["processed"] for c in q.counters) == 22 and sum(c["errors"] for c in q.counters) == 2
    (src / "b.json").write_text("\n".join(lines(15, 20)) + "\n")
    ST.run_to_files(ST.read_text_stream(spark, str(src)), *args).awaitTermination()    # same checkpoint: only the new file
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    assert got.count() == 35 and got.select("subscriber_id").distinct().count() == 35
    assert spark.read.parquet(str(tmp_path / "dead")).count() == 2
    events = ST.events_of(ST.decode(spark.read.text(str(src))))
    batch = ST.score_events(events, scorer)
    keep = [c for c in batch.columns if c != "scored_at"]
    assert batch.select(keep).exceptAll(got.select(keep)).isEmpty()
    msg = json.loads(ST.as_messages(batch).first()["value"])
    assert set(msg) >= {"subscriber_id", "segment_id", "confidence", "recommended_plans", "event_time", "scored_at"}


def test_event_field_names(spark, scorer):
    ev = spark.createDataFrame([('{"subscriber_id": "a", "call_minutes": 900.0, "location_lat": -6.2, "location_lon": 106.8}',)], "value string")
    other = spark.createDataFrame([('{"subscriber_id": "a", "call_minutes_monthly": 900.0, "location_lat": -6.2, "location_lon": 106.8}',)], "value string")
    a, b = [scorer.score(ST.events_of(ST.decode(e))) for e in (ev, other)]
    assert a.exceptAll(b).isEmpty() and a.first()["h3_home_cell"].startswith("hx8_")


def test_watermarked_shares(spark, tmp_path):
    rows = [(1, "2024-01-01 07:00:00", 3.0), (1, "2024-01-01 19:00:00", 1.0), (2, "2024-01-01 23:00:00", 5.0), (9, "2024-03-01 00:00:00", 1.0)]
    df = spark.createDataFrame(rows, "user_id long, ts string, value double").withColumn("ts", F.to_timestamp("ts"))
    df.write.parquet(str(tmp_path / "ev"))
    stream = time_bucket_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "ev")), "1 day", "1 hour")
    q = (stream.writeStream.format("memory").queryName("shares").outputMode("append").trigger(availableNow=True)
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.awaitTermination()
    got = {r["user_id"]: r for r in spark.table("shares").collect()}
    assert got[1]["morning_data_ratio"] == 0.75 and got[1]["evening_data_ratio"] == 0.25 and got[2]["night_data_ratio"] == 1.0
    assert 9 not in got      # its window is still open


def test_whole_job(spark, sample, tmp_path):
    subs = sample.drop("same_h3_zone").withColumn("home_h3", F.concat(F.lit("hx8_1_"), F.pmod(F.crc32("subscriber_id"), F.lit(3)).cast("string")))
    res = run(subs, k=3, n_init=2, check=False)
    assert res.metrics.first()["n_clusters"] == 3 and res.dimension.count() == 3 and res.density.count() > 0
    write_outputs(res, str(tmp_path / "o"), "2024-05")
    labels = spark.read.parquet(str(tmp_path / "o" / "segment_labels"))
    assert labels.filter("refresh = '2024-05'").count() == 200
    again = Scorer.load(spark, str(tmp_path / "o" / "model")).score(subs)
    same = again.join(labels.select("subscriber_id", F.col("segment_id").alias("s")), "subscriber_id").filter("segment_id = s").count()
    assert same == 200
    with pytest.raises(ValueError):
        run(subs, check=True)


def test_whole_job_by_the_density_hierarchy(spark, sample):
    """Two copies of the sample, each drawn together and far from the other, are two groups; the job ends with their scores."""
    numbers = [c for c in sample.columns if c not in ("subscriber_id", "same_h3_zone")]
    near = sample.withColumns({c: F.col(c) * 0.01 for c in numbers})
    far = near.withColumn("subscriber_id", F.concat(F.lit("far_"), "subscriber_id")).withColumns({c: F.col(c) + 0.5 for c in numbers})
    subs = near.unionByName(far).drop("same_h3_zone")
    res = run(subs, algorithm="hdbscan", eps=0.0, check=False)
    labels = {(r.subscriber_id.startswith("far_"), r.segment_id) for r in res.segmented.filter("segment_id >= 0").select("subscriber_id", "segment_id").collect()}
    assert labels and res.segmented.count() == 400 and len({seg for _, seg in labels}) == len(labels)      # no segment mixes the two
    assert res.scorer.score(subs).count() == 400
    assert res.metrics.first()["n_clusters"] == len(labels)


def test_whole_job_by_density_scores_new_rows_by_their_nearest_core_point(spark, sample, tmp_path):
    numbers = [c for c in sample.columns if c not in ("subscriber_id", "same_h3_zone")]
    near = sample.withColumns({c: F.col(c) * 0.01 for c in numbers})
    far = near.withColumn("subscriber_id", F.concat(F.lit("far_"), "subscriber_id")).withColumns({c: F.col(c) + 0.5 for c in numbers})
    subs = near.unionByName(far).drop("same_h3_zone")
    res = run(subs, algorithm="dbscan", eps=3.0, min_samples=4, check=False)
    was = res.segmented.select("subscriber_id", F.col("segment_id").alias("was"))
    got = res.scorer.score(subs).persist()
    assert was.filter("was >= 0").count() > 0
    assert got.join(was, "subscriber_id").filter("(segment_id < 0) <> (was < 0)").count() == 0
    res.scorer.save(spark, str(tmp_path / "m"), "dbscan")
    again = Scorer.load(spark, str(tmp_path / "m"))
    assert again.centers is None and again.radius == 3.0
    assert again.score(subs).exceptAll(got).isEmpty()
    again.save(spark, str(tmp_path / "m"), "dbscan")                                      # read from the same path
    assert Scorer.load(spark, str(tmp_path / "m")).references.count() == res.scorer.references.count()
