from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import models, split
from tidemark.operators import features as ft
from tidemark.plans.standins import feature_table
from tidemark.session import materialize
from tidemark.sources import readers, schemas
from tidemark.streaming import jobs

START = datetime(2024, 1, 1, tzinfo=None)


@pytest.fixture
def drop(spark, tmp_path):
    """A folder fed file by file, and the stream over it (one file per micro-batch)."""
    source = tmp_path / "in"
    source.mkdir()
    count = iter(range(100))

    def add(rows, schema):
        out = str(tmp_path / f"part{next(count)}")
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(out)
        import shutil
        from pathlib import Path

        for f in Path(out).glob("*.parquet"):
            shutil.copy(f, source / f"{f.stem}-{next(count):03d}.parquet")

    def stream(schema):
        return jobs.file_stream(spark, str(source), schema, files_per_batch=1)

    return add, stream


def run_now(df, path, tmp_path):
    """One run over the files present; the checkpoint remembers what was read."""
    jobs.to_files(df, str(tmp_path / path), str(tmp_path / f"{path}-checkpoint")).awaitTermination()


def test_stream_scores_equal_batch_scores(spark, small, drop, tmp_path):
    feat = materialize(feature_table(spark, small).where("date_time is not null"), "stream-features")
    train, _, _ = split.time_split(feat, "date_time")
    model = models.fit_regressors(train, forest={"numTrees": 3, "maxDepth": 3, "minInstancesPerNode": 5})["Random Forest"]
    stats = ft.moments(feat, ["temp"]).first()["temp"]
    requests = feat.select(
        F.col("date_time").cast("timestamp").alias("request_timestamp"), "date_time", "weather_main", "temp", "rain_1h",
        "snow_1h", F.col("clouds_all").cast("double").alias("clouds_all"), (F.col("is_holiday") == 1).alias("is_holiday"),
    )
    rows = requests.orderBy("date_time").limit(30).collect()
    add, stream = drop
    for i in range(0, 30, 10):
        add(rows[i:i + 10], requests.schema)

    def score(df):
        return models.score_requests(df, model, F.lit(stats["mean"]), F.lit(stats["std"]), 2)

    log = str(tmp_path / "log")
    jobs.append_scores(score(stream(requests.schema)), log, str(tmp_path / "log-checkpoint")).awaitTermination()
    got = readers.read_prediction_log(spark, log, "parquet").select("input_date_time", "predicted_traffic_volume")
    want = score(spark.createDataFrame(rows, requests.schema)).select(
        "input_date_time", F.round("predicted_traffic_volume", 2).alias("predicted_traffic_volume")
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # A second run finds nothing new and appends nothing.
    jobs.append_scores(score(stream(requests.schema)), log, str(tmp_path / "log-checkpoint")).awaitTermination()
    assert readers.read_prediction_log(spark, log, "parquet").count() == 30


def log_row(at, temp=290.0, weather="Clear", holiday=False):
    return (at, at, weather, temp, 0.0, 0.0, 10.0, holiday, 100.0, 1)


def test_windowed_drift_drops_late_rows(spark, drop, tmp_path):
    add, stream = drop
    day = timedelta(days=1)
    add([log_row(START, 290.0), log_row(START + timedelta(hours=5), 300.0, "Snow")], schemas.PREDICTION_LOG)
    add([log_row(START + day, 400.0, "Clear", True), log_row(START + day, 400.0, "Tornado", True)], schemas.PREDICTION_LOG)
    add([log_row(START + 3 * day, 290.0)], schemas.PREDICTION_LOG)
    # A batch drops what was late when the batch before it ended, so let one more pass.
    add([log_row(START + 3.5 * day, 290.0)], schemas.PREDICTION_LOG)
    # Far behind the watermark by now: must not change any window.
    add([log_row(START, 999.0)], schemas.PREDICTION_LOG)
    add([log_row(START + 6 * day, 290.0)], schemas.PREDICTION_LOG)
    moments = {"temp": (290.0, 10.0), "rain_1h": (0.0, 0.0), "snow_1h": (0.0, 0.0), "clouds_all": (10.0, 1.0)}
    shares = {"Clear": 0.9, "Snow": 0.1}
    source = stream(schemas.PREDICTION_LOG)
    run_now(jobs.windowed_statistics(source), "drift", tmp_path)
    # The same findings as a stream of their own.
    run_now(jobs.drift_findings_stream(stream(schemas.PREDICTION_LOG), moments, shares, 0.5), "findings", tmp_path)
    rows = jobs.windowed_drift(spark.read.parquet(str(tmp_path / "drift")), moments, shares, 0.5).collect()
    by = {(r["window_start"], r["check"]): r for r in rows}
    first = by[(START, "feature mean: temp")]
    assert (first["n_live"], first["live_value"], first["status"]) == (2, 295.0, "PASS")
    assert by[(START, "weather_main share: Snow")]["status"] == "ALERT"
    assert by[(START + day, "feature mean: temp")]["status"] == "ALERT"
    assert (START + day, "weather_main share: Snow") not in by
    assert by[(START + day, "is_holiday rate")]["live_value"] == 1.0
    # A category that training has not seen, and no list names, alerts by itself.
    unseen = by[(START + day, "weather_main share: Tornado")]
    assert (unseen["live_value"], unseen["reference_value"], unseen["status"]) == (0.5, 0.0, "ALERT")
    # The same rows as a batch, the late one left out.
    batch = spark.createDataFrame(
        [log_row(START, 290.0), log_row(START + timedelta(hours=5), 300.0, "Snow"), log_row(START + day, 400.0, "Clear", True),
         log_row(START + day, 400.0, "Tornado", True)],
        schemas.PREDICTION_LOG,
    )
    want = jobs.windowed_drift(jobs.windowed_statistics(batch), moments, shares, 0.5).collect()
    got = [r for r in rows if r["window_start"] <= START + day]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, map(tuple, want)))
    streamed = spark.read.parquet(str(tmp_path / "findings")).collect()
    assert sorted(map(str, map(tuple, streamed))) == sorted(map(str, map(tuple, rows))) and len(rows) > len(want)
    of_batch = jobs.drift_findings_stream(batch, moments, shares, 0.5).collect()
    assert sorted(map(str, map(tuple, of_batch))) == sorted(map(str, map(tuple, want)))


READING = "_ord long, date_time timestamp, sensor string, note string"


def test_the_smallest_place_wins_whenever_it_arrives(spark, drop, tmp_path):
    add, stream = drop
    hour = timedelta(hours=1)
    add([(7, START, "a", "second"), (8, START + hour, "a", "kept"), (9, START, "b", "kept")], READING)
    add([(2, START, "a", "kept"), (5, None, "a", "no time"), (11, START + hour, "a", "third")], READING)
    add([(20, START + 5 * hour, "a", "kept")], READING)
    add([(21, START + 9 * hour, "a", "kept")], READING)
    # Behind the watermark of 8 hours by now: its hour is closed.
    add([(1, START, "a", "late")], READING)
    add([(30, START + 20 * hour, "a", "still open")], READING)
    schema = spark.createDataFrame([], READING).schema
    run_now(jobs.first_per_time(stream(schema), others=["sensor"]), "first", tmp_path)
    got = spark.read.parquet(str(tmp_path / "first")).collect()
    assert sorted(map(tuple, got)) == [
        (2, START, "a", "kept"), (8, START + hour, "a", "kept"), (9, START, "b", "kept"), (20, START + 5 * hour, "a", "kept"),
        (21, START + 9 * hour, "a", "kept"),
    ]
    # A second run emits nothing twice.
    run_now(jobs.first_per_time(stream(schema), others=["sensor"]), "first", tmp_path)
    assert spark.read.parquet(str(tmp_path / "first")).count() == 5


def test_truth_that_arrives_later(spark, tmp_path):
    hour = timedelta(hours=1)
    log = spark.createDataFrame(
        [(START, START + hour, 50.0), (START, START + 2 * hour, 10.0), (START, START + 30 * hour, 1.0), (START + timedelta(days=8), START + 30 * hour, 2.0)],
        "request_timestamp timestamp, input_date_time timestamp_ntz, predicted_traffic_volume double",
    )
    seen = spark.createDataFrame(
        [(START + hour, START + hour, 40), (START + 2 * hour, START + timedelta(days=9), 10), (START + 5 * hour, START + 5 * hour, 3)],
        "date_time timestamp_ntz, observed_at timestamp, traffic_volume int",
    )
    log.write.parquet(str(tmp_path / "log"))
    seen.write.parquet(str(tmp_path / "seen"))
    streams = [jobs.file_stream(spark, str(tmp_path / n), df.schema) for n, df in (("log", log), ("seen", seen))]
    run_now(jobs.join_late_truth(*streams), "truth", tmp_path)
    rows = spark.read.parquet(str(tmp_path / "truth")).collect()
    # Two requests wait in vain for 7 days and appear once; the last may still get its truth.
    known = lambda r: (r["predicted_traffic_volume"], r["actual_volume"], r["absolute_error"])
    assert sorted(map(known, rows), key=str) == [(1.0, None, None), (10.0, None, None), (50.0, 40.0, 10.0)]
    batch = jobs.join_late_truth(log, seen).collect()
    assert sorted(map(known, batch), key=str) == [(1.0, None, None), (10.0, None, None), (2.0, None, None), (50.0, 40.0, 10.0)]
    assert list(map(known, jobs.join_late_truth(log, seen, unmatched=False, salts=3).collect())) == [(50.0, 40.0, 10.0)]
