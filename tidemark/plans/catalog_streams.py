"""Streaming jobs over the events file, run until what is there has been read.

Each returns the table the stream wrote. Where the result does not depend on the order
of arrival, the SQL twin computes it as a batch.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import vocab
from tidemark.functions.expressions import hour_start
from tidemark.operators import drift, models, split
from tidemark.operators import features as ft
from tidemark.operators.clean import parse_time, standardise_text
from tidemark.plans.catalog_drift import _SPLIT
from tidemark.plans.catalog_features import scoring_requests
from tidemark.plans.catalog_models import stored_features
from tidemark.plans.registry import query, tidy
from tidemark.plans.standins import HOURLY_SQL, KEPT_SQL, hourly, readings_of, table, tidy_readings
from tidemark.session import run_folder
from tidemark.sources import requests as rq
from tidemark.sources.readers import read_prediction_log
from tidemark.streaming import jobs


def event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return jobs.file_stream(spark, sf, schema, name_filter="events.parquet")


def request_stream(spark, sf):
    """Readings as requests, received when the event happened."""
    rows = readings_of(event_stream(spark, sf).withColumn("received_at", F.col("ts").cast("timestamp")))
    rows = rows.transform(standardise_text).transform(parse_time)
    return rows.withColumnRenamed("received_at", "request_timestamp").withColumn("is_holiday", F.col("holiday").isNotNull())


@query()
def stream_score(spark, sf):
    """Score a stream of checked requests into the prediction log."""
    feat = stored_features(spark, sf)
    train, _, _ = split.time_split(feat, "date_time")
    return score_stream_with(spark, sf, feat, models.fit_regressors(train, only=["Linear Regression"])["Linear Regression"])


def score_stream_with(spark, sf, feat, model):
    """The log of all checked requests of the stream, scored by ``model``."""
    stats = ft.moments(feat, ["temp"]).first()["temp"]
    requests = rq.accepted(rq.check_requests(request_stream(spark, sf)))
    scored = models.score_requests(requests, model, F.lit(stats["mean"]), F.lit(stats["std"]), 1)
    folder = run_folder(spark, "scores")
    jobs.append_scores(scored, f"{folder}/log", f"{folder}/checkpoint").awaitTermination()
    return read_prediction_log(spark, f"{folder}/log", "parquet")


def _literal_reference(spark, sf):
    """Reference statistics as plain numbers for a stream: 4 moments, a share per category, one rate."""
    rows = tidy_readings(spark, sf).transform(ft.add_holiday)
    train, _, _ = split.time_split(rows, "date_time")
    reference = drift.build_reference(train)
    moments = {r["field"]: (r["ref_mean"], r["ref_std"]) for r in reference.continuous.collect()}
    shares = {r["category"]: r["ref_share"] for r in reference.shares.collect()}
    return moments, shares, reference.holiday.first()["holiday_rate"]


def _windowed_sql() -> str:
    fields = "\nUNION ALL ".join(
        f"""SELECT ws, n, 'feature mean: {f}' AS "check", m_{f} AS live, r.m AS ref, CASE WHEN r.s > 0 THEN (m_{f} - r.m) / r.s ELSE 0 END AS measure,
  CASE WHEN r.s > 0 AND abs((m_{f} - r.m) / r.s) > 1 THEN 'ALERT' ELSE 'PASS' END AS status
FROM win, (SELECT avg({f}) AS m, stddev_samp({f}) AS s FROM train) r"""
        for f in vocab.CONTINUOUS_FIELDS
    )
    means = ", ".join(f"avg({f}) AS m_{f}" for f in vocab.CONTINUOUS_FIELDS)
    return f"""{_SPLIT},
log AS (SELECT tidy.* REPLACE (CASE WHEN weather_main = 'Squall' AND clouds_all % 4 = 0 THEN 'Tornado' ELSE weather_main END AS weather_main), ts, date_trunc('day', ts) AS ws, CASE WHEN holiday IS NULL THEN 0 ELSE 1 END AS hol
  FROM tidy JOIN events ON event_id = _ord),
closed AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM log),
win AS (SELECT ws, count(*) AS n, count(weather_main) AS nw, {means}, avg(hol) AS hr FROM log GROUP BY 1),
refs AS (SELECT weather_main, count(*) / (SELECT CAST(count(weather_main) AS DOUBLE) FROM train) AS share FROM train GROUP BY 1),
cats AS (SELECT ws, weather_main, count(*) AS c FROM log WHERE weather_main IS NOT NULL GROUP BY 1, 2),
found AS (
{fields}
UNION ALL SELECT ws, n, 'weather_main share: ' || cats.weather_main, c / CAST(nw AS DOUBLE), coalesce(share, 0),
  c / CAST(nw AS DOUBLE) / nullif(share, 0),
  CASE WHEN coalesce(share, 0) = 0 OR c / CAST(nw AS DOUBLE) / share > 3 THEN 'ALERT' ELSE 'PASS' END
FROM cats JOIN win USING (ws) LEFT JOIN refs ON refs.weather_main = cats.weather_main
UNION ALL SELECT ws, n, 'is_holiday rate', hr, r, hr / nullif(r, 0),
  CASE WHEN CASE WHEN r = 0 THEN hr > 0 ELSE hr / nullif(r, 0) > 3 END THEN 'ALERT' ELSE 'PASS' END
FROM win, (SELECT avg(is_holiday) AS r FROM train))
SELECT ws AS window_start, n AS n_live, "check", round(live, 6) AS live_value, round(CAST(ref AS DOUBLE), 6) AS reference_value,
  round(measure, 6) AS measure, status FROM found, closed WHERE ws + INTERVAL 1 DAY <= mark"""


@query(_windowed_sql())
def stream_drift(spark, sf):
    """Findings of the windows the watermark has closed; some requests are of a category training never saw."""
    unseen = (F.col("weather_main") == "Squall") & (F.col("clouds_all") % 4 == 0)
    live = request_stream(spark, sf).withColumn("weather_main", F.when(unseen, "Tornado").otherwise(F.col("weather_main")))
    out = jobs.run_to_table(jobs.drift_findings_stream(live, *_literal_reference(spark, sf)), "drift").drop("window_end")
    return tidy(out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


_STREAMED = "_ord, holiday, temp, rain_1h, snow_1h, clouds_all, weather_main, weather_description, date_time, traffic_volume"


@query(f"""WITH {KEPT_SQL}
SELECT _ord, holiday, round(temp, 6) AS temp, round(rain_1h, 6) AS rain_1h, round(snow_1h, 6) AS snow_1h,
  CAST(clouds_all AS BIGINT) AS clouds_all, weather_main, weather_description, date_time, CAST(traffic_volume AS BIGINT) AS traffic_volume
FROM kept WHERE date_time <= (SELECT max(date_time) FROM tidy) - INTERVAL 1 HOUR""")
def stream_dedupe(spark, sf):
    """The first reading, in the order of the file, of every hour that the watermark has passed: whole rows."""
    rows = request_stream(spark, sf).withColumn("date_time", F.col("date_time").cast("timestamp"))
    kept = jobs.run_to_table(jobs.first_per_time(rows.select(*_STREAMED.split(", "))), "dedupe")
    return tidy(kept.withColumn("date_time", F.col("date_time").cast("timestamp_ntz")))


@query(f"""WITH {HOURLY_SQL},
log AS (SELECT event_id, ts AS request_timestamp, date_trunc('hour', ts) + INTERVAL 1 HOUR AS t, value * 10 AS p FROM events),
seen AS (SELECT * FROM h WHERE hour % 6 <> 3),
mark AS (SELECT least((SELECT max(ts) FROM events), (SELECT max(date_time) + INTERVAL 1 HOUR FROM seen)) - INTERVAL 1 HOUR AS at)
SELECT event_id, request_timestamp, log.t AS input_date_time, round(p, 6) AS predicted_traffic_volume,
  CAST(traffic_volume AS DOUBLE) AS actual_volume, s.date_time + INTERVAL 1 HOUR AS observed_at,
  round(abs(p - traffic_volume), 6) AS absolute_error
FROM log LEFT JOIN seen s ON s.date_time = log.t AND s.date_time + INTERVAL 1 HOUR >= request_timestamp
  AND s.date_time + INTERVAL 1 HOUR <= request_timestamp + INTERVAL 7 DAY, mark
WHERE s.date_time IS NOT NULL OR request_timestamp + INTERVAL 7 DAY < mark.at""")
def stream_truth(spark, sf):
    """Every event predicts the next hour; the hours arrive as files when they are over.

    The sensor reports nothing at 3, 9, 15 and 21; such requests appear without truth after 7 days.
    """
    log = event_stream(spark, sf).select(
        "event_id",
        F.col("ts").cast("timestamp").alias("request_timestamp"),
        (hour_start("ts") + F.make_dt_interval(F.lit(0), F.lit(1))).alias("input_date_time"),
        (F.col("value") * 10).alias("predicted_traffic_volume"),
    )
    over = F.col("date_time") + F.make_dt_interval(F.lit(0), F.lit(1))
    hours = hourly(spark, sf).where(F.col("hour") % 6 != 3)
    hours = hours.select("date_time", "traffic_volume", over.cast("timestamp").alias("observed_at"))
    folder = run_folder(spark, "observed")
    hours.write.parquet(folder)
    observed = jobs.file_stream(spark, folder, hours.schema)
    out = jobs.run_to_table(jobs.join_late_truth(log, observed, keep=["event_id"]), "truth")
    return tidy(
        out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("request_timestamp", "observed_at")})
    )
