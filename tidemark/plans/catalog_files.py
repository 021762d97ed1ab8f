"""Sources and sinks as queries: what is written below the shared folder is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import vocab
from tidemark.operators import features as ft
from tidemark.operators import models, registry
from tidemark.plans.catalog_features import _REQUEST_SQL, _RULED_SQL, scoring_requests
from tidemark.plans.catalog_fits import ONE_TREE
from tidemark.plans.catalog_models import _split
from tidemark.plans.catalog_models import batch_score as score_all
from tidemark.plans.catalog_streams import score_stream_with
from tidemark.plans.catalog_streams import stream_score as score_stream
from tidemark.plans.registry import query, tidy, wide_ints
from tidemark.plans.standins import CLEAN_SQL, RAW_SQL, TIDY_SQL, raw_readings, table
from tidemark.session import run_folder
from tidemark.sources import readers, writers
from tidemark.sources import requests as rq


@query(rf"""WITH {RAW_SQL}
SELECT holiday, round(temp, 6) AS temp, round(rain_1h, 6) AS rain_1h, round(snow_1h, 6) AS snow_1h, CAST(clouds_all AS BIGINT) AS clouds_all,
  CASE WHEN clouds_all % 10 <> 3 THEN regexp_replace(weather_main, '^\s+|\s+$', '', 'g') END AS weather_main, weather_description, date_time,
  CAST(traffic_volume AS BIGINT) AS traffic_volume FROM raw""")
def csv_readings(spark, sf):
    """Raw readings as headed CSV, missing cells in several spellings, scanned into declared types."""
    raw = raw_readings(spark, sf).drop("_ord")
    spelled = F.when(F.col("clouds_all") % 20 == 3, "n/a").otherwise("NaN")
    raw = raw.withColumns({
        "holiday": F.coalesce("holiday", F.lit("None")),
        "weather_main": F.when(F.col("clouds_all") % 10 == 3, spelled).otherwise(F.trim(F.regexp_replace("weather_main", "\t", ""))),
    })
    folder = run_folder(spark, "csv")
    writers.write_table(raw.select(*reversed(raw.columns)), folder, "csv")
    found = readers.require_columns(readers.read_raw_csv(spark, folder)).drop("_ord")
    return tidy(found.withColumn("weather_main", F.trim("weather_main")))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n_rows, copy
FROM lineitem, (VALUES ('parquet'), ('csv'), ('json')) f(copy) GROUP BY ALL""")
def table_outputs(spark, sf):
    """A result table written in three formats and read back."""
    counts = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n_rows"))
    out = None
    for fmt in ("parquet", "csv", "json"):
        folder = run_folder(spark, f"outputs-{fmt}")
        writers.write_table(counts, folder, fmt)
        copy = spark.read.schema(counts.schema).format(fmt).option("header", True).load(folder).withColumn("copy", F.lit(fmt))
        out = copy if out is None else out.unionByName(copy)
    return out


@query("""WITH log AS (SELECT event_id, ts, value, 1 AS v FROM events UNION ALL SELECT event_id, ts, value * 2, 2 FROM events)
SELECT CAST(ts AS DATE) AS day, CAST(v AS BIGINT) AS model_version, count(*) AS n_rows, round(sum(round(value, 2)), 2) AS total FROM log GROUP BY ALL""")
def log_appended(spark, sf):
    """Two appends to the prediction log, scanned as one table."""
    ev = table(spark, sf, "events")
    folder = run_folder(spark, "log")
    for version, rows in ((1, ev), (2, ev)):
        scored = rows.select(
            F.col("ts").cast("timestamp").alias("request_timestamp"), F.col("ts").alias("input_date_time"), F.lit("Clear").alias("weather_main"),
            *[F.lit(0.0).alias(c) for c in vocab.CONTINUOUS_FIELDS], F.lit(False).alias("is_holiday"),
            (F.col("value") * version).alias("predicted_traffic_volume"), F.lit(version).alias("model_version"),
        )
        writers.append_log(scored, folder)
    log = readers.read_prediction_log(spark, folder, "parquet")
    total = F.round(F.sum(F.col("predicted_traffic_volume")), 2).alias("total")
    days = log.groupBy(F.to_date("request_timestamp").alias("day"), "model_version").agg(F.count("*").alias("n_rows"), total)
    return wide_ints(days)


_SCORED = """SELECT date_time AS input_date_time, weather_main, round(temp, 6) AS temp, round(rain_1h, 6) AS rain_1h,
  round(coalesce(snow_1h, 0), 6) AS snow_1h, CAST(clouds_all AS DOUBLE) AS clouds_all, is_holiday, CAST(1 AS BIGINT) AS model_version,
  count(*) AS n_rows, count(*) AS n_predicted FROM ruled WHERE reasons = '' GROUP BY ALL"""


def _scored_rows(log):
    """What the log says besides the predicted numbers, and how many of these are finite."""
    finite = F.count(F.when(F.abs("predicted_traffic_volume") < float("inf"), 1)).alias("n_predicted")
    fields = ["input_date_time", "weather_main", "temp", "rain_1h", "snow_1h", "clouds_all", "is_holiday", "model_version"]
    kinds = dict(log.dtypes)
    cells = [F.round(c, 6).alias(c) if kinds[c] == "double" else F.col(c) for c in fields]
    return wide_ints(log.select(*cells, "predicted_traffic_volume").groupBy(*fields).agg(F.count("*").alias("n_rows"), finite))


@query(f"WITH {_REQUEST_SQL} {_SCORED}")
def batch_score_log(spark, sf):
    """Every accepted request is in the scored table once, with a number."""
    return _scored_rows(score_all(spark, sf))


#: Requests of the stream are the tidy readings as they are.
_STREAMED_SQL = """,
req AS (
  SELECT _ord AS request_id, date_time, weather_main, temp, rain_1h, snow_1h, clouds_all, holiday IS NOT NULL AS is_holiday FROM tidy),
ruled AS (
  SELECT *, concat_ws('; ',
    CASE WHEN date_time IS NULL THEN 'date_time: missing or not a timestamp' END,
    CASE WHEN temp IS NULL THEN 'temp: missing or not a number' END,
    CASE WHEN rain_1h < 0 THEN 'rain_1h: below 0' END,
    CASE WHEN clouds_all > 100 THEN 'clouds_all: outside 0 to 100' END) AS reasons FROM req)"""


@query(f"WITH {TIDY_SQL}{_STREAMED_SQL} {_SCORED}")
def stream_score_log(spark, sf):
    """Every accepted request of the stream is in the log once, with a number."""
    return _scored_rows(score_stream(spark, sf))


# Over one flag, every model's predictions are the means of the training rows with and without it.
_FLAG_MEANS = """,
cut AS (SELECT date_time AS cutoff FROM (
  SELECT date_time, row_number() OVER (ORDER BY date_time) - 1 AS r, count(*) OVER () AS n FROM clean WHERE date_time IS NOT NULL)
  WHERE r = CAST(floor(n * (1 - 0.2)) AS BIGINT)),
flag AS (SELECT isodow(date_time) >= 6 AS weekend, avg(traffic_volume) AS volume FROM clean, cut WHERE date_time < cutoff GROUP BY 1)"""
_FLAG_SCORES = """SELECT date_time AS input_date_time, CAST(version AS BIGINT) AS model_version, round(volume, {places}) AS predicted, count(*) AS n_rows
FROM ruled JOIN flag ON weekend = (isodow(date_time) >= 6), (VALUES (1), (2)) v(version)
WHERE reasons = '' AND version <= {versions} GROUP BY ALL"""


def _by_hour(log):
    predicted = F.round("predicted_traffic_volume", 4).alias("predicted")
    return wide_ints(log.groupBy("input_date_time", "model_version", predicted).agg(F.count("*").alias("n_rows")))


@query(f"WITH {CLEAN_SQL}{_RULED_SQL}{_FLAG_MEANS} {_FLAG_SCORES.format(places=4, versions=2)}")
def batch_score_values(spark, sf):
    """The numbers themselves: a line and a tree over one flag are saved, given the alias in turn and score every request."""
    feat, train, _ = _split(spark, sf)
    fitted = models.fit_regressors(train, columns=["is_weekend"], forest=ONE_TREE)
    folder = run_folder(spark, "registry")
    paths = models.save_models(fitted, f"{folder}/models")
    stats = ft.moments(feat, ["temp"]).select("temp").scalar()
    requests = rq.accepted(rq.check_requests(scoring_requests(spark, sf)))
    logs = []
    for version, path in enumerate(paths.values(), 1):
        registry.set_alias(spark, f"{folder}/aliases", "traffic_volume_regressor", "production", version, path)
        model, number = registry.load_by_alias(spark, f"{folder}/aliases", "traffic_volume_regressor")
        logs.append(models.score_requests(requests, model, stats["mean"], stats["std"], number))
    return _by_hour(logs[0].unionByName(logs[1]))


@query(f"WITH {CLEAN_SQL}{_STREAMED_SQL}{_FLAG_MEANS} {_FLAG_SCORES.format(places=2, versions=1)}")
def stream_score_values(spark, sf):
    """The numbers that a stream logs, to two places, from a line over one flag."""
    feat, train, _ = _split(spark, sf)
    model = models.fit_regressors(train, columns=["is_weekend"], only=["Linear Regression"])["Linear Regression"]
    return _by_hour(score_stream_with(spark, sf, feat, model))
