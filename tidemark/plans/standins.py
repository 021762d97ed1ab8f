"""The driver's tables seen as a sensor table, once for Spark and once as SQL text.

``events`` plays the raw readings: one row per event, hours repeat, some cells are bad.
The SQL strings are common table expressions that define the same tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import hour_start, lookup, monday_zero, weekend_flag
from tidemark.operators.clean import clean, parse_time, standardise_text
from tidemark.operators.features import build_features
from tidemark.session import materialize

# Three weather names per event type, picked by user.
WEATHER_OF = {
    "click": ["Clear", "Clear", "Clouds"],
    "view": ["Clouds", "Clouds", "Clear"],
    "purchase": ["Rain", "Drizzle", "Snow"],
    "signup": ["Mist", "Haze", "Fog"],
    "error": ["Thunderstorm", "Squall", "Smoke"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _weather() -> Column:
    names = {f"{kind}{i}": name for kind, choices in WEATHER_OF.items() for i, name in enumerate(choices)}
    return lookup(F.concat("event_type", (F.col("user_id") % 3).cast("string")), names)


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_of(table(spark, sf_dir, "events"))


def sensor_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw readings with the sensor they are from: the user."""
    ev = table(spark, sf_dir, "events")
    return readings_of(ev.withColumn("sensor", F.col("user_id")))


def readings_of(ev: DataFrame) -> DataFrame:
    """Every event as one raw reading: padded and mixed-case text, bad times and values.

    ``ev`` may be a batch or a stream.
    """
    weather = _weather()
    day = F.to_date("ts").cast("string")
    user = F.col("user_id")
    midnight = F.hour("ts") == 0
    wordy = F.concat(weather, F.lit(" sky"))
    return ev.select(
        F.col("event_id").alias("_ord"),
        F.when(midnight & (day == "2024-01-01"), "New Years Day")
        .when(midnight & (day == "2024-01-15"), "Martin Luther King Jr Day")
        .alias("holiday"),
        (F.lit(300.0) - F.col("value")).alias("temp"),
        F.when(F.col("event_type") == "purchase", F.col("value") * 4.0).otherwise(0.0).alias("rain_1h"),
        F.when(F.col("event_type") == "error", F.col("value") / 100.0).otherwise(0.0).alias("snow_1h"),
        (user % 101).cast("int").alias("clouds_all"),
        F.when(user % 7 == 0, F.concat(F.lit("  "), weather, F.lit("\t"))).otherwise(weather).alias("weather_main"),
        F.when(user % 5 == 0, F.upper(wordy)).otherwise(F.lower(wordy)).alias("weather_description"),
        F.when(user % 97 == 0, "not-a-date")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:00:00"))
        .alias("date_time"),
        F.floor(F.col("value") * 10.0).cast("int").alias("traffic_volume"),
        *[F.col(c) for c in ("received_at", "sensor") if c in ev.columns],
    )


def tidy_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings with text and time put right, duplicates still there."""
    return raw_readings(spark, sf_dir).transform(standardise_text).transform(parse_time)


def _weather_sql() -> str:
    cases = " ".join(
        f"WHEN event_type = '{kind}' AND user_id % 3 = {i} THEN '{name}'"
        for kind, names in WEATHER_OF.items()
        for i, name in enumerate(names)
    )
    return f"CASE {cases} END"


RAW_SQL = f"""
named AS (SELECT *, {_weather_sql()} AS wx FROM events),
raw AS (
  SELECT event_id AS _ord,
    CASE WHEN hour(ts) = 0 AND CAST(ts AS DATE) = DATE '2024-01-01' THEN 'New Years Day'
         WHEN hour(ts) = 0 AND CAST(ts AS DATE) = DATE '2024-01-15' THEN 'Martin Luther King Jr Day' END AS holiday,
    CAST(300 AS DOUBLE) - value AS temp,
    CASE WHEN event_type = 'purchase' THEN value * CAST(4 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS rain_1h,
    CASE WHEN event_type = 'error' THEN value / CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS snow_1h,
    CAST(user_id % 101 AS INTEGER) AS clouds_all,
    CASE WHEN user_id % 7 = 0 THEN '  ' || wx || chr(9) ELSE wx END AS weather_main,
    CASE WHEN user_id % 5 = 0 THEN upper(wx || ' sky') ELSE lower(wx || ' sky') END AS weather_description,
    CASE WHEN user_id % 97 = 0 THEN 'not-a-date' ELSE strftime(ts, '%Y-%m-%d %H:00:00') END AS date_time,
    CAST(floor(value * CAST(10 AS DOUBLE)) AS INTEGER) AS traffic_volume
  FROM named)"""

TIDY_SQL = RAW_SQL + r""",
tidy AS (
  SELECT _ord, holiday, temp, rain_1h, snow_1h, clouds_all,
    regexp_replace(weather_main, '^\s+|\s+$', '', 'g') AS weather_main,
    lower(regexp_replace(weather_description, '^\s+|\s+$', '', 'g')) AS weather_description,
    try_cast(date_time AS TIMESTAMP) AS date_time, traffic_volume
  FROM raw)"""

KEPT_SQL = TIDY_SQL + """,
kept AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY date_time ORDER BY _ord) AS rn FROM tidy) WHERE rn = 1)"""

CLEAN_SQL = KEPT_SQL + """,
checked AS (
  SELECT * REPLACE (CASE WHEN temp <= 0 THEN NULL ELSE temp END AS temp,
                    CASE WHEN rain_1h > 1000 THEN NULL ELSE rain_1h END AS rain_1h) FROM kept),
medians AS (
  SELECT month(date_time) AS mo, quantile_cont(temp, 0.5) AS mt, quantile_cont(rain_1h, 0.5) AS mr
  FROM checked WHERE date_time IS NOT NULL GROUP BY 1),
clean AS (
  SELECT holiday, coalesce(temp, mt) AS temp, coalesce(rain_1h, mr) AS rain_1h, snow_1h, clouds_all,
    weather_main, weather_description, date_time, traffic_volume
  FROM checked LEFT JOIN medians ON month(date_time) = mo)"""


def _one_hot_sql() -> str:
    from tidemark.functions.vocab import WEATHER

    return ", ".join(f"CASE WHEN weather_main = '{w}' THEN 1 ELSE 0 END AS wx_{w}" for w in WEATHER)


FEATURE_SQL = CLEAN_SQL + f""",
cuts AS (
  SELECT avg(temp) AS tm, stddev_samp(temp) AS ts, avg(traffic_volume) AS vm, stddev_samp(traffic_volume) AS vs,
    quantile_cont(traffic_volume, 0.25) AS q1, quantile_cont(traffic_volume, 0.5) AS q2,
    quantile_cont(traffic_volume, 0.75) AS q3 FROM clean),
timed AS (
  SELECT clean.*, cuts.*, hour(date_time) AS hour, isodow(date_time) - 1 AS day_of_week,
    CASE WHEN isodow(date_time) >= 6 THEN 1 ELSE 0 END AS is_weekend,
    {_one_hot_sql()},
    CASE WHEN weather_main IN ('Thunderstorm', 'Squall') THEN 1 ELSE 0 END AS is_severe_weather,
    CASE WHEN weather_main IN ('Fog', 'Mist', 'Haze', 'Smoke') THEN 1 ELSE 0 END AS is_low_visibility,
    CASE WHEN holiday IS NULL THEN 0 ELSE 1 END AS is_holiday
  FROM clean CROSS JOIN cuts),
banded AS (
  SELECT *, sin(2 * pi() * hour / 24) AS hour_sin, cos(2 * pi() * hour / 24) AS hour_cos,
    sin(2 * pi() * day_of_week / 7) AS dow_sin, cos(2 * pi() * day_of_week / 7) AS dow_cos,
    (temp - tm) / nullif(ts, 0) AS temp_scaled, (traffic_volume - vm) / nullif(vs, 0) AS traffic_volume_scaled,
    CASE WHEN traffic_volume <= q1 THEN 'Low' WHEN traffic_volume > q3 THEN 'High' ELSE 'Medium' END AS congestion_category,
    CASE WHEN traffic_volume <= q1 THEN 'Low' WHEN traffic_volume <= q2 THEN 'Medium'
         WHEN traffic_volume <= q3 THEN 'High' ELSE 'Severe' END AS risk_congestion_category
  FROM timed),
feat AS (
  SELECT *, CASE WHEN risk_congestion_category IN ('High', 'Severe')
                  AND (is_severe_weather = 1 OR is_low_visibility = 1) THEN 1 ELSE 0 END AS high_risk
  FROM banded)"""


def clean_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_readings(spark, sf_dir))


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features over the cleaned hours, which are stored once: several passes read them."""
    return build_features(materialize(clean_readings(spark, sf_dir), "clean"))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour: count as volume, mean value as temperature."""
    ev = table(spark, sf_dir, "events")
    out = ev.groupBy(hour_start("ts").alias("date_time")).agg(
        F.count("*").alias("traffic_volume"), F.avg("value").alias("temp")
    )
    return out.select(
        "*",
        F.hour("date_time").alias("hour"),
        monday_zero("date_time").alias("day_of_week"),
        weekend_flag("date_time").alias("is_weekend"),
    )


HOURLY_SQL = """
h AS (
  SELECT *, hour(date_time) AS hour, isodow(date_time) - 1 AS day_of_week,
    CASE WHEN isodow(date_time) >= 6 THEN 1 ELSE 0 END AS is_weekend
  FROM (SELECT date_trunc('hour', ts) AS date_time, count(*) AS traffic_volume, avg(value) AS temp
        FROM events GROUP BY 1))"""


def hourly_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour and type: several readings per hour, with different volumes."""
    ev = table(spark, sf_dir, "events")
    out = ev.groupBy(hour_start("ts").alias("date_time"), "event_type").agg(
        F.count("*").alias("traffic_volume"), F.avg("value").alias("temp"), F.min("event_id").alias("_ord")
    )
    return out.select(
        "*",
        F.hour("date_time").alias("hour"),
        weekend_flag("date_time").alias("is_weekend"),
    )


HOURLY_TYPE_SQL = """
he AS (
  SELECT *, hour(date_time) AS hour, CASE WHEN isodow(date_time) >= 6 THEN 1 ELSE 0 END AS is_weekend
  FROM (SELECT date_trunc('hour', ts) AS date_time, event_type, count(*) AS traffic_volume,
          avg(value) AS temp, min(event_id) AS _ord
        FROM events GROUP BY 1, 2))"""
