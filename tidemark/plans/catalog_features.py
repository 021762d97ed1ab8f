"""Feature queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from tidemark.functions import expressions as x
from tidemark.functions import vocab
from tidemark.operators import features as ft
from tidemark.plans.registry import query, rounded, tidy, wide_ints
from tidemark.plans.standins import (
    FEATURE_SQL, HOURLY_SQL, RAW_SQL, TIDY_SQL, WEATHER_OF, feature_table, hourly, raw_readings, sensor_readings, table,
)
from tidemark.operators.clean import clean, parse_time, standardise_text
from tidemark.session import materialize
from tidemark.sources import requests as rq


@query("""SELECT event_id, CAST(hour(ts) AS BIGINT) AS hour, CAST(isodow(ts) - 1 AS BIGINT) AS day_of_week,
  CAST(CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend FROM events""")
def time_features(spark, sf):
    out = table(spark, sf, "events").select("event_id", "ts").transform(ft.add_time, "ts")
    return wide_ints(out.select("event_id", "hour", "day_of_week", "is_weekend"))


@query("""SELECT event_id, round(sin(2 * pi() * hour(ts) / 24), 6) AS hour_sin, round(cos(2 * pi() * hour(ts) / 24), 6) AS hour_cos,
  round(sin(2 * pi() * (isodow(ts) - 1) / 7), 6) AS dow_sin, round(cos(2 * pi() * (isodow(ts) - 1) / 7), 6) AS dow_cos FROM events""")
def cyclical_features(spark, sf):
    out = table(spark, sf, "events").select("event_id", "ts").transform(ft.add_time, "ts")
    return rounded(out.select("event_id", "hour_sin", "hour_cos", "dow_sin", "dow_cos"))


_ONE_HOT = ", ".join(
    f"CAST(CASE WHEN weather_main = '{w}' THEN 1 ELSE 0 END AS BIGINT) AS wx_{w}" for w in vocab.WEATHER
)


@query(f"WITH {TIDY_SQL} SELECT _ord, {_ONE_HOT} FROM tidy")
def one_hot(spark, sf):
    out = raw_readings(spark, sf).transform(standardise_text).transform(ft.add_weather)
    return wide_ints(out.select("_ord", *[f"wx_{w}" for w in vocab.WEATHER]))


@query(f"""WITH {TIDY_SQL}
SELECT _ord, CAST(CASE WHEN weather_main IN ('Thunderstorm', 'Squall') THEN 1 ELSE 0 END AS BIGINT) AS is_severe_weather,
  CAST(CASE WHEN weather_main IN ('Fog', 'Mist', 'Haze', 'Smoke') THEN 1 ELSE 0 END AS BIGINT) AS is_low_visibility,
  CAST(CASE WHEN holiday IS NULL THEN 0 ELSE 1 END AS BIGINT) AS is_holiday FROM tidy""")
def flags(spark, sf):
    out = raw_readings(spark, sf).transform(standardise_text).transform(ft.add_weather).transform(ft.add_holiday)
    return wide_ints(out.select("_ord", "is_severe_weather", "is_low_visibility", "is_holiday"))


@query("""WITH s AS (SELECT avg(l_quantity) AS qm, stddev_samp(l_quantity) AS qs, avg(l_extendedprice) AS pm,
  stddev_samp(l_extendedprice) AS ps FROM lineitem)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, round((l_quantity - qm) / nullif(qs, 0), 6) AS l_quantity_scaled,
  round((l_extendedprice - pm) / nullif(ps, 0), 6) AS l_extendedprice_scaled FROM lineitem, s""")
def zscore(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    out = ft.standardise(li, ["l_quantity", "l_extendedprice"])
    return tidy(out.select("l_orderkey", "l_linenumber", "l_quantity_scaled", "l_extendedprice_scaled"))


@query("""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CASE WHEN l_extendedprice <= q1 THEN 'Low' WHEN l_extendedprice > q3 THEN 'High' ELSE 'Medium' END AS congestion_category
FROM lineitem, q""")
def quantile_bucket3(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    out = ft.add_congestion(li, "l_extendedprice")
    return wide_ints(out.select("l_orderkey", "l_linenumber", "congestion_category"))


@query("""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS q2,
  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CASE WHEN l_extendedprice <= q1 THEN 'Low' WHEN l_extendedprice <= q2 THEN 'Medium'
       WHEN l_extendedprice <= q3 THEN 'High' ELSE 'Severe' END AS risk_congestion_category
FROM lineitem, q""")
def quantile_bucket4(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    out = ft.add_risk_congestion(li, "l_extendedprice")
    return wide_ints(out.select("l_orderkey", "l_linenumber", "risk_congestion_category"))


@query("SELECT round(quantile_cont(l_extendedprice, 0.25), 6) AS q1, round(quantile_cont(l_extendedprice, 0.5), 6) AS q2, "
       "round(quantile_cont(l_extendedprice, 0.75), 6) AS q3 FROM lineitem")
def quartiles(spark, sf):
    from tidemark.operators.ranks import exact_quantiles

    q = exact_quantiles(table(spark, sf, "lineitem"), "l_extendedprice", [0.25, 0.5, 0.75])
    return rounded(q.select(*[F.col("l_extendedprice")[i].alias(f"q{i + 1}") for i in range(3)]))


@query(f"""WITH {FEATURE_SQL}
SELECT date_time, risk_congestion_category, CAST(high_risk AS BIGINT) AS high_risk FROM feat""")
def risk_label(spark, sf):
    return wide_ints(feature_table(spark, sf).select("date_time", "risk_congestion_category", "high_risk"))


@query(f"""WITH {FEATURE_SQL}
SELECT CAST(sum(high_risk) AS BIGINT) AS positives, count(*) AS n_rows, round(avg(high_risk), 6) AS rate,
  CASE WHEN avg(high_risk) < 0.01 OR avg(high_risk) > 0.5 THEN 'WARN' ELSE 'OK' END AS status FROM feat""")
def label_rate(spark, sf):
    return rounded(ft.label_rate(feature_table(spark, sf)))


@query("""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CASE WHEN l_extendedprice / 10 <= 4500 THEN 'Low' WHEN l_extendedprice / 10 <= 5500 THEN 'Medium' ELSE 'High' END AS level
FROM lineitem""")
def threshold_bucket(spark, sf):
    li = table(spark, sf, "lineitem")
    level = x.banded(F.col("l_extendedprice") / 10, vocab.LEVEL_BOUNDS, vocab.THREE_LEVELS, "Medium")
    return wide_ints(li.select("l_orderkey", "l_linenumber", level.alias("level")))


_SEVERITY = " ".join(f"WHEN '{k}' THEN {v}" for k, v in vocab.SEVERITY.items())


@query(f"""WITH {TIDY_SQL}
SELECT _ord, weather_main, CAST(CASE weather_main {_SEVERITY} END AS BIGINT) AS weather_severity FROM tidy""")
def severity_lookup(spark, sf):
    out = raw_readings(spark, sf).transform(standardise_text).select("_ord", "weather_main")
    out = ft.left_lookup(out, vocab.SEVERITY, "weather_main", "weather_severity")
    return out.select("_ord", "weather_main", "weather_severity")


_KNOWN = ", ".join(f"'{w}'" for w in vocab.WEATHER)


@query(f"""WITH {RAW_SQL}
SELECT weather_main, count(*) AS n_rows FROM raw WHERE weather_main NOT IN ({_KNOWN}) GROUP BY 1""")
def unmapped_values(spark, sf):
    """Before trimming, padded names are outside the vocabulary."""
    return ft.unmapped_values(raw_readings(spark, sf), "weather_main", vocab.WEATHER)


@query("""SELECT user_id, count(*) AS n_rows FROM events
WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1""")
def unknown_keys(spark, sf):
    """Keys of one table that another does not hold."""
    return ft.unknown_keys(table(spark, sf, "events"), "user_id", table(spark, sf, "supplier"), "s_suppkey")


@query("""SELECT l_linestatus, count(*) FILTER (WHERE l_returnflag = 'A') AS flag_A, count(*) FILTER (WHERE l_returnflag = 'N') AS flag_N,
  count(*) FILTER (WHERE l_returnflag = 'R') AS flag_R FROM lineitem GROUP BY 1""")
def one_hot_discovered(spark, sf):
    """One-hot columns over the categories that the data have."""
    li = table(spark, sf, "lineitem")
    cells = li.select("l_linestatus", *x.one_hot("l_returnflag", ft.discover_categories(li, "l_returnflag"), "flag_"))
    return wide_ints(cells.groupBy("l_linestatus").agg(*[F.sum(c).alias(c) for c in cells.columns[1:]]))


_DAY_PART = """CASE WHEN hour(date_time) <= 5 THEN 'Night' WHEN hour(date_time) <= 9 THEN 'Morning Rush'
  WHEN hour(date_time) <= 15 THEN 'Midday' WHEN hour(date_time) <= 19 THEN 'Evening Rush' ELSE 'Evening' END"""
_WEATHER_GROUP = """CASE WHEN weather_main IN ('Thunderstorm', 'Squall') THEN 'Severe'
  WHEN weather_main IN ('Fog', 'Mist', 'Haze', 'Smoke') THEN 'LowVisibility'
  WHEN weather_main IN ('Rain', 'Drizzle', 'Snow') THEN 'Precipitation'
  WHEN weather_main = 'Clouds' THEN 'Clouds' ELSE 'Clear' END"""


@query(f"""WITH {TIDY_SQL}
SELECT _ord, {_DAY_PART} AS time_of_day, {_WEATHER_GROUP} AS weather_bucket,
  CASE WHEN isodow(date_time) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS weekday_type FROM tidy""")
def arm_buckets(spark, sf):
    out = raw_readings(spark, sf).transform(standardise_text).transform(parse_time).transform(ft.add_time)
    return ft.add_rule_attributes(out, level="weather_main").select("_ord", "time_of_day", "weather_bucket", "weekday_type")


@query(f"""WITH {TIDY_SQL}
SELECT 'holiday' AS column_name, count(*) - count(holiday) AS n_missing FROM tidy
UNION ALL SELECT 'date_time', count(*) - count(date_time) FROM tidy
UNION ALL SELECT 'temp', count(*) - count(temp) FROM tidy""")
def null_profile(spark, sf):
    out = raw_readings(spark, sf).transform(parse_time)
    return ft.missing_profile(out, ["holiday", "date_time", "temp"])


_FEATURE_COLUMNS = [
    "date_time", "hour", "day_of_week", "congestion_category", "risk_congestion_category", "high_risk",
    "traffic_volume_scaled", *vocab.FEATURES,
]
_FLOATS = {"hour_sin", "hour_cos", "dow_sin", "dow_cos", "temp_scaled", "rain_1h", "snow_1h", "traffic_volume_scaled"}
_TEXTS = {"date_time", "congestion_category", "risk_congestion_category"}


def _feature_sql(c: str) -> str:
    if c in _FLOATS:
        return f"round({c}, 6) AS {c}"
    return c if c in _TEXTS else f"CAST({c} AS BIGINT) AS {c}"


@query(f"WITH {FEATURE_SQL} SELECT {', '.join(_feature_sql(c) for c in _FEATURE_COLUMNS)} FROM feat")
def feature_build(spark, sf):
    return tidy(feature_table(spark, sf).select(*_FEATURE_COLUMNS))


_SENSOR_SQL = FEATURE_SQL.replace(
    "SELECT event_id AS _ord,", "SELECT event_id AS _ord, user_id AS sensor,").replace(
    "SELECT _ord, holiday, temp, rain_1h, snow_1h, clouds_all,", "SELECT _ord, sensor, holiday, temp, rain_1h, snow_1h, clouds_all,").replace(
    "PARTITION BY date_time ORDER BY _ord", "PARTITION BY sensor, date_time ORDER BY _ord").replace(
    "SELECT holiday, coalesce(temp, mt)", "SELECT sensor, holiday, coalesce(temp, mt)")


def sensor_features_of(spark, sf):
    """Features of one checked row per sensor and hour; a sensor is a user."""
    return ft.build_features(materialize(clean(sensor_readings(spark, sf), keys=["sensor"]), "sensors"))


@query(f"WITH {_SENSOR_SQL} SELECT sensor, {', '.join(_feature_sql(c) for c in _FEATURE_COLUMNS)} FROM feat")
def sensor_features(spark, sf):
    """The feature table of many sensors: its rows grow with the data."""
    return tidy(sensor_features_of(spark, sf).select("sensor", *_FEATURE_COLUMNS))


@query(f"WITH {FEATURE_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing FROM feat" for c in vocab.FEATURES))
def feature_matrix_missing(spark, sf):
    """Missing cells in each of the model inputs."""
    return ft.missing_profile(feature_table(spark, sf), vocab.FEATURES)


# --- scoring requests --------------------------------------------------------
def scoring_requests(spark, sf):
    """Every event as one request, some with values a model must not see."""
    raw = raw_readings(spark, sf)
    user = F.col("clouds_all")
    return raw.select(
        F.col("_ord").alias("request_id"),
        x.parse_timestamp("date_time").alias("date_time"),
        F.when(user == 3, "Sunny").otherwise(x.strip_text("weather_main")).alias("weather_main"),
        F.when(F.col("temp") > 0, F.col("temp")).alias("temp"),
        (F.col("rain_1h") - F.when(user == 5, 1.0).otherwise(0.0)).alias("rain_1h"),
        F.when(F.col("snow_1h") > 0, F.col("snow_1h")).alias("snow_1h"),
        (user.cast("double") + F.when(user > 98, 5.0).otherwise(0.0)).alias("clouds_all"),
        F.when(F.col("holiday").isNotNull(), True).alias("is_holiday"),
    )


_RULED_SQL = """,
req AS (
  SELECT _ord AS request_id, date_time, CASE WHEN clouds_all = 3 THEN 'Sunny' ELSE weather_main END AS weather_main,
    CASE WHEN temp > 0 THEN temp END AS temp,
    rain_1h - CASE WHEN clouds_all = 5 THEN 1 ELSE 0 END AS rain_1h,
    CASE WHEN snow_1h > 0 THEN snow_1h END AS snow_1h,
    clouds_all + CASE WHEN clouds_all > 98 THEN 5 ELSE 0 END AS clouds_all,
    holiday IS NOT NULL AS is_holiday FROM tidy),
ruled AS (
  SELECT *, concat_ws('; ',
    CASE WHEN date_time IS NULL THEN 'date_time: missing or not a timestamp' END,
    CASE WHEN weather_main = 'Sunny' THEN 'weather_main: not a known category' END,
    CASE WHEN temp IS NULL THEN 'temp: missing or not a number' END,
    CASE WHEN rain_1h < 0 THEN 'rain_1h: below 0' END,
    CASE WHEN clouds_all > 100 THEN 'clouds_all: outside 0 to 100' END) AS reasons FROM req)"""
_REQUEST_SQL = TIDY_SQL + _RULED_SQL


@query(f"""WITH {_REQUEST_SQL}
SELECT request_id, date_time, weather_main, round(temp, 6) AS temp, round(rain_1h, 6) AS rain_1h,
  round(coalesce(snow_1h, 0), 6) AS snow_1h, CAST(clouds_all AS DOUBLE) AS clouds_all, is_holiday,
  reasons, reasons = '' AS accepted FROM ruled""")
def request_validation(spark, sf):
    checked = rq.check_requests(scoring_requests(spark, sf))
    return rounded(checked.withColumn("reasons", F.array_join("reasons", "; ")))


def temperature_moments(spark, sf):
    """Mean and deviation of the training temperatures as scalars."""
    stats = ft.moments(hourly(spark, sf), ["temp"]).select("temp").scalar()
    return stats["mean"], stats["std"]


_MODEL_INPUTS = ", ".join(
    f"round(CAST({c} AS DOUBLE), 6) AS {c}" if c in _FLOATS | {"clouds_all"} else f"CAST({c} AS BIGINT) AS {c}"
    for c in vocab.FEATURES
)


@query(f"""WITH {_REQUEST_SQL}, {HOURLY_SQL},
m AS (SELECT avg(temp) AS tm, stddev_samp(temp) AS ts FROM h),
f AS (
  SELECT request_id, weather_main, sin(2 * pi() * hour(date_time) / 24) AS hour_sin, cos(2 * pi() * hour(date_time) / 24) AS hour_cos,
    sin(2 * pi() * (isodow(date_time) - 1) / 7) AS dow_sin, cos(2 * pi() * (isodow(date_time) - 1) / 7) AS dow_cos,
    CASE WHEN isodow(date_time) >= 6 THEN 1 ELSE 0 END AS is_weekend, CASE WHEN is_holiday THEN 1 ELSE 0 END AS is_holiday,
    {_ONE_HOT},
    CASE WHEN weather_main IN ('Thunderstorm', 'Squall') THEN 1 ELSE 0 END AS is_severe_weather,
    CASE WHEN weather_main IN ('Fog', 'Mist', 'Haze', 'Smoke') THEN 1 ELSE 0 END AS is_low_visibility,
    (temp - tm) / ts AS temp_scaled, rain_1h, coalesce(snow_1h, 0) AS snow_1h, clouds_all
  FROM ruled, m WHERE reasons = '')
SELECT request_id, {_MODEL_INPUTS} FROM f""")
def request_features(spark, sf):
    good = rq.accepted(rq.check_requests(scoring_requests(spark, sf)))
    out = ft.request_features(good, *temperature_moments(spark, sf))
    return tidy(out.select("request_id", *vocab.FEATURES))


@query("""SELECT row_number() OVER (ORDER BY k) - 1 AS position, k AS part, n AS n_rows, (SELECT count(*) FROM lineitem) AS n_all FROM (
  SELECT CAST(l_partkey AS VARCHAR) AS k, count(*) AS n FROM lineitem WHERE l_partkey % 10 <> 0 GROUP BY 1)""")
def one_hot_vectors(spark, sf):
    """Every part as a category of a sparse vector: the rows with a 1 at each position; a tenth has no category and zeros."""
    part = F.when(F.col("l_partkey") % 10 != 0, F.col("l_partkey").cast("string"))
    li = materialize(table(spark, sf, "lineitem").select(part.alias("part")), "parts")
    index = ft.category_index(li, "part")
    sums = ft.one_hot_vector(li, "part", index).agg(Summarizer.sum(F.col("one_hot")).alias("s"), F.count("*").alias("n_all"))
    held = sums.select(F.posexplode(vector_to_array("s")).alias("position", "n"), "n_all")
    return index.join(held, "position").select("position", "part", F.col("n").cast("bigint").alias("n_rows"), "n_all")
