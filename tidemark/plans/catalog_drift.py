"""Drift checks: the first 80 % of the readings as training, the rest as logged requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import clean, drift, split
from tidemark.operators import features as ft
from tidemark.plans.registry import query, rounded, tidy
from tidemark.plans.standins import KEPT_SQL, tidy_readings
from tidemark.session import materialize

_SPLIT = f"""WITH {KEPT_SQL},
known AS (SELECT *, CASE WHEN holiday IS NULL THEN 0 ELSE 1 END AS is_holiday FROM tidy WHERE date_time IS NOT NULL),
cut AS (SELECT date_time AS cutoff FROM (
  SELECT date_time, row_number() OVER (ORDER BY date_time) - 1 AS r, count(*) OVER () AS n FROM known)
  WHERE r = CAST(floor(n * (1 - 0.2)) AS BIGINT)),
train AS (SELECT * FROM known, cut WHERE date_time < cutoff),
means AS (SELECT hour(date_time) AS hr, avg(traffic_volume) AS predicted FROM train GROUP BY 1),
live AS (SELECT known.*, predicted FROM known JOIN means ON hr = hour(date_time), cut WHERE date_time >= cutoff),
observed AS (SELECT date_time, traffic_volume FROM kept),
base AS (SELECT avg(abs(traffic_volume - predicted)) AS mae FROM train JOIN means ON hr = hour(date_time))"""


def _parts(spark, sf):
    """(train, live log, observed hours, baseline error as a scalar)."""
    # The readings and the log are stored tables in practice; here they are stored first.
    rows = materialize(tidy_readings(spark, sf), "readings")
    observed = clean.first_per_key(rows.select("date_time", "traffic_volume", "_ord"), ["date_time"]).drop("_ord")
    rows = rows.transform(ft.add_holiday).withColumn("hour", F.hour("date_time"))
    train, later, _ = split.time_split(rows, "date_time")
    means = train.groupBy("hour").agg(F.avg("traffic_volume").alias("predicted_traffic_volume"))
    # At most 24 rows, one per hour of the day.
    means = F.broadcast(means)
    live = later.join(means, "hour").withColumnRenamed("date_time", "input_date_time")
    gap = F.abs(F.col("traffic_volume") - F.col("predicted_traffic_volume"))
    baseline = train.join(means, "hour").agg(F.avg(gap).alias("mae")).scalar()
    return train, live, observed, baseline


_FIELDS = ["temp", "rain_1h", "snow_1h", "clouds_all"]
_REF_ROWS = "\nUNION ALL ".join(
    f"SELECT '{f}' AS field, avg({f}) AS m, stddev_samp({f}) AS s, (SELECT avg({f}) FROM live) AS l FROM train" for f in _FIELDS
)


@query(f"{_SPLIT}, r AS ({_REF_ROWS}) SELECT field, round(m, 6) AS ref_mean, round(s, 6) AS ref_std FROM r")
def drift_reference(spark, sf):
    return rounded(drift.build_reference(_parts(spark, sf)[0]).continuous)


@query(f"""{_SPLIT}
SELECT weather_main AS category, round(count(*) / (SELECT CAST(count(weather_main) AS DOUBLE) FROM train), 6) AS ref_share
FROM train WHERE weather_main IS NOT NULL GROUP BY 1""")
def drift_reference_shares(spark, sf):
    return rounded(drift.build_reference(_parts(spark, sf)[0]).shares)


_CONTINUOUS = f"""r AS ({_REF_ROWS}),
z AS (SELECT *, CASE WHEN s > 0 THEN (l - m) / s ELSE 0 END AS z FROM r),
f1 AS (SELECT 'feature mean: ' || field AS "check", round(l, 3) AS live_value, round(m, 3) AS reference_value,
  printf('z=%+.2f (threshold |z|>1.0)', z) AS detail, CASE WHEN abs(z) > 1 THEN 'ALERT' ELSE 'PASS' END AS status FROM z)"""


@query(f"{_SPLIT}, {_CONTINUOUS} SELECT * FROM f1")
def drift_continuous(spark, sf):
    train, live, _, _ = _parts(spark, sf)
    return drift.continuous_drift(live, drift.build_reference(train).continuous)


_CATEGORICAL = """ref AS (SELECT weather_main, count(*) / (SELECT CAST(count(weather_main) AS DOUBLE) FROM train) AS rs FROM train GROUP BY 1),
now AS (SELECT weather_main, count(*) / (SELECT CAST(count(weather_main) AS DOUBLE) FROM live) AS ls FROM live
  WHERE weather_main IS NOT NULL GROUP BY 1),
pair AS (SELECT now.weather_main, ls, coalesce(rs, 0) AS rs FROM now LEFT JOIN ref ON ref.weather_main = now.weather_main),
f2 AS (SELECT 'weather_main share: ' || weather_main AS "check", round(ls, 3) AS live_value, round(rs, 3) AS reference_value,
  CASE WHEN rs = 0 THEN 'category never seen in training data'
       ELSE printf('ratio=%.2fx training share (threshold >3x)', ls / nullif(rs, 0)) END AS detail,
  CASE WHEN rs = 0 OR ls / nullif(rs, 0) > 3 THEN 'ALERT' ELSE 'PASS' END AS status FROM pair)"""


@query(f"{_SPLIT}, {_CATEGORICAL} SELECT * FROM f2")
def drift_categorical(spark, sf):
    train, live, _, _ = _parts(spark, sf)
    return drift.category_drift(live, drift.build_reference(train).shares)


_RATE = """rate AS (SELECT (SELECT avg(is_holiday) FROM live) AS l, (SELECT avg(is_holiday) FROM train) AS r),
f3 AS (SELECT 'is_holiday rate' AS "check", round(l, 3) AS live_value, round(r, 3) AS reference_value,
  CASE WHEN r = 0 THEN CASE WHEN l > 0 THEN 'holiday requests never seen in training data' ELSE 'no holidays either side' END
       ELSE printf('ratio=%.2fx training share (threshold >3x)', l / nullif(r, 0)) END AS detail,
  CASE WHEN CASE WHEN r = 0 THEN l > 0 ELSE l / nullif(r, 0) > 3 END THEN 'ALERT' ELSE 'PASS' END AS status FROM rate)"""


@query(f"{_SPLIT}, {_RATE} SELECT * FROM f3")
def drift_rate(spark, sf):
    train, live, _, _ = _parts(spark, sf)
    return drift.rate_drift(live, drift.build_reference(train).holiday)


_ERROR = """err AS (SELECT count(*) AS n_live, count(o.traffic_volume) AS n_known, avg(abs(predicted - o.traffic_volume)) AS mae
  FROM live LEFT JOIN observed o ON o.date_time = live.date_time),
f4 AS (SELECT 'prediction error (matched ground truth)' AS "check", round(err.mae, 2) AS live_value, round(base.mae, 2) AS reference_value,
  CASE WHEN n_known = 0 THEN 'N/A: no live request timestamp has a known outcome yet'
       ELSE CAST(n_known AS VARCHAR) || ' of ' || CAST(n_live AS VARCHAR) ||
            printf(' live requests matched; ratio=%.2fx (threshold >2x)', err.mae / nullif(base.mae, 0)) END AS detail,
  CASE WHEN n_known = 0 THEN 'N/A' WHEN err.mae / nullif(base.mae, 0) > 2 THEN 'ALERT' ELSE 'PASS' END AS status FROM err, base)"""


@query(f"{_SPLIT}, {_ERROR} SELECT * FROM f4")
def drift_error(spark, sf):
    _, live, observed, baseline = _parts(spark, sf)
    return drift.error_drift(live, observed, baseline)


@query(f"""{_SPLIT}
SELECT live._ord, live.date_time AS input_date_time FROM live WHERE live.date_time IN (SELECT date_time FROM observed)""")
def known_outcomes(spark, sf):
    _, live, observed, _ = _parts(spark, sf)
    return drift.known_outcomes(live, observed).select("_ord", "input_date_time")


_ALL = f"""{_SPLIT}, {_CONTINUOUS}, {_CATEGORICAL}, {_RATE}, {_ERROR},
findings AS (SELECT * FROM f1 UNION ALL SELECT * FROM f2 UNION ALL SELECT * FROM f3 UNION ALL SELECT * FROM f4)"""


def _findings(spark, sf):
    train, live, observed, baseline = _parts(spark, sf)
    return drift.drift_findings(live, drift.build_reference(train), observed, baseline)


@query(f"{_ALL} SELECT * FROM findings")
def drift_findings(spark, sf):
    return _findings(spark, sf)


@query(f"""{_ALL}
SELECT count(*) AS n_checks, count(CASE WHEN status = 'ALERT' THEN 1 END) AS n_alerts,
  CASE WHEN count(CASE WHEN status = 'ALERT' THEN 1 END) > 0 THEN 'ALERT' ELSE 'PASS' END AS overall FROM findings""")
def drift_report(spark, sf):
    return tidy(drift.overall_status(_findings(spark, sf)))
