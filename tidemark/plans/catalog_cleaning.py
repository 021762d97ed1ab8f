"""Cleaning queries over the raw stand-in (every event one raw reading)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import expressions as x
from tidemark.functions import vocab
from tidemark.operators import clean as cl
from tidemark.plans.registry import query, rounded, tidy, wide_ints
from tidemark.plans.standins import (
    CLEAN_SQL, HOURLY_TYPE_SQL, KEPT_SQL, RAW_SQL, TIDY_SQL, clean_readings, hourly_by_type, raw_readings, table,
    tidy_readings,
)


@query(f"WITH {TIDY_SQL} SELECT _ord, weather_main, weather_description FROM tidy")
def clean_text(spark, sf):
    return raw_readings(spark, sf).transform(cl.standardise_text).select("_ord", "weather_main", "weather_description")


@query(f"""WITH {TIDY_SQL}
SELECT _ord, date_time, date_time IS NULL AS failed FROM tidy""")
def parse_timestamps(spark, sf):
    out = raw_readings(spark, sf).transform(cl.parse_time)
    return out.select("_ord", "date_time", F.col("date_time").isNull().alias("failed"))


@query(f"WITH {TIDY_SQL} SELECT min(date_time) AS first_time, max(date_time) AS last_time FROM tidy")
def timestamp_range(spark, sf):
    return raw_readings(spark, sf).transform(cl.parse_time).transform(cl.time_range)


@query(f"""WITH {RAW_SQL}
SELECT _ord, round(CASE WHEN temp <= 0 THEN NULL ELSE temp END, 6) AS temp,
  round(CASE WHEN rain_1h > 1000 THEN NULL ELSE rain_1h END, 6) AS rain_1h FROM raw""")
def null_invalid(spark, sf):
    out = raw_readings(spark, sf).transform(cl.null_where, cl.impossible_readings())
    return rounded(out.select("_ord", "temp", "rain_1h"))


@query("""WITH checked AS (
  SELECT event_id, isodow(ts) - 1 AS dow, CASE WHEN value > 200 THEN NULL ELSE value END AS value FROM events),
m AS (SELECT dow, quantile_cont(value, 0.5) AS med FROM checked GROUP BY 1)
SELECT event_id, round(coalesce(value, med), 6) AS value FROM checked JOIN m USING (dow)""")
def impute_group_median(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts", "value")
    blanked = cl.null_where(ev, {"value": F.col("value") > 200})
    filled = cl.fill_group_median(blanked, ["value"], x.monday_zero("ts"))
    return rounded(filled.select("event_id", "value"))


_CONTENT = ", ".join(vocab.RAW_COLUMNS)


@query(f"""WITH {TIDY_SQL},
twice AS (SELECT * FROM tidy UNION ALL SELECT * REPLACE (_ord + 1000000000 AS _ord) FROM tidy)
SELECT {_CONTENT.replace('clouds_all', 'CAST(clouds_all AS BIGINT) AS clouds_all').replace('traffic_volume', 'CAST(traffic_volume AS BIGINT) AS traffic_volume')},
  min(_ord) AS _ord FROM twice GROUP BY ALL""")
def dedupe_exact(spark, sf):
    """Whole rows, every one of them delivered twice."""
    rows = tidy_readings(spark, sf)
    again = rows.withColumn("_ord", F.col("_ord") + 1_000_000_000)
    return wide_ints(rows.unionByName(again).transform(cl.drop_exact_duplicates))


@query(f"""WITH {HOURLY_TYPE_SQL}
SELECT date_time, event_type, traffic_volume, _ord FROM (
  SELECT *, row_number() OVER (PARTITION BY date_time ORDER BY _ord) AS rn FROM he) WHERE rn = 1""")
def dedupe_first(spark, sf):
    out = cl.first_per_key(hourly_by_type(spark, sf), ["date_time"])
    return out.select("date_time", "event_type", "traffic_volume", "_ord")


@query(f"""WITH {HOURLY_TYPE_SQL},
g AS (SELECT date_time, count(*) AS n_rows, count(DISTINCT traffic_volume) AS n_values FROM he GROUP BY 1)
SELECT date_time, traffic_volume, count(*) AS value_rows, any_value(n_rows) AS n_rows, any_value(n_values) AS n_values
FROM he JOIN g USING (date_time) WHERE n_values > 1 GROUP BY 1, 2""")
def dedupe_conflicts(spark, sf):
    return cl.conflicts(hourly_by_type(spark, sf))


_AUDIT_COLUMNS = "holiday, temp, rain_1h, snow_1h, clouds_all, weather_main, weather_description, date_time, traffic_volume"


def _pairs(step: str, source: str, metrics: dict[str, str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{step}' AS step, '{name}' AS metric, '' AS key, CAST({expr} AS BIGINT) AS value FROM {source}"
        for name, expr in metrics.items()
    )


_AUDIT_SQL = f"""WITH {KEPT_SQL},
joined AS (
  SELECT raw.*, tidy.weather_main AS wm, tidy.weather_description AS wd, tidy.date_time AS parsed,
    regexp_replace(raw.weather_description, '^\\s+|\\s+$', '', 'g') AS stripped
  FROM raw JOIN tidy USING (_ord)),
copies AS (SELECT {_AUDIT_COLUMNS}, count(*) AS n FROM tidy GROUP BY ALL),
hours AS (SELECT date_time, count(*) AS n, count(DISTINCT traffic_volume) AS v FROM copies GROUP BY 1),
months AS (
  SELECT month(date_time) AS mo,
    sum(CASE WHEN temp <= 0 THEN 1 ELSE 0 END) AS t, count(CASE WHEN NOT temp <= 0 THEN 1 END) AS tn,
    sum(CASE WHEN rain_1h > 1000 THEN 1 ELSE 0 END) AS r, count(CASE WHEN NOT rain_1h > 1000 THEN 1 END) AS rn
  FROM (SELECT * EXCLUDE (_ord) FROM kept) WHERE date_time IS NOT NULL GROUP BY 1)
{_pairs('read', 'joined', {
    'rows_loaded': 'count(*)',
    'holiday_missing': 'count(*) - count(holiday)',
    'weather_main_trimmed': 'sum(CASE WHEN wm IS DISTINCT FROM weather_main THEN 1 ELSE 0 END)',
    'weather_description_trimmed': 'sum(CASE WHEN stripped IS DISTINCT FROM weather_description THEN 1 ELSE 0 END)',
    'weather_description_lowered': 'sum(CASE WHEN wd IS DISTINCT FROM stripped THEN 1 ELSE 0 END)',
    'date_time_unparsed': 'sum(CASE WHEN parsed IS NULL AND date_time IS NOT NULL THEN 1 ELSE 0 END)',
    'descriptions_before': 'count(DISTINCT stripped)',
    'descriptions_after': 'count(DISTINCT wd)',
})}
UNION ALL {_pairs('duplicates', 'copies', {'exact_duplicates': 'sum(n - 1)'})}
UNION ALL {_pairs('duplicates', 'hours', {
    'duplicate_hours': 'count(CASE WHEN date_time IS NOT NULL AND n > 1 THEN 1 END)',
    'conflicting_hours': 'count(CASE WHEN date_time IS NOT NULL AND n > 1 AND v > 1 THEN 1 END)',
    'repeat_rows_removed': 'sum(n - 1)',
    'rows_kept': 'count(*)',
})}
UNION ALL {_pairs('invalid', 'kept', {
    'temp_invalid': 'sum(CASE WHEN temp <= 0 THEN 1 ELSE 0 END)',
    'rain_1h_invalid': 'sum(CASE WHEN rain_1h > 1000 THEN 1 ELSE 0 END)',
})}
UNION ALL SELECT 'filled', 'temp_filled', CAST(mo AS VARCHAR), CAST(t AS BIGINT) FROM months WHERE t > 0 AND tn > 0
UNION ALL SELECT 'filled', 'rain_1h_filled', CAST(mo AS VARCHAR), CAST(r AS BIGINT) FROM months WHERE r > 0 AND rn > 0"""


@query(_AUDIT_SQL)
def audit_table(spark, sf):
    return cl.audit(raw_readings(spark, sf))


@query("""WITH checked AS (
  SELECT isodow(ts) - 1 AS dow, CASE WHEN value > 200 THEN NULL ELSE value END AS value FROM events)
SELECT dow, count(*) - count(value) AS n_filled FROM checked GROUP BY 1""")
def impute_counts(spark, sf):
    ev = table(spark, sf, "events")
    blanked = cl.null_where(ev, {"value": F.col("value") > 200}).withColumn("dow", x.monday_zero("ts"))
    return wide_ints(blanked.groupBy("dow").agg((F.count("*") - F.count("value")).alias("n_filled")))


@query(f"""WITH {CLEAN_SQL}
SELECT holiday, round(temp, 6) AS temp, round(rain_1h, 6) AS rain_1h, round(snow_1h, 6) AS snow_1h,
  CAST(clouds_all AS BIGINT) AS clouds_all, weather_main, weather_description, date_time,
  CAST(traffic_volume AS BIGINT) AS traffic_volume FROM clean""")
def cleaned_hours(spark, sf):
    return tidy(clean_readings(spark, sf)).select(*vocab.RAW_COLUMNS)
