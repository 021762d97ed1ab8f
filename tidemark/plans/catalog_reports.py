"""Reporting queries: years, days, hours, distributions, lookups."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.functions import expressions as x
from tidemark.operators import asof, reports, stats
from tidemark.operators.ranks import exact_quantiles
from tidemark.plans.registry import query, rounded, tidy
from tidemark.plans.standins import (
    FEATURE_SQL, HOURLY_SQL, HOURLY_TYPE_SQL, feature_table, hourly, hourly_by_type, table,
)
from tidemark.sources.readers import distinct_view

_ORDERS_SQL = """hourly_traffic AS (
  SELECT DISTINCT o_orderdate AS date_time, CAST(floor(o_totalprice) AS BIGINT) AS traffic_volume FROM orders
  WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '2001-01-01')"""


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderdate").alias("date_time"), F.floor("o_totalprice").alias("traffic_volume")
    )


@query(f"""WITH {_ORDERS_SQL}
SELECT strftime(date_time, '%Y') AS year, count(*) AS hours_recorded,
  round(CAST(100 AS DOUBLE) * count(*) / CASE WHEN year(date_time) % 4 = 0 THEN 8784 ELSE 8760 END, 1) AS pct_hours_covered,
  CAST(sum(traffic_volume) AS BIGINT) AS total_traffic_volume,
  round(avg(traffic_volume), 1) AS avg_traffic_volume_per_hour
FROM hourly_traffic GROUP BY strftime(date_time, '%Y'), year(date_time)""")
def annual_coverage(spark, sf):
    return reports.annual_coverage(_orders(spark, sf), "date_time", "traffic_volume", 1995, 2000)


@query(f"""WITH {_ORDERS_SQL},
yearly AS (
  SELECT strftime(date_time, '%Y') AS year, count(*) AS n, CAST(sum(traffic_volume) AS BIGINT) AS t, avg(traffic_volume) AS a
  FROM hourly_traffic GROUP BY 1),
w AS (SELECT *, lag(t) OVER (ORDER BY year) AS pt, lag(a) OVER (ORDER BY year) AS pa FROM yearly)
SELECT year, n AS hours_recorded, t AS total_traffic_volume, t - pt AS total_change_vs_prev_year,
  round(CAST(100 AS DOUBLE) * (t - pt) / nullif(pt, 0), 2) AS total_pct_change_vs_prev_year,
  round(a, 1) AS avg_traffic_volume, round(a - pa, 1) AS avg_change_vs_prev_year,
  round(CAST(100 AS DOUBLE) * (a - pa) / nullif(pa, 0), 2) AS avg_pct_change_vs_prev_year
FROM w""")
def annual_change(spark, sf):
    return reports.annual_change(_orders(spark, sf), "date_time", "traffic_volume", 1995, 2000)


@query(f"WITH {HOURLY_TYPE_SQL} SELECT DISTINCT date_time, traffic_volume FROM he")
def distinct_readings(spark, sf):
    return distinct_view(hourly_by_type(spark, sf), ["date_time", "traffic_volume"], "hourly_traffic")


@query(f"WITH {HOURLY_TYPE_SQL} SELECT DISTINCT date_time, round(temp, 9) AS temp, traffic_volume FROM he")
def distinct_weather_readings(spark, sf):
    rows = rounded(hourly_by_type(spark, sf).select("date_time", "temp", "traffic_volume"), 9)
    return distinct_view(rows, ["date_time", "temp", "traffic_volume"], "hourly_weather")


_LABELS = [
    ("New Years Day (Jan 1)", date(2024, 1, 1)),
    ("Martin Luther King Jr Day (Jan 15)", date(2024, 1, 15)),
    ("Last full Sunday (Jan 28)", date(2024, 1, 28)),
    ("Not on record (Feb 19)", date(2024, 2, 19)),
]
_LABELS_SQL = ", ".join(f"('{label}', DATE '{day}')" for label, day in _LABELS)


@query(f"""WITH {HOURLY_TYPE_SQL},
hourly_weather AS (SELECT DISTINCT date_time, temp, traffic_volume FROM he),
d(label, day) AS (VALUES {_LABELS_SQL})
SELECT label, count(date_time) AS hours_recorded, round(min(temp), 2) AS min_temp_K, round(max(temp), 2) AS max_temp_K,
  round(avg(temp), 2) AS avg_temp_K, round(avg(traffic_volume), 1) AS avg_traffic_volume
FROM d LEFT JOIN hourly_weather ON CAST(date_time AS DATE) = day GROUP BY label""")
def date_summary(spark, sf):
    return reports.date_summary(hourly_by_type(spark, sf), _LABELS)


@query(f"""WITH {FEATURE_SQL}
SELECT CAST(year(date_time) AS BIGINT) AS year, round(avg(traffic_volume), 6) AS avg_traffic_volume,
  round(avg(CASE WHEN risk_congestion_category IN ('High', 'Severe') THEN 1 ELSE 0 END), 6) AS pct_high_or_severe_congestion,
  round(avg(is_severe_weather), 6) AS pct_severe_weather, round(avg(is_low_visibility), 6) AS pct_low_visibility,
  round(avg(high_risk), 6) AS pct_high_risk
FROM feat WHERE date_time IS NOT NULL GROUP BY 1""")
def yearly_diagnostic(spark, sf):
    return tidy(reports.yearly_diagnostic(feature_table(spark, sf)))


_HOUR_MEANS = "SELECT CAST(hour AS BIGINT) AS hour, round(avg(traffic_volume), 6) AS avg_volume FROM h"


@query(f"WITH {HOURLY_SQL} {_HOUR_MEANS} GROUP BY 1")
def hourly_means(spark, sf):
    return tidy(reports.hourly_means(hourly(spark, sf)))


@query(f"""WITH {HOURLY_SQL}
SELECT CAST(hour AS BIGINT) AS hour, round(a, 6) AS avg_volume FROM (
  SELECT hour, avg(traffic_volume) AS a FROM h GROUP BY 1 ORDER BY a DESC, hour LIMIT 5)""")
def peak_hours(spark, sf):
    return tidy(reports.peak_hours(hourly(spark, sf)))


@query(f"""WITH {HOURLY_SQL}
SELECT CAST(hour AS BIGINT) AS hour, round(a, 6) AS avg_volume FROM (
  SELECT hour, avg(traffic_volume) AS a FROM h WHERE hour BETWEEN 5 AND 22 GROUP BY 1 ORDER BY a, hour LIMIT 5)""")
def quiet_hours(spark, sf):
    return tidy(reports.quiet_hours(hourly(spark, sf)))


@query(f"""WITH {HOURLY_SQL}
SELECT CASE is_weekend WHEN 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type, round(avg(traffic_volume), 6) AS mean,
  round(quantile_cont(traffic_volume, 0.5), 6) AS median, round(stddev_samp(traffic_volume), 6) AS std
FROM h GROUP BY is_weekend""")
def weekend_compare(spark, sf):
    return rounded(reports.weekend_comparison(hourly(spark, sf)))


@query(f"""WITH {HOURLY_SQL}
SELECT CAST(hour AS BIGINT) AS hour, round(avg(CASE WHEN is_weekend = 0 THEN traffic_volume END), 6) AS weekday,
  round(avg(CASE WHEN is_weekend = 1 THEN traffic_volume END), 6) AS weekend FROM h GROUP BY 1""")
def hour_by_weekend_pivot(spark, sf):
    return tidy(reports.hour_by_weekend(hourly(spark, sf)))


# --- distributions over the largest table ------------------------------------
@query("""WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
c AS (SELECT least(CAST(floor(40 * (l_extendedprice - lo) / (hi - lo)) AS BIGINT) + 1, 40) AS bin, count(*) AS n
      FROM lineitem, e GROUP BY 1)
SELECT CAST(b AS BIGINT) AS bin, round(lo + (b - 1) * ((hi - lo) / 40), 6) AS bin_start,
  round(lo + b * ((hi - lo) / 40), 6) AS bin_end, coalesce(n, 0) AS n_rows
FROM range(1, 41) t(b) CROSS JOIN e LEFT JOIN c ON c.bin = b""")
def histogram(spark, sf):
    return tidy(stats.histogram(table(spark, sf, "lineitem"), "l_extendedprice"))


@query("""SELECT round(avg(l_extendedprice), 4) AS mean, round(quantile_cont(l_extendedprice, 0.5), 6) AS median FROM lineitem""")
def mean_and_median(spark, sf):
    out = stats.centre(table(spark, sf, "lineitem"), "l_extendedprice")
    return out.select(F.round("mean", 4).alias("mean"), F.round("median", 6).alias("median"))


@query("""WITH q AS (
  SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS med,
    quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1)
SELECT l_returnflag, count(*) AS n_rows, round(any_value(q1), 6) AS q1, round(any_value(med), 6) AS median,
  round(any_value(q3), 6) AS q3,
  round(min(CASE WHEN l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN l_extendedprice END), 6) AS whisker_low,
  round(max(CASE WHEN l_extendedprice BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) THEN l_extendedprice END), 6) AS whisker_high
FROM lineitem JOIN q USING (l_returnflag) GROUP BY 1""")
def box_stats(spark, sf):
    return rounded(stats.box_stats(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice"))


@query("""SELECT l_returnflag, count(*) AS n_rows, round(count(*) / (SELECT count(l_returnflag) FROM lineitem), 6) AS share
FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1""")
def value_counts(spark, sf):
    return rounded(reports.value_shares(table(spark, sf, "lineitem"), "l_returnflag"))


@query("""SELECT 'l_partkey' AS column_name, count(DISTINCT l_partkey) AS n_distinct FROM lineitem
UNION ALL SELECT 'l_suppkey', count(DISTINCT l_suppkey) FROM lineitem
UNION ALL SELECT 'l_shipdate', count(DISTINCT l_shipdate) FROM lineitem""")
def distinct_counts(spark, sf):
    return reports.distinct_counts(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey", "l_shipdate"])


def _describe_sql(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 4) AS mean,
  round(quantile_cont({c}, 0.5), 4) AS median, round(stddev_samp({c}), 4) AS std,
  round(min({c}), 4) AS min, round(max({c}), 4) AS max FROM lineitem"""


_DESCRIBED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("\nUNION ALL ".join(_describe_sql(c) for c in _DESCRIBED))
def descriptive(spark, sf):
    return rounded(stats.describe(table(spark, sf, "lineitem"), _DESCRIBED), 4)


@query("\nUNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM lineitem"
    for i, a in enumerate(_DESCRIBED) for b in _DESCRIBED[i + 1:]))
def correlations(spark, sf):
    return rounded(stats.correlations(table(spark, sf, "lineitem"), _DESCRIBED))


@query("""WITH c AS (SELECT CAST(count(*) AS DOUBLE) AS n, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS a,
  count(CASE WHEN l_quantity > 25 THEN 1 END) AS b,
  count(CASE WHEN l_returnflag = 'R' AND l_quantity > 25 THEN 1 END) AS ab FROM lineitem)
SELECT round(a / n, 6) AS p_a, round(b / n, 6) AS p_b, round(ab / n, 6) AS p_a_and_b,
  round(ab / b, 6) AS p_a_given_b, round(ab / a, 6) AS p_b_given_a FROM c""")
def conditional_prob(spark, sf):
    li = table(spark, sf, "lineitem")
    return rounded(stats.event_probabilities(li, F.col("l_returnflag") == "R", F.col("l_quantity") > 25))


@query("""SELECT l_returnflag, l_linestatus, round(quantile_cont(l_extendedprice, 0.1), 6) AS p10,
  round(quantile_cont(l_extendedprice, 0.9), 6) AS p90 FROM lineitem GROUP BY 1, 2""")
def exact_quantiles_sliced(spark, sf):
    li = table(spark, sf, "lineitem")
    out = exact_quantiles(li, "l_extendedprice", [0.1, 0.9], ["l_returnflag", "l_linestatus"])
    q = F.col("l_extendedprice")
    return rounded(out.select("l_returnflag", "l_linestatus", q[0].alias("p10"), q[1].alias("p90")))


_PARTLY = """CASE WHEN l_linenumber = 3 THEN NULL WHEN l_quantity > 49 THEN CAST('Infinity' AS DOUBLE)
  WHEN l_quantity < 2 THEN CAST('-Infinity' AS DOUBLE) ELSE l_quantity END"""


@query(f"""SELECT CAST(l_linenumber AS BIGINT) AS l_linenumber, round(quantile_cont(v, 0), 6) AS lowest, round(quantile_cont(v, 0.3), 6) AS p30,
  round(quantile_cont(v, 1), 6) AS highest FROM (SELECT l_linenumber, {_PARTLY} AS v FROM lineitem) GROUP BY 1""")
def quantiles_incomplete(spark, sf):
    """A key without any value, and values that are infinite."""
    quantity, infinite = F.col("l_quantity").cast("double"), F.lit(float("inf"))
    value = F.when(F.col("l_linenumber") == 3, None).when(quantity > 49, infinite).when(quantity < 2, -infinite).otherwise(quantity)
    out = exact_quantiles(table(spark, sf, "lineitem").withColumn("v", value), "v", [0.0, 0.3, 1.0], ["l_linenumber"])
    v = F.col("v")
    return tidy(out.select("l_linenumber", v[0].alias("lowest"), v[1].alias("p30"), v[2].alias("highest")))


# --- lookups -----------------------------------------------------------------
_SERIES_SQL = """obs AS (
  SELECT date_trunc('hour', ts) AS date_time, count(*) AS traffic_volume, avg(value) AS temp
  FROM events WHERE event_type = 'purchase' GROUP BY 1),
req AS (SELECT event_id, CASE event_type WHEN 'error' THEN ts WHEN 'signup' THEN date_trunc('hour', ts)
  WHEN 'purchase' THEN date_trunc('hour', ts) + INTERVAL 30 MINUTE WHEN 'click' THEN ts - INTERVAL 40 DAY
  ELSE ts + INTERVAL 40 DAY END AS t FROM events)"""


def purchase_hours(spark, sf):
    ev = table(spark, sf, "events").where("event_type = 'purchase'")
    return ev.groupBy(x.hour_start("ts").alias("date_time")).agg(
        F.count("*").alias("traffic_volume"), F.avg("value").alias("temp")
    )


def _requests(spark, sf):
    """A request per event: off the hour, on it, half way between two, before the first
    reading and after the last."""
    days = F.make_dt_interval(F.lit(40))
    half = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(30))
    when = (
        F.when(F.col("event_type") == "error", F.col("ts"))
        .when(F.col("event_type") == "signup", x.hour_start("ts"))
        .when(F.col("event_type") == "purchase", x.hour_start("ts") + half)
        .when(F.col("event_type") == "click", F.col("ts") - days)
        .otherwise(F.col("ts") + days)
    )
    return table(spark, sf, "events").select("event_id", when.alias("requested_date_time"))


@query(f"""WITH {_SERIES_SQL.replace(" WHERE event_type = 'purchase'", "")},
pick AS (
  SELECT event_id, t,
    (SELECT max(date_time) FROM obs WHERE date_time <= t) AS lo,
    (SELECT min(date_time) FROM obs WHERE date_time >= t) AS hi FROM (SELECT * FROM req)),
near AS (
  SELECT event_id, t, CASE WHEN hi IS NULL OR (lo IS NOT NULL AND t - lo <= hi - t) THEN lo ELSE hi END AS n FROM pick)
SELECT event_id, t AS requested_date_time, n AS nearest_available, traffic_volume, round(temp, 6) AS temp_kelvin,
  n = t AS exact_match FROM near JOIN obs ON date_time = n""")
def nearest_lookup(spark, sf):
    out = asof.nearest_readings(_requests(spark, sf), hourly(spark, sf), fields=["traffic_volume", "temp"])
    return rounded(out)


@query("""SELECT TIMESTAMP '2024-01-10 12:31:00' AS requested_date_time, date_time AS nearest_available, traffic_volume,
  round(temp, 6) AS temp_kelvin, false AS exact_match
FROM (SELECT date_trunc('hour', ts) AS date_time, count(*) AS traffic_volume, avg(value) AS temp FROM events GROUP BY 1)
ORDER BY abs(epoch_us(date_time) - epoch_us(TIMESTAMP '2024-01-10 12:31:00')), date_time LIMIT 1""")
def nearest_single(spark, sf):
    out = asof.reading_at(hourly(spark, sf), "2024-01-10 12:31:00", fields=["traffic_volume", "temp"])
    return rounded(out)


@query(f"""WITH {HOURLY_TYPE_SQL}
SELECT date_time, event_type, traffic_volume FROM he WHERE date_time = TIMESTAMP '2024-01-10 12:00:00'""")
def exact_lookup(spark, sf):
    from datetime import datetime

    found = asof.reading_exactly_at(hourly_by_type(spark, sf), datetime(2024, 1, 10, 12))
    return found.select("date_time", "event_type", "traffic_volume")


# --- weather profiles --------------------------------------------------------
@query(f"""WITH {FEATURE_SQL}
SELECT weather_main, round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM feat), 6) AS frequency,
  round(avg(temp_scaled), 6) AS temp_scaled, round(avg(rain_1h), 6) AS rain_1h,
  round(avg(snow_1h), 6) AS snow_1h, round(avg(clouds_all), 6) AS clouds_all
FROM feat WHERE weather_main IS NOT NULL GROUP BY 1""")
def weather_profile(spark, sf):
    conditions = ["temp_scaled", "rain_1h", "snow_1h", "clouds_all"]
    return rounded(reports.weather_profile(feature_table(spark, sf), conditions))


@query(f"""WITH {HOURLY_TYPE_SQL},
p AS (SELECT event_type, hour, avg(traffic_volume) AS v FROM he GROUP BY 1, 2),
w AS (SELECT event_type, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM he) AS f FROM he GROUP BY 1)
SELECT CAST(hour AS BIGINT) AS hour, round(sum(v * f), 6) AS volume FROM p JOIN w USING (event_type) GROUP BY 1""")
def weighted_profile(spark, sf):
    he = hourly_by_type(spark, sf)
    profiles = reports.hourly_means(he, keys=["event_type", "hour"]).withColumnRenamed("avg_volume", "volume")
    weights = reports.weather_profile(he, [], "event_type")
    return tidy(reports.weighted_profile(profiles, weights, "event_type"))
