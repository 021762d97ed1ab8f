"""Gaps, lookback windows, time split, and metrics of given predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import metrics, series, split
from tidemark.operators.features import moments
from tidemark.plans.registry import query, rounded, tidy, wide_ints
from tidemark.plans.standins import FEATURE_SQL, HOURLY_SQL, feature_table, hourly, hourly_by_type, table

# One series per event type: hours without an event of the type are its gaps.
KEYS = ["event_type"]
_OBS = """obs AS (SELECT event_type, date_trunc('hour', ts) AS date_time, count(*) AS traffic_volume, avg(value) AS temp
  FROM events GROUP BY 1, 2)"""
_STEPS = f"""{_OBS},
steps AS (SELECT event_type, date_time, lag(date_time) OVER o AS previous,
  date_diff('second', lag(date_time) OVER o, date_time) / 3600 AS step_hours
  FROM obs WINDOW o AS (PARTITION BY event_type ORDER BY date_time))"""


def _series(spark, sf):
    return hourly_by_type(spark, sf).select("event_type", "date_time", "traffic_volume", "temp")


@query("""WITH r AS (SELECT user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS r, count(*) OVER (PARTITION BY user_id) AS n FROM events),
cut AS (SELECT user_id, ts AS cutoff FROM r WHERE r = CAST(floor(n * (1 - 0.2)) AS BIGINT))
SELECT user_id, count(*) FILTER (WHERE ts < cutoff) AS n_train, count(*) FILTER (WHERE ts >= cutoff) AS n_test,
  min(ts) FILTER (WHERE ts >= cutoff) AS first_test FROM events JOIN cut USING (user_id) GROUP BY 1""")
def key_split(spark, sf):
    """Every user's events split at a time of their own."""
    parts = split.key_split(table(spark, sf, "events").select("user_id", "ts"), "ts", ["user_id"])
    test = F.col("split") == "test"
    return parts.groupBy("user_id").agg(
        F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(test).alias("n_test"), F.min(F.when(test, F.col("ts"))).alias("first_test")
    )


@query(f"WITH {_STEPS} SELECT event_type, date_time, previous, round(CAST(step_hours AS DOUBLE), 6) AS step_hours FROM steps")
def gap_steps(spark, sf):
    return rounded(series.gap_steps(_series(spark, sf), keys=KEYS, block_hours=48))


@query(f"""WITH {_STEPS}
SELECT event_type, count(*) AS n_rows, count(CASE WHEN step_hours = 1 THEN 1 END) AS one_hour_steps,
  count(CASE WHEN step_hours > 1 THEN 1 END) AS gap_events,
  CAST(coalesce(sum(CASE WHEN step_hours > 1 THEN step_hours - 1 END), 0) AS BIGINT) AS missing_hours FROM steps GROUP BY 1""")
def gap_stats(spark, sf):
    return series.gap_stats(_series(spark, sf), keys=KEYS)


@query(f"""WITH {_STEPS}
SELECT event_type, date_time, previous, round(CAST(step_hours AS DOUBLE), 6) AS step_hours FROM steps WHERE step_hours > 1
ORDER BY step_hours DESC, date_time, event_type LIMIT 10""")
def largest_gaps(spark, sf):
    return rounded(series.largest_gaps(_series(spark, sf), keys=KEYS))


def _count_sql(n: int) -> str:
    return f"""SELECT event_type, CAST({n} AS BIGINT) AS lookback, greatest(count(*) - {n}, 0) AS candidates,
  count(CASE WHEN date_diff('second', p{n}, date_time) = {n} * 3600 THEN 1 END) AS valid FROM lags GROUP BY 1"""


@query(f"""WITH {_OBS},
lags AS (SELECT event_type, date_time, lag(date_time, 6) OVER o AS p6, lag(date_time, 12) OVER o AS p12,
  lag(date_time, 24) OVER o AS p24 FROM obs WINDOW o AS (PARTITION BY event_type ORDER BY date_time))
{_count_sql(6)} UNION ALL {_count_sql(12)} UNION ALL {_count_sql(24)}""")
def valid_windows(spark, sf):
    return wide_ints(series.window_counts(_series(spark, sf), keys=KEYS, block_hours=72))


_WINDOWS = f"""{_OBS},
t AS (SELECT event_type, date_time AS target_time, traffic_volume AS target FROM (
  SELECT *, lag(date_time, 24) OVER (PARTITION BY event_type ORDER BY date_time) AS p FROM obs)
  WHERE date_diff('second', p, date_time) = 24 * 3600),
w AS (SELECT t.event_type, target_time, CAST(target AS DOUBLE) AS target,
  24 + date_diff('hour', target_time, date_time) AS step, CAST(traffic_volume AS DOUBLE) AS traffic_volume, temp
  FROM t JOIN obs ON obs.event_type = t.event_type AND date_time < target_time AND date_time >= target_time - INTERVAL 24 HOUR)"""


def _windows(spark, sf):
    return series.lookback_windows(_series(spark, sf), ["traffic_volume", "temp"], keys=KEYS, block_hours=72)


@query(f"""WITH {_WINDOWS}
SELECT event_type, target_time, target, step, traffic_volume, round(temp, 6) AS temp FROM w""")
def window_sequences(spark, sf):
    return tidy(series.steps_long(_windows(spark, sf), KEYS))


_CUTOFF = "(SELECT date_time FROM (SELECT date_time, row_number() OVER (ORDER BY date_time) - 1 AS r, count(*) OVER () AS n FROM {t}) WHERE r = CAST(floor(n * (1 - 0.2)) AS BIGINT))"
_SCALED = f"""{_WINDOWS},
c AS (SELECT {_CUTOFF.format(t='obs')} AS cutoff),
m AS (SELECT avg(traffic_volume) AS vm, stddev_pop(traffic_volume) AS vs, avg(temp) AS tm, stddev_pop(temp) AS ts
  FROM obs, c WHERE date_time < cutoff)"""


def training_scales(obs, cutoff):
    """Population moments of the training rows, as scalars per field."""
    stats = moments(obs.where(F.col("date_time") < F.lit(cutoff)), ["traffic_volume", "temp"], population=True)
    stats = stats.select(F.struct("traffic_volume", "temp").alias("s")).scalar()
    return {c: (stats[c]["mean"], stats[c]["std"]) for c in ("traffic_volume", "temp")}


@query(f"""WITH {_SCALED}
SELECT event_type, target_time, CASE WHEN target_time < cutoff THEN 'train' ELSE 'test' END AS split,
  round((target - vm) / vs, 6) AS target, step, round((traffic_volume - vm) / vs, 6) AS traffic_volume,
  round((temp - tm) / ts, 6) AS temp FROM w, c, m""")
def scaled_sequences(spark, sf):
    obs = _series(spark, sf)
    cutoff = split.time_cutoff(obs, "date_time")
    scaled = series.scale_windows(_windows(spark, sf), training_scales(obs, cutoff))
    return tidy(split.with_split(series.steps_long(scaled, KEYS), "target_time", cutoff))


@query(f"""WITH {_SCALED},
back AS (SELECT DISTINCT event_type, target_time, target AS y, (round((target - vm) / vs, 1)) * vs + vm AS p FROM w, c, m
  WHERE target_time >= cutoff)
SELECT count(*) AS n, round(avg(abs(y - p)), 6) AS mae, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2 FROM back""")
def inverse_scale(spark, sf):
    """Errors of a coarse forecast after going back to the original unit."""
    obs = _series(spark, sf)
    cutoff = split.time_cutoff(obs, "date_time")
    scales = training_scales(obs, cutoff)
    windows = series.scale_windows(_windows(spark, sf), scales).where(F.col("target_time") >= F.lit(cutoff))
    forecast = windows.select(
        series.unscale("target", *scales["traffic_volume"]).alias("y"),
        series.unscale(F.round("target", 1), *scales["traffic_volume"]).alias("prediction"),
    )
    return rounded(metrics.regression_metrics(forecast, "y"))


# --- split -------------------------------------------------------------------
@query(f"""WITH {HOURLY_SQL}, c AS (SELECT {_CUTOFF.format(t='h')} AS cutoff)
SELECT date_time, CASE WHEN date_time < cutoff THEN 'train' ELSE 'test' END AS split FROM h, c""")
def time_split(spark, sf):
    h = hourly(spark, sf)
    return split.with_split(h, "date_time", split.time_cutoff(h, "date_time")).select("date_time", "split")


@query("""WITH c AS (SELECT o_orderdate AS cutoff FROM (
  SELECT o_orderdate, row_number() OVER (ORDER BY o_orderdate) - 1 AS r, count(*) OVER () AS n FROM orders)
  WHERE r = CAST(floor(n * (1 - 0.2)) AS BIGINT))
SELECT CASE WHEN o_orderdate < cutoff THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows FROM orders, c GROUP BY 1""")
def time_split_ties(spark, sf):
    """Many rows share a date: the cutoff is a row rank, ties all go to the test side."""
    orders = table(spark, sf, "orders").select("o_orderdate")
    cutoff = split.time_cutoff(orders, "o_orderdate")
    return split.with_split(orders, "o_orderdate", cutoff).groupBy("split").agg(F.count("*").alias("n_rows"))


@query(f"""WITH {FEATURE_SQL},
known AS (SELECT * FROM feat WHERE date_time IS NOT NULL),
c AS (SELECT {_CUTOFF.format(t='known')} AS cutoff)
SELECT CASE WHEN date_time < cutoff THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows,
  min(date_time) AS first_time, max(date_time) AS last_time, round(avg(high_risk), 6) AS label_rate
FROM known, c GROUP BY 1""")
def split_summary(spark, sf):
    feat = feature_table(spark, sf)
    parts = split.with_split(feat, "date_time", split.time_cutoff(feat, "date_time"))
    return rounded(split.split_summary(parts, "date_time", "high_risk"))


# --- metrics of given predictions --------------------------------------------
def _scored(spark, sf):
    """Label: returned lines. Score: discount plus tax, with many ties."""
    return table(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        F.round(F.col("l_discount") * 5 + F.col("l_tax"), 2).alias("score"),
        F.when(F.col("l_discount") > 0.05, 1).otherwise(0).alias("prediction"),
    )


_SCORED = """s AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
  round(l_discount * 5 + l_tax, 2) AS score, CASE WHEN l_discount > CAST(0.05 AS DOUBLE) THEN 1 ELSE 0 END AS prediction FROM lineitem)"""


@query(f"""WITH {_SCORED},
c AS (SELECT CAST(count(*) AS DOUBLE) AS n, count(CASE WHEN label = 1 AND prediction = 1 THEN 1 END) AS tp,
  count(CASE WHEN label = 0 AND prediction = 1 THEN 1 END) AS fp, count(CASE WHEN label = 1 AND prediction = 0 THEN 1 END) AS fn,
  count(CASE WHEN label = prediction THEN 1 END) AS ok FROM s)
SELECT round(ok / n, 6) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision",
  round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c""")
def class_metrics(spark, sf):
    return rounded(metrics.class_metrics(_scored(spark, sf)))


@query(f"""WITH {_SCORED},
g AS (SELECT score, sum(label) AS p, sum(1 - label) AS q FROM s GROUP BY 1),
r AS (SELECT *, coalesce(sum(q) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
SELECT round(CAST(sum(p * (below + q / 2.0)) AS DOUBLE) / (CAST(sum(p) AS DOUBLE) * sum(q)), 6) AS roc_auc FROM r""")
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(_scored(spark, sf)))


@query("""WITH s AS (SELECT l_extendedprice AS y, l_quantity * 1500 AS p FROM lineitem)
SELECT count(*) AS n, round(avg(abs(y - p)), 4) AS mae, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2 FROM s""")
def regression_metrics(spark, sf):
    li = table(spark, sf, "lineitem").select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("prediction")
    )
    out = metrics.regression_metrics(li, "y")
    return out.select("n", F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"))
