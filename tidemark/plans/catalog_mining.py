"""Association rules, clustering on given labels, given attributions, run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import vocab
from tidemark.operators import cluster, explain, metrics, registry
from tidemark.operators import features as ft
from tidemark.operators import rules as rl
from tidemark.plans.catalog_features import _DAY_PART, _WEATHER_GROUP
from tidemark.plans.registry import query, rounded, tidy, wide_ints
from tidemark.plans.standins import HOURLY_SQL, TIDY_SQL, hourly, table, tidy_readings

# --- rules -------------------------------------------------------------------
_TRANSACTIONS = f"""WITH {TIDY_SQL},
q AS (SELECT quantile_cont(traffic_volume, 0.25) AS q1, quantile_cont(traffic_volume, 0.5) AS q2,
  quantile_cont(traffic_volume, 0.75) AS q3 FROM tidy),
t AS MATERIALIZED (
  SELECT 'time_of_day_' || {_DAY_PART} AS a, 'weather_bucket_' || {_WEATHER_GROUP} AS b,
    'weekday_type_' || CASE WHEN isodow(date_time) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS c,
    'congestion_level_' || CASE WHEN traffic_volume <= q1 THEN 'Low' WHEN traffic_volume <= q2 THEN 'Medium'
      WHEN traffic_volume <= q3 THEN 'High' ELSE 'Severe' END AS d
  FROM tidy, q),
n AS MATERIALIZED (SELECT CAST(count(*) AS DOUBLE) AS n FROM t),
cubed AS MATERIALIZED (SELECT a, b, c, d, count(*) AS n_rows FROM t GROUP BY CUBE (a, b, c, d) HAVING GROUPING(a, b, c, d) < 15),
sets AS MATERIALIZED (
  SELECT items, array_to_string(items, ', ') AS name, n_rows, n_rows / n AS support
  FROM (SELECT list_sort(list_filter([a, b, c, d], lambda v: v IS NOT NULL)) AS items, n_rows FROM cubed), n WHERE n_rows / n >= 0.005),
split AS MATERIALIZED (
  SELECT items, support, unnest(range(1, CAST(pow(2, len(items)) AS BIGINT) - 1)) AS mask FROM sets WHERE len(items) >= 2),
sides AS MATERIALIZED (
  SELECT support, array_to_string(list_filter(items, lambda v, i: (mask >> (i - 1)) & 1 = 1), ', ') AS lhs,
    array_to_string(list_filter(items, lambda v, i: (mask >> (i - 1)) & 1 = 0), ', ') AS rhs, len(items) - bit_count(mask) AS n_right FROM split),
rules AS MATERIALIZED (
  SELECT lhs AS antecedents, rhs AS consequents, n_right,
    x.support AS sa, y.support AS sc, sides.support AS support, sides.support / x.support AS confidence,
    sides.support / x.support / y.support AS lift
  FROM sides JOIN sets x ON x.name = lhs JOIN sets y ON y.name = rhs),
kept AS (SELECT * FROM rules WHERE lift >= 1)"""


def transactions(spark, sf):
    rows = tidy_readings(spark, sf).transform(ft.add_time).transform(ft.add_risk_congestion)
    return ft.add_rule_attributes(rows)


@query(f"""{_TRANSACTIONS}
SELECT array_to_string(items, ', ') AS items, len(items) AS n_items, n_rows, round(support, 6) AS support FROM sets""")
def itemsets(spark, sf):
    found = rl.itemsets(transactions(spark, sf))
    return tidy(found.withColumn("items", F.array_join("items", ", ")))


@query(f"""{_TRANSACTIONS}
SELECT array_to_string(items, ', ') AS items, len(items) AS n_items, n_rows, round(support, 6) AS support FROM sets""")
def itemsets_fpgrowth(spark, sf):
    found = rl.itemsets_fpgrowth(transactions(spark, sf))
    return tidy(found.withColumn("items", F.array_join("items", ", ")))


def _all_rules(spark, sf, single=False):
    return rl.rules(rl.itemsets(transactions(spark, sf)), single=single)


@query(f"""{_TRANSACTIONS}
SELECT antecedents, consequents, round(sa, 6) AS antecedent_support, round(sc, 6) AS consequent_support,
  round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift
FROM kept""")
def rules(spark, sf):
    out = _all_rules(spark, sf)
    for side in ("antecedents", "consequents"):
        out = out.withColumn(side, F.array_join(side, ", "))
    return rounded(out.drop("leverage", "conviction"))


@query(f"""{_TRANSACTIONS}
SELECT antecedents, consequents, round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift
FROM kept WHERE n_right = 1 AND consequents LIKE 'congestion_level_%'""")
def level_rules(spark, sf):
    out = rl.level_rules(_all_rules(spark, sf, single=True))
    return rounded(out.select("antecedents", "consequents", "support", "confidence", "lift"))


@query(f"""{_TRANSACTIONS}
SELECT antecedents, consequents, round(support - sa * sc, 6) AS leverage,
  round(CASE WHEN confidence < 1 THEN (1 - sc) / (1 - confidence) END, 6) AS conviction
FROM kept WHERE n_right = 1 AND consequents LIKE 'congestion_level_%'
ORDER BY round(lift, 9) DESC, antecedents, consequents LIMIT 15""")
def rule_measures(spark, sf):
    level = rl.level_rules(_all_rules(spark, sf, single=True)).withColumn("lift", F.round("lift", 9))
    return rounded(rl.top_rules(level).select("antecedents", "consequents", "leverage", "conviction"))


# --- clustering on given points and labels -----------------------------------
@query(f"""WITH {HOURLY_SQL},
m AS (SELECT avg(traffic_volume) AS vm, stddev_pop(traffic_volume) AS vs, avg(temp) AS tm, stddev_pop(temp) AS ts FROM h)
SELECT date_time, round((traffic_volume - vm) / vs, 6) AS traffic_volume_std, round((temp - tm) / ts, 6) AS temp_std FROM h, m""")
def standardise_population(spark, sf):
    out = cluster.standardise_population(hourly(spark, sf), ["traffic_volume", "temp"])
    return rounded(out.select("date_time", "traffic_volume_std", "temp_std"))


_CENTRES = [[5.0, 0.02], [25.0, 0.05], [45.0, 0.08], [25.0, 0.01]]
_DISTANCES = ", ".join(
    f"(l_quantity - {a}) * (l_quantity - {a}) + (l_discount - {b}) * (l_discount - {b}) AS d{i}"
    for i, (a, b) in enumerate(_CENTRES)
)


@query(f"""WITH d AS (SELECT l_orderkey, l_linenumber, {_DISTANCES} FROM lineitem),
b AS (SELECT *, least(d0, d1, d2, d3) AS d FROM d)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CAST(CASE WHEN d = d0 THEN 0 WHEN d = d1 THEN 1 WHEN d = d2 THEN 2 ELSE 3 END AS BIGINT) AS cluster FROM b""")
def assign_centres(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    out = cluster.assign_centres(li, ["l_quantity", "l_discount"], _CENTRES)
    return wide_ints(out.select("l_orderkey", "l_linenumber", "cluster"))


_SILHOUETTE = """WITH p AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id LIMIT 5000),
d AS (
  SELECT a.vec_id, a.label, b.label AS other, avg(CASE WHEN a.vec_id <> b.vec_id THEN list_distance(a.e, b.e) END) AS m
  FROM p a, p b GROUP BY 1, 2, 3),
s AS (
  SELECT vec_id, label, max(CASE WHEN other = label THEN m END) AS inside, min(CASE WHEN other <> label THEN m END) AS outside
  FROM d GROUP BY 1, 2),
v AS (SELECT vec_id, label, CASE WHEN inside IS NULL OR outside IS NULL THEN 0
  ELSE (outside - inside) / greatest(inside, outside) END AS silhouette FROM s)"""


@query(f"{_SILHOUETTE} SELECT vec_id, CAST(label AS BIGINT) AS label, round(silhouette, 6) AS silhouette FROM v")
def silhouette_points(spark, sf):
    return tidy(metrics.silhouette_scores(table(spark, sf, "embeddings"), "vec_id", "embedding", "label"))


@query(f"{_SILHOUETTE} SELECT round(avg(silhouette), 6) AS silhouette FROM v")
def silhouette(spark, sf):
    return rounded(metrics.silhouette(table(spark, sf, "embeddings"), "vec_id", "embedding", "label"))


_SEVERITY = " ".join(f"WHEN '{k}' THEN {v}" for k, v in vocab.SEVERITY.items())


@query(f"""WITH {TIDY_SQL},
c AS (SELECT *, clouds_all % 6 AS cluster FROM tidy),
w AS (SELECT cluster, weather_main, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, weather_main) AS r
  FROM c GROUP BY 1, 2)
SELECT CAST(c.cluster AS BIGINT) AS cluster, count(*) AS n_rows, round(avg(hour(date_time)), 6) AS avg_hour,
  round(avg(CASE c.weather_main {_SEVERITY} END), 6) AS avg_weather_severity, any_value(w.weather_main) AS most_common_weather,
  round(avg(CASE WHEN isodow(date_time) >= 6 THEN 1 ELSE 0 END), 6) AS pct_weekend,
  round(avg(traffic_volume), 6) AS avg_traffic_volume,
  round(count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM c), 2) AS pct_of_data
FROM c JOIN w ON w.cluster = c.cluster AND w.r = 1 GROUP BY 1""")
def cluster_profile(spark, sf):
    rows = tidy_readings(spark, sf).transform(ft.add_time).transform(ft.add_severity)
    return tidy(cluster.cluster_profile(rows.withColumn("cluster", F.col("clouds_all") % 6)))


# --- attributions given as a table -------------------------------------------
def _attributed(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("label").alias("hour"), F.col("embedding").cast("array<double>").alias("attribution")
    )


_FEATURE_LIST = ", ".join(f"'{c}'" for c in vocab.FEATURES)


@query(f"""WITH l AS (SELECT unnest([{_FEATURE_LIST}]) AS feature, unnest(CAST(embedding AS DOUBLE[])[1:{len(vocab.FEATURES)}]) AS v FROM embeddings)
SELECT feature, round(avg(abs(v)), 6) AS mean_abs_attribution FROM l GROUP BY 1""")
def attribution_rank(spark, sf):
    return rounded(explain.attribution_rank(_attributed(spark, sf)))


@query("""SELECT CAST(label AS BIGINT) AS hour, round(avg(CAST(embedding[1] AS DOUBLE) + CAST(embedding[2] AS DOUBLE)), 6) AS time_contribution
FROM embeddings GROUP BY 1""")
def hour_effect(spark, sf):
    return tidy(explain.hour_effect(_attributed(spark, sf)))


# --- run log and aliases as tables -------------------------------------------
def _run_log(spark, sf):
    """One run per order priority and year, its metrics taken from the orders."""
    orders = table(spark, sf, "orders")
    runs = orders.groupBy("o_orderpriority", F.year("o_orderdate").alias("y")).agg(
        F.min("o_orderdate").alias("start_time"), F.avg("o_totalprice").alias("mae"), F.count("*").alias("n")
    )
    return runs.select(
        F.concat("o_orderpriority", F.lit("/"), F.col("y").cast("string")).alias("run_id"),
        F.col("o_orderpriority").alias("run_name"),
        "start_time",
        F.create_map(F.lit("n"), F.col("n").cast("string")).alias("params"),
        F.when(F.col("y") % 2 == 0, F.create_map(F.lit("mae"), F.col("mae"), F.lit("r2"), F.col("n") / 1000.0))
        .otherwise(F.create_map(F.lit("mae"), F.col("mae")))
        .alias("metrics"),
    )


@query("""SELECT o_orderpriority || '/' || CAST(year(o_orderdate) AS VARCHAR) AS run_id, o_orderpriority AS run_name,
  min(o_orderdate) AS start_time, CAST(count(*) AS VARCHAR) AS n, round(avg(o_totalprice), 4) AS mae,
  CASE WHEN year(o_orderdate) % 2 = 0 THEN round(count(*) / 1000, 4) END AS r2
FROM orders GROUP BY o_orderpriority, year(o_orderdate)""")
def run_compare(spark, sf):
    return rounded(registry.compare_runs(_run_log(spark, sf), ["mae", "r2"], ["n"]), 4)


@query("""SELECT model, alias, version, set_at, path FROM (
  SELECT o_orderpriority AS model, o_orderstatus AS alias, o_orderkey AS version, o_orderdate AS set_at,
    'models/' || CAST(o_orderkey AS VARCHAR) AS path,
    row_number() OVER (PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
WHERE r = 1""")
def alias_latest(spark, sf):
    settings = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("model"),
        F.col("o_orderstatus").alias("alias"),
        F.col("o_orderkey").alias("version"),
        F.col("o_orderdate").alias("set_at"),
        F.concat(F.lit("models/"), F.col("o_orderkey").cast("string")).alias("path"),
    )
    return registry.current_aliases(settings)
