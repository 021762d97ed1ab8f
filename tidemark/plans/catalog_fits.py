"""Fits whose result SQL can state: closed forms, group means, and Newton's method on four counts.

They go through the same functions as the models of the feature table, over the order lines, so
their rows grow with the data.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tidemark.operators import cluster, drift, models
from tidemark.operators.metrics import regression_metrics
from tidemark.plans.registry import query, rounded, tidy
from tidemark.plans.standins import table
from tidemark.session import materialize, run_folder

LABEL = "l_extendedprice"
ONE_TREE = {"numTrees": 1, "maxDepth": 2, "minInstancesPerNode": 1, "bootstrap": False}

_LINES = """l AS (SELECT l_extendedprice, l_quantity, CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS r,
  CASE WHEN l_linestatus = 'O' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS o, CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END AS y,
  l_linenumber <> 1 AS training FROM lineitem)"""


def _lines(spark, sf):
    """Order lines with two flags and a label; the first line of each order is held out."""
    li = table(spark, sf, "lineitem")
    return li.select(
        F.col("l_extendedprice").cast("double").alias("l_extendedprice"), F.col("l_quantity").cast("double").alias("l_quantity"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("r"),
        F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0).alias("o"),
        F.when(F.col("l_quantity") > 40, 1).otherwise(0).alias("y"), (F.col("l_linenumber") != 1).alias("training"),
    )


def _linear(spark, sf):
    lines = _lines(spark, sf)
    fitted = models.fit_regressors(lines.where("training"), LABEL, ["l_quantity"], only=["Linear Regression"])
    return lines, fitted


_LINE_SQL = f"""WITH {_LINES},
c AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM l WHERE training)"""


@query(f"{_LINE_SQL} SELECT round(b, 4) AS slope, round(a, 4) AS intercept FROM c")
def linear_fit(spark, sf):
    """The coefficients of the fitted line."""
    line = _linear(spark, sf)[1]["Linear Regression"].stages[-1]
    values = spark.range(1).select(F.lit(float(line.coefficients[0])).alias("slope"), F.lit(float(line.intercept)).alias("intercept"))
    return rounded(values, 4)


_LINE_ERRORS = f"""{_LINE_SQL},
e AS (SELECT avg(abs(l_extendedprice - (a + b * l_quantity))) AS mae,
  1 - sum((l_extendedprice - (a + b * l_quantity)) ** 2) / (var_pop(l_extendedprice) * count(*)) AS r2 FROM l, c WHERE NOT training)"""


@query(f"{_LINE_ERRORS} SELECT 'Linear Regression' AS model, round(mae, 4) AS mae, round(r2, 4) AS r2 FROM e")
def linear_evaluation(spark, sf):
    """Held-out error of the fitted line."""
    lines, fitted = _linear(spark, sf)
    return rounded(models.evaluate_regressors(fitted, lines.where(~F.col("training")), LABEL), 4)


_CELLS = f"""WITH {_LINES},
g AS (SELECT r, o, avg(l_extendedprice) AS m FROM l WHERE training GROUP BY 1, 2)"""


@query(f"{_CELLS} SELECT r, o, round(m, 4) AS prediction FROM g")
def forest_regressor_fit(spark, sf):
    """One tree over two flags: its leaves are the four group means."""
    lines = _lines(spark, sf)
    fitted = models.fit_regressors(lines.where("training"), LABEL, ["r", "o"], ONE_TREE, only=["Random Forest"])
    return rounded(fitted["Random Forest"].transform(lines.select("r", "o").distinct()).select("r", "o", "prediction"), 4)


@query(f"""{_CELLS},
t AS (SELECT l.r, l.o, l_extendedprice AS v FROM l WHERE training),
gains AS (SELECT var_pop(v) * count(*) AS whole,
  (SELECT sum(s) FROM (SELECT var_pop(v) * count(*) AS s FROM t GROUP BY r)) AS by_r,
  (SELECT sum(s) FROM (SELECT var_pop(v) * count(*) AS s FROM t GROUP BY o)) AS by_o FROM t)
SELECT 'r' AS feature, CASE WHEN by_r <= by_o THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS importance FROM gains
UNION ALL SELECT 'o', CASE WHEN by_r <= by_o THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END FROM gains""")
def stump_importances(spark, sf):
    """A tree of one split gives all importance to the flag that explains more of the variance."""
    lines = _lines(spark, sf).where("training")
    stump = ONE_TREE | {"maxDepth": 1}
    forest = models.fit_regressors(lines, LABEL, ["r", "o"], stump, only=["Random Forest"])["Random Forest"]
    return models.importances(spark, forest, ["r", "o"])


@query(f"""WITH {_LINES},
g AS (SELECT r, avg(l_extendedprice) AS m FROM l WHERE training GROUP BY 1),
e AS (SELECT avg(abs(l_extendedprice - m)) AS mae, 1 - sum((l_extendedprice - m) ** 2) / (var_pop(l_extendedprice) * count(*)) AS r2
  FROM l JOIN g USING (r) WHERE NOT training)
SELECT version, CAST(num_trees AS BIGINT) AS num_trees, CAST(max_depth AS BIGINT) AS max_depth, CAST(1 AS BIGINT) AS min_leaf,
  round(mae, 4) AS mae, round(r2, 6) AS r2 FROM e, (VALUES ('deep', 1, 2), ('flat', 1, 1)) v(version, num_trees, max_depth)""")
def version_errors(spark, sf):
    """Two versions over one flag: a second level has nothing to split, so their errors agree."""
    lines = _lines(spark, sf)
    versions = {"flat": ONE_TREE | {"maxDepth": 1}, "deep": ONE_TREE}
    found = models.compare_versions(
        lines.where("training"), lines.where(~F.col("training")), run_folder(spark, "versions"), LABEL, ["r"], versions
    )
    return tidy(found.drop("path", "size_mb", "train_seconds").withColumn("mae", F.round("mae", 4)))


_WEIGHTED = f"""WITH RECURSIVE {_LINES},
n AS (SELECT count(*)::DOUBLE AS n, sum(y)::DOUBLE AS pos FROM l WHERE training),
cell AS (SELECT r, o, sum(y) * any_value(n / (2 * pos)) AS p, sum(1 - y) * any_value(n / (2 * (n - pos))) AS q FROM l, n
  WHERE training GROUP BY 1, 2)"""


_LIKELY = """WITH l AS (SELECT CASE WHEN l_linestatus = 'O' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS o,
  CASE WHEN l_quantity > CASE WHEN l_linestatus = 'O' THEN 10 ELSE 40 END THEN 1 ELSE 0 END AS y FROM lineitem),
n AS (SELECT count(*)::DOUBLE AS n, sum(y)::DOUBLE AS pos FROM l)"""


@query(f"""{_LIKELY}, cell AS (SELECT o, sum(y) * any_value(n / (2 * pos)) AS p, sum(1 - y) * any_value(n / (2 * (n - pos))) AS q FROM l, n GROUP BY 1)
SELECT o, round(p / (p + q), 6) AS score, CASE WHEN p > q THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM cell""")
def forest_classifier_fit(spark, sf):
    """One tree over one flag: its leaves are the weighted shares of the label."""
    lines = _lines(spark, sf).withColumn("y", F.when(F.col("l_quantity") > F.when(F.col("o") == 1, 10).otherwise(40), 1).otherwise(0))
    fitted = models.fit_classifiers(lines, "y", ["o"], ONE_TREE)["Random Forest"]
    cells = fitted.transform(lines.select("o").distinct())
    return rounded(cells.select("o", vector_to_array("probability")[1].alias("score"), "prediction"), 6)


@query(f"""{_WEIGHTED},
-- Newton's method for sum(w (p - y) x) + b = 0 and sum(w (p - y)) = 0, on the four cells.
step(i, a, b1, b2) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT i + 1, a - (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / d,
    b1 - (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / d,
    b2 - (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / d
  FROM (
    SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS d
    FROM (
      SELECT i, a, b1, b2, sum((p + q) * s - p) AS g0, sum(((p + q) * s - p) * r) + b1 AS g1, sum(((p + q) * s - p) * o) + b2 AS g2,
        sum((p + q) * s * (1 - s)) AS h00, sum((p + q) * s * (1 - s) * r) AS h01, sum((p + q) * s * (1 - s) * o) AS h02,
        sum((p + q) * s * (1 - s) * r * r) + 1 AS h11, sum((p + q) * s * (1 - s) * r * o) AS h12,
        sum((p + q) * s * (1 - s) * o * o) + 1 AS h22
      FROM (SELECT step.*, cell.*, 1 / (1 + exp(-(a + b1 * r + b2 * o))) AS s FROM step, cell WHERE i < 25)
      GROUP BY i, a, b1, b2))),
best AS (SELECT * FROM step WHERE i = 25)
SELECT r, o, round(1 / (1 + exp(-(a + b1 * r + b2 * o))), 4) AS score FROM cell, best""")
def logistic_fit(spark, sf):
    """Logistic regression with an L2 strength of 1 over two flags."""
    lines = _lines(spark, sf)
    fitted = models.fit_classifiers(lines.where("training"), "y", ["r", "o"], ONE_TREE)["Logistic Regression"]
    cells = fitted.transform(lines.select("r", "o").distinct())
    return rounded(cells.select("r", "o", vector_to_array("probability")[1].alias("score")), 4)


_AXIS = """WITH a AS (SELECT CASE l_returnflag WHEN 'A' THEN 0.0::DOUBLE WHEN 'N' THEN 1.0::DOUBLE ELSE 5.0::DOUBLE END AS x FROM lineitem)"""


def _axis(spark, sf):
    flag = F.col("l_returnflag")
    x = F.when(flag == "A", 0.0).when(flag == "N", 1.0).otherwise(5.0)
    rows = table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"), x.alias("x"), F.array(x).alias("scaled"), array_to_vector(F.array(x)).alias("features")
    )
    return materialize(rows, "axis")


@query(f"{_AXIS} SELECT x AS centre, count(*) AS n_rows FROM a GROUP BY 1")
def kmeans_three_points(spark, sf):
    """Three separate values on a line: the best of several starts has them as centres."""
    rows = _axis(spark, sf)
    model = cluster.fit_kmeans(rows, 3, 5)
    centres = F.array(*[F.lit(float(c[0])) for c in model.centres])
    sizes = model.transform(rows).groupBy("prediction").agg(F.count("*").alias("n_rows"))
    return sizes.select(F.round(centres[F.col("prediction")], 6).alias("centre"), "n_rows")


@query(f"""{_AXIS}, halves AS (
  SELECT 'low' AS cut, CASE WHEN x < 0.5 THEN 0 ELSE 1 END AS g, x FROM a UNION ALL SELECT 'high', CASE WHEN x < 2 THEN 0 ELSE 1 END, x FROM a),
costs AS (SELECT cut, sum(s) AS s FROM (SELECT cut, g, var_pop(x) * count(*) AS s FROM halves GROUP BY 1, 2) GROUP BY 1)
SELECT CAST(2 AS BIGINT) AS k, round(min(s), 2) AS inertia FROM costs UNION ALL SELECT 3, 0.0""")
def k_sweep_three_points(spark, sf):
    """Cost of the best two and three clusters of three separate values."""
    found = cluster.sweep_clusters(_axis(spark, sf), "line", (2, 3), restarts=5, sample_size=500)
    return found.select(F.col("k").cast("bigint").alias("k"), F.round("inertia", 2).alias("inertia"))


@query(f"""{_LINE_SQL}
SELECT round(l_quantity, 6) AS l_quantity, round(a + b * l_quantity, 3) AS prediction, count(*) AS n_rows FROM l, c GROUP BY 1, 2""")
def model_round_trip(spark, sf):
    """The fitted line saved, loaded from its folder and applied to every line."""
    from pyspark.ml import PipelineModel

    lines, fitted = _linear(spark, sf)
    path = models.save_models(fitted, run_folder(spark, "saved"))["Linear Regression"]
    scored = PipelineModel.load(path).transform(lines).withColumn("prediction", F.round("prediction", 3))
    return scored.groupBy("l_quantity", "prediction").agg(F.count("*").alias("n_rows")).select(F.round("l_quantity", 6).alias("l_quantity"), "prediction", "n_rows")


@query(f"""{_LINE_ERRORS},
live AS (SELECT avg(abs(2 * l_extendedprice - (a + b * l_quantity))) AS m, count(*) AS n FROM l, c WHERE NOT training)
SELECT 'prediction error (matched ground truth)' AS "check", round(m, 2) AS live_value, round(mae, 2) AS reference_value,
  CASE WHEN m / mae > 2 THEN 'ALERT' ELSE 'PASS' END AS status FROM live, e""")
def drift_from_held_out_error(spark, sf):
    """The error check against the fitted line's own held-out error; the live values have doubled."""
    lines, fitted = _linear(spark, sf)
    held = lines.where(~F.col("training")).withColumn("at", F.monotonically_increasing_id())
    held = materialize(fitted["Linear Regression"].transform(held).select("at", LABEL, "prediction"), "held")
    mae = regression_metrics(held, LABEL).select("mae").scalar()
    live = held.select(F.col("at").alias("input_date_time"), F.col("prediction").alias("predicted_traffic_volume"))
    seen = held.select(F.col("at").alias("date_time"), (F.col(LABEL) * 2).alias("traffic_volume"))
    return drift.error_drift(live, seen, mae).drop("detail")
