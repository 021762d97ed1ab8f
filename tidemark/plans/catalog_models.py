"""Fitted models on the feature table. No SQL twin: checked by rows here, by invariants in the
tests, and in ``catalog_fits`` by fits whose result SQL can state."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import vocab
from tidemark.operators import cluster, explain, metrics, models, profiles, registry, reports, series, split
from tidemark.operators import features as ft
from tidemark.plans.catalog_features import scoring_requests, sensor_features_of
from tidemark.plans.registry import query, wide_ints
from tidemark.plans.standins import CLEAN_SQL, feature_table
from tidemark.session import materialize, run_folder
from tidemark.sources import requests as rq


def stored_features(spark, sf):
    """The feature table, stored once: fits, splits and moments all read it."""
    return materialize(feature_table(spark, sf), "features")


def _split(spark, sf):
    feat = stored_features(spark, sf)
    train, test, _ = split.time_split(feat, "date_time")
    return feat, train, test


def _sensor_split(spark, sf, label):
    """(train, test) of all sensors: every sensor is split at a time of its own, so rows grow with the data.

    The cutoffs read sensors and times alone, so features are made once, as the split is stored, and only
    the inputs of the models and ``label`` are kept.
    """
    feat = sensor_features_of(spark, sf).where("date_time IS NOT NULL")
    parts = split.key_split(feat, "date_time", ["sensor"]).select(*vocab.FEATURES, label, "split")
    parts = materialize(parts, "sensor-split")
    return parts.where("split = 'train'").drop("split"), parts.where("split = 'test'").drop("split")


@query()
def fit_classifiers(spark, sf):
    train, test = _sensor_split(spark, sf, "high_risk")
    return models.evaluate_classifiers(models.fit_classifiers(train), test)


@query()
def fit_regressors(spark, sf):
    _, train, test = _split(spark, sf)
    return models.evaluate_regressors(models.fit_regressors(train), test)


@query()
def sensor_regressors(spark, sf):
    """The regressors over all sensors, so the rows of the fit grow with the data."""
    train, test = _sensor_split(spark, sf, "traffic_volume")
    return models.evaluate_regressors(models.fit_regressors(train), models.spread(test))


@query()
def top_features(spark, sf):
    _, train, _ = _split(spark, sf)
    return models.importances(spark, models.fit_regressors(train, only=["Random Forest"])["Random Forest"])


@query()
def version_comparison(spark, sf):
    _, train, test = _split(spark, sf)
    return models.compare_versions(train, test, run_folder(spark, "versions")).drop("path")


@query()
def batch_score(spark, sf):
    """Fit, save, register, point the alias, load by alias, score every request."""
    feat, train, test = _split(spark, sf)
    fitted = models.fit_regressors(train, only=["Random Forest"])
    folder = run_folder(spark, "registry")
    paths = models.save_models(fitted, f"{folder}/models")
    quality = metrics.regression_metrics(fitted["Random Forest"].transform(test), "traffic_volume").first()
    registry.append_run(
        spark, f"{folder}/runs", "Random Forest", vocab.FOREST, {"mae": quality["mae"], "r2": quality["r2"]},
        {"artifact_retained": "true"}, paths["Random Forest"],
    )
    registry.set_alias(spark, f"{folder}/aliases", "traffic_volume_regressor", "production", 1, paths["Random Forest"])
    model, version = registry.load_by_alias(spark, f"{folder}/aliases", "traffic_volume_regressor")
    stats = ft.moments(feat, ["temp"]).select("temp").scalar()
    requests = rq.accepted(rq.check_requests(scoring_requests(spark, sf)))
    return models.score_requests(requests, model, stats["mean"], stats["std"], version).drop("request_timestamp")


def _vectors(feat):
    """Standardised cluster inputs; a reading without a time has no place on the clock."""
    return feat.where("date_time is not null").transform(ft.add_severity).transform(cluster.standardise_population).transform(cluster.with_cluster_vector)


@query()
def kmeans_fit(spark, sf):
    rows = materialize(_vectors(sensor_features_of(spark, sf)), "vectors")
    return cluster.cluster_profile(cluster.fit_kmeans(rows).transform(rows, out="cluster"))


@query()
def k_sweep(spark, sf):
    rows = materialize(_vectors(sensor_features_of(spark, sf)).withColumn("reading", F.concat_ws(" ", "sensor", "date_time")), "vectors")
    return cluster.sweep_clusters(rows, "reading")


@query()
def next_hour_forecast(spark, sf):
    feat = stored_features(spark, sf).transform(ft.add_severity)
    cutoff = split.time_cutoff(feat, "date_time")
    stats = ft.moments(
        feat.where(F.col("date_time") < F.lit(cutoff)), ["traffic_volume", "weather_severity"], population=True
    ).first()
    scales = {c: (F.lit(stats[c]["mean"]), F.lit(stats[c]["std"])) for c in ("traffic_volume", "weather_severity")}
    windows = materialize(series.scale_windows(series.lookback_windows(feat), scales), "windows")
    model = models.fit_forecaster(windows.where(F.col("target_time") < F.lit(cutoff)))
    test = models.sequence_vectors(windows.where(F.col("target_time") >= F.lit(cutoff)))
    forecast = model.transform(test).select(
        series.unscale("target", *scales["traffic_volume"]).alias("traffic_volume"),
        series.unscale("prediction", *scales["traffic_volume"]).alias("prediction"),
    )
    return metrics.regression_metrics(forecast, "traffic_volume")


def _attributions(spark, sf):
    _, train, test = _split(spark, sf)
    forest = models.fit_regressors(train, only=["Random Forest"])["Random Forest"].stages[-1]
    return explain.attributions(test, forest, ["date_time", "hour"])


@query()
def tree_attribution(spark, sf):
    return _attributions(spark, sf)


@query(f"""WITH {CLEAN_SQL},
cut AS (SELECT date_time AS cutoff FROM (
  SELECT date_time, row_number() OVER (ORDER BY date_time) - 1 AS r, count(*) OVER () AS n FROM clean WHERE date_time IS NOT NULL)
  WHERE r = CAST(floor(n * (1 - 0.2)) AS BIGINT))
SELECT CAST(hour(date_time) AS BIGINT) AS hour, count(*) AS n_rows, count(*) AS n_exact FROM clean, cut WHERE date_time >= cutoff GROUP BY 1""")
def attribution_sums(spark, sf):
    """Per hour the test rows, and those whose base and attributions add up to the forest's prediction."""
    _, train, test = _split(spark, sf)
    forest = models.fit_regressors(train, only=["Random Forest"])["Random Forest"]
    predicted = forest.transform(test).select("date_time", "prediction")
    explained = explain.attributions(test, forest.stages[-1], ["date_time", "hour"])
    total = F.col("base") + F.aggregate("attribution", F.lit(0.0), lambda s, x: s + x)
    gap = F.abs(total - F.col("prediction")) <= 1e-6 * F.greatest(F.lit(1.0), F.abs("prediction"))
    both = explained.join(predicted, "date_time").groupBy("hour").agg(F.count("*").alias("n_rows"), F.count_if(gap).alias("n_exact"))
    return wide_ints(both)


@query()
def tree_attribution_rank(spark, sf):
    return explain.attribution_rank(materialize(_attributions(spark, sf), "attributions"))


@query()
def model_recommendations(spark, sf):
    """The recommendation table from simulated profiles of the fitted forest."""
    feat, train, _ = _split(spark, sf)
    forest = models.fit_regressors(train, only=["Random Forest"])["Random Forest"]
    conditions = reports.weather_profile(feat, ["temp_scaled", "rain_1h", "snow_1h", "clouds_all"])
    simulated = forest.transform(profiles.scenario_grid(conditions)).withColumnRenamed("prediction", "volume")
    return profiles.recommendations(profiles.scenario_profiles(simulated, conditions))
