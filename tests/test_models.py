from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.functions import vocab
from tidemark.operators import explain, models, registry, series, split
from tidemark.operators import features as ft
from tidemark.plans import catalog_models
from tidemark.plans.catalog_features import sensor_features_of
from tidemark.plans.standins import feature_table
from tidemark.session import materialize
from tidemark.sources import readers, schemas, writers

SMALL_FOREST = {"numTrees": 8, "maxDepth": 5, "minInstancesPerNode": 5}


@pytest.fixture(scope="module")
def parts(spark, small):
    """Features with a volume that follows the clock, split in time."""
    feat = feature_table(spark, small).where("date_time is not null")
    volume = 3000 - 1500 * F.col("hour_cos") + 400 * F.col("hour_sin") - 300 * F.col("is_weekend") + F.hash("date_time") % 50
    feat = materialize(feat.withColumn("traffic_volume", volume.cast("int")), "test-features")
    train, test, _ = split.time_split(feat, "date_time")
    return feat, train, test


@pytest.fixture(scope="module")
def regressors(parts):
    return models.fit_regressors(parts[1], forest=SMALL_FOREST)


def test_regressors_learn_the_clock(regressors, parts):
    rows = {r["model"]: r for r in models.evaluate_regressors(regressors, parts[2]).collect()}
    assert rows["Linear Regression"]["r2"] > 0.98 and rows["Random Forest"]["r2"] > 0.8


def test_fits_run_over_all_cores_and_keep_every_row(spark, parts):
    cores = spark.sparkContext.defaultParallelism
    narrow = materialize(parts[1].select("traffic_volume", "hour_cos").coalesce(1), "one-file")
    assert narrow.rdd.getNumPartitions() < cores
    with models.reused(narrow) as rows:
        assert rows.rdd.getNumPartitions() == cores
        assert rows.exceptAll(narrow).isEmpty() and narrow.exceptAll(rows).isEmpty()
    wide = spark.range(100, numPartitions=3 * cores)
    assert models.spread(wide) is wide
    # The same rows in the same place each time, so a lost task draws the same samples again.
    assert models.spread(narrow).rdd.glom().collect() == models.spread(narrow).rdd.glom().collect()


def test_parts_of_a_fit_do_not_grow_with_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    for df in (spark.range(4_000, numPartitions=1), spark.range(4_000, numPartitions=cores)):
        dealt = models.spread(df, rows_a_part=100)
        sizes = [len(p) for p in dealt.rdd.glom().collect()]
        assert len(sizes) == 40 and max(sizes) <= 110 and sum(sizes) == 4_000
        assert sorted(r.id for r in dealt.collect()) == list(range(4_000))
    assert models.spread(spark.range(0)).count() == 0


def test_parts_of_a_large_fit_fill_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism

    def parts(*sizes):
        starts = [sum(sizes[:i]) for i in range(len(sizes))]
        rows = spark.sparkContext.parallelize(list(zip(starts, sizes, strict=True)), len(sizes))
        return rows.flatMap(lambda r: [(i,) for i in range(r[0], r[0] + r[1])]).toDF("id long")

    for uneven in (parts(*[100] * (cores + 1)), parts(100, *[50] * cores), parts(100 * cores + 50)):
        dealt = models.spread(uneven, rows_a_part=100)
        sizes = [len(p) for p in dealt.rdd.glom().collect()]
        n = uneven.count()
        assert len(sizes) % cores == 0 and max(sizes) <= 1.25 * n / len(sizes)
        assert sorted(r.id for r in dealt.collect()) == list(range(n))
    for even in (parts(*[50] * 2 * cores), parts(*[100] * cores, 5), parts(*[20] * (3 * cores + 1))):
        assert models.spread(even, rows_a_part=100) is even


def test_sensor_features_are_stored_once_with_the_split(spark, small, monkeypatch):
    stored = []
    monkeypatch.setattr(catalog_models, "materialize", lambda df, name: stored.append(name) or materialize(df, name))
    train, test = catalog_models._sensor_split(spark, small, "high_risk")
    assert stored == ["sensor-split"] and train.columns == test.columns == [*vocab.FEATURES, "high_risk"]
    feat = sensor_features_of(spark, small).where("date_time IS NOT NULL")
    whole = split.key_split(feat, "date_time", ["sensor"])
    for name, part in {"train": train, "test": test}.items():
        expected = whole.where(F.col("split") == name).select(part.columns)
        assert part.count() > 0 and part.exceptAll(expected).isEmpty() and expected.exceptAll(part).isEmpty()


def test_deep_forests_keep_nodes_and_are_the_same(spark, parts):
    deep = {"numTrees": 3, "maxDepth": models.DEEP, "minInstancesPerNode": 2}
    assert not models.forest_regressor(spark, "traffic_volume", SMALL_FOREST).getCacheNodeIds()
    estimator = models.forest_regressor(spark, "traffic_volume", deep)
    assert estimator.getCacheNodeIds() and estimator.getMaxMemoryInMB() >= 256 and spark.sparkContext.getCheckpointDir()
    rows = models.assembler().transform(parts[1]).select("traffic_volume", "features").repartition(2).persist()
    plain = estimator.copy().setParams(cacheNodeIds=False, maxMemoryInMB=1)
    assert estimator.fit(rows).toDebugString.split("\n", 1)[1] == plain.fit(rows).toDebugString.split("\n", 1)[1]
    rows.unpersist()


def test_balanced_weights_even_out_the_classes(spark):
    df = spark.range(100).select((F.col("id") < 10).cast("int").alias("y"))
    sums = {r["y"]: r["w"] for r in models.balanced_weights(df, "y").groupBy("y").agg(F.sum("weight").alias("w")).collect()}
    assert sums == {0: pytest.approx(50), 1: pytest.approx(50)}


def test_classifiers(parts):
    _, train, test = parts
    label = (F.col("hour").between(8, 18)).cast("int")
    fitted = models.fit_classifiers(train.withColumn("high_risk", label), forest=SMALL_FOREST)
    for r in models.evaluate_classifiers(fitted, test.withColumn("high_risk", label)).collect():
        assert r["roc_auc"] > 0.95 and r["accuracy"] > 0.85 and 0 <= r["f1"] <= 1


def test_importances_rank_the_hour_first(spark, regressors):
    rows = models.importances(spark, regressors["Random Forest"]).collect()
    assert len(rows) == 8 and rows[0]["feature"] == "hour_cos"
    everything = models.importances(spark, regressors["Random Forest"], top_n=None).agg(F.sum("importance")).first()[0]
    assert everything == pytest.approx(1.0)


def test_missing_input_is_an_error(parts, regressors):
    broken = parts[2].withColumn("rain_1h", F.lit(None).cast("double"))
    with pytest.raises(Exception, match="null|NULL|handleInvalid"):
        regressors["Linear Regression"].transform(broken).select("prediction").collect()


def test_versions(parts, tmp_path):
    versions = {"big": {"numTrees": 12, "maxDepth": 8, "minInstancesPerNode": 1}, "small": {"numTrees": 2, "maxDepth": 2, "minInstancesPerNode": 10}}
    table = models.compare_versions(parts[1], parts[2], str(tmp_path), versions=versions)
    rows = {r["version"]: r for r in table.collect()}
    registry.register_versions(table, str(tmp_path / "runs"), str(tmp_path / "aliases"), "volume", "big")
    model, version = registry.load_by_alias(table.sparkSession, str(tmp_path / "aliases"), "volume")
    assert version == 1
    base = table.sparkSession.range(1).select(models.baseline_mae(model, parts[2])).first()[0]
    assert base == pytest.approx(rows["big"]["mae"])
    runs = table.sparkSession.read.schema(schemas.RUN_LOG).parquet(str(tmp_path / "runs"))
    assert {r["run_name"]: r["model_path"] is not None for r in runs.collect()} == {"volume big": True, "volume small": False}
    assert rows["big"]["size_mb"] > rows["small"]["size_mb"] > 0 and rows["big"]["mae"] < rows["small"]["mae"]


def test_registry_round_trip(spark, regressors, parts, tmp_path):
    paths = models.save_models(regressors, str(tmp_path / "models"))
    aliases, runs = str(tmp_path / "aliases"), str(tmp_path / "runs")
    registry.set_alias(spark, aliases, "volume", "production", 1, paths["Linear Regression"], datetime(2024, 1, 1))
    registry.set_alias(spark, aliases, "volume", "production", 2, paths["Random Forest"], datetime(2024, 1, 2))
    model, version = registry.load_by_alias(spark, aliases, "volume")
    assert version == 2
    test = parts[2]
    assert model.transform(test).select("prediction").collect() == regressors["Random Forest"].transform(test).select("prediction").collect()
    with pytest.raises(LookupError):
        registry.load_by_alias(spark, aliases, "volume", "staging")
    registry.append_run(spark, runs, "second", {"k": 6}, {"mae": 2.0}, start_time=datetime(2024, 1, 2))
    registry.append_run(spark, runs, "first", {"k": 5}, {"mae": 3.0, "r2": 0.5}, {"kind": "rf"}, "p", datetime(2024, 1, 1))
    rows = registry.compare_runs(spark.read.schema(schemas.RUN_LOG).parquet(runs), ["mae", "r2"], ["k"]).collect()
    assert [(r["run_name"], r["k"], r["mae"], r["r2"]) for r in rows] == [("first", "5", 3.0, 0.5), ("second", "6", 2.0, None)]


def test_evaluations_become_runs(spark, regressors, parts, tmp_path):
    path = str(tmp_path / "runs")
    registry.log_evaluation(models.evaluate_regressors(regressors, parts[2]), path, {"trees": 8}, {"task": "volume"})
    rows = registry.compare_runs(spark.read.schema(schemas.RUN_LOG).parquet(path), ["mae", "r2"], ["trees"]).collect()
    assert {r["run_name"] for r in rows} == set(regressors) and all(r["mae"] > 0 and r["trees"] == "8" for r in rows)


def _requests(parts):
    return parts[0].select(
        "date_time", "weather_main", "temp", "rain_1h", "snow_1h", F.col("clouds_all").cast("double").alias("clouds_all"),
        (F.col("is_holiday") == 1).alias("is_holiday"),
    )


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_scores_go_to_an_append_log(spark, parts, regressors, tmp_path, fmt):
    stats = ft.moments(parts[0], ["temp"]).first()["temp"]
    path = str(tmp_path / "log")
    assert readers.read_prediction_log(spark, path, fmt).count() == 0
    scored = models.score_requests(_requests(parts), regressors["Random Forest"], F.lit(stats["mean"]), F.lit(stats["std"]), 3)
    writers.append_log(scored, path, fmt)
    writers.append_log(scored.limit(5), path, fmt)
    log = readers.read_prediction_log(spark, path, fmt)
    assert log.count() == parts[0].count() + 5 and log.columns[:10] == vocab.LOG_COLUMNS
    row = log.first()
    assert row["model_version"] == 3 and round(row["predicted_traffic_volume"], 2) == row["predicted_traffic_volume"]
    assert log.where("input_date_time is null or request_timestamp is null").count() == 0


def test_table_outputs(spark, tmp_path):
    df = spark.createDataFrame([(0, 1.5), (1, None)], "hour int, time_contribution double")
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / fmt)
        writers.write_table(df, path, fmt)
        reader = spark.read.schema(df.schema).option("header", True)
        assert sorted(map(tuple, reader.format(fmt).load(path).collect())) == [(0, 1.5), (1, None)]


def test_attributions_sum_to_the_prediction(parts, regressors):
    model = regressors["Random Forest"]
    test = parts[2]
    rows = explain.attributions(test, model.stages[-1], ["date_time", "hour"]).collect()
    leaves = explain.leaf_boxes(test, model.stages[-1])
    assert leaves.select("tree").distinct().count() == model.stages[-1].getNumTrees > 1
    grouped = explain.attributions(test, model.stages[-1], ["date_time"], max_conditions=60).collect()
    by_time = {r["date_time"]: r for r in grouped}
    assert all(by_time[r["date_time"]]["attribution"] == pytest.approx(r["attribution"]) for r in rows)
    predicted = {r["date_time"]: r["prediction"] for r in model.transform(test).select("date_time", "prediction").collect()}
    assert len(rows) == len(predicted)
    for r in rows:
        assert r["base"] + sum(r["attribution"]) == pytest.approx(predicted[r["date_time"]], rel=1e-6)


def test_attributions_against_all_orders():
    """A tree with a repeated feature against the Shapley sum over feature subsets."""
    import math
    from itertools import combinations

    import pandas as pd

    columns = ["tree", "node", "value", "cover", "left", "right", "feature", "threshold", "n_categories"]
    nodes = pd.DataFrame(
        [(0, 0, 0, 10, 1, 2, 0, 0.5, -1), (0, 1, 0, 4, 3, 4, 1, 0.3, -1), (0, 2, 0, 6, 5, 6, 0, 0.8, -1),
         (0, 3, 1.0, 1, -1, -1, -1, np.nan, -1), (0, 4, 5.0, 3, -1, -1, -1, np.nan, -1),
         (0, 5, 2.0, 2, -1, -1, -1, np.nan, -1), (0, 6, 0, 4, 7, 8, 2, 0.5, -1),
         (0, 7, 9.0, 1, -1, -1, -1, np.nan, -1), (0, 8, -3.0, 3, -1, -1, -1, np.nan, -1)], columns=columns)
    by = {r.node: r for r in nodes.itertuples()}

    def value(x, known, at=0):
        n = by[at]
        if n.left < 0:
            return n.value
        if n.feature in known:
            return value(x, known, n.left if x[n.feature] <= n.threshold else n.right)
        return sum(by[c].cover / n.cover * value(x, known, c) for c in (n.left, n.right))

    points = np.array([[0.2, 0.1, 0.9], [0.9, 0.9, 0.1], [0.6, 0.3, 0.5], [0.5, 0.31, 0.7]])
    leaves = pa.Table.from_pandas(explain.leaf_conditions(nodes), preserve_index=False)
    got = explain.box_attributions(points, explain.by_depth(leaves), 1)
    for x, phi in zip(points, got):
        for i in range(3):
            others = [j for j in range(3) if j != i]
            want = sum(
                math.factorial(len(s)) * math.factorial(2 - len(s)) / 6 * (value(x, {*s, i}) - value(x, set(s)))
                for n in range(3) for s in combinations(others, n)
            )
            assert phi[i] == pytest.approx(want)


def test_groups_of_trees():
    assert explain.tree_groups([(0, 5), (1, 4), (2, 9), (3, 30), (4, 1)], 10) == [(0, 1), (2, 2), (3, 3), (4, 4)]
    assert explain.tree_groups([], 10) == []


def test_hour_effect_follows_the_clock(spark, parts, regressors):
    attributed = explain.attributions(parts[2], regressors["Random Forest"].stages[-1], ["hour"])
    effect = {r["hour"]: r["time_contribution"] for r in explain.hour_effect(attributed).collect()}
    assert effect[12] > 0 > effect[0]
    ranked = explain.attribution_rank(attributed, top_n=2).collect()
    assert ranked[0]["feature"] == "hour_cos" and len(ranked) == 2


def test_forecaster_beats_the_mean(spark):
    df = spark.range(24 * 40).select(
        F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("date_time"),
        (100 + 50 * F.sin(F.col("id") / 24 * 2 * 3.14159)).alias("traffic_volume"),
    )
    windows = materialize(series.lookback_windows(df, ["traffic_volume"], lookback=6), "test-windows")
    train, test, _ = split.time_split(windows, "target_time")
    model = models.fit_forecaster(train, maxIter=5)
    scored = model.transform(models.sequence_vectors(test))
    from tidemark.operators.metrics import regression_metrics

    assert regression_metrics(scored, "target").first()["r2"] > 0.9
