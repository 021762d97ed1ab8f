"""Forests grown a tree at a time, beside those of Spark ML."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tidemark.operators import forest, models

COLUMNS = ["a", "b", "c", "d"]
DEEP = {"numTrees": 5, "maxDepth": models.DEEP, "minInstancesPerNode": 4}


@pytest.fixture(scope="module")
def rows(spark):
    """``a`` has more values than bins, ``b`` few, ``c`` two of which one is rare, ``d`` one."""
    value = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000))
    made = spark.range(900, numPartitions=3).select(
        "id", (value / 10).alias("a"), (F.col("id") % 5).cast("double").alias("b"), (F.col("id") % 90 == 0).cast("int").alias("c"),
        F.lit(3.0).alias("d"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(40)).alias("noise"),
    )
    return made.withColumn("y", F.floor(F.sin(F.col("a") / 9) * 300 + F.col("b") * 50 + F.col("c") * 400 + F.col("noise")).cast("int")).cache()


def predicted(tree, bins):
    node = np.zeros(bins.shape[1], dtype=int)
    while (inner := tree["feature"][node] >= 0).any():
        f, at = tree["feature"][node], np.arange(len(node))
        node = np.where(inner, tree["left"][node] + (bins[f, at] > tree["cut"][node]), node)
    return tree["prediction"][node]


@pytest.mark.parametrize(("depth", "least"), [(4, 1), (8, 7), (1, 400)])
def test_a_tree_without_a_bootstrap_is_that_of_spark(rows, depth, least):
    estimator = RandomForestRegressor(labelCol="y", numTrees=1, bootstrap=False, maxDepth=depth, minInstancesPerNode=least, seed=3)
    known = estimator.fit(models.assembler(COLUMNS).transform(rows))
    data = rows.orderBy("id").toPandas()
    splits = forest.candidate_splits(rows, COLUMNS, 32)
    assert [len(t) for t in splits][1:] == [4, 1, 0] and 25 < len(splits[0]) <= 31
    bins = np.array([np.searchsorted(t, data[c]) for t, c in zip(splits, COLUMNS)])
    tree = forest.grow(bins, data["y"].to_numpy(float), np.ones(len(data)), [len(t) + 1 for t in splits], depth, least)
    wanted = known.transform(models.assembler(COLUMNS).transform(rows)).orderBy("id").toPandas()["prediction"]
    assert len(tree["n"]) == known.totalNumNodes
    np.testing.assert_allclose(predicted(tree, bins), wanted, rtol=1e-9)


@pytest.mark.parametrize("wave", [1, 10**9])
def test_forests_over_many_rows_are_grown_tree_by_tree(spark, rows, monkeypatch, tmp_path, wave):
    by_level = models.fit_regressors(rows, "y", COLUMNS, DEEP, only=["Random Forest"])
    monkeypatch.setattr(models, "SPLIT_BY_LEVEL", 0)
    monkeypatch.setattr(forest, "WAVE_BYTES", wave)
    monkeypatch.setattr(models.RandomForestRegressor, "_fit", lambda *_: pytest.fail("split a level of all trees at a time"))
    model = models.fit_regressors(rows, "y", COLUMNS, DEEP, only=["Random Forest"])["Random Forest"]
    last = model.stages[-1]
    assert last.getNumTrees == 5 and last.getLabelCol() == "y" and last.numFeatures == 4 and {t.depth for t in last.trees} <= set(range(5, 11))
    assert len({t.toDebugString.split("\n", 1)[1] for t in last.trees}) == 5
    again = models.fit_regressors(rows, "y", COLUMNS, DEEP, only=["Random Forest"])["Random Forest"]
    scored = {name: m.transform(rows).orderBy("id").toPandas()["prediction"] for name, m in [("level", by_level["Random Forest"]), ("tree", model), ("again", again)]}
    assert (scored["tree"] == scored["again"]).all()
    assert abs(last.totalNumNodes / by_level["Random Forest"].stages[-1].totalNumNodes - 1) < 0.1
    assert np.corrcoef(scored["tree"], scored["level"])[0, 1] > 0.99
    assert last.featureImportances.toArray().argmax() == 0 and abs(last.featureImportances.toArray().sum() - 1) < 1e-9
    path = models.save_models({"Random Forest": model}, str(tmp_path))["Random Forest"]
    assert (PipelineModel.load(path).transform(rows).orderBy("id").toPandas()["prediction"] == scored["tree"]).all()


def test_missing_values_are_an_error(rows, monkeypatch):
    monkeypatch.setattr(models, "SPLIT_BY_LEVEL", 0)
    for column in ("a", "y"):
        broken = rows.withColumn(column, F.when(F.col("id") != 7, F.col(column)))
        with pytest.raises(Exception, match="a fit needs every value"):
            models.fit_regressors(broken, "y", COLUMNS, DEEP, only=["Random Forest"])


def test_summed_up_values_keep_their_rows_and_rare_ones():
    values, counts = forest.counted(np.append(np.arange(10_000) / 7, 5.0), np.ones(10_001, dtype=int))
    kept, n = forest.condensed(values, counts, 500)
    assert len(kept) == 500 and n.sum() == 10_001 and abs(np.diff(np.cumsum(n)) - 20).max() <= 1
    few = forest.condensed(np.array([0.0, 1.0]), np.array([10**6, 1]), 500)
    assert forest.thresholds(*few, 32).tolist() == [0.5]
