from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import START, hours, series_frame
from tidemark.operators import metrics, series, split


def test_windows_and_gaps(spark):
    df = series_frame(spark, [0, 1, 2, 4, 5, 6, 7, 8], v=[0, 1, 2, 4, 5, 6, 7, 8])
    windows = series.lookback_windows(df, ["v"], "v", 3).orderBy("target_time").collect()
    assert [w["target"] for w in windows] == [7.0, 8.0]
    assert [[s["v"] for s in w["steps"]] for w in windows] == [[4, 5, 6], [5, 6, 7]]
    counts = series.window_counts(df, [3]).first()
    assert (counts["candidates"], counts["valid"]) == (5, 2)
    gaps = series.gap_stats(df).first()
    assert (gaps["gap_events"], gaps["missing_hours"], gaps["one_hour_steps"]) == (1, 1, 6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.integers(0, 120), min_size=1, max_size=90), st.integers(1, 6))
def test_blocks_do_not_change_the_result(spark, numbers, lookback):
    """Many short blocks against the rule stated over the sorted list."""
    at = sorted(numbers)
    df = series_frame(spark, at, v=[float(n) for n in at])
    valid = [i for i in range(lookback, len(at)) if at[i] - at[i - lookback] == lookback]
    windows = series.lookback_windows(df, ["v"], "v", lookback, block_hours=7).orderBy("target_time").collect()
    assert [w["target"] for w in windows] == [at[i] for i in valid]
    assert [[s["v"] for s in w["steps"]] for w in windows] == [at[i - lookback:i] for i in valid]
    steps = series.gap_steps(df, block_hours=7).orderBy("date_time").collect()
    assert [r["step_hours"] for r in steps] == [None] + [b - a for a, b in zip(at, at[1:])]
    counts = series.window_counts(df, [lookback], block_hours=7).first()
    assert (counts["candidates"], counts["valid"]) == (max(len(at) - lookback, 0), len(valid))


def test_series_are_kept_apart(spark):
    a = series_frame(spark, [0, 1, 2]).withColumn("k", F.lit("a"))
    b = series_frame(spark, [10, 14]).withColumn("k", F.lit("b"))
    out = {r["k"]: (r["gap_events"], r["missing_hours"]) for r in series.gap_stats(a.unionByName(b), keys=["k"]).collect()}
    assert out == {"a": (0, 0), "b": (1, 3)}


def test_largest_gaps(spark):
    df = series_frame(spark, [0, 5, 6, 11, 13])
    rows = series.largest_gaps(df, 2).collect()
    assert [(r["step_hours"], r["date_time"]) for r in rows] == [(5.0, hours([5])[0]), (5.0, hours([11])[0])]


def test_scaling_and_back(spark):
    df = series_frame(spark, [0, 1, 2, 3], v=[1.0, 2.0, 3.0, 10.0], w=[5.0, 5.0, 5.0, 5.0])
    windows = series.lookback_windows(df, ["v", "w"], "v", 2)
    scaled = series.scale_windows(windows, {"v": (F.lit(2.0), F.lit(4.0))}, "v")
    row = scaled.orderBy("target_time").first()
    assert row["target"] == 0.25 and [s["v"] for s in row["steps"]] == [-0.25, 0.0] and row["steps"][0]["w"] == 5.0
    assert scaled.select(series.unscale("target", F.lit(2.0), F.lit(4.0)).alias("y")).orderBy("y").first()[0] == 3.0
    flat = scaled.orderBy("target_time").select(series.flat_steps("steps", ["v", "w"])).first()[0]
    assert flat == [-0.25, 5.0, 0.0, 5.0]


@pytest.mark.parametrize("numbers, cut, train, test", [
    (list(range(10)), 8, 8, 2),
    ([0, 1, 2, 3, 4, 5, 6, 7, 7, 9], 7, 7, 3),
])
def test_split_at_a_row_rank(spark, numbers, cut, train, test):
    df = spark.createDataFrame([(t,) for t in hours(numbers)] + [(None,)], "t timestamp_ntz")
    first, last, cutoff = split.time_split(df, "t")
    assert cutoff == START + timedelta(hours=cut)
    assert (first.count(), last.count()) == (train, test)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 4 * 10**11), min_size=1, max_size=60), st.sampled_from([0.1, 0.2, 0.5]))
def test_cutoff_is_the_ranked_row(spark, micros, fraction):
    rows = [(START + timedelta(microseconds=m - m % 3 * 1000),) for m in micros]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    assert split.time_cutoff(df, "t", fraction) == sorted(r[0] for r in rows)[int(len(rows) * (1 - fraction))]


def test_empty_table_has_no_cutoff(spark):
    with pytest.raises(ValueError):
        split.time_cutoff(spark.createDataFrame([], "t timestamp_ntz"), "t")


def test_cutoff_before_1970(spark):
    rows = [(datetime(1969, 12, 31, 23, 59, 59, 500_000) - timedelta(days=i),) for i in range(5)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    assert split.time_cutoff(df, "t") == sorted(r[0] for r in rows)[4]


def test_auc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1)], "label int, score double")
    assert metrics.roc_auc(df).first()[0] == 0.875
    assert metrics.roc_auc(df.where("label = 1")).first()[0] is None
    unscored = df.unionByName(df.limit(2).withColumn("score", F.lit(float("nan")).cast(dict(df.dtypes)["score"])))
    assert metrics.roc_auc(unscored).first()[0] == 0.875


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 9)), min_size=2, max_size=40))
def test_auc_against_all_pairs(spark, rows):
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    if not pos or not neg:
        return
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    df = spark.createDataFrame([(y, float(s)) for y, s in rows], "label int, score double")
    assert metrics.roc_auc(df, slices=4).first()[0] == pytest.approx(wins / len(pos) / len(neg))


def test_regression_is_not_squared_correlation(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 4.0)], "y double, prediction double")
    row = metrics.regression_metrics(df, "y").first()
    assert row["mae"] == pytest.approx(1 / 3) and row["r2"] == pytest.approx(0.5)


def test_no_predicted_positives(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    row = metrics.class_metrics(df).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (0.5, 0, 0, 0)


def test_silhouette(spark):
    df = spark.createDataFrame([(i, [float(x)], c) for i, (x, c) in enumerate([(0, 0), (1, 0), (10, 1), (11, 1)])],
                               "id int, x array<double>, c int")
    rows = metrics.silhouette_scores(df, "id", "x", "c").orderBy("id").collect()
    assert [round(r["silhouette"], 6) for r in rows] == [0.904762, 0.894737, 0.894737, 0.904762]
    assert metrics.silhouette(df, "id", "x", "c").first()[0] == pytest.approx(0.899749, abs=1e-6)
    lone = df.where("id < 3")
    assert metrics.silhouette_scores(lone, "id", "x", "c").where("id = 2").first()["silhouette"] == 0.0
    assert metrics.silhouette_scores(df, "id", "x", "c", sample_size=3).count() == 3


def test_hashed_sample_is_the_same_with_and_without_the_bound(spark):
    df = spark.range(5000).select("id", (F.col("id") * 1.0).alias("v"))
    few = [r["id"] for r in metrics.hashed_sample(df, "id", 20).collect()]
    want = [r["id"] for r in df.orderBy(F.md5(F.col("id").cast("string")), "id").limit(20).collect()]
    assert few == want
    assert metrics.hashed_sample(df, "id", 5000).count() == 5000
