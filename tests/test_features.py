import math
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import expressions as x
from tidemark.functions import vocab
from tidemark.operators import features as ft
from tidemark.operators import ranks
from tidemark.sources import requests as rq


def test_time_features(spark):
    times = [datetime(2018, 6, 11, 8), datetime(2018, 6, 16, 23), datetime(2018, 6, 16, 6), datetime(2018, 6, 16), None]
    df = spark.createDataFrame([(t,) for t in times], "date_time timestamp_ntz")
    rows = ft.add_time(df).collect()
    assert [(r["hour"], r["day_of_week"], r["is_weekend"]) for r in rows] == [
        (8, 0, 0), (23, 5, 1), (6, 5, 1), (0, 5, 1), (None, None, 0)
    ]
    assert rows[2]["hour_sin"] == pytest.approx(1) and rows[2]["hour_cos"] == pytest.approx(0, abs=1e-12)
    assert (rows[3]["hour_sin"], rows[3]["hour_cos"]) == (0, 1)
    assert rows[4]["hour_sin"] is None


def test_hours_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([(datetime(2024, 3, 10, 2, 30, 15, 250),)], "t timestamp_ntz")
    try:
        for name in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", name)
            row = df.select(x.hour_start("t"), x.hour_number("t"), x.micros_of("t")).first()
            seconds = (datetime(2024, 3, 10, 2, 30, 15) - datetime(1970, 1, 1)).total_seconds()
            assert row[0] == datetime(2024, 3, 10, 2)
            assert row[1] == int(seconds // 3600)
            assert row[2] == int(seconds) * 1_000_000 + 250
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_quantile_bands(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 3, 4, 5, 6, 7, 8]], "traffic_volume int")
    fit = df
    df = df.unionByName(spark.createDataFrame([(None,)], "traffic_volume int"))
    three = {r[0]: r[1] for r in ft.add_congestion(df, fit_on=fit).collect()}
    four = {r[0]: r[1] for r in ft.add_risk_congestion(df, fit_on=fit).collect()}
    assert [three[v] for v in (1, 2, 3, 6, 7, 8, None)] == ["Low", "Low", "Medium", "Medium", "High", "High", "Medium"]
    assert [four[v] for v in (2, 3, 4, 5, 6, 7, None)] == ["Low", "Medium", "Medium", "High", "High", "Severe", "Severe"]


def test_value_on_a_cut_goes_below(spark):
    df = spark.createDataFrame([(4500.0,), (4500.5,), (5500.0,), (5500.1,)], "v double")
    got = [r[0] for r in df.select(x.banded("v", vocab.LEVEL_BOUNDS, vocab.THREE_LEVELS, "Medium")).collect()]
    assert got == ["Low", "Medium", "Medium", "High"]


@pytest.mark.parametrize("population, expected", [(False, 1.161895), (True, 1.341641)])
def test_standard_deviations(spark, population, expected):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "v double")
    out = ft.standardise(df, ["v"], population=population)
    assert out.agg(F.max("v_scaled")).first()[0] == pytest.approx(expected, abs=1e-6)
    constant = ft.standardise(df.withColumn("v", F.lit(2.0)), ["v"], population=True)
    assert constant.where("v_scaled is not null").count() == 0


def test_missing_categories_count_as_zero(spark):
    df = spark.createDataFrame([("Fog",), (None,)], "weather_main string")
    rows = ft.add_weather(df).collect()
    assert rows[0]["wx_Fog"] == 1 and rows[0]["is_low_visibility"] == 1 and rows[0]["is_severe_weather"] == 0
    assert sum(rows[1][f"wx_{w}"] for w in vocab.WEATHER) == 0
    assert (rows[1]["is_low_visibility"], rows[1]["is_severe_weather"]) == (0, 0)


@pytest.mark.parametrize("hour, text", [(0, "12:00 AM"), (12, "12:00 PM"), (14, "2:00 PM"), (23, "11:00 PM"), (24, "12:00 AM")])
def test_clock_text(spark, hour, text):
    assert spark.range(1).select(x.clock_text(F.lit(hour))).first()[0] == text


def test_severity_and_unmapped(spark):
    df = spark.createDataFrame([("Squall",), ("Clear",), ("Sleet",), ("Sleet",), (None,)], "weather_main string")
    assert [r[1] for r in ft.add_severity(df).collect()] == [5, 0, None, None, None]
    assert [tuple(r) for r in ft.unmapped_values(df, "weather_main", vocab.WEATHER).collect()] == [("Sleet", 2)]
    assert ft.left_lookup(df, vocab.SEVERITY, "weather_main", "s").count() == 5


def test_label_rate_verdict(spark):
    for positives, verdict in ((0, "WARN"), (10, "OK"), (60, "WARN")):
        df = spark.range(100).select((F.col("id") < positives).cast("int").alias("high_risk"))
        assert ft.label_rate(df).first()["status"] == verdict


def test_request_checks(spark):
    rows = [
        ('{"date_time": "2018-06-15T08:00:00", "weather_main": "Clear", "temp": 295}', ""),
        ('{"date_time": "2018-06-15T08:00:00", "weather_main": "Clear", "temp": 295, "rain_1h": -1}', "rain_1h"),
        ('{"date_time": "2018-06-15T08:00:00", "weather_main": "Clear", "temp": 295, "clouds_all": 101}', "clouds_all"),
        ('{"date_time": "2018-06-15T08:00:00", "weather_main": "Sunny", "temp": 295}', "weather_main"),
        ('{"date_time": "2018-06-15T08:00:00", "weather_main": "Clear"}', "temp"),
        ('{"date_time": "soon", "weather_main": "Clear", "temp": 295}', "date_time"),
        ('{"date_time": "2018-06-15T08:00:00", "weather_main": "Clear", "temp": 295, "snow_1h": "deep"}', "snow_1h"),
    ]
    df = spark.createDataFrame(rows, "body string, expected string")
    checked = rq.check_requests(rq.requests_from_json(df, "body")).collect()
    for r in checked:
        assert r["accepted"] == (r["expected"] == "")
        assert [reason.split(":")[0] for reason in r["reasons"]] == ([r["expected"]] if r["expected"] else [])
    first = next(r for r in checked if r["accepted"])
    assert (first["rain_1h"], first["snow_1h"], first["clouds_all"], first["is_holiday"]) == (0.0, 0.0, 0.0, False)


def test_serving_matches_training(spark, small):
    from tidemark.plans.standins import feature_table

    feat = feature_table(spark, small)
    stats = ft.moments(feat, ["temp"]).first()["temp"]
    feat = feat.where("date_time is not null")
    requests = feat.select(
        "date_time", "weather_main", "temp", "rain_1h", "snow_1h", F.col("clouds_all").cast("double").alias("clouds_all"),
        (F.col("is_holiday") == 1).alias("is_holiday"),
    )
    served = ft.request_features(requests, F.lit(stats["mean"]), F.lit(stats["std"]))
    left = {r["date_time"]: r for r in feat.select("date_time", *vocab.FEATURES).collect()}
    for r in served.select("date_time", *vocab.FEATURES).collect():
        for c in vocab.FEATURES:
            assert r[c] == pytest.approx(left[r["date_time"]][c], abs=1e-9)


@pytest.mark.parametrize("n", [40, 20_000])
def test_quantiles_equal_the_built_in(spark, n):
    """Skewed, repeated, missing, infinite and keyed values, few rows and many."""
    df = spark.range(0, n, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 1, "empty")
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 5).cast("string"))).alias("k"),
        F.when((F.col("id") % 7 == 1) & (F.col("id") % 3 != 0), None).when(F.col("id") % 4 == 0, 7.0)
        .when(F.col("id") % 101 == 0, None).when(F.col("id") % 37 == 2, float("inf")).when(F.col("id") % 41 == 2, float("nan"))
        .otherwise(F.exp((F.hash("id") % 1000) / 100.0)).alias("v"),
    )
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    known = df.select("k", F.when(~F.isnan("v"), F.col("v")).alias("v"))
    want = {r["k"]: r["q"] for r in known.groupBy("k").agg(F.percentile("v", probs).alias("q")).collect()}
    # All groups in buffers, none, and some; with brackets that are cut into slices, and with ones that miss at first.
    cut, missing = {"reach": 0.05, "per_slice": 40}, {"reach": 1e-5}
    for settings in ({}, {"whole": n}, {"whole": 0}, {"whole": n // 4}, {"whole": 0, **cut}, {"whole": n // 4, **cut}, {"whole": 0, **missing}):
        got = {r["k"]: r["v"] for r in ranks.exact_quantiles(df, "v", probs, ["k"], **settings).collect()}
        assert got.keys() == want.keys() and got["empty"] is None
        for k in set(want) - {"empty"}:
            assert got[k] == pytest.approx(want[k], rel=1e-12)
    two = ranks.exact_quantiles(df.withColumn("w", -F.col("v")), ["v", "w"], [0.5], per_slice=8, whole=0).first()
    assert two["v"][0] == pytest.approx(-two["w"][0])


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "k string, v double")
    mixed = df.unionByName(spark.createDataFrame([("c", 1.0), ("c", 2.0)], df.schema))
    for whole in (0, 1, 2):
        got = {r["k"]: r["v"] for r in ranks.exact_quantiles(mixed, "v", [0.5], ["k"], whole=whole).collect()}
        assert got == {"a": None, "b": None, "c": [1.5]}
    assert {r["k"]: r["v"] for r in ranks.exact_quantiles(df, "v", [0.5], ["k"]).collect()} == {"a": None, "b": None}
    assert ranks.exact_quantiles(df.where("false"), "v", [0.5], ["k"]).collect() == []
    assert ranks.exact_quantiles(df, "v", [0.5]).first()["v"] is None


def test_sparse_vectors_of_found_categories(spark):
    """Thousands of categories, one of a third of the rows, missing and unknown ones."""
    df = spark.range(0, 9000, 1, 5).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, None).otherwise(F.concat(F.lit("c"), (F.col("id") % 4001).cast("string"))).alias("c"),
    )
    index = ft.category_index(df, "c")
    places = {r["c"]: r["position"] for r in index.collect()}
    assert sorted(places, key=places.get) == sorted(places) and sorted(places.values()) == list(range(len(places)))
    more = df.unionByName(spark.createDataFrame([(-1, "new"), (-2, "hot")], df.schema))
    got = ft.one_hot_vector(more, "c", index)
    assert got.columns == ["id", "c", "one_hot"]
    rows = got.collect()
    assert len(rows) == 9002
    for r in rows:
        place = places.get(r["c"])
        assert r["one_hot"].size == len(places) and list(r["one_hot"].indices) == ([] if place is None else [place])
    nothing = ft.category_index(df.where("c IS NULL"), "c")
    assert nothing.count() == 0


def test_running_totals_equal_a_global_window(spark):
    from pyspark.sql import Window

    df = spark.range(0, 5000, 1, 4).select((F.abs(F.hash("id")) % 700).cast("double").alias("o"), (F.col("id") % 3).alias("n"))
    got = {r["o"]: (r["n"], r["n_before"], r["n_total"]) for r in
           ranks.running_totals(df, "o", {"n": F.col("n")}, slices=16).collect()}
    w = Window.orderBy("o").rowsBetween(Window.unboundedPreceding, -1)
    points = df.groupBy("o").agg(F.sum("n").alias("n"))
    total = points.agg(F.sum("n")).first()[0]
    want = {r["o"]: (r["n"], r["b"] or 0, total) for r in points.withColumn("b", F.sum("n").over(w)).collect()}
    assert got == want


def test_moments_ignore_missing(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "v double")
    row = ft.moments(df, ["v"]).first()["v"]
    assert row["mean"] == 2.0 and row["std"] == pytest.approx(math.sqrt(2))
