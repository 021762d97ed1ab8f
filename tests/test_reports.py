from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import START
from tidemark.operators import asof, reports, stats
from tidemark.sources.readers import distinct_view


def test_year_on_year(spark):
    rows = [(datetime(2011, 5, 5), 9), (datetime(2012, 1, 1), 40), (datetime(2012, 1, 1), 40), (datetime(2012, 1, 1), 60),
            (datetime(2013, 1, 1), 150), (datetime(2014, 1, 1), 0), (datetime(2015, 12, 31, 23), 10), (datetime(2016, 1, 1), 7)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, v long")
    out = reports.annual_change(df, "t", "v", 2012, 2015).collect()
    assert [r["year"] for r in out] == ["2012", "2013", "2014", "2015"]
    assert [r["total_traffic_volume"] for r in out] == [100, 150, 0, 10]
    assert [r["total_change_vs_prev_year"] for r in out] == [None, 50, -150, 10]
    assert [r["total_pct_change_vs_prev_year"] for r in out] == [None, 50.0, -100.0, None]
    assert [r["hours_recorded"] for r in out] == [2, 1, 1, 1]


def test_year_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(datetime(2012, 1, 1), 1)], "t timestamp_ntz, v long").write.parquet(path)
    plan = reports.annual_coverage(spark.read.parquet(path), "t", "v", 2012, 2013)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(t,2012-01-01" in plan


def test_leap_years_have_more_hours(spark):
    rows = [(datetime(y, 1, 1) + timedelta(hours=h), h) for y in (2015, 2016) for h in range(876)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, v long")
    out = {r["year"]: r["pct_hours_covered"] for r in reports.annual_coverage(df, "t", "v", 2015, 2016).collect()}
    assert out == {"2015": 10.0, "2016": 10.0}
    assert 876 / 8784 * 100 < 9.98


def test_absent_date_keeps_its_row(spark):
    df = spark.createDataFrame([(datetime(2015, 1, 1, 5), 270.0, 100)], "date_time timestamp_ntz, temp double, traffic_volume int")
    out = reports.date_summary(df, [("here", date(2015, 1, 1)), ("gone", date(2016, 1, 1))]).collect()
    by = {r["label"]: r for r in out}
    assert by["here"]["hours_recorded"] == 1 and by["here"]["avg_temp_K"] == 270.0
    assert by["gone"]["hours_recorded"] == 0 and by["gone"]["min_temp_K"] is None


def test_distinct_view_keeps_conflicting_values(spark):
    t = datetime(2020, 1, 1)
    df = spark.createDataFrame([(t, 1), (t, 1), (t, 2)], "t timestamp_ntz, v int")
    assert distinct_view(df, ["t", "v"], "readings").count() == 2
    assert spark.sql("select count(*) from readings").first()[0] == 2


def test_hour_rankings_break_ties_by_hour(spark):
    df = spark.createDataFrame([(h, v) for h, v in [(4, 1), (5, 7), (6, 7), (7, 9), (8, 2), (23, 0), (None, 50)]], "hour int, traffic_volume int")
    assert [r["hour"] for r in reports.peak_hours(df, 3).collect()] == [7, 5, 6]
    assert [r["hour"] for r in reports.quiet_hours(df, 2).collect()] == [8, 5]


def test_weekend_comparison(spark):
    df = spark.createDataFrame([(0, 1), (0, 2), (0, 6), (1, 4)], "is_weekend int, traffic_volume int")
    out = {r["day_type"]: r for r in reports.weekend_comparison(df).collect()}
    assert (out["Weekday"]["mean"], out["Weekday"]["median"]) == (3.0, 2.0)
    assert out["Weekday"]["std"] == pytest.approx(2.6457513)
    assert out["Weekend"]["std"] is None


def test_histogram_has_empty_bins(spark):
    df = spark.createDataFrame([(0.0,), (10.0,)], "v double")
    out = stats.histogram(df, "v").orderBy("bin").collect()
    assert len(out) == 40 and [r["bin"] for r in out if r["n_rows"]] == [1, 40]
    assert sum(r["n_rows"] for r in stats.histogram(spark.createDataFrame([(3.0,)] * 4, "v double"), "v").collect()) == 4


def test_box_statistics(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [*range(1, 9), 100]] + [("b", 50.0)], "k string, v double")
    out = stats.box_stats(df, "k", "v").collect()
    assert [r["k"] for r in out] == ["b", "a"]
    a = out[1]
    assert (a["q1"], a["median"], a["q3"], a["whisker_low"], a["whisker_high"]) == (3, 5, 7, 1, 8)


def test_shares_ignore_missing(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), (None,)], "k string")
    assert {r["k"]: r["share"] for r in reports.value_shares(df, "k").collect()} == {"a": 0.5, "b": 0.5}


def test_weights_are_not_rescaled(spark):
    profiles = spark.createDataFrame([("Clear", 0, 100.0), ("Snow", 0, 40.0)], "weather_main string, hour int, volume double")
    weights = spark.createDataFrame([("Clear", 0.75), ("Snow", 0.25)], "weather_main string, frequency double")
    assert reports.weighted_profile(profiles, weights, "weather_main").first()["volume"] == 85.0
    half = weights.withColumn("frequency", F.col("frequency") / 2)
    assert reports.weighted_profile(profiles, half, "weather_main").first()["volume"] == 42.5


def _observed(spark, minutes):
    rows = [(START + timedelta(minutes=m), m) for m in sorted(set(minutes))]
    return spark.createDataFrame(rows, "date_time timestamp_ntz, traffic_volume int")


def test_nearest_single(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 8), 10), (datetime(2024, 1, 1, 10), 20)], "date_time timestamp_ntz, traffic_volume int"
    )
    def at(text):
        r = asof.reading_at(df, text, fields=["traffic_volume"]).first()
        return r["traffic_volume"], r["exact_match"]

    assert at("2024-01-01 08:00") == (10, True)
    assert at("2024-01-01 09:00") == (10, False)
    assert at("2024-01-01 09:31") == (20, False)
    assert at("2024-01-01 07:00") == (10, False)
    with pytest.raises(ValueError):
        asof.reading_at(df, "garbage")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.integers(0, 30000), min_size=1, max_size=25),
    st.lists(st.integers(-5000, 35000), min_size=1, max_size=25),
)
def test_nearest_against_plain_python(spark, observed, asked):
    rows = [(i, START + timedelta(minutes=m)) for i, m in enumerate(asked)]
    requests = spark.createDataFrame(rows, "id int, requested_date_time timestamp_ntz")
    out = asof.nearest_readings(requests, _observed(spark, observed), fields=["traffic_volume"], slices=5)
    got = {r["id"]: (r["traffic_volume"], r["exact_match"]) for r in out.collect()}
    for i, m in enumerate(asked):
        near = min(set(observed), key=lambda o: (abs(o - m), o))
        assert got[i] == (near, near == m)


def test_request_without_a_time_keeps_its_row(spark):
    requests = spark.createDataFrame([(1, None), (2, START)], "id int, requested_date_time timestamp_ntz")
    out = asof.nearest_readings(requests, _observed(spark, [0]), fields=["traffic_volume"]).orderBy("id").collect()
    assert [(r["id"], r["exact_match"]) for r in out] == [(1, None), (2, True)]


def test_many_requests_for_one_time(spark):
    """A third of the requests share one time, and most share their nearest reading."""
    times = [START + timedelta(minutes=0 if i % 3 == 0 else 10_000 + i) for i in range(300)]
    requests = spark.createDataFrame(list(enumerate(times)), "id int, requested_date_time timestamp_ntz")
    out = asof.nearest_readings(requests, _observed(spark, [0, 60]), fields=["traffic_volume"]).collect()
    assert {r["id"]: r["traffic_volume"] for r in out} == {i: 0 if i % 3 == 0 else 60 for i in range(300)}


def test_one_time_with_a_third_of_the_requests(spark):
    from tidemark.operators import joins

    requests = spark.range(0, 6000, 1, 6).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") + 100).alias("k"),
    )
    right = spark.createDataFrame([(7, "hot"), (102, "cold"), (None, "never"), (5, "unasked")], "k long, v string")
    assert [r.k for r in joins.hot_keys(requests, ["k"]).collect()] == [7]
    out = joins.hot_left_join(requests, right, ["k"])
    assert sorted(out.columns) == ["id", "k", "v"] and out.count() == 6000
    counts = {r.v: r["count"] for r in out.groupBy("v").count().collect()}
    assert counts == {"hot": 2000, "cold": 1, None: 3999}
    # The right side is not copied: the rows of the hot key meet one broadcast row of it.
    plan = out._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "Generate" not in plan
    assert joins.hot_left_join(requests.where("false"), right, ["k"]).count() == 0
