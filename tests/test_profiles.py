import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import FLAT, LATE, ONE, PROFILES, TWO, expected_window, profile_rows
from tidemark.functions import vocab
from tidemark.operators import profiles as pf


def frame(spark, profiles):
    return spark.createDataFrame(profile_rows(profiles), "k string, hour int, volume double")


@pytest.mark.parametrize("size, expected", [
    (1, {"two": (10, 11, 4500.0, True), "one": (7, 8, 1200.0, False), "late": (7, 8, 1200.0, False), "flat": (7, 8, 100.0, False)}),
    (3, {"two": (9, 12, 4633.33, True), "one": (7, 10, 1900.0, False)}),
])
def test_best_window(spark, size, expected):
    out = {r["k"]: r for r in pf.best_window(frame(spark, PROFILES), ["k"], size).collect()}
    for k, want in expected.items():
        r = out[k]
        assert (r["start_hour"], r["end_hour"], round(r["avg_volume"], 2), r["is_trough"]) == want
        assert r["peak_volume"] == max(PROFILES[k])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(1, 12), min_size=24, max_size=24), min_size=1, max_size=6), st.integers(1, 5))
def test_best_window_against_plain_python(spark, many, size):
    profiles = {str(i): v for i, v in enumerate(many)}
    for r in pf.best_window(frame(spark, profiles), ["k"], size).collect():
        start, end, mean, trough = expected_window(profiles[r["k"]], size)
        assert (r["start_hour"], r["end_hour"], r["is_trough"]) == (start, end, trough)
        assert r["avg_volume"] == pytest.approx(mean)


def test_profile_without_a_choice_fails(spark):
    df = frame(spark, {"two": TWO}).where("hour < 5")
    with pytest.raises(Exception, match="no hour to recommend"):
        pf.best_window(df, ["k"]).collect()


def test_local_minima(spark):
    df = frame(spark, {"two": TWO, "flat": FLAT})
    out = {}
    for r in pf.local_minima(df, ["k"]).collect():
        out.setdefault(r["k"], []).append(r["hour"])
    assert sorted(out["flat"]) == list(range(24)) and sorted(out["two"]) == [2, 3, 10]
    assert pf.local_minima(df, ["k"], vocab.MIN_PROMINENCE_PCT).count() == 0
    wrap = pf.local_minima(frame(spark, {"w": [1] + [5] * 22 + [9]}), ["k"], 5.0).collect()
    assert [r["hour"] for r in wrap] == [0]


def test_lowest_and_minimum_windows(spark):
    df = frame(spark, {"two": TWO, "late": LATE})
    low = {r["k"]: (r["start_hour"], r["end_hour"], r["avg_volume"]) for r in pf.lowest_window(df, ["k"], 3).collect()}
    assert low["two"] == (20, 23, pytest.approx(2433.33, abs=0.01))
    assert low["late"][:2] == (5, 8)
    first = {r["k"]: r for r in pf.minimum_window(df, ["k"]).collect()}
    assert (first["two"]["start_hour"], first["two"]["is_trough"]) == (10, True)
    prominent = {r["k"]: r for r in pf.minimum_window(df, ["k"], earliest=7, min_prominence_pct=5.0).collect()}
    assert (prominent["two"]["start_hour"], prominent["two"]["is_trough"]) == (22, False)


@pytest.fixture(scope="module")
def conditions(spark):
    rows = [(w, 1.0 / 11, 0.1 * i, 0.0, 0.0, 50.0) for i, w in enumerate(vocab.WEATHER)]
    return spark.createDataFrame(
        rows, "weather_main string, frequency double, temp_scaled double, rain_1h double, snow_1h double, clouds_all double"
    )


def test_grid(spark, conditions):
    grid = pf.scenario_grid(conditions)
    assert grid.count() == 2 * 11 * 24
    row = grid.where("day_type = 'weekend' and weather_main = 'Squall' and hour = 6").first()
    assert (row["is_weekend"], row["is_holiday"], row["wx_Squall"], row["is_severe_weather"]) == (1, 0, 1, 1)
    assert row["hour_sin"] == pytest.approx(1) and set(vocab.FEATURES) <= set(grid.columns)
    with pytest.raises(ValueError):
        pf.scenario_grid(conditions, ["holiday"])


def test_recommendation_table(spark, conditions):
    volumes = pf.scenario_grid(conditions).withColumn(
        "volume", F.get(F.array(*[F.lit(float(v)) for v in TWO]), F.col("hour")) * F.when(F.col("is_weekend") == 1, 0.5).otherwise(1.0)
    )
    profiles = pf.scenario_profiles(volumes, conditions)
    rows = pf.recommendations(profiles).collect()
    assert len(rows) == 24 and len({(r["day_type"], r["weather_condition"]) for r in rows}) == 24
    mix = next(r for r in rows if r["day_type"] == "weekday" and r["weather_condition"] == vocab.TYPICAL_MIX)
    assert (mix["recommended_start"], mix["recommended_end"], mix["is_genuine_trough"]) == ("10:00 AM", "11:00 AM", True)
    assert mix["recommendation_text"] == (
        "For a weekday journey, consider travelling between 10:00 AM and 11:00 AM, when historical traffic volumes "
        "dip to a local low between the morning and evening rush periods (predicted volume approximately 4500, "
        "31% below the daily peak of approximately 6500)."
    )
    rain = next(r for r in rows if r["day_type"] == "weekend" and r["weather_condition"] == "Rain")
    assert rain["recommendation_text"].startswith("For a weekend journey during rain conditions, consider")


def test_sentence_without_a_trough(spark):
    df = frame(spark, {"weekend": ONE}).select(F.col("k").alias("day_type"), F.lit("Snow").alias("weather_condition"), "hour", "volume")
    text = pf.recommendations(df).first()["recommendation_text"]
    assert text == (
        "For a weekend journey during snow conditions, there is no significant midday dip between rush periods; the lowest "
        "point within typical travel hours is around 7:00 AM to 8:00 AM (predicted volume approximately 1200, 73% below "
        "the daily peak of approximately 4400)."
    )


def test_alignment_keeps_one_sided_hours(spark):
    a = spark.createDataFrame([(0, 1.0), (1, 2.0)], "hour int, volume double")
    b = spark.createDataFrame([(1, 5.0), (2, 6.0)], "hour int, volume double")
    rows = {r["hour"]: r["difference"] for r in pf.align_profiles(a, b).collect()}
    assert rows == {0: None, 1: -3.0, 2: None}


def test_conditions_attach(spark, conditions):
    asked = spark.createDataFrame([("Snow",), ("Hail",)], "weather_main string")
    good, lacking = pf.attach_conditions(asked, conditions)
    assert good.count() == 1 and lacking.first()["weather_main"] == "Hail"


def test_found_categories_are_recommended_too(spark):
    rows = [("weekday", w, h, float(v)) for w in ("Hail", "Clear") for h, v in enumerate(TWO)]
    profiles = spark.createDataFrame(rows, "day_type string, weather_condition string, hour int, volume double")
    out = {(r["day_type"], r["weather_condition"]): r for r in pf.recommendation_table(profiles, ["Clear", "Snow"]).collect()}
    assert {c for _, c in out} == {vocab.TYPICAL_MIX, "Clear", "Snow", "Hail"} and len(out) == 8
    assert out["weekday", "Hail"]["recommended_start"] == "10:00 AM"
    assert out["weekend", "Hail"]["recommended_start"] is None and "Hail" in out["weekend", "Hail"]["recommendation_text"]
