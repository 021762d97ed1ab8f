from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift
from tidemark.operators.reports import value_shares


def means(spark, mean, std):
    return spark.createDataFrame([("temp", mean, std)], "field string, ref_mean double, ref_std double")


@pytest.mark.parametrize("live, std, status, z", [
    (291.0, 10.0, "ALERT", "+1.10"), (290.0, 10.0, "PASS", "+1.00"), (500.0, 0.0, "PASS", "+0.00"), (268.0, 10.0, "ALERT", "-1.20"),
])
def test_mean_shift(spark, live, std, status, z):
    df = spark.createDataFrame([(live,)], "temp double")
    row = drift.continuous_drift(df, means(spark, 280.0, std)).first()
    assert (row["status"], row["check"], row["live_value"]) == (status, "feature mean: temp", live)
    assert row["detail"] == f"z={z} (threshold |z|>1.0)"


def test_category_shares(spark):
    live = spark.createDataFrame([("a",)] * 30 + [("b",)] * 301 + [("c",)] * 9 + [("d",)] * 660, "weather_main string")
    ref = spark.createDataFrame([("a", 0.01), ("b", 0.1), ("d", 0.8)], "category string, ref_share double")
    got = {r["check"].split(": ")[1]: (r["status"], r["detail"]) for r in drift.category_drift(live, ref).collect()}
    assert got["a"][0] == "PASS" and got["b"][0] == "ALERT" and got["d"][0] == "PASS"
    assert got["c"] == ("ALERT", "category never seen in training data")
    assert got["b"][1] == "ratio=3.01x training share (threshold >3x)"


@pytest.mark.parametrize("live, ref, status, text", [
    ([True, False], 0.0, "ALERT", "holiday requests never seen in training data"),
    ([False], 0.0, "PASS", "no holidays either side"),
    ([True], 0.25, "ALERT", "ratio=4.00x"),
    ([False], 0.25, "PASS", "ratio=0.00x"),
])
def test_holiday_rate(spark, live, ref, status, text):
    df = spark.createDataFrame([(v,) for v in live], "is_holiday boolean")
    row = drift.rate_drift(df, spark.createDataFrame([(ref,)], "holiday_rate double")).first()
    assert row["status"] == status and row["detail"].startswith(text)


T = datetime(2024, 1, 1)


@pytest.mark.parametrize("base, predicted, status", [(5.0, 110.0, "PASS"), (4.9, 110.0, "ALERT"), (0.0, 110.0, "ALERT")])
def test_error_ratio(spark, base, predicted, status):
    live = spark.createDataFrame([(T, predicted), (datetime(2030, 1, 1), 0.0)], "input_date_time timestamp_ntz, predicted_traffic_volume double")
    seen = spark.createDataFrame([(T, 100)], "date_time timestamp_ntz, traffic_volume int")
    row = drift.error_drift(live, seen, F.lit(base)).first()
    assert row["status"] == status and row["live_value"] == 10.0 and row["detail"].startswith("1 of 2 live requests matched")
    assert drift.known_outcomes(live, seen).count() == 1


def test_no_known_outcome(spark):
    live = spark.createDataFrame([(T, 1.0)], "input_date_time timestamp_ntz, predicted_traffic_volume double")
    none = spark.createDataFrame([], "date_time timestamp_ntz, traffic_volume int")
    row = drift.error_drift(live, none, F.lit(3.0)).first()
    assert (row["status"], row["live_value"], row["reference_value"]) == ("N/A", None, 3.0)


def test_report(spark):
    def verdict(states):
        df = spark.createDataFrame([(s,) for s in states], "status string")
        return tuple(drift.overall_status(df).first())

    assert verdict(["PASS", "N/A"]) == (2, 0, "PASS")
    assert verdict(["PASS", "ALERT", "N/A"]) == (3, 1, "ALERT")


def test_all_findings_in_one_table(spark):
    fields = "temp double, rain_1h double, snow_1h double, clouds_all double, weather_main string, is_holiday boolean"
    train = spark.createDataFrame([(280.0 + i, 0.0, 0.0, float(i), "Clear", i == 0) for i in range(10)], fields)
    live = spark.createDataFrame([(400.0, 0.0, 1.0, 5.0, "Snow", False)], fields).withColumns(
        {"input_date_time": F.lit(T), "predicted_traffic_volume": F.lit(7.0)}
    )
    seen = spark.createDataFrame([(T, 10)], "date_time timestamp_ntz, traffic_volume int")
    reference = drift.build_reference(train)
    rows = drift.drift_findings(live, reference, seen, F.lit(1.0)).collect()
    assert {r["check"]: r["status"] for r in rows} == {
        "feature mean: temp": "ALERT", "feature mean: rain_1h": "PASS", "feature mean: snow_1h": "PASS",
        "feature mean: clouds_all": "PASS", "weather_main share: Snow": "ALERT", "is_holiday rate": "PASS",
        "prediction error (matched ground truth)": "ALERT",
    }
    assert value_shares(train, "weather_main").first()["share"] == 1.0
