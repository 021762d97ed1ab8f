import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import RAW_CSV
from tidemark.functions import expressions as x
from tidemark.operators import clean as cl
from tidemark.sources import readers


@pytest.fixture(scope="module")
def raw_csv_path(tmp_path_factory):
    body = "\n".join(line.split(",", 1)[1] for line in RAW_CSV.strip().splitlines())
    path = tmp_path_factory.mktemp("plain") / "raw.csv"
    path.write_text(body + "\n")
    return str(path)


def test_csv_scan_types_and_nulls(spark, raw_csv_path):
    df = readers.read_raw_csv(spark, raw_csv_path)
    kinds = dict(df.dtypes)
    assert kinds["temp"] == "double" and kinds["traffic_volume"] == "int" and kinds["date_time"] == "string"
    assert df.where("holiday is not null").count() == 1
    ordered = df.orderBy("_ord").select("traffic_volume").collect()
    assert [r[0] for r in ordered][:3] == [5500, 4500, 4500]


def test_order_follows_files_and_lines(spark, tmp_path):
    head = ",".join(["holiday", "temp", "rain_1h", "snow_1h", "clouds_all", "weather_main", "weather_description", "date_time", "traffic_volume"])
    for n, name in enumerate(["a.csv", "b.csv", "c.csv"]):
        # Files of growing size, so that the scan does not take them in name order.
        lines = [f"None,1,0,0,1,Clear,x,2020-01-01 00:00:00,{n * 100 + i}" for i in range(5 + 20 * n)]
        (tmp_path / name).write_text("\n".join([head, *lines]) + "\n")
    df = readers.read_raw_csv(spark, str(tmp_path))
    got = [r[0] for r in df.orderBy("_ord").select("traffic_volume").collect()]
    assert got == [n * 100 + i for n in range(3) for i in range(5 + 20 * n)]
    assert cl.first_per_key(df, ["date_time"]).first()["traffic_volume"] == 0


def test_csv_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_raw_csv(spark, str(tmp_path / "absent.csv"))
    short = tmp_path / "short.csv"
    short.write_text("temp,rain_1h\n1,2\n")
    with pytest.raises(ValueError, match="holiday"):
        readers.read_raw_csv(spark, str(short))
    head = "holiday,temp,rain_1h,snow_1h,clouds_all,weather_main,weather_description,date_time,traffic_volume\n"
    bad = tmp_path / "bad.csv"
    bad.write_text(head + "None,warm,0,0,1,Clear,x,2020-01-01 00:00:00,1\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        readers.read_raw_csv(spark, str(bad)).collect()
    wide = tmp_path / "wide.csv"
    wide.write_text(head + "None,1,0,0,1,Clear,x,2020-01-01 00:00:00,1,9,9\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|FAILED_READ"):
        readers.read_raw_csv(spark, str(wide)).collect()


def test_extra_columns_are_kept(spark, tmp_path):
    path = tmp_path / "extra.csv"
    path.write_text(
        "note,holiday,temp,rain_1h,snow_1h,clouds_all,weather_main,weather_description,date_time,traffic_volume\n"
        "hi,NA,1.5,0,0,1,Clear,x,2020-01-01 00:00:00,1\n"
    )
    row = readers.read_raw_csv(spark, str(path)).first()
    assert (row["note"], row["temp"], row["holiday"]) == ("hi", 1.5, None)


def test_clean_keeps_first_and_fills_by_month(spark, raw_csv_path):
    rows = cl.clean(readers.read_raw_csv(spark, raw_csv_path)).collect()
    got = {str(r["date_time"]): r for r in rows}
    assert len(rows) == 7
    assert got["2012-10-02 10:00:00"]["weather_main"] == "Clouds"
    # October median of 288, 290 and 280, over both years.
    assert got["2012-10-02 11:00:00"]["temp"] == 288.0
    # The only July row has no median to take, and an unreadable time has no month.
    assert got["2016-07-11 17:00:00"]["rain_1h"] is None
    assert got["None"]["temp"] is None
    assert got["2013-10-02 12:00:00"]["traffic_volume"] == 4000


def test_audit_counts(spark, raw_csv_path):
    table = cl.audit(readers.read_raw_csv(spark, raw_csv_path)).collect()
    got = {(r["metric"], r["key"]): r["value"] for r in table}
    expected = {
        "rows_loaded": 11, "weather_main_trimmed": 1, "weather_description_trimmed": 0,
        "weather_description_lowered": 2, "date_time_unparsed": 2, "descriptions_before": 7,
        "descriptions_after": 6, "exact_duplicates": 1, "duplicate_hours": 2, "conflicting_hours": 1,
        "rows_kept": 7, "temp_invalid": 2, "rain_1h_invalid": 1,
    }
    assert {k: got[(k, "")] for k in expected} == expected
    assert got[("temp_filled", "10")] == 1
    assert ("rain_1h_filled", "7") not in got


def test_conflicts_in_long_form(spark, raw_csv_path):
    tidy = readers.read_raw_csv(spark, raw_csv_path).transform(cl.parse_time)
    rows = cl.conflicts(tidy).orderBy("traffic_volume").collect()
    assert [(r["traffic_volume"], r["n_rows"], r["n_values"]) for r in rows] == [(4000, 2, 2), (4100, 2, 2)]


def test_strip_cuts_all_white_space(spark):
    df = spark.createDataFrame([("\t a b \n",), (" c ",), (None,)], "s string")
    assert [r[0] for r in df.select(x.strip_text("s")).collect()] == ["a b", "c", None]


def test_exact_duplicates_keep_the_earliest(spark):
    df = spark.createDataFrame([(3, "a", None), (1, "a", None), (2, "b", 1)], "_ord int, s string, n int")
    rows = cl.drop_exact_duplicates(df).collect()
    assert sorted((r["_ord"], r["s"]) for r in rows) == [(1, "a"), (2, "b")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 50)), min_size=1, max_size=30))
def test_first_per_key_against_plain_python(spark, pairs):
    rows = [(i, k, v) for i, (k, v) in enumerate(pairs)]
    expected = {}
    for i, k, v in rows:
        expected.setdefault(k, (i, v))
    df = spark.createDataFrame(rows, "_ord long, k int, v int").repartition(3)
    got = {r["k"]: (r["_ord"], r["v"]) for r in cl.first_per_key(df, ["k"]).collect()}
    assert got == expected


def test_one_key_with_a_third_of_the_rows(spark):
    df = spark.range(0, 30000, 1, 8).select(
        F.col("id").alias("_ord"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k")
    )
    out = cl.first_per_key(df, ["k"])
    assert out.count() == 20001
    assert out.where("k = -1").first()["_ord"] == 0


def test_many_sensors_keep_their_own_hours(spark, raw_csv_path):
    raw = readers.read_raw_csv(spark, raw_csv_path)
    both = raw.withColumn("sensor", F.lit("a")).unionByName(raw.withColumn("sensor", F.lit("b")))
    one, two = cl.clean(raw), cl.clean(both, keys=["sensor"])
    assert two.columns == [*one.columns, "sensor"] and sorted(map(tuple, two.groupBy("sensor").count().collect())) == [(s, one.count()) for s in ("a", "b")]
