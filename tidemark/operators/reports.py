"""Reporting queries over hourly readings."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import expressions as x
from tidemark.functions import vocab
from tidemark.operators.bounds import small_table
from tidemark.operators.ranks import exact_quantiles
from tidemark.sources.readers import distinct_view


# --- years -------------------------------------------------------------------
def year_range(ts: str, first: int, last: int) -> Column:
    """Inclusive years as a half-open time range, which reaches the scan as a filter."""
    start, end = F.lit(f"{first}-01-01"), F.lit(f"{last + 1}-01-01")
    return (F.col(ts) >= start.cast("timestamp_ntz")) & (F.col(ts) < end.cast("timestamp_ntz"))


def yearly_totals(df: DataFrame, ts: str, volume: str, first: int, last: int) -> DataFrame:
    """Hours, total and mean per year over the distinct (time, volume) readings."""
    view = distinct_view(df.where(year_range(ts, first, last)), [ts, volume])
    return view.groupBy(F.year(ts).alias("y")).agg(
        F.count("*").alias("hours_recorded"), F.sum(volume).alias("total"), F.avg(volume).alias("mean")
    )


def annual_coverage(df: DataFrame, ts: str, volume: str, first: int, last: int) -> DataFrame:
    """Recorded hours against the hours of the year (leap test: divisible by four)."""
    hours = F.when(F.col("y") % 4 == 0, 8784.0).otherwise(8760.0)
    return (
        yearly_totals(df, ts, volume, first, last)
        .select(
            F.col("y").cast("string").alias("year"),
            "hours_recorded",
            F.round(F.col("hours_recorded") * 100.0 / hours, 1).alias("pct_hours_covered"),
            F.col("total").alias("total_traffic_volume"),
            F.round("mean", 1).alias("avg_traffic_volume_per_hour"),
        )
        .orderBy("year")
    )


def annual_change(df: DataFrame, ts: str, volume: str, first: int, last: int) -> DataFrame:
    """Year-on-year change of total and mean; the window sees one row per year."""
    by_year = Window.orderBy("y")

    def change(c: str) -> Column:
        return F.col(c) - F.lag(c).over(by_year)

    def percent(c: str) -> Column:
        before = F.lag(c).over(by_year).cast("double")
        return F.round(F.try_divide(F.lit(100.0) * change(c), before), 2)

    return (
        yearly_totals(df, ts, volume, first, last)
        .select(
            F.col("y").cast("string").alias("year"),
            "hours_recorded",
            F.col("total").alias("total_traffic_volume"),
            change("total").alias("total_change_vs_prev_year"),
            percent("total").alias("total_pct_change_vs_prev_year"),
            F.round("mean", 1).alias("avg_traffic_volume"),
            F.round(change("mean"), 1).alias("avg_change_vs_prev_year"),
            percent("mean").alias("avg_pct_change_vs_prev_year"),
        )
        .orderBy("year")
    )


def yearly_diagnostic(df: DataFrame, ts: str = "date_time") -> DataFrame:
    """Per year: mean volume and the shares of crowded, severe, hazy and risky hours."""
    def share(test: Column) -> Column:
        return F.avg(x.flag(test))

    return df.where(F.col(ts).isNotNull()).groupBy(F.year(ts).alias("year")).agg(
        F.avg("traffic_volume").alias("avg_traffic_volume"),
        share(F.col("risk_congestion_category").isin("High", "Severe")).alias("pct_high_or_severe_congestion"),
        share(F.col("weather_main").isin(*vocab.SEVERE)).alias("pct_severe_weather"),
        F.avg("is_low_visibility").alias("pct_low_visibility"),
        F.avg("high_risk").alias("pct_high_risk"),
    )


# --- days --------------------------------------------------------------------
def on_dates(ts: str, dates: Sequence[date]) -> Column:
    """Rows on any of the dates, as time ranges the scan can use."""
    def one(d: date) -> Column:
        low, high = F.lit(d.isoformat()), F.lit((d + timedelta(days=1)).isoformat())
        return (F.col(ts) >= low.cast("timestamp_ntz")) & (F.col(ts) < high.cast("timestamp_ntz"))

    return reduce(lambda a, b: a | b, [one(d) for d in sorted(set(dates))])


def date_summary(
    df: DataFrame, labels: Sequence[tuple[str, date]], ts: str = "date_time", temp: str = "temp",
    volume: str = "traffic_volume",
) -> DataFrame:
    """One row per labelled date over the distinct readings; a date without any still has its row.

    All dates share one scan and one aggregation.
    """
    names, days = zip(*labels)
    dates = small_table(df.sparkSession, {"label": names, "day": days}, "label string, day date")
    readings = distinct_view(df.where(on_dates(ts, [d for _, d in labels])), [ts, temp, volume])
    per_day = readings.groupBy(F.to_date(ts).alias("day")).agg(
        F.count("*").alias("n"),
        F.min(temp).alias("low"),
        F.max(temp).alias("high"),
        F.avg(temp).alias("mean"),
        F.avg(volume).alias("volume"),
    )
    return dates.join(per_day, "day", "left").select(
        "label",
        F.coalesce("n", F.lit(0)).alias("hours_recorded"),
        F.round("low", 2).alias("min_temp_K"),
        F.round("high", 2).alias("max_temp_K"),
        F.round("mean", 2).alias("avg_temp_K"),
        F.round("volume", 1).alias("avg_traffic_volume"),
    )


# --- hours of the day --------------------------------------------------------
def hourly_means(df: DataFrame, volume: str = "traffic_volume", keys: Sequence[str] = ("hour",)) -> DataFrame:
    """Mean per hour (or other keys); rows with a missing key are left out."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df.groupBy(*keys).agg(F.avg(volume).alias("avg_volume"))


def peak_hours(df: DataFrame, top_n: int = 5, volume: str = "traffic_volume") -> DataFrame:
    """Hours with the highest mean; the earlier hour wins a tie."""
    return hourly_means(df, volume).orderBy(F.desc("avg_volume"), "hour").limit(top_n)


def quiet_hours(
    df: DataFrame, top_n: int = 5, first: int = 5, last: int = 22, volume: str = "traffic_volume"
) -> DataFrame:
    """Hours with the lowest mean between two hours, both included."""
    within = df.where(F.col("hour").between(first, last))
    return hourly_means(within, volume).orderBy("avg_volume", "hour").limit(top_n)


def weekend_comparison(df: DataFrame, volume: str = "traffic_volume", **kw) -> DataFrame:
    """Mean, median and sample deviation, weekday against weekend."""
    medians = exact_quantiles(df, volume, [0.5], ["is_weekend"], **kw)
    medians = medians.select("is_weekend", F.col(volume)[0].alias("median"))
    spread = df.where("is_weekend is not null").groupBy("is_weekend").agg(
        F.avg(volume).alias("mean"), F.stddev_samp(F.col(volume).cast("double")).alias("std")
    )
    return spread.join(medians, "is_weekend", "left").select(
        x.day_label("is_weekend").alias("day_type"), "mean", "median", "std"
    )


def hour_by_weekend(df: DataFrame, volume: str = "traffic_volume") -> DataFrame:
    """Mean by hour with one column for weekdays and one for weekends."""
    return (
        df.where(F.col("hour").isNotNull())
        .groupBy("hour")
        .pivot("is_weekend", [0, 1])
        .agg(F.avg(volume))
        .withColumnsRenamed({"0": "weekday", "1": "weekend"})
    )


# --- frequencies -------------------------------------------------------------
def value_shares(df: DataFrame, c: str) -> DataFrame:
    """Count and share of each value; missing values count in neither."""
    counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n_rows"))
    total = counts.agg(F.sum("n_rows").alias("n")).scalar()
    return counts.withColumn("share", F.col("n_rows") / total)


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column: exact one aggregate per column, or one sketch pass."""
    if approximate:
        return df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
    per_column = [
        df.agg(F.countDistinct(c).alias("n_distinct")).select(F.lit(c).alias("column_name"), "n_distinct")
        for c in columns
    ]
    return reduce(DataFrame.unionByName, per_column)


# --- weather -----------------------------------------------------------------
def weather_profile(df: DataFrame, conditions: Sequence[str], c: str = "weather_main") -> DataFrame:
    """Share of all rows and mean conditions per category."""
    total = df.agg(F.count("*").alias("n")).scalar()
    return df.where(F.col(c).isNotNull()).groupBy(c).agg(
        (F.count("*") / total).alias("frequency"), *[F.avg(k).alias(k) for k in conditions]
    )


def weighted_profile(
    profiles: DataFrame, weights: DataFrame, key: str, volume: str = "volume", weight: str = "frequency",
    by: Sequence[str] = ("hour",),
) -> DataFrame:
    """Sum of value times weight over the categories, per hour. Weights are used as given."""
    joined = profiles.join(weights.select(key, weight), key)
    return joined.groupBy(*by).agg(F.sum(F.col(volume) * F.col(weight)).alias(volume))
