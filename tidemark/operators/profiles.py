"""24-hour profiles: local minima, quiet windows and travel recommendations.

A profile is 24 rows (key columns, hour, volume). Each is folded into one array of 24
numbers by a plain aggregate, after which every rule is an expression over that array,
for all profiles at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import expressions as x
from tidemark.functions import vocab
from tidemark.operators.bounds import small_table


def fold_profiles(df: DataFrame, keys: Sequence[str], volume: str = "volume", hour: str = "hour") -> DataFrame:
    """(keys, v): v[h] is the volume of hour h, null where the hour is absent."""
    cells = [F.max(F.when(F.col(hour) == h, F.col(volume).cast("double"))) for h in range(24)]
    return df.groupBy(*keys).agg(F.array(*cells).alias("v"))


def _hours(low: Column | int, high: Column | int) -> Column:
    """Array of the hours low..high, empty when low is above high."""
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.filter(F.sequence(F.lit(0), F.lit(23)), lambda h: (h >= low) & (h <= high))


def _present(v: Column, hours: Column) -> Column:
    return F.filter(hours, lambda h: v[h].isNotNull())


def arg_max(v: Column, hours: Column) -> Column:
    """First hour with the highest value, null for no hours."""
    best = F.array_max(F.transform(_present(v, hours), lambda h: F.struct(v[h].alias("v"), (-h).alias("n"))))
    return -best["n"]


def arg_min(v: Column, hours: Column) -> Column:
    """First hour with the lowest value, null for no hours."""
    return F.array_min(F.transform(_present(v, hours), lambda h: F.struct(v[h].alias("v"), h.alias("h"))))["h"]


def mean_over(v: Column, hours: Column) -> Column:
    found = _present(v, hours)
    total = F.aggregate(found, F.lit(0.0), lambda s, h: s + v[h])
    return F.try_divide(total, F.size(found).cast("double"))


def minima_hours(v: Column, min_prominence_pct: float | None = None) -> Column:
    """Hours not above either neighbour on the 24-hour circle.

    With a prominence, the smaller of the two rises must also reach that percentage
    of the hour's own value.
    """
    def keep(h: Column) -> Column:
        here, before, after = v[h], v[F.pmod(h + 23, F.lit(24))], v[F.pmod(h + 1, F.lit(24))]
        test = (here <= before) & (here <= after)
        if min_prominence_pct is not None:
            rise = F.least(before - here, after - here)
            test = test & (here > 0) & (F.try_divide(rise, here) * 100 >= min_prominence_pct)
        return F.coalesce(test, F.lit(False))

    return F.filter(F.sequence(F.lit(0), F.lit(23)), keep)


def local_minima(df: DataFrame, keys: Sequence[str], min_prominence_pct: float | None = None, **kw) -> DataFrame:
    """One row per profile and local minimum."""
    folded = fold_profiles(df, keys, **kw)
    hours = folded.select(*keys, "v", F.explode(minima_hours(F.col("v"), min_prominence_pct)).alias("hour"))
    return hours.select(*keys, "hour", F.col("v")[F.col("hour")].alias("volume"))


def lowest_window(
    df: DataFrame, keys: Sequence[str], window_size: int = 1, earliest: int = 5, latest: int = vocab.LATEST_HOUR, **kw
) -> DataFrame:
    """The run of ``window_size`` hours with the lowest mean; the earliest start wins ties."""
    v = F.col("v")
    starts = F.sequence(F.lit(earliest), F.lit(latest - window_size + 1))
    means = F.transform(
        starts, lambda s: F.struct(mean_over(v, _hours(s, s + window_size - 1)).alias("mean"), s.alias("start"))
    )
    best = F.array_min(F.filter(means, lambda m: m["mean"].isNotNull()))
    return fold_profiles(df, keys, **kw).select(*keys, best.alias("b")).select(
        *keys,
        F.col("b.start").alias("start_hour"),
        (F.col("b.start") + window_size).alias("end_hour"),
        F.col("b.mean").alias("avg_volume"),
    )


def _around(best: Column, window_size: int, earliest: int, latest: int) -> tuple[Column, Column]:
    """Hours (start, end) of a window about ``best``, kept inside the travel range."""
    start = F.greatest(F.lit(earliest), best - (window_size - 1) // 2)
    end = F.least(F.lit(latest + 1), start + window_size)
    return end - window_size, end


def _described(chosen: DataFrame, keys: Sequence[str], window_size: int, earliest: int, latest: int) -> DataFrame:
    start, end = _around(F.col("best"), window_size, earliest, latest)
    out = chosen.withColumn("start_hour", start).withColumn("end_hour", end)
    mean = mean_over(F.col("v"), _hours(F.col("start_hour"), F.col("end_hour") - 1))
    return out.withColumn("avg_volume", mean).withColumn("peak_volume", F.array_max("v")).select(
        *keys, "start_hour", "end_hour", "avg_volume", "peak_volume", "is_trough"
    )


def minimum_window(
    df: DataFrame,
    keys: Sequence[str],
    window_size: int = 1,
    earliest: int = 5,
    latest: int = vocab.LATEST_HOUR,
    min_prominence_pct: float | None = None,
    **kw,
) -> DataFrame:
    """Window about the lowest local minimum of the travel range, else about its lowest hour."""
    v = F.col("v")
    dips = F.filter(minima_hours(v, min_prominence_pct), lambda h: (h >= earliest) & (h <= latest))
    dip = arg_min(v, dips)
    chosen = fold_profiles(df, keys, **kw).withColumn("is_trough", dip.isNotNull())
    chosen = chosen.withColumn("best", F.coalesce(dip, arg_min(v, _hours(earliest, latest))))
    return _described(chosen, keys, window_size, earliest, latest)


def best_window(
    df: DataFrame,
    keys: Sequence[str],
    window_size: int = 1,
    earliest: int = vocab.EARLIEST_HOUR,
    latest: int = vocab.LATEST_HOUR,
    **kw,
) -> DataFrame:
    """Recommended window from the day's two rush hours.

    If the morning and evening peaks are at least two hours apart and some hour between
    them is below both, that trough is taken. Otherwise the lower of the lowest hours
    before and after the larger peak is, the morning peak and the earlier side winning
    ties. A profile that leaves no hour to choose fails the job.
    """
    v = F.col("v")
    out = fold_profiles(df, keys, **kw)
    out = out.withColumns(
        {"am": arg_max(v, _hours(*vocab.MORNING_HOURS)), "pm": arg_max(v, _hours(*vocab.EVENING_HOURS))}
    )
    am, pm = F.col("am"), F.col("pm")
    between = _hours(F.greatest(am + 1, F.lit(earliest)), F.least(pm - 1, F.lit(latest)))
    out = out.withColumn("dip", F.when(pm - am >= 2, arg_min(v, between)))
    dip = F.col("dip")
    out = out.withColumn("is_trough", F.coalesce((v[dip] < v[am]) & (v[dip] < v[pm]), F.lit(False)))
    out = out.withColumn("peak", F.when(v[am] >= v[pm], am).otherwise(pm))
    out = out.withColumns(
        {
            "pre": arg_min(v, _hours(earliest, F.col("peak") - 1)),
            "post": arg_min(v, _hours(F.col("peak") + 1, latest)),
        }
    )
    pre, post = F.col("pre"), F.col("post")
    side = F.when(post.isNull() | (v[pre] <= v[post]), pre).otherwise(post)
    best = F.coalesce(
        F.when(F.col("is_trough"), dip).otherwise(side),
        F.raise_error(F.lit("the profile leaves no hour to recommend")).cast("int"),
    )
    return _described(out.withColumn("best", best), keys, window_size, earliest, latest)


# --- scenarios ---------------------------------------------------------------
def scenario_grid(conditions: DataFrame, day_types: Sequence[str] = tuple(vocab.DAY_TYPES)) -> DataFrame:
    """One row per day type, weather category and hour, with the model inputs.

    ``conditions`` has one row per category (``weather_main``, ``temp_scaled``,
    ``rain_1h``, ``snow_1h``, ``clouds_all``). Only the hour varies within a scenario.
    """
    unknown = [d for d in day_types if d not in vocab.DAY_TYPES]
    if unknown:
        raise ValueError(f"day type must be one of {list(vocab.DAY_TYPES)}: {unknown}")
    days = F.array(
        *[
            F.struct(F.lit(d).alias("day_type"), F.lit(w).alias("is_weekend"), F.lit(n).alias("day_of_week"))
            for d, (w, n) in vocab.DAY_TYPES.items()
            if d in day_types
        ]
    )
    grid = conditions.select("*", F.explode(days).alias("d")).select("*", "d.*").drop("d")
    grid = grid.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    hour_sin, hour_cos = x.cyclic("hour", 24)
    dow_sin, dow_cos = x.cyclic("day_of_week", 7)
    return grid.select(
        "*",
        hour_sin.alias("hour_sin"),
        hour_cos.alias("hour_cos"),
        dow_sin.alias("dow_sin"),
        dow_cos.alias("dow_cos"),
        F.lit(0).alias("is_holiday"),
        *x.one_hot("weather_main", vocab.WEATHER, "wx_"),
        x.member_flag("weather_main", vocab.SEVERE).alias("is_severe_weather"),
        x.member_flag("weather_main", vocab.LOW_VISIBILITY).alias("is_low_visibility"),
    )


def attach_conditions(scenarios: DataFrame, conditions: DataFrame, key: str = "weather_main") -> tuple[DataFrame, DataFrame]:
    """(scenarios with their conditions, scenarios whose category has none)."""
    return scenarios.join(conditions, key), scenarios.join(conditions, key, "left_anti")


def scenario_profiles(volumes: DataFrame, frequency: DataFrame) -> DataFrame:
    """Per-category profiles plus the frequency-weighted typical day.

    ``volumes`` has (day_type, weather_main, hour, volume), ``frequency`` (weather_main,
    frequency). Weights are used as they are, not brought to a sum of one.
    """
    mix = (
        volumes.select("day_type", "weather_main", "hour", "volume")
        .join(frequency.select("weather_main", "frequency"), "weather_main")
        .groupBy("day_type", "hour")
        .agg(F.sum(F.col("volume") * F.col("frequency")).alias("volume"))
        .withColumn("weather_condition", F.lit(vocab.TYPICAL_MIX))
    )
    single = volumes.withColumnRenamed("weather_main", "weather_condition")
    columns = ["day_type", "weather_condition", "hour", "volume"]
    return single.select(*columns).unionByName(mix.select(*columns))


def recommendation_sentence() -> Column:
    """The plain-language line of a recommendation row."""
    weather = F.when(F.col("weather_condition") == vocab.TYPICAL_MIX, F.lit("")).otherwise(
        F.concat(F.lit(" during "), F.lower("weather_condition"), F.lit(" conditions"))
    )
    start, end = x.clock_text("start_hour"), x.clock_text("end_hour")
    # --- fixed values: sentence wording ---
    opening = F.concat(F.lit("For a "), F.col("day_type"), F.lit(" journey"), weather, F.lit(", "))
    size = F.concat(
        F.lit("(predicted volume approximately "), x.whole_text("avg_volume"), F.lit(", "),
        x.whole_text("pct_below_peak"), F.lit("% below the daily peak of approximately "),
        x.whole_text("peak_volume"), F.lit(")."),
    )
    trough = F.concat(
        F.lit("consider travelling between "), start, F.lit(" and "), end,
        F.lit(", when historical traffic volumes dip to a local low between the morning and evening rush periods "),
    )
    trend = F.concat(
        F.lit("there is no significant midday dip between rush periods; "
              "the lowest point within typical travel hours is around "),
        start, F.lit(" to "), end, F.lit(" "),
    )
    return F.concat(opening, F.when(F.col("is_trough"), trough).otherwise(trend), size)


def with_share_below_peak(windows: DataFrame) -> DataFrame:
    below = (F.lit(1.0) - F.try_divide(F.col("avg_volume"), F.col("peak_volume"))) * 100
    return windows.withColumn("pct_below_peak", below)


def recommendations(profiles: DataFrame, **kw) -> DataFrame:
    """The recommendation table, one row per day type and weather condition."""
    windows = with_share_below_peak(best_window(profiles, ["day_type", "weather_condition"], **kw))
    return windows.select(
        "day_type",
        "weather_condition",
        x.clock_text("start_hour").alias("recommended_start"),
        x.clock_text("end_hour").alias("recommended_end"),
        F.round("avg_volume", 1).alias("predicted_volume"),
        F.round("peak_volume", 1).alias("daily_peak_volume"),
        F.round("pct_below_peak", 1).alias("pct_below_peak"),
        F.col("is_trough").alias("is_genuine_trough"),
        recommendation_sentence().alias("recommendation_text"),
    )


def recommendation_table(
    profiles: DataFrame, categories: Sequence[str] = tuple(vocab.WEATHER), day_types: Sequence[str] = tuple(vocab.DAY_TYPES), **kw
) -> DataFrame:
    """The recommendations of every day type with the typical mix and each category, declared or found in the profiles.

    A combination without a profile keeps its row, without figures and with a text that says so.
    """
    found = recommendations(profiles, **kw)
    declared = small_table(profiles.sparkSession, {"weather_condition": [vocab.TYPICAL_MIX, *categories]})
    named = declared.union(profiles.select("weather_condition").where(F.col("weather_condition").isNotNull())).distinct()
    asked = named.select(F.explode(F.array(*[F.lit(d) for d in day_types])).alias("day_type"), "weather_condition")
    missing = F.concat(F.lit("No recommendation for a "), "day_type", F.lit(" journey: no conditions are known for "), "weather_condition", F.lit("."))
    out = asked.join(found, ["day_type", "weather_condition"], "left")
    return out.withColumn("recommendation_text", F.coalesce("recommendation_text", missing))


# --- comparing profiles ------------------------------------------------------
def align_profiles(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("hour",)) -> DataFrame:
    """Two profiles side by side with their difference; an hour of only one side is kept."""
    a = left.select(*keys, F.col("volume").alias("simulated"))
    b = right.select(*keys, F.col("volume").alias("historical_mean"))
    return a.join(b, list(keys), "full").withColumn("difference", F.col("simulated") - F.col("historical_mean"))


def profile_correlation(aligned: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return aligned.groupBy(*by).agg(F.corr("simulated", "historical_mean").alias("correlation"))
