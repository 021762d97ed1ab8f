"""Feature columns for training tables and for scoring requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import vocab
from tidemark.functions import expressions as x
from tidemark.operators.bounds import small_table
from tidemark.operators.joins import hot_left_join
from tidemark.operators.ranks import quantile_scalars
from tidemark.session import materialize


def add_time(df: DataFrame, ts: str = "date_time") -> DataFrame:
    """hour, day_of_week (Monday 0), is_weekend and the two circular encodings."""
    out = df.withColumns(
        {"hour": F.hour(ts), "day_of_week": x.monday_zero(ts), "is_weekend": x.weekend_flag(ts)}
    )
    hour_sin, hour_cos = x.cyclic("hour", 24)
    dow_sin, dow_cos = x.cyclic("day_of_week", 7)
    return out.withColumns({"hour_sin": hour_sin, "hour_cos": hour_cos, "dow_sin": dow_sin, "dow_cos": dow_cos})


def add_weather(df: DataFrame, c: str = "weather_main") -> DataFrame:
    """One-hot columns over the declared categories and the two weather flags."""
    return df.select(
        "*",
        *x.one_hot(c, vocab.WEATHER, "wx_"),
        x.member_flag(c, vocab.SEVERE).alias("is_severe_weather"),
        x.member_flag(c, vocab.LOW_VISIBILITY).alias("is_low_visibility"),
    )


def add_holiday(df: DataFrame, c: str = "holiday") -> DataFrame:
    return df.withColumn("is_holiday", F.col(c).isNotNull().cast("int"))


def discover_categories(df: DataFrame, c: str) -> list[str]:
    """Categories present, for one-hot columns that follow the data: as many as there are."""
    found = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*")).select(c).collect()
    return sorted(r[0] for r in found)


def category_index(df: DataFrame, c: str) -> DataFrame:
    """(c, position) of every category in the data, stored: positions from 0 in ascending order.

    Categories are ordered in ranges, numbered in each, and each range starts where those before it
    end; only the sizes of the ranges, one row per task, are added up in one place.
    """
    number = F.monotonically_increasing_id()
    ranges = df.where(F.col(c).isNotNull()).select(c).distinct().orderBy(c).select(c, F.spark_partition_id().alias("_part"), number.alias("_id"))
    ranges = materialize(ranges, "categories")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.groupBy("_part").agg(F.count("*").alias("n"), F.min("_id").alias("_first"))
    starts = sizes.select("_part", "_first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    numbered = ranges.join(F.broadcast(starts), "_part")
    return materialize(numbered.select(c, (F.col("_start") + F.col("_id") - F.col("_first")).alias("position")), "category-index")


def one_hot_vector(df: DataFrame, c: str, index: DataFrame, out: str = "one_hot") -> DataFrame:
    """Add a sparse vector with a 1 at the category's position of ``category_index``.

    A missing category, or one the index does not know, has a vector of zeros. However many
    categories there are, a row holds one number and the driver none of their names.
    """
    size = index.count()
    places = index.select(F.col(c).alias("_category"), F.col("position").cast("double").alias("_position"))
    met = hot_left_join(df.withColumn("_category", F.col(c)), places, ["_category"])
    # Positions from the size on are unknown to the encoder, which gives them zeros.
    met = met.withColumn("_position", F.coalesce("_position", F.lit(float(size))))
    encoder = OneHotEncoder(inputCols=["_position"], outputCols=[out], handleInvalid="keep", dropLast=True)
    fitted = encoder.fit(index.select(F.col("position").cast("double").alias("_position")))
    return fitted.transform(met).drop("_category", "_position")


def moments(df: DataFrame, columns: Sequence[str], population: bool = False) -> DataFrame:
    """One row with a struct (mean, std) per column. Sample deviation by default."""
    std = F.stddev_pop if population else F.stddev_samp
    return df.agg(
        *[F.struct(F.avg(c).alias("mean"), std(F.col(c).cast("double")).alias("std")).alias(c) for c in columns]
    )


def standardise(
    df: DataFrame,
    columns: Sequence[str],
    suffix: str = "_scaled",
    population: bool = False,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """z-scores from the moments of ``fit_on`` (default: the table itself).

    The moments are one shared scalar subquery: no join, one pass for all columns.
    """
    stats = moments(fit_on if fit_on is not None else df, columns, population)
    stats = stats.select(F.struct(*columns).alias("s")).scalar()
    return df.withColumns({f"{c}{suffix}": x.zscore(c, stats[c]["mean"], stats[c]["std"]) for c in columns})


def add_quantile_band(
    df: DataFrame,
    c: str,
    out: str,
    probs: Sequence[float],
    labels: Sequence[str],
    missing: str,
    fit_on: DataFrame | None = None,
    cuts: Sequence[Column] | None = None,
    **kw,
) -> DataFrame:
    """Label each value by where it lies between exact quantiles of ``fit_on``
    (or between cut points computed before)."""
    if cuts is None:
        cuts = quantile_scalars(fit_on if fit_on is not None else df, c, probs, **kw)
    return df.withColumn(out, x.banded(c, cuts, labels, missing))


def add_congestion(df: DataFrame, c: str = "traffic_volume", **kw) -> DataFrame:
    """Low up to the first quartile, High above the third, Medium between (and for null)."""
    return add_quantile_band(df, c, "congestion_category", [0.25, 0.75], vocab.THREE_LEVELS, "Medium", **kw)


def add_risk_congestion(df: DataFrame, c: str = "traffic_volume", **kw) -> DataFrame:
    """Four bands at the quartiles; a missing value falls through to the last."""
    return add_quantile_band(
        df, c, "risk_congestion_category", [0.25, 0.5, 0.75], vocab.FOUR_LEVELS, "Severe", **kw
    )


def risk_label() -> Column:
    """High or Severe congestion in severe or low-visibility weather."""
    crowded = F.col("risk_congestion_category").isin("High", "Severe")
    risky = (F.col("is_severe_weather") == 1) | (F.col("is_low_visibility") == 1)
    return x.flag(crowded & risky)


def label_rate(df: DataFrame, label: str = "high_risk") -> DataFrame:
    """Positive count and rate with a verdict: WARN below 1 % or above 50 %."""
    low, high = vocab.LABEL_RATE_BOUNDS
    out = df.agg(F.sum(label).alias("positives"), F.count("*").alias("n_rows"))
    out = out.withColumn("rate", x.safe_ratio("positives", "n_rows"))
    odd = (F.col("rate") < low) | (F.col("rate") > high)
    return out.withColumn("status", F.when(odd, "WARN").otherwise("OK"))


def build_features(clean: DataFrame, **kw) -> DataFrame:
    """Cleaned readings to the full feature table, label included."""
    out = clean.transform(add_time).transform(add_weather)
    out = standardise(out, ["temp", "traffic_volume"])
    q1, q2, q3 = quantile_scalars(clean, "traffic_volume", [0.25, 0.5, 0.75], **kw)
    out = add_congestion(out, cuts=[q1, q3]).transform(add_holiday)
    return add_risk_congestion(out, cuts=[q1, q2, q3]).withColumn("high_risk", risk_label())


def request_features(requests: DataFrame, temp_mean: Column, temp_std: Column) -> DataFrame:
    """Checked requests to the model inputs, through the same column functions as training.

    The two temperature moments come from the training table: literals, or fields of
    a stored one-row table.
    """
    out = requests.transform(add_time).transform(add_weather)
    return out.withColumns(
        {
            "is_holiday": x.flag(F.col("is_holiday")),
            "temp_scaled": x.zscore("temp", temp_mean, temp_std),
        }
    )


def missing_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing cells per column, one row each, from a single pass."""
    counts = F.array(
        *[F.struct(F.lit(c).alias("column"), F.sum(x.flag(F.col(c).isNull())).alias("n")) for c in columns]
    )
    return df.agg(counts.alias("m")).select(F.explode("m").alias("m")).select(
        F.col("m.column").alias("column_name"), F.col("m.n").alias("n_missing")
    )


def feature_matrix(df: DataFrame, columns: Sequence[str] = tuple(vocab.FEATURES), out: str = "features") -> DataFrame:
    """Assemble the model inputs; a missing cell is an error."""
    assembler = VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="error")
    return assembler.transform(df)


# --- severity and rule attributes --------------------------------------------
def add_severity(df: DataFrame, c: str = "weather_main") -> DataFrame:
    return df.withColumn("weather_severity", x.severity_rank(c))


def left_lookup(df: DataFrame, table: dict, key: str, out: str) -> DataFrame:
    """Join a small fixed table on its key, keeping unmatched rows with null."""
    rows = small_table(df.sparkSession, {key: table.keys(), out: table.values()})
    return df.join(F.broadcast(rows), key, "left")


def unmapped_values(df: DataFrame, c: str, known: Sequence[str]) -> DataFrame:
    """Distinct values outside a fixed vocabulary, with their row counts."""
    table = small_table(df.sparkSession, {c: known}, f"{c} string")
    found = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n_rows"))
    return found.join(F.broadcast(table), c, "left_anti")


def unknown_keys(df: DataFrame, c: str, known: DataFrame, known_c: str) -> DataFrame:
    """Distinct values of a column that are no key of another table, with their row counts.

    Rows are counted per value first, so the anti join sees each value once.
    """
    found = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n_rows"))
    return found.join(known.select(F.col(known_c).alias(c)), c, "left_anti")


def add_rule_attributes(df: DataFrame, level: str = "risk_congestion_category") -> DataFrame:
    """The four categorical columns association rules are mined from."""
    return df.withColumns(
        {
            "time_of_day": x.day_part("hour"),
            "weather_bucket": x.weather_group("weather_main"),
            "weekday_type": x.day_label("is_weekend"),
            "congestion_level": F.col(level),
        }
    )
