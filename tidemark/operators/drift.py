"""Drift checks of logged requests against the training period."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import vocab
from tidemark.functions.expressions import flag
from tidemark.operators.joins import hot_left_join
from tidemark.operators.reports import value_shares

FINDING_COLUMNS = ["check", "live_value", "reference_value", "detail", "status"]


@dataclass
class Reference:
    """Training-period statistics as three small tables."""

    continuous: DataFrame  # field, ref_mean, ref_std
    shares: DataFrame  # category, ref_share
    holiday: DataFrame  # holiday_rate


def field_means(df: DataFrame, fields: Sequence[str], with_std: bool = False) -> DataFrame:
    """One row per field with its mean (and sample deviation), from one pass."""
    cells = []
    for f in fields:
        parts = [F.lit(f).alias("field"), F.avg(f).alias("mean")]
        if with_std:
            parts.append(F.stddev_samp(F.col(f).cast("double")).alias("std"))
        cells.append(F.struct(*parts))
    return df.agg(F.array(*cells).alias("s")).select(F.explode("s").alias("s")).select("s.*")


def build_reference(
    train: DataFrame,
    fields: Sequence[str] = tuple(vocab.CONTINUOUS_FIELDS),
    category: str = "weather_main",
    holiday: str = "is_holiday",
) -> Reference:
    continuous = field_means(train, fields, with_std=True).withColumnsRenamed({"mean": "ref_mean", "std": "ref_std"})
    shares = value_shares(train, category).select(F.col(category).alias("category"), F.col("share").alias("ref_share"))
    rate = train.agg(F.avg(F.col(holiday).cast("int")).alias("holiday_rate"))
    return Reference(continuous, shares, rate)


def _status(alert: Column) -> Column:
    return F.when(F.coalesce(alert, F.lit(False)), "ALERT").otherwise("PASS")


def _ratio_text(ratio: Column) -> Column:
    return F.format_string(f"ratio=%.2fx training share (threshold >{vocab.MAX_SHARE_RATIO:.0f}x)", ratio)


def z_distance(live_mean: Column, ref_mean: Column, ref_std: Column) -> Column:
    """Live mean in reference deviations; 0 where the deviation is not above 0."""
    return F.when(ref_std > 0, F.try_divide(live_mean - ref_mean, ref_std)).otherwise(0.0)


def continuous_drift(live: DataFrame, reference: DataFrame, fields: Sequence[str] = tuple(vocab.CONTINUOUS_FIELDS)) -> DataFrame:
    """Mean shift per field that both sides have; ALERT strictly beyond the threshold."""
    fields = [f for f in fields if f in live.columns]
    both = reference.join(F.broadcast(field_means(live, fields)), "field")
    z = z_distance(F.col("mean"), F.col("ref_mean"), F.col("ref_std"))
    return both.withColumn("z", z).select(
        F.concat(F.lit("feature mean: "), "field").alias("check"),
        F.round("mean", 3).alias("live_value"),
        F.round("ref_mean", 3).alias("reference_value"),
        F.format_string(f"z=%+.2f (threshold |z|>{vocab.MAX_ABS_Z})", "z").alias("detail"),
        _status(F.abs("z") > vocab.MAX_ABS_Z).alias("status"),
    )


def category_drift(live: DataFrame, shares: DataFrame, category: str = "weather_main") -> DataFrame:
    """Over-represented and unseen categories; under-representation passes."""
    seen = value_shares(live, category).select(F.col(category).alias("category"), "share")
    both = seen.join(shares, "category", "left").withColumn("ref_share", F.coalesce("ref_share", F.lit(0.0)))
    ratio = F.try_divide(F.col("share"), F.col("ref_share"))
    unseen = F.col("ref_share") == 0
    return both.select(
        F.concat(F.lit(f"{category} share: "), "category").alias("check"),
        F.round("share", 3).alias("live_value"),
        F.round("ref_share", 3).alias("reference_value"),
        F.when(unseen, "category never seen in training data").otherwise(_ratio_text(ratio)).alias("detail"),
        _status(unseen | (ratio > vocab.MAX_SHARE_RATIO)).alias("status"),
    )


def rate_drift(live: DataFrame, holiday_rate: DataFrame, c: str = "is_holiday") -> DataFrame:
    """Share of holiday requests, with its own rule where training had none."""
    ref = F.col("ref")
    rates = live.agg(F.avg(flag(F.col(c).cast("boolean"))).alias("live"))
    rates = rates.withColumn("ref", holiday_rate.select("holiday_rate").scalar())
    ratio = F.try_divide(F.col("live"), ref)
    some = F.col("live") > 0
    nothing = F.when(some, "holiday requests never seen in training data").otherwise("no holidays either side")
    return rates.select(
        F.lit(f"{c} rate").alias("check"),
        F.round("live", 3).alias("live_value"),
        F.round("ref", 3).alias("reference_value"),
        F.when(ref == 0, nothing).otherwise(_ratio_text(ratio)).alias("detail"),
        _status(F.when(ref == 0, some).otherwise(ratio > vocab.MAX_SHARE_RATIO)).alias("status"),
    )


def known_outcomes(
    live: DataFrame, observed: DataFrame, asked: str = "input_date_time", ts: str = "date_time"
) -> DataFrame:
    """Logged requests whose time has been observed."""
    return live.join(observed.select(F.col(ts).alias(asked)).distinct(), asked, "left_semi")


def with_truth(
    live: DataFrame, observed: DataFrame, asked: str = "input_date_time", ts: str = "date_time",
    volume: str = "traffic_volume",
) -> DataFrame:
    """Logged requests with the observed volume, null where there is none yet."""
    truth = observed.select(F.col(ts).alias(asked), F.col(volume).cast("double").alias("actual_volume"))
    return hot_left_join(live, truth, [asked])


def error_drift(
    live: DataFrame, observed: DataFrame, baseline_mae: Column, prediction: str = "predicted_traffic_volume", **kw
) -> DataFrame:
    """Error on rows with a known outcome against the baseline; N/A without any."""
    known = F.col("actual_volume").isNotNull()
    sums = with_truth(live, observed, **kw).agg(
        F.count("*").alias("n_live"),
        F.count(F.when(known, 1)).alias("n_known"),
        F.avg(F.when(known, F.abs(F.col(prediction) - F.col("actual_volume")))).alias("mae"),
    )
    sums = sums.withColumn("base", baseline_mae)
    base = F.col("base")
    ratio = F.when(base > 0, F.try_divide(F.col("mae"), base)).otherwise(F.lit(float("inf")))
    none = F.col("n_known") == 0
    matched = F.format_string(
        f"%d of %d live requests matched; ratio=%.2fx (threshold >{vocab.MAX_ERROR_RATIO:.0f}x)", "n_known", "n_live", ratio
    )
    return sums.select(
        F.lit("prediction error (matched ground truth)").alias("check"),
        F.when(~none, F.round("mae", 2)).alias("live_value"),
        F.round("base", 2).alias("reference_value"),
        F.when(none, "N/A: no live request timestamp has a known outcome yet").otherwise(matched).alias("detail"),
        F.when(none, "N/A").otherwise(_status(ratio > vocab.MAX_ERROR_RATIO)).alias("status"),
    )


def drift_findings(live: DataFrame, reference: Reference, observed: DataFrame, baseline_mae: Column) -> DataFrame:
    """All checks in one table."""
    parts = [
        continuous_drift(live, reference.continuous),
        category_drift(live, reference.shares),
        rate_drift(live, reference.holiday),
        error_drift(live, observed, baseline_mae),
    ]
    return reduce(DataFrame.unionByName, [p.select(*FINDING_COLUMNS) for p in parts])


def overall_status(findings: DataFrame) -> DataFrame:
    """Checks, alerts and the verdict: ALERT if any check alerted (N/A is none)."""
    counts = findings.agg(
        F.count("*").alias("n_checks"), F.count(F.when(F.col("status") == "ALERT", 1)).alias("n_alerts")
    )
    return counts.withColumn("overall", F.when(F.col("n_alerts") > 0, "ALERT").otherwise("PASS"))
