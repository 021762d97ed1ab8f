"""Structured Streaming forms of scoring, logging, drift and late truth.

Every transformation takes and returns a DataFrame, so the same function runs on a
batch. Event time must be a zoned ``timestamp``: watermarks reject the zone-free type.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import vocab
from tidemark.functions.expressions import flag
from tidemark.operators.drift import z_distance
from tidemark.session import run_folder
from tidemark.sources.readers import ORDER_COLUMN
from tidemark.sources.writers import log_rows


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None,
    name_filter: str | None = None,
) -> DataFrame:
    """New files below ``path`` as a stream."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(path)


def to_files(
    df: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] | None = None, partition_by: tuple[str, ...] = ()
) -> StreamingQuery:
    """Append a stream to parquet files, exactly once per checkpoint.

    The default trigger takes what is there and ends; pass ``processingTime`` to keep running.
    """
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)


def run_to_table(df: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is available now and read back the table it wrote."""
    spark = df.sparkSession
    folder = run_folder(spark, name)
    query = to_files(df, f"{folder}/table", f"{folder}/checkpoint")
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/table")


def append_scores(scored: DataFrame, path: str, checkpoint: str, **kw) -> StreamingQuery:
    """Append scored requests to the prediction log, split by request day."""
    rows = log_rows(scored).withColumn("request_day", F.to_date("request_timestamp"))
    return to_files(rows, path, checkpoint, partition_by=("request_day",), **kw)


def _window_sums(log: DataFrame, window: str, delay: str) -> DataFrame:
    fields = vocab.CONTINUOUS_FIELDS
    return (
        log.withWatermark("request_timestamp", delay)
        .groupBy(F.window("request_timestamp", window).alias("w"), "weather_main")
        .agg(
            F.count("*").alias("n"),
            *[F.sum(F.col(f).cast("double")).alias(f"sum_{f}") for f in fields],
            *[F.count(f).alias(f"n_{f}") for f in fields],
            F.sum(flag(F.col("is_holiday"))).alias("n_holiday"),
        )
    )


def windowed_statistics(log: DataFrame, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Per tumbling window of request time and weather category: rows, field sums and holidays.

    One aggregation of sums, so the state is a few hundred bytes per window and category that
    occurs, listed or not. Rows older than the watermark are dropped.
    """
    return _window_sums(log, window, delay).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*").drop("w")


def _window_totals(stats: DataFrame, window: Sequence[str | Column]) -> DataFrame:
    """One row per window from its rows per category; the categories are kept as a list."""
    mean = lambda f: F.try_divide(F.sum(f"sum_{f}"), F.sum(f"n_{f}")).alias(f"mean_{f}")
    named = F.col("weather_main").isNotNull()
    return stats.groupBy(*window).agg(
        F.sum("n").alias("n_live"),
        F.sum(F.when(named, F.col("n"))).alias("n_weather"),
        *[mean(f) for f in vocab.CONTINUOUS_FIELDS],
        (F.sum("n_holiday") / F.sum("n")).alias("holiday_rate"),
        F.collect_list(F.when(named, F.struct("weather_main", "n"))).alias("categories"),
    )


def windowed_drift(
    stats: DataFrame, moments: Mapping[str, tuple[float, float]], shares: Mapping[str, float], holiday_rate: float
) -> DataFrame:
    """Drift findings per window: the batch rules over the table that ``windowed_statistics`` fills."""
    totals = _window_totals(stats, ["window_start", "window_end"])
    return _findings(totals, moments, shares, holiday_rate)


def drift_findings_stream(
    log: DataFrame, moments: Mapping[str, tuple[float, float]], shares: Mapping[str, float], holiday_rate: float,
    window: str = "1 day", delay: str = "1 hour",
) -> DataFrame:
    """Drift findings of every window of a stream, as rows of their own once the watermark has closed it.

    Two stateful steps in append mode: sums per window and category, and, over the windows that
    the first one closes, the totals of a window with the list of its categories. What follows
    has no state. On a batch it gives the findings of all windows.
    """
    totals = _window_totals(_window_sums(log, window, delay), [F.window("w", window).alias("whole")])
    totals = totals.select(F.col("whole.start").alias("window_start"), F.col("whole.end").alias("window_end"), "*").drop("whole")
    return _findings(totals, moments, shares, holiday_rate)


def _findings(
    totals: DataFrame, moments: Mapping[str, tuple[float, float]], shares: Mapping[str, float], holiday_rate: float
) -> DataFrame:
    """Findings of the windows in ``totals``.

    The reference is 4 moments, a share per category seen in training and a rate. A category of
    a window that training has not seen alerts by itself, as in the batch check; one without
    live rows has no finding.
    """
    window = ["window_start", "window_end"]

    def finding(name: Column, live: Column, ref: Column, measure: Column, alert: Column) -> Column:
        return F.struct(
            name.alias("check"),
            live.cast("double").alias("live_value"),
            ref.cast("double").alias("reference_value"),
            measure.cast("double").alias("measure"),
            F.when(F.coalesce(alert, F.lit(False)), "ALERT").otherwise("PASS").alias("status"),
        )

    findings = []
    for field, (ref_mean, ref_std) in moments.items():
        z = z_distance(F.col(f"mean_{field}"), F.lit(ref_mean), F.lit(ref_std))
        findings.append(finding(F.lit(f"feature mean: {field}"), F.col(f"mean_{field}"), F.lit(ref_mean), z, F.abs(z) > vocab.MAX_ABS_Z))
    rate, ref = F.col("holiday_rate"), F.lit(float(holiday_rate))
    ratio = F.try_divide(rate, ref)
    alert = (ratio > vocab.MAX_SHARE_RATIO) if holiday_rate > 0 else rate > 0
    findings.append(finding(F.lit("is_holiday rate"), rate, ref, ratio, alert))

    known = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair]) if shares else F.lit(None).cast("map<string,double>")

    def category(x: Column) -> Column:
        share = F.try_divide(x["n"].cast("double"), F.col("n_weather").cast("double"))
        ref = F.coalesce(F.try_element_at(known, x["weather_main"]), F.lit(0.0))
        ratio = F.try_divide(share, ref)
        return finding(F.concat(F.lit("weather_main share: "), x["weather_main"]), share, ref, ratio, (ref == 0) | (ratio > vocab.MAX_SHARE_RATIO))

    every = F.concat(F.array(*findings), F.transform("categories", category))
    return totals.select(*window, "n_live", F.inline(every))


def first_per_time(
    readings: DataFrame, key: str = "date_time", order: str = ORDER_COLUMN, others: Sequence[str] = (), delay: str = "1 hour"
) -> DataFrame:
    """The whole row of smallest ``order`` for each time (and ``others``), once the watermark has passed that time.

    ``key`` is the event time itself, a zoned timestamp, so its state goes when its rows may no longer come:
    ``delay`` after the latest time seen. The state is one row per open time. It is an aggregate,
    so every task reduces its rows first: a time that brings a third of a batch is one row per
    task at the shuffle. Readings without a time have no place in event time and are left out;
    ``order`` tells the rows of one time apart.
    """
    rest = [c for c in readings.columns if c not in (key, *others)]
    rows = readings.where(F.col(key).isNotNull()).withWatermark(key, delay)
    first = rows.groupBy(key, *others).agg(F.min_by(F.struct(*rest), order).alias("_row"))
    return first.select(*[F.col("_row")[c].alias(c) if c in rest else F.col(c) for c in readings.columns])


def join_late_truth(
    log: DataFrame,
    observed: DataFrame,
    horizon: str = "7 days",
    request_delay: str = "1 hour",
    truth_delay: str = "1 hour",
    salts: int | None = None,
    keep: Sequence[str] = (),
    unmatched: bool = True,
) -> DataFrame:
    """Predictions with the volume observed later, and those whose truth did not come.

    ``log`` is keyed by ``input_date_time`` with event time ``request_timestamp``,
    ``observed`` by ``date_time`` with event time ``observed_at``. A truth must arrive
    within ``horizon`` of its request, which is what lets both states be dropped: a request
    without one appears once, with null truth, when its state expires (not with ``unmatched``
    off). The requests for one hour are spread over ``salts`` parts, as many as the join has
    partitions, and the few truths copied to each, so an hour that everyone asks about is not
    one task.
    """
    salts = salts or int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("request_timestamp", "input_date_time", "predicted_traffic_volume"), F.lit(salts))
    asked = log.withWatermark("request_timestamp", request_delay).withColumn("_part", part).alias("l")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>"))
    truth = observed.withWatermark("observed_at", truth_delay).withColumn("_part", copies).alias("t")
    on = (
        (F.col("l.input_date_time") == F.col("t.date_time"))
        & (F.col("l._part") == F.col("t._part"))
        & (F.col("t.observed_at") >= F.col("l.request_timestamp"))
        & (F.col("t.observed_at") <= F.col("l.request_timestamp") + F.expr(f"interval {horizon}"))
    )
    error = F.abs(F.col("l.predicted_traffic_volume") - F.col("t.traffic_volume"))
    return asked.join(truth, on, "left_outer" if unmatched else "inner").select(
        *[F.col(f"l.{c}").alias(c) for c in keep],
        F.col("l.request_timestamp").alias("request_timestamp"),
        F.col("l.input_date_time").alias("input_date_time"),
        F.col("l.predicted_traffic_volume").alias("predicted_traffic_volume"),
        F.col("t.traffic_volume").cast("double").alias("actual_volume"),
        F.col("t.observed_at").alias("observed_at"),
        error.alias("absolute_error"),
    )
