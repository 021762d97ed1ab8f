"""Nearest-reading lookups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expressions import micros_of
from tidemark.operators.bounds import sized
from tidemark.operators.joins import hot_left_join
from tidemark.operators.ranks import slice_edges, with_slice
from tidemark.session import materialize

FIELDS = ("traffic_volume", "weather_main", "weather_description", "temp")


def nearest_times(
    requests: DataFrame, observed: DataFrame, requested: str, ts: str, fields: Sequence[str] = (), slices: int | None = None
) -> DataFrame:
    """(requested, nearest, *fields) for each distinct requested time; the earlier time wins a tie.

    Requested and observed times are merged inside slices of time that hold about equally
    many readings, so each task orders one slice, also where a burst holds a third of them.
    Times beyond a slice's border come from a table of slice ends. Requests are made
    distinct first: a time asked for by a third of all requests is one point. A reading's
    fields travel with its time, so the nearest time, which many requests may share, is never
    a join key. ``observed`` holds one row per timestamp.
    """
    reading = F.struct(F.col(ts).alias("t"), *fields)
    observed_at = observed.where(F.col(ts).isNotNull()).select(F.col(ts).alias("t"), reading.alias("seen"))
    asked = requests.where(F.col(requested).isNotNull()).select(F.col(requested).alias("t")).distinct()
    points = observed_at.unionByName(asked, allowMissingColumns=True)
    # Microseconds of any year up to 2255 are whole numbers a double holds exactly.
    points = materialize(points.withColumn("at", micros_of("t").cast("double")), "points")
    points = with_slice(points, "at", slice_edges(points, "at", slices), "_block")

    when = F.col("seen")["t"]
    ends = points.groupBy("_block").agg(F.min_by("seen", when).alias("low"), F.max_by("seen", when).alias("high"))
    up = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(
        "_block",
        F.last("high", ignorenulls=True).over(up).alias("earlier"),
        F.last("low", ignorenulls=True).over(down).alias("later"),
    )
    forward = Window.partitionBy("_block").orderBy("t", when.asc_nulls_last())
    backward = Window.partitionBy("_block").orderBy(F.desc("t"), when.desc_nulls_last())
    so_far = (Window.unboundedPreceding, 0)
    placed = points.select(
        "_block",
        "t",
        "seen",
        F.last("seen", ignorenulls=True).over(forward.rowsBetween(*so_far)).alias("before"),
        F.last("seen", ignorenulls=True).over(backward.rowsBetween(*so_far)).alias("after"),
    ).where("seen is null")
    placed = placed.join(sized(ends, "slice-ends"), "_block").select(
        "t", F.coalesce("before", "earlier").alias("before"), F.coalesce("after", "later").alias("after")
    )
    back, ahead = micros_of("t") - micros_of("before.t"), micros_of("after.t") - micros_of("t")
    take_before = F.col("after").isNull() | (back <= ahead)
    nearest = F.when(F.col("before").isNotNull() & take_before, F.col("before")).otherwise(F.col("after"))
    found = placed.select(F.col("t").alias(requested), nearest.alias("r")).where("r is not null")
    return found.select(requested, F.col("r.t").alias("nearest"), *[F.col("r")[f].alias(f) for f in fields])


def nearest_readings(
    requests: DataFrame,
    observed: DataFrame,
    requested: str = "requested_date_time",
    ts: str = "date_time",
    fields: Sequence[str] = FIELDS,
    **kw,
) -> DataFrame:
    """Each request with its nearest reading and whether the time matched exactly.

    ``observed`` holds one row per timestamp. A request without a time keeps its row. Times that
    many requests share are measured, and their readings go to the requests.
    """
    readings = sized(nearest_times(requests, observed, requested, ts, fields, **kw), "nearest")
    out = hot_left_join(requests, readings, [requested])
    return out.select(
        *requests.columns,
        F.col("nearest").alias("nearest_available"),
        *[F.col(f).alias("temp_kelvin" if f == "temp" else f) for f in fields],
        (F.col("nearest") == F.col(requested)).alias("exact_match"),
    )


def reading_at(df: DataFrame, when: str | datetime, ts: str = "date_time", fields: Sequence[str] = FIELDS) -> DataFrame:
    """The reading at or nearest to one time, as one row. Text that is no time raises ``ValueError``."""
    moment = when if isinstance(when, datetime) else datetime.fromisoformat(when.strip())
    target = F.lit(moment.replace(tzinfo=None)).cast("timestamp_ntz")
    distance = F.abs(micros_of(ts) - micros_of(target))
    best = F.min_by(F.struct(ts, *fields), F.struct(distance, ts)).alias("r")
    return df.where(F.col(ts).isNotNull()).agg(best).where("r is not null").select(
        target.alias("requested_date_time"),
        F.col("r")[ts].alias("nearest_available"),
        *[F.col("r")[f].alias("temp_kelvin" if f == "temp" else f) for f in fields],
        (F.col("r")[ts] == target).alias("exact_match"),
    )


def reading_exactly_at(df: DataFrame, when: datetime, ts: str = "date_time") -> DataFrame:
    """Rows at exactly one time; the literal reaches the scan."""
    return df.where(F.col(ts) == F.lit(when).cast("timestamp_ntz"))
