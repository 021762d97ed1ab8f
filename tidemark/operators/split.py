"""Chronological train/test split at an exact row rank."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import vocab
from tidemark.functions.expressions import micros_of
from tidemark.operators.bounds import sized

_DAY, _SECOND = 86_400_000_000, 1_000_000
_EPOCH = datetime(1970, 1, 1)


def time_cutoff(df: DataFrame, ts: str, test_fraction: float = vocab.TEST_FRACTION) -> datetime:
    """Timestamp of the row at 0-based rank ``int(n * (1 - test_fraction))`` in time order.

    Rows are never sorted: they are counted per day, then per second of the one day
    that holds the rank, then per microsecond of the one second. Every count table has
    a fixed bound (days on record, 86,400, 1,000,000) and the later passes carry a
    literal time range down to the scan.
    """
    rows = df.where(F.col(ts).isNotNull()).select(F.col(ts).alias("t"))
    rank, low = None, None
    for width in (_DAY, _SECOND, 1):
        part = rows if low is None else rows.where((F.col("t") >= F.lit(low)) & (F.col("t") < F.lit(high)))
        counts = part.groupBy(F.floor(micros_of("t") / F.lit(width)).alias("step")).agg(F.count("*").alias("n"))
        earlier = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
        placed = counts.select(
            "step",
            "n",
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"),
            F.sum("n").over(Window.partitionBy()).alias("total"),
        )
        target = F.lit(rank) if rank is not None else F.floor(F.col("total") * F.lit(1 - test_fraction))
        hit = placed.withColumn("rank", target)
        hit = hit.where((F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("n"))).first()
        if hit is None:
            raise ValueError("no row with a timestamp at the split position")
        rank = hit["rank"] - hit["start"]
        low = _EPOCH + timedelta(microseconds=hit["step"] * width)
        high = low + timedelta(microseconds=width)
    return low


def with_split(df: DataFrame, ts: str, cutoff: datetime) -> DataFrame:
    """Add ``split``: train before the cutoff, test from it on, null without a time."""
    return df.withColumn(
        "split", F.when(F.col(ts) < F.lit(cutoff), "train").when(F.col(ts) >= F.lit(cutoff), "test")
    )


def time_split(
    df: DataFrame, ts: str, test_fraction: float = vocab.TEST_FRACTION
) -> tuple[DataFrame, DataFrame, datetime]:
    """(train, test, cutoff); a row without a timestamp is in neither part."""
    cutoff = time_cutoff(df, ts, test_fraction)
    return df.where(F.col(ts) < F.lit(cutoff)), df.where(F.col(ts) >= F.lit(cutoff)), cutoff


def key_cutoffs(df: DataFrame, ts: str, keys: Sequence[str], test_fraction: float = vocab.TEST_FRACTION) -> DataFrame:
    """(keys, cutoff): for every key the timestamp of its row at 0-based rank ``int(n * (1 - test_fraction))``.

    Rows are never sorted: they are counted per key and day, and per time only in the one day of a
    key that holds the rank, so a window orders the days of a key or the times of a day. Both
    counts combine before the shuffle; the days are stored. Rows without a time count nowhere.
    """
    keys = list(keys)
    rows = df.where(F.col(ts).isNotNull()).select(*keys, F.col(ts).alias("_t"), F.floor(micros_of(ts) / F.lit(_DAY)).alias("_day"))
    over = Window.partitionBy(*keys)

    def holding(counts: DataFrame, step: str, rank: Column) -> DataFrame:
        before = F.coalesce(F.sum("_n").over(over.orderBy(step).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        placed = counts.withColumns({"_start": before, "_rank": rank})
        return placed.where((F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_start") + F.col("_n")))

    days = rows.groupBy(*keys, "_day").agg(F.count(F.lit(1)).alias("_n"))
    target = F.floor(F.sum("_n").over(over) * F.lit(1 - test_fraction))
    day = holding(days, "_day", target).select(*keys, "_day", (F.col("_rank") - F.col("_start")).alias("_place"))
    day = sized(day.withColumnsRenamed({k: f"_key_{k}" for k in keys}), "split-days")
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    day = day.withColumnRenamed("_day", "_key_day")
    times = rows.join(day, same & (F.col("_day") == F.col("_key_day")))
    times = times.groupBy(*keys, "_t").agg(F.count(F.lit(1)).alias("_n"), F.max("_place").alias("_place"))
    return holding(times, "_t", F.col("_place")).select(*keys, F.col("_t").alias("cutoff"))


def key_split(df: DataFrame, ts: str, keys: Sequence[str], test_fraction: float = vocab.TEST_FRACTION) -> DataFrame:
    """``df`` with ``split``: train before the cutoff of the row's key, test from it on, null without a time.

    ``df`` is read more than once. The cutoffs are stored, and broadcast while they are small.
    """
    cutoffs = key_cutoffs(df, ts, keys, test_fraction).withColumnsRenamed({k: f"_key_{k}" for k in keys} | {"cutoff": "_cutoff"})
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    both = df.join(sized(cutoffs, "cutoffs"), same, "left")
    split = F.when(F.col(ts) < F.col("_cutoff"), "train").when(F.col(ts) >= F.col("_cutoff"), "test")
    return both.withColumn("split", split).select(*df.columns, "split")


def split_summary(split: DataFrame, ts: str, label: str) -> DataFrame:
    """Rows, first and last time and label rate of each part."""
    return (
        split.where(F.col("split").isNotNull())
        .groupBy("split")
        .agg(
            F.count("*").alias("n_rows"),
            F.min(ts).alias("first_time"),
            F.max(ts).alias("last_time"),
            F.avg(F.col(label).cast("double")).alias("label_rate"),
        )
    )
