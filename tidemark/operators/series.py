"""Steps, gaps and lookback windows of an hourly series.

A window over a whole series is one task per series. Here a series is cut into blocks
of fixed length in time; what crosses a block border is carried by a small table of
block ends (steps) or by copying the last few hours into the next block (lookbacks).
Every task sees one block, however long the series is. ``keys`` name the series;
the input holds one row per key and timestamp (see ``first_per_key``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import vocab
from tidemark.functions.expressions import as_col, hour_number, micros_of

BLOCK_HOURS = 28 * 24
_HOUR_MICROS = 3_600_000_000


def block_of(ts: str | Column, block_hours: int = BLOCK_HOURS) -> Column:
    return F.floor(hour_number(ts) / F.lit(block_hours))


def with_previous(
    df: DataFrame, ts: str = "date_time", keys: Sequence[str] = (), block_hours: int = BLOCK_HOURS
) -> DataFrame:
    """Add ``previous``: the timestamp of the row before, null on the first one."""
    keys = list(keys)
    marked = df.where(F.col(ts).isNotNull()).withColumn("_block", block_of(ts, block_hours))
    inside = Window.partitionBy(*keys, "_block").orderBy(ts)
    ends = marked.groupBy(*keys, "_block").agg(F.max(ts).alias("_last"))
    over_blocks = Window.partitionBy(*keys).orderBy("_block")
    carried = ends.select(*keys, "_block", F.lag("_last").over(over_blocks).alias("_carried"))
    stepped = marked.withColumn("previous", F.lag(ts).over(inside))
    out = stepped.join(carried, [*keys, "_block"], "left")
    return out.withColumn("previous", F.coalesce("previous", "_carried")).drop("_block", "_carried")


def gap_steps(df: DataFrame, ts: str = "date_time", keys: Sequence[str] = (), **kw) -> DataFrame:
    """Hours between each row and the one before."""
    steps = with_previous(df.select(*keys, ts), ts, keys, **kw)
    gap = (micros_of(ts) - micros_of("previous")) / F.lit(float(_HOUR_MICROS))
    return steps.withColumn("step_hours", gap)


def gap_stats(df: DataFrame, ts: str = "date_time", keys: Sequence[str] = (), **kw) -> DataFrame:
    """Rows, one-hour steps, gaps (longer steps) and the hours missing in them."""
    step = F.col("step_hours")
    return gap_steps(df, ts, keys, **kw).groupBy(*keys).agg(
        F.count("*").alias("n_rows"),
        F.count(F.when(step == 1, 1)).alias("one_hour_steps"),
        F.count(F.when(step > 1, 1)).alias("gap_events"),
        F.coalesce(F.sum(F.when(step > 1, step - 1)), F.lit(0.0)).cast("long").alias("missing_hours"),
    )


def largest_gaps(df: DataFrame, top_n: int = 10, ts: str = "date_time", keys: Sequence[str] = (), **kw) -> DataFrame:
    """The longest gaps, the earlier one first on ties."""
    gaps = gap_steps(df, ts, keys, **kw).where("step_hours > 1")
    return gaps.orderBy(F.desc("step_hours"), ts, *keys).limit(top_n)


def _with_halo(df: DataFrame, ts: str, hours: int, block_hours: int) -> DataFrame:
    """Copy the last ``hours`` of every block into the next; ``_own`` marks originals."""
    if hours > block_hours:
        raise ValueError("a block must be at least as long as the lookback")
    block = block_of(ts, block_hours)
    late = F.pmod(hour_number(ts), F.lit(block_hours)) >= block_hours - hours
    homes = F.when(late, F.array(block, block + 1)).otherwise(F.array(block))
    out = df.where(F.col(ts).isNotNull()).select("*", F.posexplode(homes).alias("_copy", "_block"))
    return out.withColumn("_own", F.col("_copy") == 0).drop("_copy")


def _gap_free(ts: str, lookback: int, window) -> Column:
    """The row ``lookback`` places earlier is exactly that many hours earlier."""
    start = F.lag(ts, lookback).over(window)
    return F.coalesce(micros_of(ts) - micros_of(start) == lookback * _HOUR_MICROS, F.lit(False))


def lookback_windows(
    df: DataFrame,
    fields: Sequence[str] = tuple(vocab.SEQUENCE_FEATURES),
    target: str = "traffic_volume",
    lookback: int = vocab.LOOKBACK,
    ts: str = "date_time",
    keys: Sequence[str] = (),
    block_hours: int = BLOCK_HOURS,
) -> DataFrame:
    """Every row preceded by ``lookback`` gap-free hours: (keys, target_time, steps, target).

    ``steps`` is an array of structs, oldest hour first.
    """
    keys = list(keys)
    spread = _with_halo(df.select(*dict.fromkeys([*keys, ts, *fields, target])), ts, lookback, block_hours)
    order = Window.partitionBy(*keys, "_block").orderBy(ts)
    step = F.struct(*[F.col(f).cast("double").alias(f) for f in fields])
    windows = spread.select(
        *keys,
        F.col(ts).alias("target_time"),
        F.collect_list(step).over(order.rowsBetween(-lookback, -1)).alias("steps"),
        F.col(target).cast("double").alias("target"),
        (F.col("_own") & _gap_free(ts, lookback, order)).alias("_valid"),
    )
    return windows.where("_valid").drop("_valid")


def window_counts(
    df: DataFrame,
    lookbacks: Sequence[int] = (6, 12, 24),
    ts: str = "date_time",
    keys: Sequence[str] = (),
    block_hours: int = BLOCK_HOURS,
) -> DataFrame:
    """Candidate and valid windows for several lookbacks, from one pass."""
    keys = list(keys)
    spread = _with_halo(df.select(*keys, ts), ts, max(lookbacks), block_hours)
    order = Window.partitionBy(*keys, "_block").orderBy(ts)
    marked = spread.select(*keys, "_own", *[_gap_free(ts, n, order).alias(f"v{n}") for n in lookbacks]).where("_own")
    counts = F.array(
        *[
            F.struct(
                F.lit(n).alias("lookback"),
                F.greatest(F.count("*") - n, F.lit(0)).alias("candidates"),
                F.count(F.when(F.col(f"v{n}"), 1)).alias("valid"),
            )
            for n in lookbacks
        ]
    )
    return marked.groupBy(*keys).agg(counts.alias("c")).select(*keys, F.explode("c").alias("c")).select(*keys, "c.*")


def steps_long(windows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per window and step."""
    exploded = windows.select(*keys, "target_time", "target", F.posexplode("steps").alias("step", "s"))
    return exploded.select(*keys, "target_time", "target", "step", "s.*")


def scale_windows(windows: DataFrame, scales: dict[str, tuple[Column, Column]], target: str = "traffic_volume") -> DataFrame:
    """Standardise the named fields of every step, and the target by its own field's scale."""
    names = windows.schema["steps"].dataType.elementType.names
    # Scalar subqueries may not stand inside a lambda, so the moments become columns first.
    out = windows.withColumns(
        {f"_{n}_{part}": c for n, pair in scales.items() for part, c in zip(("mean", "std"), pair)}
    )

    def standard(value: Column, n: str) -> Column:
        return F.try_divide(value - F.col(f"_{n}_mean"), F.col(f"_{n}_std"))

    def scaled(step: Column) -> Column:
        return F.struct(*[(standard(step[n], n) if n in scales else step[n]).alias(n) for n in names])

    out = out.withColumns({"steps": F.transform("steps", scaled), "target": standard(F.col("target"), target)})
    return out.select(*windows.columns)


def unscale(c: str | Column, mean: Column, std: Column) -> Column:
    """Back to the original unit."""
    return as_col(c) * std + mean


def flat_steps(steps: str | Column, names: Sequence[str]) -> Column:
    """All fields of all steps as one array of numbers, oldest hour first."""
    return F.flatten(F.transform(as_col(steps), lambda s: F.array(*[s[n] for n in names])))
