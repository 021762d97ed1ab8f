"""Distributions and descriptive statistics."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import expressions as x
from tidemark.operators.bounds import sized
from tidemark.operators.ranks import exact_quantiles, quantile_scalars


def histogram(df: DataFrame, c: str, bins: int = 40) -> DataFrame:
    """Equal-width bins from minimum to maximum, empty ones included.

    The last bin holds the maximum. Constant data gets bins around the value.
    """
    value = F.col(c).cast("double")
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    same = F.col("lo") == F.col("hi")
    ends = ends.select(
        F.when(same, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(same, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    box = ends.select(F.struct("lo", "hi").alias("e")).scalar()
    place = F.least(F.width_bucket(value, box["lo"], box["hi"], F.lit(bins)), F.lit(bins))
    counts = df.where(value.isNotNull()).groupBy(place.alias("bin")).agg(F.count("*").alias("n_rows"))
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    numbers = F.sequence(F.lit(1), F.lit(bins)).cast("array<bigint>")
    grid = ends.select("lo", width.alias("w"), F.explode(numbers).alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * F.col("w")).alias("bin_start"),
        (F.col("lo") + F.col("bin") * F.col("w")).alias("bin_end"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
    )


def centre(df: DataFrame, c: str, **kw) -> DataFrame:
    """Mean and median of a column, one row."""
    [median] = quantile_scalars(df, c, [0.5], **kw)
    return df.agg(F.avg(c).alias("mean")).withColumn("median", median)


def box_stats(df: DataFrame, category: str, c: str, **kw) -> DataFrame:
    """Quartiles and whiskers per category, highest median first.

    A whisker is the most extreme reading within 1.5 interquartile ranges.
    """
    quartiles = exact_quantiles(df, c, [0.25, 0.5, 0.75], [category], **kw).select(
        category,
        *[F.col(c)[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))],
    )
    quartiles = sized(quartiles)
    value = F.col(c).cast("double")
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = value.between(F.col("q1") - reach, F.col("q3") + reach)
    rows = df.where(value.isNotNull()).join(quartiles, category)
    # The quartiles are constant within a category, so any of them stands for it.
    return (
        rows.groupBy(category)
        .agg(
            F.count("*").alias("n_rows"),
            F.max("q1").alias("q1"),
            F.max("median").alias("median"),
            F.max("q3").alias("q3"),
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
        )
        .orderBy(F.desc("median"), category)
    )


def describe(df: DataFrame, columns: Sequence[str], **kw) -> DataFrame:
    """Count, mean, median, sample deviation, minimum and maximum per column, in one pass
    beside the medians."""
    medians = exact_quantiles(df, columns, [0.5], **kw).select(F.struct(*columns).alias("m")).scalar()
    cells = []
    for c in columns:
        value = F.col(c).cast("double")
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(value).alias("n"),
                F.avg(value).alias("mean"),
                F.stddev_samp(value).alias("std"),
                F.min(value).alias("min"),
                F.max(value).alias("max"),
            )
        )
    rows = df.agg(F.array(*cells).alias("s")).select(F.posexplode("s").alias("i", "s"))
    middle = F.array(*[medians[c][0] for c in columns])
    return rows.select(
        "s.column_name", "s.n", "s.mean", middle[F.col("i")].alias("median"), "s.std", "s.min", "s.max"
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, from one pass."""
    pairs = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.corr(a, b).alias("r"))
        for a, b in combinations(columns, 2)
    ]
    return df.agg(F.array(*pairs).alias("p")).select(F.explode("p").alias("p")).select(
        F.col("p.a").alias("column_a"), F.col("p.b").alias("column_b"), F.col("p.r").alias("correlation")
    )


def event_probabilities(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """P(A), P(B), P(A and B), P(A given B), P(B given A) of two conditions."""
    counts = df.agg(
        F.count("*").alias("n"),
        F.sum(x.flag(a)).alias("a"),
        F.sum(x.flag(b)).alias("b"),
        F.sum(x.flag(a & b)).alias("ab"),
    )
    return counts.select(
        x.safe_ratio("a", "n").alias("p_a"),
        x.safe_ratio("b", "n").alias("p_b"),
        x.safe_ratio("ab", "n").alias("p_a_and_b"),
        x.safe_ratio("ab", "b").alias("p_a_given_b"),
        x.safe_ratio("ab", "a").alias("p_b_given_a"),
    )
