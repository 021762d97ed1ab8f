"""Joins whose left side may repeat one key in a large share of its rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.bounds import sized

#: A key with at least this share of the rows is hot; there are at most ``1 / HOT_SHARE`` of them.
HOT_SHARE = 0.001


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """The keys of at least ``share`` of the rows, counted exactly: at most ``1 / share`` rows, stored. Missing keys are none."""
    bound = max(2, int(df.count() * share))
    counts = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return sized(counts.where(F.col("_n") >= bound).select(*keys), "hot-keys")


def hot_left_join(left: DataFrame, right: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """A left join whose left side may have hot keys, and rows without a key.

    For a right side with few rows per key. The right rows of hot keys are few by arithmetic and
    stored, so the planner broadcasts them and the rows of hot keys are not shuffled; the rest
    is a plain join in which no key is hot; rows without a key meet nothing and are not moved. Both
    sides are read more than once: pass stored tables.
    """
    keys = list(keys)
    hot = hot_keys(left, keys, share)
    missing = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in keys])
    known, lost = left.where(~missing), left.where(missing)
    few = sized(right.join(hot, keys, "left_semi"), "hot-rows")
    busy = known.join(hot, keys, "left_semi").join(few, keys, "left")
    rest = known.join(hot, keys, "left_anti").join(right, keys, "left")
    return rest.unionByName(busy).unionByName(lost, allowMissingColumns=True)
