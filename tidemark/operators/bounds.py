"""Small tables whose size the planner knows."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import materialize


def sized(df: DataFrame, name: str = "sized") -> DataFrame:
    """``df`` as a stored table, computed once.

    The planner reads its size from the files: below ``spark.sql.autoBroadcastJoinThreshold``
    a join broadcasts it, beyond that it shuffles, and the rows are the same.
    """
    return materialize(df, name)


def small_table(spark: SparkSession, columns: dict[str, Iterable], schema: str | None = None) -> DataFrame:
    """A few fixed rows as a local relation, whose size the planner knows."""
    return spark.createDataFrame(pa.table({name: list(cells) for name, cells in columns.items()}), schema)
