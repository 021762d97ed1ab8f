"""Writing result tables and the append-only prediction log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import vocab


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a result table; CSV gets a header line in every part file."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def log_rows(scored: DataFrame, volume: str = "predicted_traffic_volume") -> DataFrame:
    """Rows in the layout of the prediction log, volume rounded to 2 places."""
    return scored.withColumn(volume, F.round(volume, 2)).select(*vocab.LOG_COLUMNS)


def append_log(scored: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append predictions to the log; the first call creates it.

    Parquet logs are split by request day so that monitoring reads only the days
    it looks at.
    """
    rows = log_rows(scored)
    if fmt == "parquet":
        rows = rows.withColumn("request_day", F.to_date("request_timestamp"))
        rows.write.mode("append").partitionBy("request_day").parquet(path)
    else:
        write_table(rows, path, fmt, mode="append")
