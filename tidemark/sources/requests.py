"""Checking scoring requests before they reach a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import vocab
from tidemark.functions.expressions import as_col, parse_timestamp
from tidemark.sources import schemas

_DEFAULTS = {"rain_1h": 0.0, "snow_1h": 0.0, "clouds_all": 0.0, "is_holiday": False}


def requests_from_json(df: DataFrame, column: str) -> DataFrame:
    """Typed request columns from JSON text; a field of the wrong type becomes null
    and its original text is kept in ``given`` for the check below."""
    shape = T.StructType([T.StructField(f.name, T.StringType()) for f in schemas.REQUEST.fields])
    given = df.withColumn("given", F.from_json(as_col(column), shape))
    typed = []
    for f in schemas.REQUEST.fields:
        cell = F.col("given")[f.name]
        typed.append((parse_timestamp(cell) if f.name == "date_time" else cell.try_cast(f.dataType)).alias(f.name))
    return given.select("*", *typed)


def _reasons() -> Column:
    c = F.col
    rules = [
        (c("date_time").isNull(), "date_time: missing or not a timestamp"),
        (c("weather_main").isNull() | ~c("weather_main").isin(*vocab.WEATHER), "weather_main: not a known category"),
        (c("temp").isNull() | F.isnan("temp"), "temp: missing or not a number"),
        ((c("rain_1h") < 0) | F.isnan("rain_1h"), "rain_1h: below 0"),
        ((c("snow_1h") < 0) | F.isnan("snow_1h"), "snow_1h: below 0"),
        ((c("clouds_all") < 0) | (c("clouds_all") > 100) | F.isnan("clouds_all"), "clouds_all: outside 0 to 100"),
    ]
    return F.array_compact(F.array(*[F.when(bad, F.lit(text)) for bad, text in rules]))


def _untyped() -> Column:
    """Optional fields that were given but could not be read as their type."""
    return F.array_compact(
        F.array(
            *[
                F.when(F.col("given")[name].isNotNull() & F.col(name).isNull(), F.lit(f"{name}: wrong type"))
                for name in _DEFAULTS
            ]
        )
    )


def check_requests(df: DataFrame) -> DataFrame:
    """Add ``reasons`` (empty for an acceptable request) and fill the defaults."""
    reasons = _reasons()
    if "given" in df.columns:
        reasons = F.concat(reasons, _untyped())
    out = df.withColumn("reasons", reasons)
    for name, value in _DEFAULTS.items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return out.withColumn("accepted", F.size("reasons") == 0)


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where("accepted").drop("accepted", "reasons", "given")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where("not accepted")
