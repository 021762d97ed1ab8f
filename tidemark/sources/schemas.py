"""Declared table types."""

from __future__ import annotations

from pyspark.sql import types as T

_string, _double, _int = T.StringType(), T.DoubleType(), T.IntegerType()
_ntz, _bool, _long = T.TimestampNTZType(), T.BooleanType(), T.LongType()


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# Raw observations; ``date_time`` stays text until it is parsed.
RAW = _table(
    ("holiday", _string), ("temp", _double), ("rain_1h", _double), ("snow_1h", _double),
    ("clouds_all", _int), ("weather_main", _string), ("weather_description", _string),
    ("date_time", _string), ("traffic_volume", _int),
)

REQUEST = _table(
    ("date_time", _ntz), ("weather_main", _string), ("temp", _double), ("rain_1h", _double),
    ("snow_1h", _double), ("clouds_all", _double), ("is_holiday", _bool),
)

# Event time of the log is zoned: streaming watermarks need that type.
PREDICTION_LOG = _table(
    ("request_timestamp", T.TimestampType()), ("input_date_time", _ntz), ("weather_main", _string),
    ("temp", _double), ("rain_1h", _double), ("snow_1h", _double), ("clouds_all", _double),
    ("is_holiday", _bool), ("predicted_traffic_volume", _double), ("model_version", _int),
)

_numbers = T.MapType(_string, _double)
_texts = T.MapType(_string, _string)

RUN_LOG = _table(
    ("run_id", _string), ("run_name", _string), ("start_time", _ntz), ("params", _texts),
    ("metrics", _numbers), ("tags", _texts), ("model_path", _string),
)

ALIAS_LOG = _table(
    ("model", _string), ("alias", _string), ("version", _int), ("set_at", _ntz), ("path", _string),
)
