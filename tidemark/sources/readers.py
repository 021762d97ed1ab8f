"""Reading raw tables and logs, and checking what was read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import vocab
from tidemark.functions.expressions import na_to_null
from tidemark.sources import schemas

ORDER_COLUMN = "_ord"


def require_columns(df: DataFrame, expected: Sequence[str] = tuple(vocab.RAW_COLUMNS)) -> DataFrame:
    """``df`` itself, or ``ValueError`` naming the columns it lacks. No job runs."""
    missing = missing_columns(df, expected)
    if missing:
        raise ValueError(f"Missing expected columns: {missing}")
    return df


def missing_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    return [c for c in expected if c not in df.columns]


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType = schemas.RAW) -> DataFrame:
    """Scan a headed CSV into typed raw rows plus ``_ord``, their place in the files.

    Columns are found by name, extra ones are kept as text. NA spellings become null;
    a row of the wrong width or a number that is none fails the job. ``_ord`` is
    (file, block, position in block), so it is the same on every run and every retry.
    """
    try:
        text = (
            spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
        )
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            raise FileNotFoundError(path) from e
        raise
    require_columns(text, schema.names)
    kinds = {f.name: f.dataType for f in schema.fields}
    cells = [
        na_to_null(F.col(f"`{c}`")).cast(kinds.get(c, T.StringType())).alias(c) for c in text.columns
    ]
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return text.select(*cells, place.alias(ORDER_COLUMN))


def read_prediction_log(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """The prediction log with both time columns typed; no log yet gives no rows.

    A parquet log also has ``request_day``, by which its files are split.
    """
    reader = spark.read.schema(schemas.PREDICTION_LOG).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    try:
        return reader.load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in (e.getCondition() or ""):
            return spark.createDataFrame([], schemas.PREDICTION_LOG)
        raise


def distinct_view(df: DataFrame, columns: Sequence[str], name: str | None = None) -> DataFrame:
    """Distinct rows over ``columns``, optionally registered as a temp view.

    A key with two different values stays twice.
    """
    out = df.select(*columns).distinct()
    if name:
        out.createOrReplaceTempView(name)
    return out
