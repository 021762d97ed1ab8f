"""Run log and model aliases as append-only tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import schemas


def append_run(
    spark: SparkSession,
    path: str,
    run_name: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    tags: Mapping[str, str] | None = None,
    model_path: str | None = None,
    start_time: datetime | None = None,
) -> str:
    """Append one run to the log table and return its id."""
    run_id = uuid.uuid4().hex
    row = (
        run_id,
        run_name,
        start_time or datetime.now(),
        {k: v if isinstance(v, str) else json.dumps(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items()},
        dict(tags or {}),
        model_path,
    )
    spark.createDataFrame([row], schemas.RUN_LOG).coalesce(1).write.mode("append").parquet(path)
    return run_id


def log_evaluation(
    evaluation: DataFrame, path: str, params: Mapping[str, object] | None = None, tags: Mapping[str, str] | None = None
) -> None:
    """Append one run per row of an evaluation table (``model`` and metric columns)."""
    def literal_map(items: Mapping[str, object]):
        cells = [F.lit(x) for k, v in items.items() for x in (k, v if isinstance(v, str) else json.dumps(v))]
        return (F.create_map(*cells) if cells else F.create_map()).cast("map<string,string>")

    names = [c for c in evaluation.columns if c != "model"]
    metrics = F.create_map(*[x for c in names for x in (F.lit(c), F.col(c).cast("double"))])
    rows = evaluation.select(
        F.uuid().alias("run_id"),
        F.col("model").alias("run_name"),
        F.localtimestamp().alias("start_time"),
        literal_map(params or {}).alias("params"),
        metrics.alias("metrics"),
        literal_map(tags or {}).alias("tags"),
        F.lit(None).cast("string").alias("model_path"),
    )
    rows.write.mode("append").parquet(path)


def register_versions(
    versions: DataFrame, runs_path: str, aliases_path: str, model: str, production: str, registered: int = 1
) -> None:
    """Log a version comparison (see ``compare_versions``) and point ``production`` at one.

    Only that version keeps its model path; the others are logged by their numbers.
    """
    spark = versions.sparkSession
    for row in versions.collect():
        kept = row["version"] == production
        append_run(
            spark, runs_path, f"{model} {row['version']}",
            {c: row[c] for c in ("num_trees", "max_depth", "min_leaf")},
            {c: row[c] for c in ("size_mb", "train_seconds", "mae", "r2")},
            {"artifact_retained": str(kept).lower()},
            row["path"] if kept else None,
        )
        if kept:
            set_alias(spark, aliases_path, model, "production", registered, row["path"])


def compare_runs(runs: DataFrame, metrics: Sequence[str], params: Sequence[str] = ()) -> DataFrame:
    """One row per run in start order, chosen params and metrics as columns."""
    return runs.select(
        "run_id",
        "run_name",
        "start_time",
        *[F.try_element_at("params", F.lit(p)).alias(p) for p in params],
        *[F.try_element_at("metrics", F.lit(m)).alias(m) for m in metrics],
    ).orderBy("start_time", "run_id")


def set_alias(
    spark: SparkSession, path: str, model: str, alias: str, version: int, model_path: str, at: datetime | None = None
) -> None:
    """Point an alias at a version. Earlier rows stay as history."""
    row = (model, alias, version, at or datetime.now(), model_path)
    spark.createDataFrame([row], schemas.ALIAS_LOG).coalesce(1).write.mode("append").parquet(path)


def current_aliases(aliases: DataFrame) -> DataFrame:
    """The latest setting of every (model, alias)."""
    latest = F.max(F.struct("set_at", "version", "path")).alias("r")
    return aliases.groupBy("model", "alias").agg(latest).select(
        "model", "alias", "r.version", "r.set_at", "r.path"
    )


def resolve_alias(aliases: DataFrame, model: str, alias: str = "production") -> tuple[int, str]:
    """(version, path) an alias points at now, ``LookupError`` if it was never set."""
    row = current_aliases(aliases.where((F.col("model") == model) & (F.col("alias") == alias))).first()
    if row is None:
        raise LookupError(f"no alias {alias!r} for model {model!r}")
    return row["version"], row["path"]


def load_by_alias(spark: SparkSession, path: str, model: str, alias: str = "production") -> tuple[PipelineModel, int]:
    """The pipeline an alias points at, and its version."""
    version, model_path = resolve_alias(spark.read.schema(schemas.ALIAS_LOG).parquet(path), model, alias)
    return PipelineModel.load(model_path), version
