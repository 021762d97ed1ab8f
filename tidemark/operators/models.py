"""Supervised models on the feature table."""

from __future__ import annotations

import re
import time
from collections.abc import Mapping, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import vocab
from tidemark.operators import forest as whole_trees
from tidemark.operators.features import request_features
from tidemark.operators.metrics import class_metrics, regression_metrics, roc_auc
from tidemark.operators.series import flat_steps
from tidemark.operators.split import time_cutoff
from tidemark.session import materialize, shared_folder

_ON_DISK_TOO = StorageLevel.MEMORY_AND_DISK


#: Rows of a partition of a fit at most. A forest of 150 trees keeps some 850 bytes for each, one of a single tree 100.
ROWS_A_PART = 1_000_000


#: How much longer than with even parts a pass over large input may take before its rows are dealt again.
UNEVEN = 1.25


def spread(df: DataFrame, rows_a_part: int = ROWS_A_PART) -> DataFrame:
    """``df`` in at least as many partitions as there are cores, with at most about ``rows_a_part`` rows
    in each; one that has them is not shuffled, unless it is large and its parts do not fill the cores.

    A stored table of a few narrow columns is often read as one partition, and every pass of a
    fit would then run in one task; dealt to the cores alone, what a task keeps and reads in every pass would
    grow with the table. Parts come in multiples of the cores: 13 even ones on 12 cores take as long as 24. Rows are
    counted by partition first, in one pass that reads no more columns than the filters of ``df`` need.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    counts = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n"))
    sizes = [r.n for r in counts.collect()]
    n, most = sum(sizes), max(sizes, default=0)
    if len(sizes) >= cores and most <= rows_a_part:
        rounds = -(-sum(2 * size > most for size in sizes) // cores)
        if n <= rows_a_part or rounds * most * cores <= UNEVEN * n:
            return df
    return df.repartition(cores * max(1, -(-n // (rows_a_part * cores))))


@contextmanager
def reused(df: DataFrame):
    """Keep ``df`` for the iterations of a fit, over all cores, spilling to disk where memory ends."""
    kept = spread(df).persist(_ON_DISK_TOO)
    try:
        yield kept
    finally:
        kept.unpersist()


def assembler(columns: Sequence[str] = tuple(vocab.FEATURES)) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="error")


def balanced_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Add n / (classes * rows of the class), so every 0/1 class weighs the same."""
    y = F.col(label) == 1
    counts = df.agg(F.count(F.when(y, 1)).alias("pos"), F.count(F.when(~y, 1)).alias("neg"))
    c = counts.select(F.struct("pos", "neg").alias("c")).scalar()
    n = (c["pos"] + c["neg"]).cast("double")
    weight = F.when(y, F.try_divide(n, 2.0 * c["pos"])).otherwise(F.try_divide(n, 2.0 * c["neg"]))
    return df.withColumn(out, weight)


def fit_classifiers(
    train: DataFrame,
    label: str = "high_risk",
    columns: Sequence[str] = tuple(vocab.FEATURES),
    forest: Mapping[str, int] = vocab.FOREST,
) -> dict[str, PipelineModel]:
    """Logistic regression and random forest with balanced classes.

    The weights sum to the row count, so an L2 strength of C = 1 is 1 / n here.
    """
    weighted = balanced_weights(train, label).select(label, "weight", *columns)
    with reused(weighted) as rows:
        n = rows.count()
        shared = {"labelCol": label, "weightCol": "weight", "featuresCol": "features"}
        logistic = LogisticRegression(
            **shared, regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False, maxIter=1000
        )
        trees = RandomForestClassifier(**shared, seed=vocab.SEED, featureSubsetStrategy="sqrt", **forest)
        return {
            "Logistic Regression": Pipeline(stages=[assembler(columns), logistic]).fit(rows),
            "Random Forest": Pipeline(stages=[assembler(columns), trees]).fit(rows),
        }


def node_memory(spark: SparkSession) -> int:
    """MB of statistics that a task of a forest may hold in a pass: a quarter of the heap of a core, 256 at least.

    The nodes of a forest are split in passes over all rows, as many nodes a pass as fit.
    """
    conf, master = spark.sparkContext.getConf(), spark.sparkContext.master
    cluster = re.match(r"local-cluster\[\s*\d+\s*,\s*(\d+)", master)
    local = master.startswith("local") and not cluster
    heap = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsMb(
        conf.get("spark.driver.memory" if local else "spark.executor.memory", "1g")
    )
    cores = spark.sparkContext.defaultParallelism
    if not local:
        cores = int(conf.get("spark.executor.cores", cluster[1] if cluster else str(cores)))
    return max(256, heap // cores // 4)


#: Forests at least this deep keep the node of every row and tree instead of looking for it from the root in each pass.
DEEP = 10


#: Deep forests over more rows are grown a tree at a time in one task each (``forest.fit``), which has all
#: rows; those over at most so many by Spark ML, a level of all trees at a time, and so are those too large for a task.
SPLIT_BY_LEVEL, ROWS_A_TREE = 100_000, 3_000_000


def forest_regressor(spark: SparkSession, label: str, forest: Mapping[str, int] = vocab.FOREST) -> RandomForestRegressor:
    """Every split looks at all features, so neither the node memory nor the kept nodes change the forest."""
    deep = forest["maxDepth"] >= DEEP
    if deep and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))  # cuts the lineage of the kept nodes
    return RandomForestRegressor(
        labelCol=label, featuresCol="features", seed=vocab.SEED, featureSubsetStrategy="all",
        maxMemoryInMB=node_memory(spark), cacheNodeIds=deep, **forest
    )


def fit_regressors(
    train: DataFrame,
    label: str = "traffic_volume",
    columns: Sequence[str] = tuple(vocab.FEATURES),
    forest: Mapping[str, int] = vocab.FOREST,
    only: Sequence[str] = ("Linear Regression", "Random Forest"),
) -> dict[str, PipelineModel]:
    """Ordinary least squares and random forest, those of them that ``only`` names. The one-hot
    columns are collinear with the intercept: predictions are determined, single coefficients
    are not."""
    kinds = {
        "Linear Regression": LinearRegression(labelCol=label, featuresCol="features", regParam=0.0),
        "Random Forest": forest_regressor(train.sparkSession, label, forest),
    }
    def fitted(name: str, rows: DataFrame) -> PipelineModel:
        if name == "Random Forest" and forest["maxDepth"] >= DEEP and SPLIT_BY_LEVEL < rows.count() <= ROWS_A_TREE:
            return PipelineModel(stages=[assembler(columns), whole_trees.fit(rows, kinds[name], columns)])
        return Pipeline(stages=[assembler(columns), kinds[name]]).fit(rows)

    with reused(train.select(label, *columns)) as rows:
        return {name: fitted(name, rows) for name in only}


def _stacked(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def evaluate_classifiers(models: Mapping[str, PipelineModel], test: DataFrame, label: str = "high_risk") -> DataFrame:
    """Accuracy, precision, recall, F1 and ROC AUC per model; each scores the test set once."""
    parts = []
    for name, model in models.items():
        scored = model.transform(test).select(
            F.col(label).alias("label"), "prediction", vector_to_array("probability")[1].alias("score")
        )
        scored = materialize(scored, "scored")
        auc = roc_auc(scored).scalar()
        parts.append(class_metrics(scored).select(F.lit(name).alias("model"), "*", auc.alias("roc_auc")))
    return _stacked(parts)


def evaluate_regressors(models: Mapping[str, PipelineModel], test: DataFrame, label: str = "traffic_volume") -> DataFrame:
    """MAE and R2 per model."""
    return _stacked(
        [
            regression_metrics(model.transform(test), label).select(F.lit(name).alias("model"), "mae", "r2")
            for name, model in models.items()
        ]
    )


def baseline_mae(model: PipelineModel, test: DataFrame, label: str = "traffic_volume") -> Column:
    """Held-out error of the model in production, as a scalar for the drift check."""
    return regression_metrics(model.transform(test), label).select("mae").scalar()


def importances(
    spark: SparkSession, model: PipelineModel, columns: Sequence[str] = tuple(vocab.FEATURES), top_n: int | None = 8
) -> DataFrame:
    """Features by importance, highest first."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = spark.createDataFrame(list(zip(columns, values, strict=True)), "feature string, importance double")
    ranked = rows.orderBy(F.desc("importance"), "feature")
    return ranked.limit(top_n) if top_n else ranked


def save_models(models: Mapping[str, PipelineModel], folder: str) -> dict[str, str]:
    """Save each pipeline below ``folder``; returns name -> path."""
    paths = {}
    for name, model in models.items():
        paths[name] = f"{folder}/{name.lower().replace(' ', '_')}"
        model.write().overwrite().save(paths[name])
    return paths


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a saved directory, through the file system it lives on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def compare_versions(
    train: DataFrame,
    test: DataFrame,
    folder: str,
    label: str = "traffic_volume",
    columns: Sequence[str] = tuple(vocab.FEATURES),
    versions: Mapping[str, Mapping[str, int]] = vocab.FOREST_VERSIONS,
) -> DataFrame:
    """Fit each parameter set and compare: saved size, training time, MAE, R2."""
    spark = train.sparkSession
    rows = []
    with reused(train.select(label, *columns)) as fitting:
        fitting.count()
        for name, params in versions.items():
            started = time.monotonic()
            model = Pipeline(stages=[assembler(columns), forest_regressor(spark, label, params)]).fit(fitting)
            seconds = time.monotonic() - started
            path = save_models({name: model}, folder)[name]
            quality = regression_metrics(model.transform(test), label).first()
            size = stored_bytes(spark, path) / 1e6
            rows.append(
                (name, params["numTrees"], params["maxDepth"], params["minInstancesPerNode"], size, seconds,
                 quality["mae"], quality["r2"], path)
            )
    return spark.createDataFrame(
        rows,
        "version string, num_trees int, max_depth int, min_leaf int, size_mb double, train_seconds double, "
        "mae double, r2 double, path string",
    )


def score_requests(
    requests: DataFrame, model: PipelineModel, temp_mean: Column, temp_std: Column, version: int
) -> DataFrame:
    """Predictions for checked requests, in log layout and with the 1-decimal response.

    Works alike on a batch and on a stream.
    """
    if "request_timestamp" not in requests.columns:
        requests = requests.withColumn("request_timestamp", F.current_timestamp())
    scored = model.transform(request_features(requests, temp_mean, temp_std))
    return scored.select(
        "request_timestamp",
        F.col("date_time").alias("input_date_time"),
        "weather_main",
        "temp",
        "rain_1h",
        "snow_1h",
        "clouds_all",
        (F.col("is_holiday") == 1).alias("is_holiday"),
        F.col("prediction").alias("predicted_traffic_volume"),
        F.lit(version).alias("model_version"),
        F.round("prediction", 1).alias("response_volume"),
    )


# --- next-hour forecaster ----------------------------------------------------
def sequence_vectors(windows: DataFrame) -> DataFrame:
    """Add the model input: every field of every step, oldest hour first."""
    fields = windows.schema["steps"].dataType.elementType.names
    return windows.withColumn("features", array_to_vector(flat_steps("steps", fields)))


def fit_forecaster(windows: DataFrame, validation_fraction: float = 0.1, **params) -> PipelineModel:
    """Boosted trees on the flattened lookback; the last part in time watches for overfitting."""
    cutoff = time_cutoff(windows, "target_time", validation_fraction)
    rows = sequence_vectors(windows).select(
        "features", "target", (F.col("target_time") >= F.lit(cutoff)).alias("is_validation")
    )
    settings = {"maxIter": 30, "maxDepth": 5, "seed": vocab.SEED, **params}
    with reused(rows) as kept:
        trees = GBTRegressor(
            labelCol="target", featuresCol="features", validationIndicatorCol="is_validation", **settings
        )
        return Pipeline(stages=[trees]).fit(kept)
