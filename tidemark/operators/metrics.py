"""Model quality from a table of labels and predictions."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import vocab
from tidemark.functions.expressions import flag, safe_ratio
from tidemark.operators.ranks import running_totals


def class_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of a 0/1 label; an empty denominator gives 0."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = df.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.sum(flag(y & p)).alias("tp"),
        F.sum(flag(~y & p)).alias("fp"),
        F.sum(flag(y & ~p)).alias("fn"),
        F.sum(flag(y == p)).alias("right"),
    )

    def part(num, den):
        return F.coalesce(safe_ratio(num, den), F.lit(0.0))

    return counts.select(
        *by,
        part("right", "n").alias("accuracy"),
        part("tp", F.col("tp") + F.col("fp")).alias("precision"),
        part("tp", F.col("tp") + F.col("fn")).alias("recall"),
        part(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", **kw) -> DataFrame:
    """Area under the ROC curve by rank sums, ties counting half. Exact at any size:
    rows are grouped by score and ranked slice by slice. Rows without a score (null or NaN)
    are left out. Null without both classes."""
    y = F.col(label) == 1
    totals = running_totals(
        df.where(F.col(score).isNotNull() & ~F.isnan(score)), score, {"pos": flag(y).cast("long"), "neg": flag(~y).cast("long")}, **kw
    )
    pairs = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0))
    all_pairs = F.max(F.col("pos_total").cast("double") * F.col("neg_total"))
    return totals.agg(F.try_divide(pairs.cast("double"), all_pairs).alias("roc_auc"))


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """MAE and R2 = 1 - SSE / SST (not the squared correlation), in one pass."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    both = df.where(y.isNotNull() & p.isNotNull())
    sums = both.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.sum((y - p) * (y - p)).alias("sse"),
        (F.var_pop(y) * F.count("*")).alias("sst"),
    )
    return sums.select(*by, "n", "mae", (F.lit(1.0) - F.try_divide(F.col("sse"), F.col("sst"))).alias("r2"))


# --- silhouette --------------------------------------------------------------
def hashed_sample(df: DataFrame, key: str, size: int) -> DataFrame:
    """The ``size`` rows with the lowest hash of their key: the same ones on every run.

    An order with a limit: each task keeps its own lowest ones, and only those meet.
    """
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(size)


def silhouette_scores(
    df: DataFrame, key: str, features: str, cluster: str, sample_size: int = vocab.SILHOUETTE_SAMPLE
) -> DataFrame:
    """Euclidean silhouette of each point of a fixed-size sample, against that sample.

    The sample is the feature: its size is a parameter, so the matrix sent to the tasks
    has a known bound. The points are spread over tasks and measured in batches; no pair
    of points becomes a row.
    """
    spark = df.sparkSession
    points = df.select(F.col(key).alias("key"), F.col(features).alias("x"), F.col(cluster).cast("int").alias("cluster"))
    sample = hashed_sample(points, "key", sample_size)
    rows = sample.collect()
    if not rows:
        return spark.createDataFrame([], f"{key} string, {cluster} int, silhouette double")
    matrix = np.asarray([r["x"] for r in rows], dtype=float)
    labels = np.asarray([r["cluster"] for r in rows])
    centre = matrix.mean(axis=0)
    shared = spark.sparkContext.broadcast((matrix - centre, labels, centre))
    shared_keys = spark.sparkContext.broadcast(np.asarray([r["key"] for r in rows]))

    def score(batches):
        all_points, owner, middle = shared.value
        names, member = np.unique(owner, return_inverse=True)
        sizes = np.bincount(member)
        one_hot = np.eye(len(names))[member]
        lengths = (all_points * all_points).sum(axis=1)
        for batch in batches:
            x = np.asarray(batch["x"].tolist(), dtype=float) - middle
            squares = (x * x).sum(axis=1)[:, None] + lengths - 2 * (x @ all_points.T)
            # A point's distance to itself is 0; rounding may leave a little below or above.
            same = batch["key"].to_numpy()[:, None] == shared_keys.value
            sums = np.sqrt(np.where(same, 0.0, np.maximum(squares, 0.0))) @ one_hot
            own = np.searchsorted(names, batch["cluster"].to_numpy())
            at = np.arange(len(batch))
            others = sizes[own] - 1
            inner = np.divide(sums[at, own], others, out=np.zeros(len(batch)), where=others > 0)
            means = sums / sizes
            means[at, own] = np.inf
            outer = means.min(axis=1)
            top = np.maximum(inner, outer)
            value = np.where((others > 0) & np.isfinite(outer) & (top > 0), (outer - inner) / np.where(top > 0, top, 1), 0.0)
            yield pd.DataFrame({"key": batch["key"], "cluster": batch["cluster"], "silhouette": value})

    kind = points.schema["key"].dataType.simpleString()
    local = spark.createDataFrame(rows, sample.schema).repartition("key")
    out = local.mapInPandas(score, f"key {kind}, cluster int, silhouette double")
    return out.withColumnsRenamed({"key": key, "cluster": cluster})


def silhouette(df: DataFrame, key: str, features: str, cluster: str, **kw) -> DataFrame:
    """Mean silhouette, one row."""
    return silhouette_scores(df, key, features, cluster, **kw).agg(F.avg("silhouette").alias("silhouette"))
