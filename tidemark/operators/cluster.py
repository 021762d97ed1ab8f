"""K-means clustering and cluster profiles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import vocab
from tidemark.functions.expressions import nearest_point
from tidemark.operators.features import standardise
from tidemark.operators.metrics import hashed_sample, silhouette
from tidemark.operators.models import spread
from tidemark.session import materialize, ship_code


def standardise_population(df: DataFrame, columns: Sequence[str] = tuple(vocab.CLUSTER_FEATURES)) -> DataFrame:
    """Centre and divide by the population deviation (``<c>_std`` columns)."""
    return standardise(df, columns, suffix="_std", population=True)


def with_cluster_vector(df: DataFrame, columns: Sequence[str] = tuple(vocab.CLUSTER_FEATURES)) -> DataFrame:
    cells = [F.col(f"{c}_std").cast("double") for c in columns]
    return df.withColumn("scaled", F.array(*cells)).withColumn("features", array_to_vector("scaled"))


#: Distinct vectors (those of smallest hash) from which the first centres are drawn, and rounds at most.
START_ROWS = 2_000
ROUNDS = 300
#: A fit is done when no centre moves further than this.
TOLERANCE = 1e-4


@dataclass(frozen=True)
class Clustering:
    """Centres of one fit and its cost, the sum of squared distances of all rows."""

    centres: np.ndarray
    cost: float

    def transform(self, df: DataFrame, scaled: str = "scaled", out: str = "prediction") -> DataFrame:
        """Number of the nearest centre, the first of equal ones; null without a vector."""
        far = [
            F.aggregate(F.zip_with(scaled, F.array(*[F.lit(float(x)) for x in c]), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)
            for c in self.centres
        ]
        far = F.array(*far)
        return df.withColumn(out, (F.array_position(far, F.array_min(far)) - 1).cast("int"))


def _starts(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++: each next centre is drawn by squared distance to the nearest one so far."""
    draw = np.random.default_rng(seed)
    chosen = [points[draw.integers(len(points))]]
    far = ((points - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < min(k, len(points)):
        share = far / far.sum() if far.sum() > 0 else np.full(len(points), 1 / len(points))
        chosen.append(points[draw.choice(len(points), p=share)])
        far = np.minimum(far, ((points - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vectors of a batch as one block of bytes, component by component, and their number."""
    for batch in batches:
        rows = batch.column(0).drop_null()
        if len(rows):
            x = rows.flatten().to_numpy().reshape(len(rows), -1)
            yield pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int32()), pa.array([x.T.astype("<f8").tobytes()], pa.binary())], ["n", "block"])


def _nearest(x: np.ndarray, squares: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Number of the nearest centre, the first of equal ones, for each column of ``x``, whose squared length is given."""
    far = (2 * centres) @ x
    np.subtract(squares, far, out=far)
    far += (centres * centres).sum(axis=1)[:, None]
    near, best = np.zeros(x.shape[1], dtype=np.intp), far[0]
    for j in range(1, len(centres)):
        np.copyto(near, j, where=far[j] < best)
        np.minimum(best, far[j], out=best)
    return near


def _sums(shared, costs: bool):
    """Per task one row for each fit and cluster: rows and component sums of the rows nearest to it, or rows and cost."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits = shared.value
        totals = {f: np.zeros((2 if costs else 1 + c.shape[1], len(c))) for f, c in fits.items()}
        for batch in batches:
            for n, block in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.frombuffer(block.as_buffer(), "<f8").reshape(-1, n)
                squares = (x * x).sum(axis=0)
                for f, centres in fits.items():
                    near = _nearest(x, squares, centres)
                    cells = [((x - centres.T[:, near]) ** 2).sum(axis=0)] if costs else x
                    totals[f][0] += np.bincount(near, minlength=len(centres))
                    for t, c in zip(totals[f][1:], cells):
                        t += np.bincount(near, weights=c, minlength=len(centres))
        for f, t in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([f] * t.shape[1], pa.int32()), pa.array(range(t.shape[1]), pa.int32()), pa.array(t.T.tolist(), pa.list_(pa.float64()))],
                ["fit", "cluster", "cells"],
            )

    return task


def _pass(blocks: DataFrame, centres: dict[int, np.ndarray], costs: bool = False) -> dict[tuple[int, int, int], float]:
    """(fit, cluster, cell) -> sum over all rows, in one pass over the blocks."""
    shared = blocks.sparkSession.sparkContext.broadcast(centres)
    parts = blocks.mapInArrow(_sums(shared, costs), "fit int, cluster int, cells array<double>").select("fit", "cluster", F.posexplode("cells").alias("i", "x"))
    found = {(r.fit, r.cluster, r.i): r.s for r in parts.groupBy("fit", "cluster", "i").agg(F.sum("x").alias("s")).collect()}
    shared.destroy()
    return found


def fit_many(vectors: DataFrame, wanted: Sequence[tuple[int, int]], scaled: str = "scaled") -> list[Clustering]:
    """One fit per (k, seed), all in the same passes; ``vectors`` should be stored.

    A round is one pass over the rows for every fit that still moves, whatever their number: tasks send
    a row of sums per fit and cluster, and these alone reach the driver. The vectors are kept as blocks of bytes for
    the rounds, and the costs of the last centres come from one more pass. First centres are drawn
    by k-means++ from at most ``START_ROWS`` distinct vectors; rounds and costs cover all rows.
    A centre that loses all its rows stays. Null vectors are left out; no vectors, no fits.
    """
    spark = vectors.sparkSession
    ship_code(spark)
    rows = vectors.select(scaled).where(F.col(scaled).isNotNull())
    sample = rows.distinct().orderBy(F.xxhash64(scaled), scaled).limit(START_ROWS).collect()
    if not sample:
        return []
    points = np.array([r[0] for r in sample], dtype=float)
    centres = {f: _starts(points, k, seed) for f, (k, seed) in enumerate(wanted)}
    moving = set(centres)
    blocks = spread(rows).mapInArrow(_packed, "n int, block binary").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for _ in range(ROUNDS):
            if not moving:
                break
            found = _pass(blocks, {f: centres[f] for f in moving})
            for f in sorted(moving):
                old = centres[f]
                n = np.array([found[f, j, 0] for j in range(len(old))])
                sums = np.array([[found[f, j, 1 + d] for d in range(old.shape[1])] for j in range(len(old))])
                new = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], old)
                # Centres that have come to rest are the ones their last rows were summed for.
                if np.sqrt(((new - old) ** 2).sum(axis=1)).max() <= TOLERANCE:
                    moving.discard(f)
                else:
                    centres[f] = new
        found = _pass(blocks, centres, costs=True)
    finally:
        blocks.unpersist()
    return [Clustering(c, float(sum(found[f, j, 1] for j in range(len(c))))) for f, c in sorted(centres.items())]


def fit_kmeans(vectors: DataFrame, k: int = vocab.CLUSTER_COUNT, restarts: int = vocab.CLUSTER_RESTARTS) -> Clustering:
    """The fit with the lowest cost of several starts, all fitted in the same passes."""
    return min(fit_many(vectors, [(k, vocab.SEED + i) for i in range(restarts)]), key=lambda c: c.cost)


def sweep_clusters(
    df: DataFrame,
    key: str,
    ks: Sequence[int] = tuple(vocab.CLUSTER_SWEEP),
    restarts: int = vocab.CLUSTER_RESTARTS,
    sample_size: int = vocab.SILHOUETTE_SAMPLE,
) -> DataFrame:
    """(k, inertia, silhouette) over a range of cluster counts; ``df`` has ``key`` and ``scaled`` (array).

    All counts and starts are fitted in the same passes, and the silhouettes share one sample.
    """
    rows = df.select(key, "scaled")
    wanted = [(k, vocab.SEED + i) for k in ks for i in range(restarts)]
    fits = fit_many(rows, wanted)
    sample = materialize(hashed_sample(rows.where("scaled IS NOT NULL"), key, sample_size), "silhouette-sample")
    out = []
    for k in ks:
        best = min((f for f, (n, _) in zip(fits, wanted) if n == k), key=lambda c: c.cost)
        score = silhouette(best.transform(sample), key, "scaled", "prediction", sample_size=sample_size).first()["silhouette"]
        out.append((k, best.cost, score))
    return df.sparkSession.createDataFrame(out, "k int, inertia double, silhouette double")


def assign_centres(df: DataFrame, columns: Sequence[str], centres: Sequence[Sequence[float]], out: str = "cluster") -> DataFrame:
    """Nearest of a few fixed centres, as an expression."""
    return df.withColumn(out, nearest_point(columns, centres))


def most_common(df: DataFrame, by: str, c: str) -> DataFrame:
    """(by, c): the most frequent value per group, the smallest on ties.

    Counted per (group, value) first, so only distinct values reach the group.
    """
    counts = df.where(F.col(c).isNotNull()).groupBy(by, c).agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col(c).alias("v"))).alias("b")
    return counts.groupBy(by).agg(best).select(by, F.col("b.v").alias(c))


def cluster_profile(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Size, means, most common weather and share of all rows per cluster."""
    sums = df.groupBy(cluster).agg(
        F.count("*").alias("n_rows"),
        F.avg("hour").alias("avg_hour"),
        F.avg("weather_severity").alias("avg_weather_severity"),
        F.avg("is_weekend").alias("pct_weekend"),
        F.avg("traffic_volume").alias("avg_traffic_volume"),
    )
    total = sums.agg(F.sum("n_rows").alias("n")).scalar()
    common = most_common(df, cluster, "weather_main").withColumnRenamed("weather_main", "most_common_weather")
    return sums.join(common, cluster, "left").select(
        cluster, "n_rows", "avg_hour", "avg_weather_severity", "most_common_weather", "pct_weekend",
        "avg_traffic_volume", F.round(F.col("n_rows") * 100.0 / total, 2).alias("pct_of_data"),
    )
