"""Exact k-means on integer vectors, with bounds tightened by where a centroid moved.

Every vector carries an upper bound of the distance to its own centroid and a lower bound of the
distance to each other one. When centroids move, a lower bound must give way by the most any
vector of the cluster may have come nearer to the moved centroid. The cluster lies in a sphere, and
over a sphere that most is a question of the plane through its centre and the two places of the
centroid: usually much less than the full drift, and negative where the centroid moved away.
Vectors whose bounds leave no doubt keep their cluster unseen; the others are scanned exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import discard, run_folder, ship_code

#: Rows a task works on at a time.
ROWS = 8192
#: Components up to this size keep squared distances of a thousand dimensions within 64 bits.
LARGEST = 2**25


def loosening(centres: np.ndarray, moved: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """(i, j): the most by which a vector within ``radii[i]`` of centre i comes nearer to moved j.

    For a centroid that goes from a to b, |x - a| - |x - b| is constant on hyperbolas about a and b.
    In the plane of the axis ab and the sphere's centre, with the middle of ab as origin:
    a sphere outside the cone of half-angle w about the way to b lies outside the hyperbola that
    has this cone as its asymptote, on which the difference is |ab| cos w. A sphere within the cone
    of half-angle w about the way back, with its tip at a, lies inside the hyperbola on which the
    difference is -|ab| cos w. A sphere that holds the origin gives way by the full drift.
    """
    a, b = centres.astype(np.float64), moved.astype(np.float64)
    out = np.zeros((len(a), len(a)))
    for j in range(len(a)):
        drift = np.linalg.norm(b[j] - a[j])
        if not drift:
            continue
        axis = (b[j] - a[j]) / drift

        def angle(tip: np.ndarray, way: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            rest = a - tip
            along = rest @ way
            across = np.sqrt(np.maximum((rest**2).sum(axis=1) - along**2, 0))
            far = np.hypot(along, across)
            held = radii >= far
            return np.arctan2(across, along), np.arcsin(np.clip(radii / np.where(far > 0, far, 1), 0, 1)), held

        middle, spread, held = angle((a[j] + b[j]) / 2, axis)
        nearest = np.maximum(middle - spread, 0)
        give = np.where(held, drift, drift * np.maximum(np.cos(nearest), 0))
        back, spread, held = angle(a[j], -axis)
        widest = back + spread
        behind = ~held & (widest < np.pi / 2)
        out[:, j] = np.where(behind, -drift * np.cos(np.minimum(widest, np.pi / 2)), give)
    # Beyond any rounding of the lines above.
    return out + 1e-9 * (1 + np.abs(a).max(initial=0) + np.abs(b).max(initial=0) + radii.max(initial=0))


def _raised(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 + 1e-12)).astype(np.float32), np.float32(np.inf))


def _lowered(x: np.ndarray) -> np.ndarray:
    return np.nextafter((x * (1 - 1e-12)).astype(np.float32), np.float32(-np.inf))


def _squared(vectors: np.ndarray, centre: np.ndarray) -> np.ndarray:
    gap = vectors - centre
    return (gap * gap).sum(axis=1)


class Bounds:
    """Clusters and bounds of some vectors; ``scanned`` counts the distances that were computed."""

    def __init__(self, vectors: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray):
        self.vectors, self.cluster, self.upper, self.lower = vectors, cluster, upper, lower
        self.scanned = 0

    @classmethod
    def start(cls, vectors: np.ndarray, centres: np.ndarray) -> Bounds:
        """Every distance computed: the nearest centroid, of equal ones the first."""
        squared = np.stack([_squared(vectors, c) for c in centres], axis=1)
        cluster = squared.argmin(axis=1)
        upper = _raised(np.sqrt(squared[np.arange(len(vectors)), cluster].astype(np.float64)))
        out = cls(vectors, cluster, upper, _lowered(np.sqrt(squared.astype(np.float64))))
        out.scanned = squared.size
        return out

    def follow(self, centres: np.ndarray, drift: np.ndarray, loose: np.ndarray) -> None:
        """The same for moved centroids; ``drift`` and ``loose`` are of the clusters as they were."""
        self.upper = _raised(self.upper.astype(np.float64) + drift[self.cluster])
        self.lower = _lowered(np.maximum(self.lower.astype(np.float64) - loose[self.cluster], 0))
        rows = np.arange(len(self.cluster))
        others = self.lower.copy()
        others[rows, self.cluster] = np.inf
        doubt = np.flatnonzero(self.upper >= others.min(axis=1, initial=np.inf))
        if not len(doubt):
            return
        vectors, cluster = self.vectors[doubt], self.cluster[doubt]
        own = _squared(vectors, centres[cluster])
        self.upper[doubt] = _raised(np.sqrt(own.astype(np.float64)))
        open_ = self.upper[doubt, None] >= others[doubt]
        self.scanned += len(doubt) + int(open_.sum())
        best, place = own.copy(), cluster.copy()
        for j in range(len(centres)):
            at = np.flatnonzero(open_[:, j])
            squared = _squared(vectors[at], centres[j])
            self.lower[doubt[at], j] = _lowered(np.sqrt(squared.astype(np.float64)))
            nearer = (squared < best[at]) | ((squared == best[at]) & (j < place[at]))
            best[at[nearer]], place[at[nearer]] = squared[nearer], j
        gone = place != cluster
        self.lower[doubt[gone], cluster[gone]] = _lowered(np.sqrt(own[gone].astype(np.float64)))
        self.upper[doubt] = _raised(np.sqrt(best.astype(np.float64)))
        self.cluster[doubt] = place

    def distances(self, centres: np.ndarray) -> np.ndarray:
        """Squared distances to the own centroid, exact."""
        return _squared(self.vectors, centres[self.cluster])


def _usable(vector: str, dims: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) == dims) & F.coalesce(finite, F.lit(False))


def _matrix(column: pa.ListArray, dims: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), dims)


def _task(centres: np.ndarray, step: tuple[np.ndarray, np.ndarray] | None, last: bool):
    """One round over stored vectors and bounds. A task's last rows are the sums of its clusters."""
    k, dims = centres.shape

    def one(part: pa.RecordBatch) -> Bounds:
        vectors = _matrix(part.column("vector"), dims, np.int64)
        if ((vectors > LARGEST) | (vectors < -LARGEST)).any():
            raise OverflowError(f"a component beyond {LARGEST}: squared distances would not fit 64 bits")
        if step is None:
            return Bounds.start(vectors, centres)
        lower = _matrix(part.column("lower"), k, np.float32)
        found = Bounds(vectors, part.column("cluster").to_numpy().astype(np.int64), part.column("upper").to_numpy().copy(), lower)
        found.follow(centres, *step)
        return found

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, radii = np.zeros((k, 2 + dims), dtype=object), np.zeros(k)
        names = ["vec_id", "vector", "cluster", "upper", "lower", "distance", "sums", "radius"]
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                found = one(part)
                far = found.distances(centres) if last else np.zeros(len(found.cluster), dtype=np.int64)
                for j in range(k):
                    mine = found.cluster == j
                    if mine.any():
                        sums[j] += [int(mine.sum()), int(far[mine].sum()), *found.vectors[mine].sum(axis=0).tolist()]
                        radii[j] = max(radii[j], found.upper[mine].max())
                n = len(found.cluster)
                lower = pa.FixedSizeListArray.from_arrays(pa.array(found.lower.ravel()), k).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id"), part.column("vector"), pa.array(found.cluster, pa.int32()), pa.array(found.upper), lower,
                        pa.array(far), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.float64()),
                    ],
                    names,
                )
        kind = [batch.column("vec_id").type, batch.column("vector").type] if radii.any() or sums.any() else None
        if kind:
            none = [pa.nulls(k, t) for t in kind]
            yield pa.RecordBatch.from_arrays(
                [
                    *none, pa.array(range(k), pa.int32()), pa.nulls(k, pa.float32()), pa.nulls(k, pa.list_(pa.float32())),
                    pa.nulls(k, pa.int64()), pa.array(sums.tolist(), pa.list_(pa.int64())), pa.array(radii),
                ],
                names,
            )

    return task


def _figures(state: DataFrame, k: int, dims: int) -> tuple[list[list[int]], np.ndarray]:
    """Per cluster [rows, inertia, component sums...] and radius, exact; ``k`` times ``dims`` numbers reach the driver."""
    sums = [[0] * (2 + dims) for _ in range(k)]
    radii = np.zeros(k)
    parts = state.where("sums IS NOT NULL").select("cluster", "radius", F.posexplode("sums").alias("place", "part"))
    for r in parts.groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("s"), F.max("radius").alias("r")).collect():
        sums[r.cluster][r.place] = int(r.s)
        radii[r.cluster] = r.r
    return sums, radii


def cluster(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 8, rounds: int = 10, dims: int = 64,
    scale: int = 1024, seed: str = "3",
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) per vector of ``dims`` finite components.

    Components become floor(scale * x). The ``k`` first centroids are the vectors with the smallest
    sha256 of ``seed:key`` (rows without a key after all others; of equal keys the smaller vector
    first); fewer vectors give fewer centroids. A round assigns every vector to its nearest
    centroid, of equal ones the first, and puts each centroid that has vectors at the floor of their
    mean; then vectors are assigned once more. Centroids that no longer move end the rounds early,
    with the same result. ``centroid`` is the list of its components, inertias are sums of squared
    distances. All of it is exact; a component beyond 2^25 (after scaling) raises OverflowError.

    Null vectors, other lengths and null or non-finite components give no row. Rows that repeat are
    rows; other columns are not read; no rows give no rows. What passes the driver is ``k`` times
    ``dims`` sums a round. Vectors and bounds are written once a round to the shared folder, and
    the round before is removed; a lost executor costs its part of one round.
    """
    spark = vectors.sparkSession
    ship_code(spark)
    kind = dict(vectors.dtypes)[key]
    scaled = F.transform(F.col("vector"), lambda x: F.floor(x.cast("double") * scale))
    rows = vectors.select(F.col(key).alias("vec_id"), F.col(vector).alias("vector")).where(_usable("vector", dims)).withColumn("vector", scaled)
    first = rows.withColumn("_h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    start = first.orderBy(F.col("_h").asc_nulls_last(), "vector").limit(k).select("vector").collect()
    if not start:
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>")
    centres = np.array([r.vector for r in start], dtype=np.int64)
    n = len(centres)
    schema = f"vec_id {kind}, vector array<long>, cluster int, upper float, lower array<float>, distance long, sums array<long>, radius double"
    step, state, path, last = None, rows, None, rounds < 1
    for done in range(rounds + 1):
        before, path = path, run_folder(spark, "kmeans")
        state.mapInArrow(_task(centres, step, last), schema).write.parquet(path)
        state = spark.read.schema(schema).parquet(path)
        if before:
            discard(spark, before)
        sums, radii = _figures(state, n, dims)
        state = state.where("vector IS NOT NULL")
        if last:
            break
        moved = np.array([[s // c[0] for s in c[2:]] if c[0] else old.tolist() for c, old in zip(sums, centres)], dtype=np.int64)
        drift = np.linalg.norm((moved - centres).astype(np.float64), axis=1) * (1 + 1e-9)
        step, last = (drift, loosening(centres, moved, radii)), done + 1 == rounds or not drift.any()
        centres = moved
    inertias = [(j, c[1], sum(c[1] for c in sums), centres[j].tolist()) for j, c in enumerate(sums)]
    ends = spark.createDataFrame(inertias, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(ends), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )
