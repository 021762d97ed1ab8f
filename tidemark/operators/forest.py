"""Regression forests whose trees are grown whole, each in one task.

Spark ML splits all trees a level at a time: every task of a pass keeps a full table of statistics (all bins of all
features) for every open node and sends it to the shuffle. Deep nodes hold a few rows and as many statistics
as the root, so a deep forest moves many times its rows. Here rows become one byte a feature, tasks get
all of them, and a tree counts its own rows only. The trees are those of Spark ML: the
same rule for candidate splits, Poisson weights, variance, least rows of a node and depth; the weights are
another draw. The result is a Spark ML model.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize, run_folder, scratch, ship_code

#: Values of a feature that a task sums up its rows in, at most; features with fewer are counted exactly.
VALUES = 2048
#: Bytes of the trees that reach the driver at once, taken at 110 bytes a node, the largest trees possible.
WAVE_BYTES = 256_000_000
_NODE = (
    "id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, leftChild: int, rightChild: int, "
    "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>"
)
#: Params of a forest that its trees do not have.
_FOREST_ONLY = ("bootstrap", "featureSubsetStrategy", "leafCol", "numTrees", "subsamplingRate")


# --- candidate splits ----------------------------------------------------------
def counted(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, with the sums of their counts."""
    distinct, place = np.unique(values, return_inverse=True)
    return distinct, np.bincount(place, counts, len(distinct)).astype(np.int64)


def condensed(values: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` of the values, evenly spaced by rows; each counts the rows of those it stands for."""
    if len(values) <= most:
        return values, counts
    below = np.cumsum(counts)
    slot = (below - 1) * most // below[-1]
    last = np.flatnonzero(np.append(slot[1:] != slot[:-1], True))
    return values[last], np.diff(below[last], prepend=0)


def thresholds(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Spark ML's candidate splits: the middle of neighbouring values, or, where these are more than bins allow, of those at even strides by rows."""
    middle = (values[:-1] + values[1:]) / 2
    if len(middle) < bins:
        return middle
    stride = counts.sum() / bins
    out, target, below = [], stride, np.cumsum(counts)
    for i in range(1, len(values)):
        if abs(below[i - 1] - target) < abs(below[i] - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


def _matrix(batch: pa.RecordBatch, columns: int) -> np.ndarray:
    """The first ``columns`` columns as doubles, a row per column."""
    out = np.empty((columns, batch.num_rows))
    for i in range(columns):
        if batch.column(i).null_count:
            raise ValueError(f"{batch.schema.names[i]}: a fit needs every value")
        out[i] = batch.column(i).to_numpy(zero_copy_only=False)
    if np.isnan(out).any():
        raise ValueError("NaN: a fit needs every value")
    return out


def candidate_splits(rows: DataFrame, columns: Sequence[str], bins: int) -> list[np.ndarray]:
    """Thresholds per column, from every row: tasks sum up their values, the driver gets at most ``VALUES`` a task and column."""
    width = len(columns)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = (np.empty(0), np.empty(0, dtype=np.int64))
        held = [none] * width
        for batch in batches:
            for i, x in enumerate(_matrix(batch, width)):
                values, counts = held[i]
                both = counted(np.append(values, x), np.append(counts, np.ones(len(x), dtype=np.int64)))
                held[i] = condensed(*both, 2 * VALUES) if len(both[0]) > 4 * VALUES else both
        held = [condensed(*x, VALUES) for x in held]
        columns = [pa.array(range(width), pa.int32()), pa.array([x[0] for x in held], pa.list_(pa.float64())), pa.array([x[1] for x in held], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["feature", "v", "n"])

    found = rows.select(*columns).mapInArrow(task, "feature int, v array<double>, n array<bigint>").toArrow()
    parts: list[list] = [[] for _ in columns]
    for feature, v, n in zip(found["feature"].to_pylist(), found["v"], found["n"]):
        parts[feature].append((v.values.to_numpy(), n.values.to_numpy()))
    return [thresholds(*counted(*(np.concatenate(x) for x in zip(*p))), bins) for p in parts]


def blocks_of(rows: DataFrame, label: str, columns: Sequence[str], splits: list[np.ndarray]) -> DataFrame:
    """(part, seq, n, bins, y): runs of rows, with the bin of every value (bytes, feature by feature) and the labels."""
    width = len(columns)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for seq, batch in enumerate(b for b in batches if b.num_rows):
            values = _matrix(batch, width + 1)
            bins = np.array([np.searchsorted(t, x) for t, x in zip(splits, values)], dtype=np.uint8)
            cells = [part, seq, batch.num_rows, bins.tobytes(), values[width].tobytes()]
            yield pa.RecordBatch.from_pylist([dict(zip(["part", "seq", "n", "bins", "y"], cells))], schema)

    schema = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n", pa.int32()), ("bins", pa.binary()), ("y", pa.binary())])
    doubles = rows.select(*[F.col(c).cast("double") for c in (*columns, label)])
    return doubles.mapInArrow(task, "part int, seq int, n int, bins binary, y binary")


# --- one tree --------------------------------------------------------------------
def grow(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, sizes: Sequence[int], depth: int, least: int) -> dict[str, np.ndarray]:
    """A tree by variance over the rows with a weight. Nodes are numbered level by level; a leaf has feature -1.

    ``bins`` has a row per feature with bins below ``sizes``; both sides of a split weigh ``least`` or more.
    """
    rows = np.flatnonzero(weight)
    b, w = bins[:, rows], weight[rows].astype(np.float64)
    # Around their mean, sums of squares keep their digits.
    centre = float(y[rows] @ w / w.sum()) if len(rows) else 0.0
    y = y[rows] - centre
    total = w * y
    at = np.zeros(len(rows), dtype=np.int64)
    n, s, q = np.array([w.sum()]), np.array([total.sum()]), np.array([total @ y])
    tiny = 1e-12 * q[0] / max(n[0], 1.0)
    levels = [(n, s, q)]
    splits: list[tuple[np.ndarray, ...]] = []
    ids, made = np.array([0]), 1
    for _ in range(depth):
        k = len(ids)
        if not k:
            break
        best, feature, cut = np.full(k, -np.inf), np.full(k, -1), np.zeros(k, dtype=np.int64)
        for f, size in enumerate(sizes):
            if size < 2:
                continue
            cell = at * size + b[f]
            n_left = np.bincount(cell, w, k * size).reshape(k, size).cumsum(axis=1)[:, :-1]
            s_left = np.bincount(cell, total, k * size).reshape(k, size).cumsum(axis=1)[:, :-1]
            n_right = n[:, None] - n_left
            with np.errstate(divide="ignore", invalid="ignore"):
                score = s_left**2 / n_left + (s[:, None] - s_left) ** 2 / n_right
            score[(n_left < max(least, 1)) | (n_right < max(least, 1))] = -np.inf
            top = score.argmax(axis=1)
            score = score[np.arange(k), top]
            better = score > best
            best[better], feature[better], cut[better] = score[better], f, top[better]
        gain = (best - s**2 / np.maximum(n, 1.0)) / np.maximum(n, 1.0)
        split = gain > tiny
        parents = ids[split]
        if not len(parents):
            break
        k = 2 * len(parents)
        # Rows of nodes that do not split go to one more place.
        child = np.where(split, 2 * (np.cumsum(split) - 1), k)[at]
        child += (b[feature[at], np.arange(len(at))] > cut[at]) & split[at]
        n, s, q = (np.bincount(child, x, k + 1)[:k] for x in (w, total, total * y))
        levels.append((n, s, q))
        splits.append((parents, feature[split], cut[split], gain[split], made + 2 * np.arange(len(parents))))
        # Rows of nodes that did not split or are too small to split are done.
        open_ = n >= 2 * max(least, 1)
        kept = np.append(open_, False)[child]
        at = (np.cumsum(open_) - 1)[child[kept]]
        if len(at) < len(w):
            b = b[:, kept]
            w = w[kept]
            y = y[kept]
            total = total[kept]
        ids, n, s = made + np.flatnonzero(open_), n[open_], s[open_]
        made += k
    n, s, q = (np.concatenate(x) for x in zip(*levels))
    feature, cut, left = np.full(made, -1), np.zeros(made, dtype=np.int64), np.full(made, -1)
    gain = np.full(made, -1.0)
    for parents, f, c, g, first in splits:
        feature[parents], cut[parents], gain[parents], left[parents] = f, c, g, first
    whole = np.maximum(n, 1.0)
    return {
        "n": n, "sum": s + n * centre, "squares": q + 2 * centre * s + n * centre**2, "impurity": np.maximum(q / whole - (s / whole) ** 2, 0.0),
        "prediction": s / whole + centre, "gain": gain, "feature": feature, "cut": cut, "left": left,
    }


def _node_rows(number: int, tree: dict[str, np.ndarray], splits: list[np.ndarray]) -> pa.RecordBatch:
    """The nodes of a tree as Spark ML stores them."""
    made, inner = len(tree["n"]), tree["feature"] >= 0
    stats = np.column_stack([tree["n"], tree["sum"], tree["squares"]]).ravel()
    cuts = np.array([splits[f][c] for f, c in zip(tree["feature"][inner], tree["cut"][inner])], dtype=np.float64)
    ends = np.append(0, np.cumsum(inner)).astype(np.int32)
    split = pa.StructArray.from_arrays(
        [pa.array(tree["feature"], pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(cuts)), pa.array(np.full(made, -1), pa.int32())],
        ["featureIndex", "leftCategoriesOrThreshold", "numCategories"],
    )
    node = {
        "id": pa.array(np.arange(made), pa.int32()), "prediction": pa.array(tree["prediction"]), "impurity": pa.array(tree["impurity"]),
        "impurityStats": pa.ListArray.from_arrays(pa.array(np.arange(0, 3 * made + 1, 3, dtype=np.int32)), pa.array(stats)),
        "rawCount": pa.array(tree["n"].astype(np.int64)), "gain": pa.array(tree["gain"]), "leftChild": pa.array(tree["left"], pa.int32()),
        "rightChild": pa.array(np.where(inner, tree["left"] + 1, -1), pa.int32()), "split": split,
    }
    return pa.RecordBatch.from_arrays([pa.array(np.full(made, number), pa.int32()), pa.StructArray.from_arrays(list(node.values()), list(node))], ["treeID", "nodeData"])


# --- the forest --------------------------------------------------------------------
def _growing(
    splits: list[np.ndarray], starts: dict[tuple[int, int], int], total: int, groups: list[range], first: int, seed: int, depth: int, least: int,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The task that puts the blocks it gets in their order, and grows the trees of its groups over them."""
    sizes = [len(t) + 1 for t in splits]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, y, mine = np.empty((len(sizes), total), dtype=np.uint8), np.empty(total), set()
        for batch in batches:
            for i in range(batch.num_rows):
                group, part, seq, n = (batch.column(c)[i].as_py() for c in range(4))
                at = starts[part, seq]
                bins[:, at:at + n] = np.frombuffer(batch.column(4)[i].as_buffer(), dtype=np.uint8).reshape(len(sizes), n)
                y[at:at + n] = np.frombuffer(batch.column(5)[i].as_buffer(), dtype=np.float64)
                mine.add(group)
            del batch  # not kept as the trees grow
        for number in (t for group in sorted(mine) for t in groups[group]):
            weight = np.random.default_rng([seed, number]).poisson(1.0, total).astype(np.uint8)
            yield _node_rows(number - first, grow(bins, y, weight, sizes, depth, least), splits)

    return task


def _describe(spark, estimator: RandomForestRegressor, path: str, features: int, trees: int) -> None:
    """The descriptions that Spark ML reads beside the nodes of a stored forest."""
    def params(of: dict, without: tuple[str, ...] = ()) -> dict:
        return {p.name: v for p, v in of.items() if p.name not in without}

    def told(kind: str, uid: str, without: tuple[str, ...] = (), **more: int) -> str:
        sets, defaults = params(estimator._paramMap, without), params(estimator._defaultParamMap, without)
        return json.dumps({
            "class": f"org.apache.spark.ml.regression.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid,
            "paramMap": sets, "defaultParamMap": defaults, **more,
        })

    forest = told("RandomForestRegressionModel", estimator.uid, numFeatures=features, numTrees=trees)
    spark.createDataFrame([(forest,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    rows = [(i, told("DecisionTreeRegressionModel", f"{estimator.uid}_{i}", _FOREST_ONLY), 1.0) for i in range(trees)]
    spark.createDataFrame(rows, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")


def fit(rows: DataFrame, estimator: RandomForestRegressor, columns: Sequence[str]) -> RandomForestRegressionModel:
    """``estimator`` fitted to ``rows``; every task that grows trees holds all rows, at 31 bytes for 23 features and twice that as it works.

    ``rows`` is read twice. Trees are grown in waves, so that those reaching the driver at once are bounded, and all
    waves are joined in one model. Supports what ``models.forest_regressor`` sets: all features at every split, whole Poisson
    bootstrap. A missing value is an error.
    """
    spark = rows.sparkSession
    ship_code(spark)
    label, depth, least = estimator.getLabelCol(), estimator.getMaxDepth(), estimator.getMinInstancesPerNode()
    count, seed = estimator.getNumTrees(), estimator.getSeed() % 2**63
    with scratch(spark):
        splits = candidate_splits(rows.select(*[F.col(c).cast("double") for c in columns]), columns, estimator.getMaxBins())
        blocks = materialize(blocks_of(rows, label, columns, splits), "forest-rows")
        starts, total = {}, 0
        for part, seq, n in blocks.select("part", "seq", "n").orderBy("part", "seq").collect():
            starts[part, seq] = total
            total += n
        cores = spark.sparkContext.defaultParallelism
        largest = min(2 ** (depth + 1), 4 * (total // max(least, 1) + 1))
        wave = max(1, WAVE_BYTES // (110 * largest))
        wave = min(count, max(wave // cores, 1) * cores)
        grown = []
        for first in range(0, count, wave):
            trees = range(first, min(first + wave, count))
            groups = [trees[i::min(len(trees), cores)] for i in range(min(len(trees), cores))]
            dealt = blocks.select(F.explode(F.array(*[F.lit(i) for i in range(len(groups))])).alias("group"), "part", "seq", "n", "bins", "y")
            task = _growing(splits, starts, total, groups, first, seed, depth, least)
            nodes = dealt.repartitionById(len(groups), F.col("group")).mapInArrow(task, f"treeID int, nodeData struct<{_NODE}>")
            path = run_folder(spark, "forest")
            nodes.write.parquet(f"{path}/data")
            _describe(spark, estimator, path, len(columns), len(trees))
            grown += list(RandomForestRegressionModel.load(path)._java_obj.trees())
    jvm = spark._jvm.org.apache.spark.ml.regression
    array = spark.sparkContext._gateway.new_array(jvm.DecisionTreeRegressionModel, len(grown))
    for i, tree in enumerate(grown):
        array[i] = tree
    model = estimator._copyValues(RandomForestRegressionModel(jvm.RandomForestRegressionModel(estimator.uid, array, len(columns))))
    model._transfer_params_to_java()
    return model
