"""Feature attributions of a fitted tree ensemble."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import vocab
from tidemark.session import materialize, run_folder, ship_code

_CELLS = 2_000_000
_ROWS = 128
#: Conditions (a feature's bounds in a leaf) that are brought to the driver and broadcast at a time.
_MAX_CONDITIONS = 4_000_000

_LEAVES = "tree long, value double, feature array<int>, low array<double>, high array<double>, share array<double>"


def leaf_boxes(df: DataFrame, model: RandomForestRegressionModel) -> DataFrame:
    """One row per leaf of the ensemble, stored: its value, and a box with a share per feature on its path.

    Derived in tasks from the nodes as Spark ML saves them, one tree per group. ``share`` is the
    part of the training rows that followed the splits of that feature.
    """
    ship_code(df.sparkSession)
    path = run_folder(df.sparkSession, "forest")
    model.write().save(path)
    nodes = df.sparkSession.read.parquet(f"{path}/data").select(
        F.col("treeID").cast("long").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.col("nodeData.prediction").alias("value"),
        F.get("nodeData.impurityStats", F.lit(0)).alias("cover"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("nodeData.split.numCategories").alias("n_categories"),
    )
    return materialize(nodes.groupBy("tree").applyInPandas(leaf_conditions, _LEAVES), "leaves")


def leaf_conditions(nodes: pd.DataFrame) -> pd.DataFrame:
    """The leaves of one tree: value, and per distinct feature of the path low < x <= high and the share."""
    if (nodes.loc[nodes["left"] >= 0, "n_categories"] != -1).any():
        raise ValueError("only numeric splits are supported")
    table = {r.node: r for r in nodes.itertuples()}
    out, stack = [], [(0, {})]
    while stack:
        at, box = stack.pop()
        node = table[at]
        if node.left < 0:
            low, high, share = zip(*box.values()) if box else ((), (), ())
            out.append((node.tree, float(node.value), list(box), list(low), list(high), list(share)))
            continue
        for child, goes_left in ((node.left, True), (node.right, False)):
            low, high, share = box.get(node.feature, (-np.inf, np.inf, 1.0))
            bounds = (low, min(high, node.threshold)) if goes_left else (max(low, node.threshold), high)
            stack.append((child, {**box, node.feature: (*bounds, share * float(table[child].cover / node.cover))}))
    return pd.DataFrame(out, columns=["tree", "value", "feature", "low", "high", "share"])


def by_depth(leaves: pa.Table) -> dict[int, tuple[np.ndarray, ...]]:
    """Leaves by number of distinct features on their path, as arrays: value, feature, low, high, share."""
    leaves = leaves.combine_chunks()
    depth = pc.list_value_length(leaves["feature"]).to_numpy()
    out = {}
    for d in np.unique(depth).tolist():
        part = leaves.filter(pa.array(depth == d)).combine_chunks()
        cells = [pc.list_flatten(part[c]).to_numpy().reshape(part.num_rows, d) for c in ("feature", "low", "high", "share")]
        out[d] = (part["value"].to_numpy(), *cells)
    return out


def box_attributions(x: np.ndarray, leaves: dict[int, tuple[np.ndarray, ...]], n_trees: int) -> np.ndarray:
    """Shapley values of a batch of rows, from the multilinear form of the value function.

    With every other feature known with probability t, feature i changes a leaf by
    value * (hit_i - share_i) * prod over j of (t * hit_j + (1 - t) * share_j). The
    Shapley value is the integral over t, a polynomial that Gauss-Legendre nodes
    integrate exactly. Some rows by some leaves at a time: the effects of a feature are summed
    by its place, and memory does not grow with the leaves.
    """
    out = np.zeros(x.shape)
    for depth, (value, feature, low, high, share) in leaves.items():
        if depth == 0:
            continue
        points, weights = np.polynomial.legendre.leggauss((depth + 1) // 2)
        points, weights = (points + 1) / 2, weights / 2
        rows = min(len(x), _ROWS)
        step = max(1, _CELLS // (rows * depth))
        for j in range(0, len(value), step):
            part = slice(j, j + step)
            owner = feature[part].ravel()
            order = np.argsort(owner, kind="stable")
            names, starts = np.unique(owner[order], return_index=True)
            for i in range(0, len(x), rows):
                cells = x[i : i + rows][:, feature[part]]
                hit = ((cells > low[part]) & (cells <= high[part])).astype(float)
                mass = np.zeros(hit.shape)
                for t, w in zip(points, weights):
                    factor = t * hit + (1 - t) * share[part]
                    mass += w * factor.prod(axis=2, keepdims=True) / factor
                effect = (value[part, None] * (hit - share[part]) * mass).reshape(len(cells), -1)
                out[i : i + rows, names] += np.add.reduceat(effect[:, order], starts, axis=1)
    return out / n_trees


def attributions(
    df: DataFrame,
    model: RandomForestRegressionModel,
    keep: Sequence[str],
    columns: Sequence[str] = tuple(vocab.FEATURES),
    max_conditions: int = _MAX_CONDITIONS,
) -> DataFrame:
    """(keep, base, attribution array) per row; base + attributions = prediction.

    Rows stay where they are: the leaves are broadcast and each Arrow batch is a few
    matrix operations. The stored leaves are read in groups of whole trees with at most
    ``max_conditions`` conditions (or one tree), one pass over the rows per group, so neither the driver
    nor a broadcast holds more, however large the forest is.
    """
    leaves = leaf_boxes(df, model)
    sizes = leaves.groupBy("tree").agg(F.sum(F.size("feature") + 1).alias("n")).orderBy("tree").collect()
    keep, columns = list(keep), list(columns)
    out = df.select(
        *keep,
        F.lit(0.0).alias("base"),
        F.array(*[F.lit(0.0)] * len(columns)).alias("attribution"),
        F.array(*[F.col(c).cast("double") for c in columns]).alias("_x"),
    )
    groups = tree_groups([(r["tree"], r["n"]) for r in sizes], max_conditions)
    for first, last in groups:
        group = by_depth(leaves.where(F.col("tree").between(first, last)).drop("tree").toArrow())
        base = sum(float((v * share.prod(axis=1)).sum()) for v, _, _, _, share in group.values()) / len(sizes)
        out = out.mapInPandas(_adder(df.sparkSession.sparkContext.broadcast(group), base, len(sizes)), out.schema)
        if len(groups) > 1:
            out = materialize(out, "attributions")
    return out.drop("_x")


def tree_groups(sizes: Sequence[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """(first, last) of runs of trees whose sizes add up to at most ``most``, or one tree."""
    groups: list[list[int]] = []
    held = 0
    for tree, n in sizes:
        if not groups or held + n > most:
            groups.append([tree, tree])
            held = 0
        groups[-1][1] = tree
        held += n
    return [(a, b) for a, b in groups]


def _adder(shared, base: float, n_trees: int):
    """Adds the share of one group of trees to base and attributions of each batch."""

    def explain(batches):
        for batch in batches:
            if len(batch):
                found = box_attributions(np.stack(batch["_x"].to_numpy()), shared.value, n_trees)
                batch["base"] = batch["base"] + base
                batch["attribution"] = list(np.stack(batch["attribution"].to_numpy()) + found)
            yield batch

    return explain


def attribution_rank(attributed: DataFrame, columns: Sequence[str] = tuple(vocab.FEATURES), top_n: int | None = None) -> DataFrame:
    """Mean absolute attribution per feature, highest first, from one pass."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.avg(F.abs(F.col("attribution")[i])).alias("mean_abs_attribution"))
            for i, c in enumerate(columns)
        ]
    )
    ranked = attributed.agg(cells.alias("c")).select(F.explode("c").alias("c")).select("c.*")
    ranked = ranked.orderBy(F.desc("mean_abs_attribution"), "feature")
    return ranked.limit(top_n) if top_n else ranked


def hour_effect(attributed: DataFrame, columns: Sequence[str] = tuple(vocab.FEATURES), hour: str = "hour") -> DataFrame:
    """Mean joint attribution of the two hour features, per hour."""
    both = F.col("attribution")[list(columns).index("hour_sin")] + F.col("attribution")[list(columns).index("hour_cos")]
    return attributed.where(F.col(hour).isNotNull()).groupBy(hour).agg(F.avg(both).alias("time_contribution"))
