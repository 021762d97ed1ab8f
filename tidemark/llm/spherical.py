"""Near-duplicate vectors by spherical-cap filters from a random product code.

A filter is a direction; a vector passes it when their inner product exceeds a bound. The
directions are product codes: a rotated space is cut into blocks, each block has its own random
code words, and every combination of code words is a direction. So a vector's filters are listed
by decoding block after block, without trying all directions. Several codes with rotations of
their own even out vectors that one rotation serves badly. Vectors that share a filter are
compared exactly, in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import by_runs, split_large
from tidemark.llm.components import components
from tidemark.session import materialize, ship_code

BLOCKS = 2
CODES = 8
BLOCK = 512
#: Pairs that are compared in one product.
TOGETHER = 1_000_000
#: Vectors of a run up to which pairs are listed; larger ones are compared as matrices, some columns at a time.
SMALL = 48
COLUMNS = 2048
#: Scores (rows by words of a block) that decoding holds at a time.
CELLS = 2_000_000
#: Share of pairs at the threshold itself that must have a filter in common; closer pairs have more.
RECALL = 0.97
#: Directions per code and vector of the largest label. With so many, lists of filters and chance
#: meetings stay as long as they are when labels grow (measured for 500 to 62,500 vectors).
DENSITY = 25


@dataclass(frozen=True)
class Code:
    """Per code a rotation (d, d) and the words of each block (k, size of block); the bound of all."""

    parts: list[tuple[np.ndarray, list[np.ndarray]]]
    bound: float

    def decode_all(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``decode`` for any number of rows, some at a time: scores of ``CELLS`` at most are held."""
        step = max(1, CELLS // self.parts[0][1][0].shape[0])
        found = [(start, *self.decode(unit[start:start + step])) for start in range(0, len(unit), step)]
        if not found:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        return np.concatenate([start + row for start, row, _ in found]), np.concatenate([code for _, _, code in found])

    def decode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of every filter that a row of ``unit`` passes, by row and filter."""
        found = [self._one(unit, place) for place in range(len(self.parts))]
        row, code = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((code, row))
        return row[order], code[order]

    def _one(self, unit: np.ndarray, place: int) -> tuple[np.ndarray, np.ndarray]:
        rotation, words = self.parts[place]
        turned, at, scores = unit @ rotation, 0, []
        for w in words:
            scores.append(turned[:, at:at + w.shape[1]] @ w.T)
            at += w.shape[1]
        best = np.cumsum([s.max(axis=1) for s in reversed(scores)], axis=0)[::-1]
        rest = [*best[1:], np.zeros(len(unit))]
        row, code, part = np.arange(len(unit)), np.full(len(unit), place, dtype=np.int64), np.zeros(len(unit))
        for s, ahead in zip(scores, rest):
            total = part[:, None] + s[row]
            r, c = np.nonzero(total + ahead[row][:, None] >= self.bound)
            row, code, part = row[r], code[r] * s.shape[1] + c, total[r, c]
        return row, code


def make_code(dims: int, largest: int, cosine: float, recall: float = RECALL, seed: int = 42, bound: float | None = None) -> Code:
    """A code for labels of up to ``largest`` vectors: directions grow with them, lists do not.

    The bound is the highest at which ``recall`` of random pairs at ``cosine`` (simulated from
    the seed, no data) share a filter; a known one is taken as it is, so that a code is made again
    from a few numbers wherever it is needed. Its size grows with the square root of the label.
    """
    draw = np.random.Generator(np.random.PCG64(seed))
    blocks = min(BLOCKS, dims)
    size = max(8, int(np.ceil((DENSITY * max(largest, 1)) ** (1 / blocks))))
    parts = []
    for _ in range(CODES):
        rotation, words = np.linalg.qr(draw.standard_normal((dims, dims)))[0], []
        for part in np.array_split(np.arange(dims), blocks):
            w = draw.standard_normal((size, len(part)))
            words.append(w / np.linalg.norm(w, axis=1, keepdims=True) / np.sqrt(blocks))
        parts.append((rotation, words))
    if bound is not None:
        return Code(parts, bound)
    a = draw.standard_normal((600, dims))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = draw.standard_normal((600, dims))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    norm = np.linalg.norm(b, axis=1, keepdims=True)
    b = cosine * a + np.sqrt(1 - cosine**2) * b / np.where(norm > 0, norm, 1)
    every = CODES * size**blocks

    def enough(at: float) -> bool:
        code = Code(parts, at)
        seen = [set((r * every + c).tolist()) for r, c in (code.decode_all(a), code.decode_all(b))]
        return len({k // every for k in seen[0] & seen[1]}) >= recall * len(a)

    low = next((x / 50 for x in range(45, -51, -1) if enough(x / 50)), -2.0)
    if low > -2:
        high = low + 0.02
        for _ in range(4):
            middle = (low + high) / 2
            low, high = (middle, high) if enough(middle) else (low, middle)
    return Code(parts, low)


def _usable(vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.ChunkedArray | pa.ListArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _met(unit: np.ndarray, label: np.ndarray, own: np.ndarray, halves: np.ndarray, starts: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (x before y) inside each small run: runs of one size are compared in one product."""
    sizes = np.diff(starts)
    found = []
    for size in np.unique(sizes[(sizes > 1) & (sizes <= SMALL)]).tolist():
        at = starts[:-1][sizes == size]
        step = max(1, TOGETHER // (size * size))
        for low in range(0, len(at), step):
            rows = at[low:low + step, None] + np.arange(size)
            close = unit[rows] @ unit[rows].transpose(0, 2, 1) >= cosine
            close &= label[rows][:, :, None] == label[rows][:, None, :]
            # Two halves of a large filter: pairs inside one half are met where it is alone.
            close &= ~halves[rows][:, :, None] | (own[rows][:, :, None] != own[rows][:, None, :])
            run, i, j = np.nonzero(np.triu(close, 1))
            found.append((rows[run, i], rows[run, j]))
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return tuple(np.concatenate(side) for side in zip(*found))


def _compare(cosine: float):
    """Links of many runs: (node, root, links); a pair counts at its smallest common filter."""
    def compare(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch | None:
        table = table.combine_chunks()
        unit = _unit_of_each(table["vector"].combine_chunks())
        label = pc.dictionary_encode(table["label"].combine_chunks()).indices.to_numpy()
        own, node, copies, here = (table[c].to_numpy() for c in ("own", "node", "copies", "filter"))
        halves = table["lo"].to_numpy() < table["hi"].to_numpy()
        lists = table["filters"].combine_chunks()
        parts = [
            _dense(unit[a:b], label[a:b], own[a:b], node[a:b], copies[a:b], here[a], halves[a], lists.slice(a, b - a), cosine)
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()) if b - a > SMALL
        ]
        x, y = _met(unit, label, own, halves, starts, cosine)
        if not len(x):
            return pa.Table.from_batches(parts).combine_chunks().to_batches()[0] if sum(p.num_rows for p in parts) else None
        width = lists.value_lengths().to_numpy()
        filters = np.full((len(node), width.max()), -1, dtype=np.int64)
        filters[np.arange(filters.shape[1])[None, :] < width[:, None]] = lists.flatten().to_numpy()
        links = np.zeros(len(node), dtype=np.int64)
        for start in range(0, len(x), 10_000):
            a, b = x[start:start + 10_000], y[start:start + 10_000]
            shared = (filters[a][:, :, None] == filters[b][:, None, :]).any(axis=2) & (filters[a] >= 0)
            first = np.where(shared, filters[a], np.iinfo(np.int64).max).min(axis=1) == here[a]
            np.add.at(links, a[first], copies[b[first]])
            np.add.at(links, b[first], copies[a[first]])
        root = np.arange(len(node))
        while True:
            least = root.copy()
            np.minimum.at(least, x, root[y])
            np.minimum.at(least, y, root[x])
            least = least[least]
            if (least == root).all():
                break
            root = least
        keep = np.union1d(x, y)
        columns = [pa.array(node[keep]), pa.array(node[root[keep]]), pa.array(links[keep])]
        parts.append(pa.RecordBatch.from_arrays(columns, ["node", "root", "links"]))
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    return compare


def _dense(
    unit: np.ndarray, label: np.ndarray, own: np.ndarray, node: np.ndarray, copies: np.ndarray, here: int, halves: bool, lists: pa.ListArray,
    cosine: float,
) -> pa.RecordBatch:
    """The links of one large run, by products of matrices: of the vectors, and of the smaller filters each has."""
    n = len(node)
    close = (unit @ unit.T >= cosine) & (label[:, None] == label[None, :])
    np.fill_diagonal(close, False)
    if halves:
        close &= own[:, None] != own[None, :]
    owner, filters = np.repeat(np.arange(n), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
    owner, filters = owner[filters < here], filters[filters < here]
    names, at, times = np.unique(filters, return_inverse=True, return_counts=True)
    # A filter of one vector is shared by none.
    owner, at = owner[times[at] > 1], (np.cumsum(times > 1) - 1)[at[times[at] > 1]]
    order = np.argsort(at, kind="stable")
    owner, at, shared = owner[order], at[order], np.zeros((n, n), dtype=np.float32)
    for start in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
        a, b = np.searchsorted(at, (start, start + COLUMNS))
        has = np.zeros((n, COLUMNS), dtype=np.float32)
        has[owner[a:b], at[a:b] - start] = 1
        shared += has @ has.T
    links = ((close & (shared == 0)).astype(np.float64) @ copies).astype(np.int64)
    np.fill_diagonal(close, True)
    root = np.arange(n)
    while True:
        least = np.where(close, root[None, :], n).min(axis=1)
        least = least[least]
        if (least == root).all():
            break
        root = least
    keep = np.flatnonzero(close.sum(axis=1) > 1)
    return pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(node[root[keep]]), pa.array(links[keep])], ["node", "root", "links"])


def _unit_of_each(vectors: pa.ListArray) -> np.ndarray:
    """Unit vectors of several lengths, filled up with zeros; only vectors of one length share a run with their label."""
    sizes = vectors.value_lengths().to_numpy()
    if len(sizes) and (sizes == sizes[0]).all():
        return _unit(_matrix(vectors))
    out = np.zeros((len(sizes), sizes.max(initial=0)))
    for dims in np.unique(sizes):
        at = np.flatnonzero(sizes == dims)
        out[at, :dims] = _unit(_matrix(vectors.take(pa.array(at))))
    return out


def near_vectors(
    vectors: DataFrame, cosine: float = 0.93, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    recall: float = RECALL,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors``.

    Only vectors of one (non-null) label and length are compared. Null, zero and empty vectors and
    ones with null or non-finite components link with nothing. Equal vectors of a label are one
    node with a count, and link each other. A null key is a row like others but never a component
    id where another key is in the component; repeated keys are counted as rows. Other columns
    are not read. No rows give no rows.

    A filter with many vectors (many close copies) is compared in pairs of blocks; each run of
    blocks returns a link count and one edge per vector, never its pairs.
    """
    ship_code(vectors.sparkSession)
    rows = vectors.select(F.col(key).alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("vector"))
    good = _usable("vector") & F.col("label").isNotNull()
    nodes = rows.where(good).groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "spherical-nodes")
    shapes = nodes.groupBy(F.size("vector").alias("dims"), "label").count().groupBy("dims").agg(F.max("count").alias("largest")).collect()
    made = {r["dims"]: (r["largest"], make_code(r["dims"], r["largest"], cosine, recall).bound) for r in shapes}

    def filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, Code] = {}
        for batch in batches:
            sizes = pc.list_value_length(batch.column(1)).to_numpy()
            for dims in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dims))
                if dims not in codes:
                    largest, bound = made[int(dims)]
                    codes[dims] = make_code(int(dims), largest, cosine, recall, bound=bound)
                for start in range(0, part.num_rows, 1024):
                    node, vector = part.slice(start, 1024).columns
                    row, code = codes[dims].decode_all(_unit(_matrix(vector)))
                    offsets = np.searchsorted(row, np.arange(len(node) + 1)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([node, pa.ListArray.from_arrays(offsets, pa.array(code))], ["node", "filters"])

    lists = materialize(nodes.select("node", "vector").mapInArrow(filters, "node long, filters array<long>"), "spherical-filters")
    full = nodes.join(lists, "node").select("node", "label", "vector", "copies", "filters")
    spots = nodes.select("node", F.xxhash64("label", F.size("vector")).alias("group")).join(lists, "node")
    spots = spots.select("node", "group", F.explode("filters").alias("filter"))
    spots = materialize(spots.select("node", "filter", F.xxhash64("group", "filter").alias("bucket")), "spherical-entries")
    met = split_large(spots, "bucket", "node", BLOCK).join(full, "node")
    columns = ["bucket", "filter", "lo", "hi", "own", "node", "label", "vector", "copies", "filters"]
    found = by_runs(met.select(*columns), ["bucket", "filter", "lo", "hi"], _compare(cosine), "node long, root long, links long")
    found = materialize(found, "spherical-links")
    linked = components(found.where("node <> root"), "node", "root")
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = nodes.join(sums, "node", "left").join(linked, "node", "left").withColumn("root", F.coalesce("component", "node"))
    least = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = classes.join(least, "root").select(
        F.col("label").alias("_l"), F.col("vector").alias("_v"), "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    # Equal vectors are the only hot keys here; adaptive execution splits the side of the rows.
    usable = rows.where(good).join(classes, (F.col("label") == F.col("_l")) & (F.col("vector") == F.col("_v")))
    alone = rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    both = usable.select("vec_id", "n_links", F.col("component_id").cast("long").alias("component_id")).unionByName(alone)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
