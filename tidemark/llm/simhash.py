"""SimHash near-duplicates by segment popcounts: a grid range join, then exact Hamming distances.

A fingerprint (or a table of its bits) is cut into 4-bit segments and mapped to the vector of the
segments' bit counts. The Manhattan distance of two such vectors is at most the Hamming distance
of the fingerprints, so fingerprints within ``2`` bits have vectors within distance 2, and these
share a grid point: each vector is entered at its own point and at all points one step away, and
two vectors within distance 2 have a point between them. The join is on equal points; what meets
there is compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import attach, by_run, split_large, unused
from tidemark.llm.components import components
from tidemark.session import materialize, ship_code

SEED = 42
SEGMENT = 4
BITS = 64
#: Words of a shingle, and bits that fingerprints may differ in and still link. The grid of
#: ``entries`` is exact for this many bits.
SHINGLE = 3
DISTANCE = 2
#: Fingerprints of one grid point that are compared in one go.
BLOCK = 512
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of each shingle. A text with fewer words than a shingle is one; without words there is none."""
    tokens = text.translate(_LOWER).split()
    if not tokens:
        return np.empty(0, dtype=np.uint64)
    grams = [b" ".join(g) for g in zip(*(tokens[i:] for i in range(shingle)))] or [b" ".join(tokens)]
    return np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype=np.uint64, count=len(grams))


def fingerprint(hashes: np.ndarray) -> int:
    """As a signed 64-bit word. A bit is 1 if it is set in over half of the hashes; no hashes give zero."""
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 65_536):
        h = hashes[start:start + 65_536]
        ones += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, h, f0): ``f0`` is the fingerprint, ``h`` a hash of the whole text. A null text has no words."""
    ship_code(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(shingle_hashes(t.as_py(), shingle)) for t in batch.column(2).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints, pa.int64())], ["doc_id", "h", "f0"])

    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("h"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(task, f"doc_id {dict(docs.dtypes)[key]}, h long, f0 long")


def _popcounts(word: Column) -> Column:
    """The vector of segment popcounts as one integer, four bits per count.

    Counts are raised by 1, so that a step down from 0 stays in its place.
    """
    code = F.lit(0).cast("long")
    for i in range(BITS // SEGMENT):
        count = F.bit_count(F.shiftrightunsigned(word, SEGMENT * i).bitwiseAND(F.lit(15))) + 1
        code = code + F.shiftleft(count.cast("long"), SEGMENT * i)
    return code


def entries(nodes: DataFrame) -> DataFrame:
    """(point, node, f0): each node at its grid point and at all points one step away."""
    steps = [0] + [sign << (SEGMENT * i) for i in range(BITS // SEGMENT) for sign in (1, -1)]
    steps = F.array(*[F.lit(x).cast("long") for x in steps])
    placed = nodes.select("node", "f0", _popcounts(F.col("f0")).alias("code"))
    return placed.select(F.explode(steps).alias("step"), "*").select((F.col("code") + F.col("step")).alias("point"), "node", "f0")


def _star(node: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
    """A spanning star of each component of the graph ``near``, in which each node is near itself."""
    label = np.arange(len(node))
    while True:
        least = np.where(near, label[None, :], len(node)).min(axis=1)
        least = least[least]
        if (least == label).all():
            break
        label = least
    rows = np.flatnonzero(label != np.arange(len(node)))
    return pa.RecordBatch.from_arrays([pa.array(node[rows]), pa.array(node[label[rows]])], ["a", "b"])


def _linked(run: pa.Table) -> pa.RecordBatch | None:
    """Edges among the nodes of one grid point: a spanning star of what is within ``DISTANCE`` bits."""
    node, first = np.unique(run["node"].to_numpy(), return_index=True)
    if len(node) < 2:
        return None
    x = run["f0"].to_numpy()[first].view(np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= DISTANCE
    rows = np.flatnonzero(near.sum(axis=1) > 1)
    return _star(node[rows], near[np.ix_(rows, rows)]) if len(rows) else None


def links(nodes: DataFrame) -> DataFrame:
    """(a, b): enough links between nodes for their components; ``nodes`` has node and f0.

    Every grid point yields a spanning star of the pairs that hold there, so no link is lost and
    no group is expanded into its pairs.
    """
    spread = split_large(entries(nodes), "point", "node", BLOCK)
    return by_run(spread.select("point", "lo", "hi", "node", "f0"), ["point", "lo", "hi"], _linked, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, h, f0, root, component_id) per row of ``docs``: the smallest key reachable by links.

    ``root`` names the component, also where several share a key or have none.

    Null texts and texts without words have the fingerprint zero and link like others. A null key
    counts for nothing as component id; a component of null keys only has none (null). Rows that
    repeat are in one component. Texts are read whole, however long, one at a time. Other columns are not read. No rows give no rows. Equal
    fingerprints are one node from the start, however many rows have them.
    """
    prints = materialize(fingerprints(docs, key, text, shingle), "simhash")
    nodes = prints.groupBy("f0").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "simhash-nodes")
    found = components(links(nodes))
    rooted = nodes.join(found, "node", "left").withColumn("root", F.coalesce("component", "node"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = materialize(rooted.join(least, "root").select("f0", "n", "root", "component_id"), "simhash-classes")
    return attach(prints, classes, ["f0"], "n", prints.count(), large=True).select("doc_id", "h", "f0", "root", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest key.

    Among rows of that key, the one with the smallest hash of its text; of rows equal in key and
    text one stays. In a group of null keys, the smallest hash decides alone. Null texts and texts
    without words are one group. Every column of ``docs`` stays, whatever its name; an empty
    table stays empty.
    """
    rows = near_duplicates(docs, key, text, shingle)
    k, h, own = unused(docs, "_k", "_h", "_hash")
    first = rows.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    mine = first.groupBy("root").agg(F.first("doc_id").alias(k), F.min("h").alias(h)).select(k, h)
    texts = docs.withColumn(own, F.xxhash64(text))
    same = F.col(key).eqNullSafe(F.col(k)) & (F.col(own) == F.col(h))
    return texts.join(mine, same, "left_semi").dropDuplicates([key, own]).drop(own)
