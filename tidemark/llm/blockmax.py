"""Exact top-k by inner product, block at a time.

Rows are put in an order that keeps like vectors together and cut into ranges (shards), and these
into blocks. A block has the largest and smallest weight of each term (component) and a forward index:
the weights of its rows. The summed maxima of a query's terms bound every score in a block. A query
takes the blocks in the order of these bounds and scores them whole, until the bounds fall below
its k-th best score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize, ship_code

#: Rows of a block, and of a shard while there are fewer than ``MOST_SHARDS``; then shards grow.
BLOCK = 64
SHARD = 32_768
MOST_SHARDS = 4096
#: Queries that meet a shard in one task.
QUERIES = 2048
#: Below this all sums of products are whole numbers of a double.
EXACT = 2.0**53


def usable(vector: str) -> Column:
    """Neither null nor with a null or non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def _dense(column: pa.ListArray | pa.ChunkedArray, dims: int) -> np.ndarray:
    """A matrix of ``dims`` columns; shorter vectors lack their last terms, which weigh 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims), dtype=np.int64)
    out[np.arange(dims)[None, :] < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer rows, exact: as doubles where every sum fits one, else as integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    largest = float(np.abs(a.astype(np.float64)).max()) * float(np.abs(b.astype(np.float64)).max()) * a.shape[1]
    if largest < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if largest >= 2.0**62:
        raise OverflowError("scores would not fit 64 bits")
    return a @ b.T


def bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """(query, block): the sum of each term's largest product with a weight of the block."""
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    return products(up, high) + products(down, low)


class Best:
    """The ``k`` best (score descending, key ascending) of each query so far."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor
        empty = np.empty(0, dtype=np.int64)
        self.query, self.score, self.row, self.found = empty, empty, empty, np.zeros(queries, dtype=np.int64)

    def add(self, query: list[np.ndarray], score: list[np.ndarray], row: list[np.ndarray], key: np.ndarray) -> None:
        """More scores; ``key`` ranks rows. ``floor`` becomes the k-th best where k are known."""
        q, s, r = (np.concatenate([old, *new]) for old, new in ((self.query, query), (self.score, score), (self.row, row)))
        order = np.lexsort((key[r], -s, q))
        q, s, r = q[order], s[order], r[order]
        start = np.searchsorted(q, np.arange(len(self.found)))
        rank = np.arange(len(q)) - start[q]
        kept = rank < self.k
        self.query, self.score, self.row = q[kept], s[kept], r[kept]
        last = kept & (rank == self.k - 1)
        self.floor[q[last]] = np.maximum(self.floor[q[last]], s[last])


def search(queries: np.ndarray, own: np.ndarray, floor: np.ndarray, blocks: list[tuple], k: int) -> tuple[Best, np.ndarray, int]:
    """The best of one shard for each query, what rows are called there, and how many products it took.

    ``blocks`` has (rows, keys, weights, high, low). Each query takes its blocks by descending bound, one
    at first and then twice as many a turn, and is done when the next bound is below its floor.
    """
    rows, key = (np.concatenate([b[i] for b in blocks]) for i in (0, 1))
    at = np.cumsum([0, *[len(b[0]) for b in blocks]])
    upper = bounds(queries, np.stack([b[3] for b in blocks]), np.stack([b[4] for b in blocks]))
    order = np.argsort(-upper, axis=1, kind="stable")
    best, work, start, size = Best(len(queries), k, floor.copy()), 0, 0, 1
    while start < len(blocks):
        turn = order[:, start:start + size]
        query, place = np.nonzero(np.take_along_axis(upper, turn, axis=1) >= best.floor[:, None])
        if not len(query):
            break
        block = turn[query, place]
        by_block = np.argsort(block, kind="stable")
        query, block = query[by_block], block[by_block]
        found: tuple[list, list, list] = ([], [], [])
        for b in np.unique(block):
            asked = query[slice(*np.searchsorted(block, (b, b + 1)))]
            score = products(queries[asked], blocks[b][2])
            work += score.size
            i, j = np.nonzero((score >= best.floor[asked][:, None]) & (rows[at[b]:at[b + 1]][None, :] != own[asked][:, None]))
            for out, new in zip(found, (asked[i], score[i, j], at[b] + j)):
                out.append(new)
        best.add(*found, key)
        start, size = start + size, 2 * size
    return best, rows, work


def _blocks(dims: int):
    """A sorted shard as rows (shard, block, ids, rows, weights, high, low); the last one, block -1, bounds the shard."""
    names = ["shard", "block", "ids", "rows", "weights", "high", "low"]

    def row(shard: int, place: int, part: pa.Table | None, weights: np.ndarray, high: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
        ids, rows = (part[c].to_pylist() for c in ("vec_id", "row")) if part is not None else ([], [])
        long = lambda x: pa.array([x], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([place], pa.int32()), long(ids), long(rows), long(weights.ravel()), long(high), long(low)], names
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, place, held, high, low = None, 0, None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            while held.num_rows >= BLOCK:
                shard, high, low, out = cut(held.slice(0, BLOCK), place, high, low)
                yield out
                place, held = place + 1, held.slice(BLOCK)
        if held is not None and held.num_rows:
            shard, high, low, out = cut(held, place, high, low)
            yield out
        if shard is not None:
            yield row(shard, -1, None, np.empty(0, dtype=np.int64), high, low)

    def cut(part: pa.Table, place: int, high: np.ndarray | None, low: np.ndarray | None):
        weights = _dense(part["vector"], dims)
        top, bottom = weights.max(axis=0), weights.min(axis=0)
        shard = part["shard"][0].as_py()
        wide = (top, bottom) if high is None else (np.maximum(high, top), np.minimum(low, bottom))
        return shard, *wide, row(shard, place, part, weights, top, bottom)

    return task


def _locality(dims: int, bits: int = 16, seed: int = 42) -> Column:
    """An integer that like vectors tend to share: the signs of ``bits`` random sums of components, the first the highest.

    It only decides which rows stand together, never a result.
    """
    draw = np.random.Generator(np.random.PCG64(seed))
    code = F.lit(0)
    for _ in range(bits):
        signs = F.array(*[F.lit(float(x)) for x in draw.choice([-1.0, 1.0], dims)])
        total = F.aggregate(F.zip_with("vector", signs, lambda x, y: F.coalesce(x * y, F.lit(0.0))), F.lit(0.0), lambda s, x: s + x)
        code = code * 2 + (total > 0).cast("int")
    return code


def top_k(
    vectors: DataFrame, every: int = 100, k: int = 10, scale: int = 1024, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for every row whose key is divisible by ``every``.

    Components become floor(scale * x); the score is their integer inner product, components that
    one of two vectors lacks weighing 0. All rows but the query's own are searched, rows of the same key
    included; ties go to the smaller key (null before all), and fewer rows give fewer ranks. Null vectors and ones with null
    or non-finite components take no part, empty ones score 0. Repeated queries are searched each.
    Other columns are not read; no rows give no rows. Scores beyond 62 bits raise OverflowError.

    Each query first searches the shard with the highest bound; its k-th score there is the floor
    with which it visits the other shards, and only those whose bound reaches it. A shard meets its
    queries in groups of ``QUERIES``, so a shard that all queries want is many tasks. What is
    broadcast is one row of bounds per shard: at most ``MOST_SHARDS`` times twice the dimension.
    """
    spark = vectors.sparkSession
    ship_code(spark)
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector")).where(usable("vector"))
    rows = rows.withColumn("vector", F.transform("vector", lambda x: F.floor(x.cast("double") * scale)))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "topk-rows")
    total, dims, asked = rows.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.count_if(F.col("vec_id") % every == 0)).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not total or not asked:
        return spark.createDataFrame([], schema)
    dims = max(dims, 1)
    n_shards = min(MOST_SHARDS, -(-total // SHARD))
    ordered = rows.withColumn("code", _locality(dims)).repartitionByRange(n_shards, "code", "row").sortWithinPartitions("code", "row")
    ordered = ordered.select(F.spark_partition_id().alias("shard"), "vec_id", "row", "vector")
    long = "array<long>"
    blocks = materialize(
        ordered.mapInArrow(_blocks(dims), f"shard int, block int, ids {long}, rows {long}, weights {long}, high {long}, low {long}"), "topk-blocks"
    )
    shards = blocks.where("block < 0").select("shard", "high", "low")
    queries = rows.where(F.col("vec_id") % every == 0).select("row", "vec_id", "vector")
    # Bounded: one row per shard.
    n_groups = -(-asked // QUERIES)
    summary = shards.orderBy("shard").collect()
    names = np.array([r.shard for r in summary])
    high, low = (np.array([r[c] for r in summary], dtype=np.int64) for c in ("high", "low"))
    summary = spark.sparkContext.broadcast((names, high, low))

    def visits(first: bool):
        """(shard, row, vec_id, vector, floor): the shard of the highest bound, or the others that reach the floor."""
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, high, low = summary.value
            for batch in batches:
                for start in range(0, batch.num_rows, 1024):
                    part = batch.slice(start, 1024)
                    upper = bounds(_dense(part.column("vector"), dims), high, low)
                    home = upper.argmax(axis=1)
                    if first:
                        query, place = np.arange(len(home)), home
                        floor = np.full(len(home), np.iinfo(np.int64).min)
                    else:
                        floor = part.column("floor").to_numpy()
                        wanted = upper >= floor[:, None]
                        wanted[np.arange(len(home)), home] = False
                        query, place = np.nonzero(wanted)
                        floor = floor[query]
                    taken = part.select(["row", "vec_id", "vector"]).take(pa.array(query))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[place], pa.int32()), *taken.columns, pa.array(floor, pa.int64())], ["shard", "row", "vec_id", "vector", "floor"]
                    )

        return task

    def visit(asking: pa.Table, shard: pa.Table) -> pa.Table:
        parts = []
        for ids, own, weights, top, bottom in zip(*(shard[c].combine_chunks() for c in ("ids", "rows", "weights", "high", "low"))):
            long = lambda x: x.values.to_numpy(zero_copy_only=False)
            # A null key comes back as NaN; it goes before all others.
            parts.append((long(own), [x.as_py() for x in ids], long(weights).reshape(-1, dims), long(top), long(bottom)))
        keys = [i for p in parts for i in p[1]]
        least = np.iinfo(np.int64).min
        parts = [(r, np.array([least if i is None else i for i in ids], dtype=np.int64), w, t, b) for r, ids, w, t, b in parts]
        if not asking.num_rows or not parts:
            return pa.table({"row": pa.array([], pa.int64()), "query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        best, _, _ = search(_dense(asking["vector"], dims), asking["row"].to_numpy(), asking["floor"].to_numpy(), parts, k)
        query = pa.array(best.query)
        return pa.table({
            "row": asking["row"].take(query), "query_id": asking["vec_id"].take(query),
            "vec_id": pa.array([keys[i] for i in best.row.tolist()], pa.int64()), "score": pa.array(best.score),
        })

    def searched(asking: DataFrame) -> DataFrame:
        dealt = asking.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(n_groups)).cast("int"))
        meetings = dealt.select(F.col("shard").alias("at"), F.col("part").alias("group")).distinct()
        met = blocks.where("block >= 0").join(meetings, F.col("shard") == F.col("at")).drop("shard")
        both = dealt.groupBy("shard", "part").cogroup(met.groupBy("at", "group"))
        return both.applyInArrow(visit, "row long, query_id long, vec_id long, score long")

    def ranked(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_first())
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    entry = "shard int, row long, vec_id long, vector array<long>, floor long"
    home = materialize(ranked(searched(queries.mapInArrow(visits(True), entry))), "topk-home")
    floors = home.where(F.col("rank") == k).select("row", F.col("score").alias("floor"))
    queries = queries.join(floors, "row", "left").na.fill({"floor": int(np.iinfo(np.int64).min)})
    rest = searched(queries.mapInArrow(visits(False), entry))
    return ranked(home.drop("rank").unionByName(rest)).select("query_id", "rank", "vec_id", "score")
