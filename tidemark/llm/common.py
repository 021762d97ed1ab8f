"""Helpers the operators share: joining per-key facts without hot tasks, reading sorted runs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with at least this share of the rows is hot; there are at most ``1 / HOT_SHARE`` of them.
HOT_SHARE = 0.001

#: Bytes of `[\x20\x09-\x0D]`, the white space that separates words in every operator here.
SPACES = "\t\n\x0b\x0c\r "


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names that begin like ``names`` and that no column of ``df`` has, in whatever case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def attach(left: DataFrame, facts: DataFrame, keys: list[str], n: str, total: int, large: bool = False) -> DataFrame:
    """``left`` with the row of ``facts`` of its ``keys`` (null is a key like others), inner.

    ``facts`` has one row per key, and in ``n`` how many rows of ``left`` have it. Keys with
    ``HOT_SHARE`` of the ``total`` rows or more, at most ``1 / HOT_SHARE`` by arithmetic, are
    broadcast, so that their rows are not shuffled; the rest meet in a shuffled join in which
    no key is hot. Both inputs are read twice: pass stored tables. Small files of facts may hold many
    rows: ``large`` facts are shuffled however small the planner takes them to be.
    """
    bound = max(1, int(total * HOT_SHARE))
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_fact_{k}")) for k in keys])
    facts = facts.withColumnsRenamed({k: f"_fact_{k}" for k in keys})
    named = [f"_fact_{k}" for k in keys]
    hot, cold = facts.where(F.col(n) >= bound), facts.where(F.col(n) < bound)
    by_broadcast = left.join(F.broadcast(hot), same, "inner")
    rest = left.join(F.broadcast(hot.select(*named)), same, "left_anti")
    return by_broadcast.unionByName(rest.join(cold.hint("merge") if large else cold, same, "inner")).drop(*named)


def smallest(df: DataFrame, h: str, n: int, total: int) -> DataFrame:
    """The ``n`` rows of ``df`` (``total`` rows) with the smallest hashes ``h``, 64 bits each.

    Rows above twice the hash that ``n`` of ``total`` rows are expected below are dropped where they
    are read, so what tasks send on is about ``2 n`` rows together, not ``n`` each.
    """
    bound = int(-(2**63) + 2**64 * min(1.0, 2 * n / max(total, 1)))
    low = df if bound >= 2**63 else df.where(F.col(h) < bound)
    return low.orderBy(h).limit(n)


def split_large(rows: DataFrame, key: str, member: str, block: int) -> DataFrame:
    """Rows of keys that have two or more, with ``lo``, ``hi`` and ``own``: the block pairs of a key.

    A key with over ``block`` rows is cut into blocks by a hash of ``member``, and each row goes
    to every pair of blocks that holds its own (``own``). Two rows of a key meet in at least one
    (key, lo, hi), and each of those holds about ``2 * block`` rows at most. ``rows`` is read
    twice: derive it cheaply from a stored table.

    Rows and sizes meet by a shuffle, never by a broadcast: ``rows`` may come out of an ``explode``, which
    the planner takes to be as small as what it reads.
    """
    sizes = rows.groupBy(F.col(key).alias("_size_key")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    parts = F.ceil(F.col("_n") / F.lit(block)).cast("int")
    pairs = F.when(F.col("_parts") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_parts") - 1))
    return (
        rows.join(sizes.hint("merge"), F.col(key) == F.col("_size_key"), "inner")
        .withColumn("_parts", parts)
        .withColumn("own", F.pmod(F.xxhash64(F.col(member), F.lit(7)), F.col("_parts")).cast("int"))
        .withColumn("_other", F.explode(pairs))
        .withColumn("lo", F.least("own", "_other"))
        .withColumn("hi", F.greatest("own", "_other"))
        .drop("_size_key", "_n", "_parts", "_other")
    )


def by_run(rows: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``fn`` on the rows of each combination of ``keys``, as one Arrow table at a time.

    For groups of bounded size (see ``split_large``): a partition is sorted by the keys and read
    as a stream, so a task holds one group and one batch.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, keys):
            out = fn(run)
            if out is not None and out.num_rows:
                yield out

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from gathered(task(batches))

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(joined, schema)


def by_runs(rows: DataFrame, keys: list[str], fn: Callable[[pa.Table, np.ndarray], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Like ``by_run`` for small groups: ``fn`` gets many whole runs in one table, and where each begins (and the end)."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            starts = _starts(table, keys)
            # The last run may go on in the next batch.
            last, held = int(starts[-2]), table.slice(int(starts[-2]))
            if last and (out := fn(table.slice(0, last), starts[:-1])) is not None:
                yield out
        if held is not None and (out := fn(held, _starts(held, keys))) is not None:
            yield out

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lambda batches: gathered(task(batches)), schema)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, dtype=bool)
    for k in keys:
        column = table[k].to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.array([0, *np.flatnonzero(new), table.num_rows])


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Maximal runs of equal keys in a sorted stream."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        new = np.zeros(table.num_rows, dtype=bool)
        for k in keys:
            column = table[k].to_numpy()
            new[1:] |= column[1:] != column[:-1]
        starts = [0, *np.flatnonzero(new).tolist(), table.num_rows]
        for start, end in zip(starts, starts[1:]):
            part = table.slice(start, end - start)
            if held and (start or any(held[-1][k][-1] != part[k][0] for k in keys)):
                yield pa.concat_tables(held)
                held = []
            held.append(part)
    if held:
        yield pa.concat_tables(held)


def gathered(batches: Iterator[pa.RecordBatch], rows: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Small batches joined to larger ones."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()
