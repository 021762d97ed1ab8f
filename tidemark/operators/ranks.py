"""Exact order statistics and running totals over a global order.

A window without a partition key sends the whole table to one task, and Spark's
``percentile`` keeps every distinct value of a group in one buffer. Quantile sketches say where
to look instead: running totals cut the order into slices, and quantiles read a bracket around each
wanted rank. What they find is counted exactly, so the sketches decide how much is read, never what the
result is. Groups that are counted to be small enough for a buffer (``WHOLE``) are left to ``percentile``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.bounds import sized

MIN_SLICES = 256
ROWS_PER_SLICE = 2_000_000
#: Size of a sketch. Its ranks are off by about 0.13 % of the rows at 4,000, so a bracket of
#: ``REACH`` on either side nearly always holds the rank; where it does not, wider ones follow.
SKETCH = 4_000
REACH = 0.005
#: Values of a group that one buffer holds, some 100 bytes each; an aggregate keeps at most 128 buffers before it sorts.
WHOLE = 10_000
_LARGEST = 1.7976931348623157e308


def slices_for(n_rows: int) -> int:
    """Enough slices that one of them is a comfortable task, however many rows there are."""
    return max(MIN_SLICES, n_rows // ROWS_PER_SLICE)


def _sketch(value: str) -> list[Column]:
    """Rows with a value, and a mergeable sketch of the values (null without any); NaN is no value, infinities are clipped."""
    known = F.when(F.col(value).isNotNull() & ~F.isnan(value), F.greatest(F.least(F.col(value), F.lit(_LARGEST)), F.lit(-_LARGEST)))
    return [F.count(known).alias("n"), F.kll_sketch_agg_double(known, F.lit(SKETCH)).alias("sketch")]


def _points(sketch: str | Column, steps: Sequence[float]) -> Column:
    """Values at the shares ``steps``, with the clipped ends opened again."""
    opened = lambda x: (
        F.when(x >= _LARGEST, float("inf")).when(x <= -_LARGEST, float("-inf")).otherwise(x)
    )
    return F.transform(F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(float(x)) for x in steps])), opened)


def slice_edges(df: DataFrame, value: str, slices: int | None = None) -> list[float]:
    """Ascending distinct finite cut points that split ``value`` about evenly.

    One pass: tasks send on one sketch each (some 90 KB), and the merged one alone reaches the
    driver; it also knows the rows for ``slices_for``.
    """
    n, sketch = df.select(F.col(value).cast("double").alias("v")).agg(*_sketch("v")).first()
    slices = slices or slices_for(n)
    steps = [i / slices for i in range(1, slices)]
    if not n or not steps:
        return []
    cuts = df.sparkSession.range(1).select(_points(F.lit(bytes(sketch)), steps).alias("cuts")).first()["cuts"]
    return sorted(c for c in set(cuts) if abs(c) <= _LARGEST)


def with_slice(df: DataFrame, value: str, edges: Sequence[float], out: str = "slice") -> DataFrame:
    """Add the slice number of ``value``; slice order is value order. Infinities are in the outer slices.

    Missing values (NaN included) have no slice.
    """
    known = F.col(value).isNotNull() & ~F.isnan(value)
    if not edges:
        return df.withColumn(out, F.when(known, F.lit(0.0)))
    splits = [float("-inf"), *edges, float("inf")]
    cut = Bucketizer(splits=splits, inputCol=value, outputCol=out, handleInvalid="keep").transform(df)
    return cut.withColumn(out, F.when(known, F.col(out)))


def running_totals(
    df: DataFrame, order: str, sums: dict[str, Column], keys: Sequence[str] = (), slices: int | None = None
) -> DataFrame:
    """One row per distinct ``order`` value (and key) with its totals and the totals before it.

    ``sums`` maps a name to the column summed; the result has ``name``, ``name_before``
    and ``name_total``. Equal order values are one row, so a value held by a third of
    all rows is reduced before the shuffle.
    """
    keys = list(keys)
    points = df.groupBy(*keys, order).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    sliced = with_slice(points.withColumn("_at", F.col(order).cast("double")), "_at", slice_edges(df, order, slices))
    per_slice = sliced.groupBy(*keys, "slice").agg(*[F.sum(n).alias(f"{n}_slice") for n in sums])
    over_slices = Window.partitionBy(*keys).orderBy("slice")
    everything = Window.partitionBy(*keys)
    offsets = per_slice.select(
        *keys,
        "slice",
        *[
            F.coalesce(F.sum(f"{n}_slice").over(over_slices.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
            .alias(f"{n}_offset")
            for n in sums
        ],
        *[F.sum(f"{n}_slice").over(everything).alias(f"{n}_total") for n in sums],
    )
    inside = Window.partitionBy(*keys, "slice").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    local = sliced.select("*", *[F.coalesce(F.sum(n).over(inside), F.lit(0)).alias(f"{n}_local") for n in sums])
    return local.join(offsets, [*keys, "slice"]).select(
        *keys,
        order,
        *[F.col(n) for n in sums],
        *[(F.col(f"{n}_offset") + F.col(f"{n}_local")).alias(f"{n}_before") for n in sums],
        *[f"{n}_total" for n in sums],
    )


def exact_quantiles(
    df: DataFrame,
    values: str | Sequence[str],
    probs: Sequence[float],
    keys: Sequence[str] = (),
    reach: float = REACH,
    per_slice: int = ROWS_PER_SLICE,
    whole: int = WHOLE,
) -> DataFrame:
    """Linear-interpolation quantiles: one row per key, one array per value column.

    Missing values (NaN included) and rows with a missing key are left out; a key without any
    value has null arrays. Infinities are values like others.

    Two passes. The first stores a count and a sketch per key and column. The second puts the values
    of groups of at most ``whole`` in order, each in a buffer, and for each wanted rank of a larger group counts
    the rows below a bracket of ``reach`` on either side of it, and those inside by value;
    a bracket of many rows is cut into slices of ``per_slice``, and only values of a slice are
    ordered. A rank that its bracket has missed is looked for again in a bracket eight times as
    wide, which in the end is the whole column. Several columns go through the same passes, as one more key.
    """
    keys, values = list(keys), [values] if isinstance(values, str) else list(values)
    rows = df
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    pairs = F.array(*[F.struct(F.lit(v).alias("_column"), F.col(v).cast("double").alias("_v")) for v in values])
    long = rows.select(*keys, F.inline(pairs))
    groups = [*keys, "_column"]
    sketches = sized(long.groupBy(*groups).agg(*_sketch("_v")), "sketches")
    most, small = sketches.agg(F.max("n"), F.count_if(F.col("n") <= whole)).first()
    found = None
    if most is None or small:
        few = long if (most or 0) <= whole else long.join(sketches.where(F.col("n") <= whole).select(*groups), groups, "left_semi")
        value = F.when(~F.isnan("_v"), F.col("_v"))
        found = few.groupBy(*groups).agg(F.percentile(value, [float(p) for p in probs]).alias("quantiles"))
    if (most or 0) > whole:
        large = _by_brackets(long, sketches.where(F.col("n") > whole), groups, probs, reach, per_slice, most)
        found = large if found is None else found.unionByName(large)
    cells = [F.max(F.when(F.col("_column") == v, F.col("quantiles"))).alias(v) for v in values]
    return found.groupBy(*keys).agg(*cells)


def _by_brackets(
    long: DataFrame, wanted: DataFrame, groups: list[str], probs: Sequence[float], reach: float, per_slice: int, most: int
) -> DataFrame:
    """(groups, quantiles) of the groups in ``wanted``, the largest of which has ``most`` values."""
    found, asked = None, list(enumerate(probs))
    while True:
        parts = max(1, -(-int(2 * reach * most) // per_slice))
        counts = sized(_bracketed(long, wanted, groups, asked, reach, parts), "brackets")
        hits = _ranked(counts, groups)
        found = hits if found is None else found.unionByName(hits)
        below, upto = F.sum(F.when(F.col("slice") < 0, F.col("c")).otherwise(0)), F.sum("c")
        missed = counts.groupBy(*groups, "i", "at").agg(below.alias("below"), upto.alias("upto"))
        missed = missed.where((F.floor("at") < F.col("below")) | (F.ceil("at") >= F.col("upto")))
        if reach >= 1 or missed.isEmpty():
            break
        missed = sized(missed.select(*groups, "i"), "missed")
        again = {r["i"] for r in missed.select("i").distinct().collect()}
        asked = [(i, p) for i, p in asked if i in again]
        wanted, reach = wanted.join(missed.select(*groups).distinct(), groups, "left_semi"), 8 * reach
    # A place that was found may have been looked up again for the sake of others; the value is the same.
    found = found.groupBy(*groups, "i").agg(F.max("q").alias("q"))
    in_order = F.array_sort(F.collect_list(F.struct("i", "q")))
    return found.groupBy(*groups).agg(F.transform(in_order, lambda x: x["q"]).alias("quantiles"))


def _bracketed(
    long: DataFrame, wanted: DataFrame, groups: list[str], asked: Sequence[tuple[int, float]], reach: float, parts: int
) -> DataFrame:
    """(groups, i, at, slice, v, c): rows below the bracket of each wanted place (slice -1) and, by value, those in it.

    A bracket is a list of edges; the first and the last belong to it, and the ends of the whole
    column are its least and largest value.
    """
    brackets = []
    for i, p in asked:
        low, high = max(p - reach, 0.0), min(p + reach, 1.0)
        edges = _points("sketch", [min(1.0, low + (high - low) * k / parts) for k in range(parts + 1)])
        brackets.append(F.struct(F.lit(i).alias("i"), _place(p).alias("at"), edges.alias("edges")))
    brackets = wanted.select(*groups, F.array(*brackets).alias("asked"))
    met = long.where(F.col("_v").isNotNull() & ~F.isnan("_v")).join(brackets, groups)
    met = met.select(*groups, "_v", F.inline("asked")).where(F.col("_v") <= F.element_at("edges", -1))
    below = F.col("_v") < F.col("edges")[0]
    inner = F.slice("edges", F.lit(2), F.greatest(F.size("edges") - 2, F.lit(0)))
    place = F.when(below, -1).otherwise(F.size(F.filter(inner, lambda e: e < F.col("_v"))))
    counts = met.select(*groups, "i", "at", place.alias("slice"), F.when(~below, F.col("_v")).alias("v"))
    return counts.groupBy(*groups, "i", "at", "slice", "v").agg(F.count(F.lit(1)).alias("c"))


def _place(p: float) -> Column:
    return (F.col("n") - 1) * F.lit(float(p))


def _ranked(counts: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, i, q): the quantile of each wanted place that its bracket holds."""
    over = Window.partitionBy(*groups, "i").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.groupBy(*groups, "i", "at", "slice").agg(F.sum("c").alias("n"))
    starts = starts.withColumn("start", F.coalesce(F.sum("n").over(over), F.lit(0)))
    starts = starts.withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))))
    holding = starts.where((F.col("slice") >= 0) & (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("n")))
    # One row per rank that is there, and only the values of its slice are put in order.
    holding = holding.select(*groups, "i", "slice", "start", "rank")
    inside = Window.partitionBy(*groups, "i", "slice", "rank").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    hits = counts.join(holding, [*groups, "i", "slice"])
    hits = hits.withColumn("first", F.col("start") + F.coalesce(F.sum("c").over(inside), F.lit(0)))
    hits = hits.where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("c")))
    found = hits.groupBy(*groups, "i", "at").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("ranks"))
    share = F.col("at") - F.floor("at")
    # Equal ends stand for themselves, also where they are infinite.
    between = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("low") * (1 - share) + F.col("high") * share)
    whole = F.col("ranks") == F.when(share == 0, 1).otherwise(2)
    return found.where(whole).select(*groups, "i", between.alias("q"))


def quantile_scalars(df: DataFrame, value: str, probs: Sequence[float], **kw) -> list[Column]:
    """Quantiles of a whole column as expressions (one shared scalar subquery)."""
    cuts = exact_quantiles(df, value, probs, **kw).select(value).scalar()
    return [cuts[i] for i in range(len(probs))]


def approximate_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """The one-pass estimate, for callers who do not need the exact value."""
    return df.groupBy(*keys).agg(F.approx_percentile(value, list(probs), accuracy).alias("quantiles"))
