"""Cleaning raw readings, and the audit of what cleaning changed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import vocab
from tidemark.functions.expressions import changed, flag, parse_timestamp, strip_text
from tidemark.operators.bounds import sized
from tidemark.operators.ranks import exact_quantiles
from tidemark.session import materialize
from tidemark.sources.readers import ORDER_COLUMN, require_columns


def strip_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: strip_text(c) for c in columns})


def lower_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.lower(c) for c in columns})


def parse_time(df: DataFrame, column: str = "date_time", formats: Sequence[str] = ()) -> DataFrame:
    """Text to timestamp; what cannot be read becomes null."""
    return df.withColumn(column, parse_timestamp(column, formats))


def time_range(df: DataFrame, column: str = "date_time") -> DataFrame:
    return df.agg(F.min(column).alias("first_time"), F.max(column).alias("last_time"))


def drop_exact_duplicates(df: DataFrame, order: str = ORDER_COLUMN) -> DataFrame:
    """One row per distinct content, keeping the earliest place."""
    content = [c for c in df.columns if c != order]
    return df.groupBy(*content).agg(F.min(order).alias(order)).select(*df.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: str = ORDER_COLUMN) -> DataFrame:
    """The row of smallest ``order`` of every key; missing keys are one group.

    ``order`` is a fixed-width column that tells the rows of a key apart. Only it and the keys are
    aggregated, in hash tables of map tasks, so a key that holds a third of the table is one row per
    task; its place then picks the whole row. The places are stored: while they are small they are
    broadcast and no other row moves, beyond that rows meet them by key and place, of which
    no value is hot. ``df`` is read twice.
    """
    own = {c: f"_first_{c}" for c in (*keys, order)}
    places = df.groupBy(*keys).agg(F.min(order).alias(order)).withColumnsRenamed(own)
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(n)) for c, n in own.items()])
    return df.join(sized(places, "places"), same, "left_semi")


def conflicts(df: DataFrame, key: str = "date_time", value: str = "traffic_volume") -> DataFrame:
    """Keys that repeat with different values: one row per key and value.

    Long form on purpose. A list of values per key would grow with the key.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(key, value).agg(F.count("*").alias("value_rows"))
    split = counts.groupBy(key).agg(
        F.sum("value_rows").alias("n_rows"), F.count(value).alias("n_values")
    ).where("n_values > 1")
    return counts.join(split, key).where(F.col(value).isNotNull())


def null_where(df: DataFrame, bad: dict[str, Column]) -> DataFrame:
    """Blank the cells whose condition holds; a missing condition leaves them."""
    return df.withColumns({c: F.when(~F.coalesce(test, F.lit(False)), F.col(c)) for c, test in bad.items()})


def impossible_readings() -> dict[str, Column]:
    """The preset's rules: temperature at or below zero kelvin, rain above 1000 mm."""
    return {
        "temp": F.col("temp") <= vocab.MIN_TEMP_EXCLUSIVE,
        "rain_1h": F.col("rain_1h") > vocab.MAX_RAIN_INCLUSIVE,
    }


def fill_group_median(df: DataFrame, columns: Sequence[str], group: Column, **kw) -> DataFrame:
    """Fill missing cells with the exact median of their group.

    A group without any value stays missing, and so does a row without a group.
    The medians are stored, so that the join knows their size.
    """
    marked = df.withColumn("_group", group)
    medians = exact_quantiles(marked, list(columns), [0.5], ["_group"], **kw)
    medians = sized(medians.select("_group", *[F.col(c)[0].alias(f"_{c}") for c in columns]))
    filled = marked.join(medians, "_group", "left")
    return filled.withColumns({c: F.coalesce(c, f"_{c}") for c in columns}).select(*df.columns)


def standardise_text(df: DataFrame) -> DataFrame:
    out = strip_columns(df, ["weather_main", "weather_description"])
    return lower_columns(out, ["weather_description"])


def clean(raw: DataFrame, order: str = ORDER_COLUMN, keys: Sequence[str] = (), **kw) -> DataFrame:
    """Raw readings to one checked row per hour, and per ``keys`` where the table holds many sensors.

    Taking the first row per timestamp also removes exact duplicates (they share the
    timestamp), so the raw rows are read twice and nothing but times and places is shuffled
    (see ``first_per_key``). The hours that remain are written to the shared folder, because the
    medians and the fill both read them.
    """
    out = (
        require_columns(raw)
        .transform(standardise_text)
        .transform(parse_time)
        .transform(first_per_key, [*keys, "date_time"], order)
        .transform(null_where, impossible_readings())
    )
    hours = materialize(out.drop(order), "hours")
    return fill_group_median(hours, ["temp", "rain_1h"], F.month("date_time"), **kw)


# --- audit -------------------------------------------------------------------
def _long(step: str, row: DataFrame, key: str | None = None) -> DataFrame:
    """Counts of a table as (step, metric, key, value) rows."""
    names = [c for c in row.columns if c != key]
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("long").alias("value")) for n in names])
    keyed = row.select(
        F.lit(step).alias("step"),
        (F.col(key).cast("string") if key else F.lit("")).alias("key"),
        F.explode(pairs).alias("m"),
    )
    return keyed.select("step", "m.metric", "key", "m.value")


def audit(raw: DataFrame, order: str = ORDER_COLUMN) -> DataFrame:
    """What cleaning does to ``raw``, counted: (step, metric, key, value).

    A text cell that is missing before and after does not count as changed. One scan of ``raw``
    fills a stored table with a row per time and content (as 128 bits of hash), its copies, first
    place and sums of what was changed; all counts follow from that table. The sums travel in the rows of
    an aggregate and not as counters of tasks, which a lost executor would count twice.
    """
    text = ["weather_main", "weather_description"]
    stripped = {c: strip_text(c) for c in text}
    lowered = F.lower(stripped["weather_description"])
    parsed = parse_timestamp("date_time")
    bad = impossible_readings()

    read = {
        "holiday_missing": F.col("holiday").isNull(),
        **{f"{c}_trimmed": changed(c, stripped[c]) for c in text},
        "weather_description_lowered": changed(stripped["weather_description"], lowered),
        "date_time_unparsed": parsed.isNull() & F.col("date_time").isNotNull(),
    }
    marks = {m: flag(test).cast("long").alias(f"_{m}") for m, test in read.items()}
    words = [F.xxhash64(stripped["weather_description"]).alias("_before"), F.xxhash64(lowered).alias("_after")]
    tidy = raw.select("*", *marks.values(), *words, stripped["weather_description"].isNull().alias("_no_words"))
    tidy = tidy.transform(standardise_text).transform(parse_time)
    content = [c for c in raw.columns if c != order]
    # Seeds of their own make the two hashes differ; missing cells are marked, not skipped.
    cells = [F.struct(F.col(c).isNull(), F.col(c)) for c in content]
    hashes = {f"_h{i}": F.xxhash64(F.lit(i), *cells) for i in (1, 2)}
    whole = ["date_time", "traffic_volume", *bad, *hashes]
    copies = tidy.withColumns(hashes).groupBy(*whole, "_before", "_after", "_no_words").agg(
        F.count(F.lit(1)).alias("n"), F.min(order).alias("place"), *[F.sum(f"_{m}").alias(m) for m in read]
    )
    copies = sized(copies, "audit")

    known = ~F.col("_no_words")
    counts = copies.agg(
        F.sum("n").alias("rows_loaded"), *[F.sum(m).alias(m) for m in read],
        F.countDistinct(F.when(known, F.col("_before"))).alias("descriptions_before"),
        F.countDistinct(F.when(known, F.col("_after"))).alias("descriptions_after"),
    )
    contents = copies.groupBy(*whole).agg(F.sum("n").alias("n"), F.min("place").alias("place"))
    first = [F.min_by(c, "place").alias(c) for c in bad]
    per_value = contents.groupBy("date_time", "traffic_volume").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("n") - 1).alias("again"), *first, F.min("place").alias("place")
    )
    per_time = per_value.groupBy("date_time").agg(
        F.sum("n").alias("n"), F.sum("again").alias("again"), F.count("traffic_volume").alias("volumes"), *first
    )
    real = F.col("date_time").isNotNull()
    tests = {c: F.coalesce(test, F.lit(False)) for c, test in bad.items()}
    # One row per month of the year (or none), with all that is left to know.
    months = per_time.groupBy(F.month("date_time").alias("month")).agg(
        F.sum("again").alias("exact_duplicates"),
        F.count_if(real & (F.col("n") > 1)).alias("duplicate_hours"),
        F.count_if(real & (F.col("n") > 1) & (F.col("volumes") > 1)).alias("conflicting_hours"),
        F.sum(F.col("n") - 1).alias("repeat_rows_removed"),
        F.count(F.lit(1)).alias("rows_kept"),
        *[F.count_if(test).alias(f"{c}_invalid") for c, test in tests.items()],
        *[F.count_if(test | F.col(c).isNull()).alias(f"{c}_missing") for c, test in tests.items()],
        *[F.count_if(~test & F.col(c).isNotNull()).alias(f"{c}_valid") for c, test in tests.items()],
    )
    months = sized(months, "audit-months")
    exact = months.agg(F.sum("exact_duplicates").alias("exact_duplicates"))
    hours = ["duplicate_hours", "conflicting_hours", "repeat_rows_removed", "rows_kept"]
    repeats = months.agg(*[F.sum(m).alias(m) for m in hours])
    invalid = months.agg(*[F.sum(f"{c}_invalid").alias(f"{c}_invalid") for c in bad])
    # A month is filled only if it has a value to take the median of.
    filled = months.where("month is not null").select(
        "month", *[F.when(F.col(f"{c}_valid") > 0, F.col(f"{c}_missing")).otherwise(0).alias(f"{c}_filled") for c in bad]
    )
    parts = [
        _long("read", counts),
        _long("duplicates", exact),
        _long("duplicates", repeats),
        _long("invalid", invalid),
        _long("filled", filled, "month").where("value > 0"),
    ]
    return reduce(DataFrame.unionByName, parts)
