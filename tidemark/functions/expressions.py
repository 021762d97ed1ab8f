"""Column expressions. No function here starts a job or reads a table."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import vocab

ColumnLike = Column | str


def as_col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- text --------------------------------------------------------------------
def strip_text(c: ColumnLike) -> Column:
    """Cut white space at both ends (tabs and line ends too, unlike ``trim``)."""
    return F.regexp_replace(as_col(c), r"(?U)^\s+|\s+$", "")


def na_to_null(c: ColumnLike, tokens: Sequence[str] = tuple(vocab.NA_TOKENS)) -> Column:
    c = as_col(c)
    return F.when(~c.isin(*tokens), c)


def changed(before: ColumnLike, after: ColumnLike) -> Column:
    """True where a cell really changed; a missing cell that stays missing did not."""
    return ~as_col(before).eqNullSafe(as_col(after))


# --- time --------------------------------------------------------------------
def parse_timestamp(c: ColumnLike, formats: Sequence[str] = ()) -> Column:
    """Text to a zone-free timestamp, null where it is not one."""
    c = as_col(c)
    tries = [c.try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(*tries)


def hour_start(c: ColumnLike) -> Column:
    """Start of the hour as a zone-free timestamp, whatever the session zone."""
    c = as_col(c)
    return F.to_date(c).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(c))


def day_start(d: ColumnLike) -> Column:
    return F.to_date(as_col(d)).cast("timestamp_ntz")


def hour_number(c: ColumnLike) -> Column:
    """Whole hours since 1970-01-01, from calendar fields (no zone involved)."""
    c = as_col(c)
    return F.unix_date(F.to_date(c)).cast("long") * 24 + F.hour(c)


def micros_of(c: ColumnLike) -> Column:
    """Microseconds since 1970-01-01 of a zone-free timestamp."""
    c = as_col(c)
    second = hour_number(c) * 3600 + F.minute(c) * 60
    return second * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")


def monday_zero(c: ColumnLike) -> Column:
    return F.weekday(as_col(c))


def flag(condition: Column) -> Column:
    """0/1 integer; a missing condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def weekend_flag(ts: ColumnLike) -> Column:
    return flag(monday_zero(ts) >= 5)


def cyclic(c: ColumnLike, period: int) -> tuple[Column, Column]:
    """(sin, cos) of a position on a circle of ``period`` steps."""
    angle = F.lit(2 * math.pi) * as_col(c) / F.lit(period)
    return F.sin(angle), F.cos(angle)


# --- categories --------------------------------------------------------------
def one_hot(c: ColumnLike, categories: Iterable[str], prefix: str) -> list[Column]:
    """One 0/1 column per declared category; a missing value gives all zeros."""
    return [flag(as_col(c) == F.lit(v)).alias(f"{prefix}{v}") for v in categories]


def member_flag(c: ColumnLike, values: Iterable[str]) -> Column:
    return flag(as_col(c).isin(*values))


def lookup(c: ColumnLike, table: dict) -> Column:
    """Value of a small fixed table, null for a key it does not hold."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.create_map(*pairs)[as_col(c)]


def severity_rank(c: ColumnLike) -> Column:
    return lookup(c, vocab.SEVERITY)


def day_part(hour: ColumnLike) -> Column:
    """Name of the part of the day; upper bounds are inclusive."""
    out = None
    for upper, name in vocab.DAY_PARTS:
        test = as_col(hour) <= upper
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(vocab.LAST_DAY_PART)


def weather_group(c: ColumnLike) -> Column:
    """Five groups; anything unlisted, missing included, counts as Clear."""
    c = as_col(c)
    # --- fixed values: group names ---
    return (
        F.when(c.isin(*vocab.SEVERE), "Severe")
        .when(c.isin(*vocab.LOW_VISIBILITY), "LowVisibility")
        .when(c.isin(*vocab.PRECIPITATION), "Precipitation")
        .when(c == "Clouds", "Clouds")
        .otherwise("Clear")
    )


def day_label(is_weekend: ColumnLike) -> Column:
    return F.when(as_col(is_weekend) == 1, "Weekend").when(as_col(is_weekend) == 0, "Weekday")


# --- numbers -----------------------------------------------------------------
def zscore(c: ColumnLike, mean: Column, std: Column) -> Column:
    """(x - mean) / std, null where the deviation is zero or missing."""
    return F.try_divide(as_col(c).cast("double") - mean, std)


def banded(c: ColumnLike, cuts: Sequence[Column | float], labels: Sequence[str], missing: str) -> Column:
    """Label by ascending cut points; a value equal to a cut stays below it.

    ``missing`` names the band of a null value.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("one more label than cut points is needed")
    c = as_col(c)
    out = F.when(c.isNull(), missing)
    for cut, label in zip(cuts, labels):
        out = out.when(c <= (cut if isinstance(cut, Column) else F.lit(cut)), label)
    return out.otherwise(labels[-1])


def safe_ratio(num: ColumnLike, den: ColumnLike) -> Column:
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def nearest_point(features: Sequence[ColumnLike], centres: Sequence[Sequence[float]]) -> Column:
    """Index of the closest of a few fixed centres; the lower index wins ties."""
    distances = []
    for i, centre in enumerate(centres):
        total = F.lit(0.0)
        for f, x in zip(features, centre, strict=True):
            gap = as_col(f) - F.lit(float(x))
            total = total + gap * gap
        distances.append(F.struct(total.alias("d"), F.lit(i).alias("i")))
    return F.array_min(F.array(*distances))["i"]


# --- wording -----------------------------------------------------------------
def clock_text(hour: ColumnLike) -> Column:
    """12-hour clock: 0 and 24 -> 12:00 AM, 14 -> 2:00 PM."""
    h = F.pmod(as_col(hour).cast("int"), F.lit(24))
    face = F.when(h % 12 == 0, F.lit(12)).otherwise(h % 12)
    half = F.when(h < 12, F.lit("AM")).otherwise(F.lit("PM"))
    return F.concat(face.cast("string"), F.lit(":00 "), half)


def whole_text(c: ColumnLike) -> Column:
    """Rounded to a whole number as text; an exact half goes to the even side."""
    return F.rint(as_col(c)).cast("long").cast("string")
