"""Quality rules with host verdicts: rule failures per host, shrunk by a beta prior, joined back.

Everything is DataFrame expressions. Per text: word, symbol, line and repetition counts. Rules
that fail by themselves reject a document. Other rules have two bounds: a text beyond the outer
one fails anywhere; one between the two is left to its host, whose failure rate of that rule is
estimated as a beta posterior mean, with the prior fitted to all hosts. So a few
unlucky documents do not condemn a small host, and a host known for a fault gets no doubt.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, attach, unused, words_of
from tidemark.session import materialize

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
SYMBOLS = "#*$%&|<>"
#: A host whose shrunk rate of a rule is above this has that rule applied at its inner bound.
HOST_RATE = 0.3
#: Rows that the prior of a rule weighs, at least and at most.
LEAST_WEIGHT = 4.0
MOST_WEIGHT = 1000.0


@dataclass(frozen=True)
class Rule:
    """Fails where ``100 * part > outer * whole``; on a host convicted of it, ``inner`` counts."""

    name: str
    part: str
    whole: str
    outer: int
    inner: int


RULES = (
    Rule("symbols", "n_symbols", "n_words", 25, 10),
    Rule("dup_lines", "n_dup_lines", "n_lines", 60, 30),
    Rule("repeats", "n_repeat_words", "n_words", 50, 30),
    Rule("shouting", "n_upper", "word_chars", 50, 35),
)


def text_counts(text: Column) -> dict[str, Column]:
    """Counts that need no word windows."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike("[^\\x20\\x09-\\x0D]"))
    return {
        "word_chars": F.length(F.translate(text, SPACES, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "_lines": lines,
        "n_upper": F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long"),
    }


def repeat_words(windows: Column) -> Column:
    """Words in windows found twice or more; ``windows`` are (w, i), sorted.

    Equal windows are neighbours after sorting, so no window is compared with all others.
    """
    same = lambda x, i: (
        ((i > 0) & (F.get(windows, i - 1)["w"] == x["w"])) | F.coalesce(F.get(windows, i + 1)["w"] == x["w"], F.lit(False))
    )
    spots = F.flatten(F.transform(F.filter(windows, same), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    return F.size(F.array_distinct(spots)).cast("long")


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row of counts per row of ``docs``: key, host, a hash of the text and the counts, no text."""
    counts = text_counts(F.col(text))
    step = docs.select(
        F.col(key).alias("doc_id"), F.col(host).cast("string").alias("host"), F.xxhash64(text).alias("h"), words_of(F.col(text)).alias("_words"),
        *[c.alias(n) for n, c in counts.items()],
    )
    zipped = F.arrays_zip(
        F.col("_words").alias("a"), F.slice("_words", 2, F.size("_words")).alias("b"),
        F.slice("_words", 3, F.size("_words")).alias("c"),
    )
    step = step.withColumn("_zipped", zipped)
    windows = F.transform("_zipped", lambda x, i: F.struct(F.xxhash64(x).alias("h"), x.alias("w"), i.alias("i")))
    step = step.withColumn("_windows", F.array_sort(F.filter(windows, lambda x: x["w"]["c"].isNotNull())))
    return step.select(
        "doc_id", "host", "h", F.size("_words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("_windows")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"), "n_upper",
    )


def _fails(rule: Rule, bound: int) -> Column:
    return F.lit(100) * F.col(rule.part) > F.lit(bound) * F.col(rule.whole)


def host_rates(measured: DataFrame, rules: tuple[Rule, ...] = RULES, host_rate: float = HOST_RATE) -> DataFrame:
    """Per host: rows, failures of each rule at its inner bound, and the shrunk rates.

    The mean of a rule's beta prior is the failure rate of all rows; its weight, in rows, comes
    from how alike two rows of one host are. With f of n rows failing, f (f - 1) / (n (n - 1)) is
    an estimate of the squared rate of a host that is free of sampling noise. Averaged by rows over hosts of
    two rows or more, against the squared mean of these hosts, it gives the correlation r of two rows of a host,
    and the prior weighs 1 / r - 1 rows. Hosts of one row say nothing of r; no correlation gives
    ``MOST_WEIGHT``. While the mean is below ``host_rate``, the prior weighs enough that one failing
    row alone does not lift a host above it, and two that fail of two can.
    The prior is a handful of numbers on the driver.
    """
    n = F.col("host_rows")
    failed = {r.name: F.col(f"failed_{r.name}") for r in rules}
    hosts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("host_rows"),
        *[F.sum(_fails(r, r.inner).cast("long")).alias(f"failed_{r.name}") for r in rules],
    )
    hosts = materialize(hosts, "quality-hosts")
    several = n > 1
    prior = hosts.agg(
        F.sum(n).alias("rows"), F.sum(F.when(several, n)).alias("several"),
        *[F.sum(f).alias(f"all_{x}") for x, f in failed.items()],
        *[F.sum(F.when(several, f)).alias(f"some_{x}") for x, f in failed.items()],
        *[F.sum(F.when(several, f * (f - 1) / (n - 1))).alias(f"both_{x}") for x, f in failed.items()],
    ).first()
    for x, f in failed.items():
        mean = (prior[f"all_{x}"] or 0) / (prior["rows"] or 1)
        weight = prior_weight(prior["several"] or 0, prior[f"some_{x}"] or 0, prior[f"both_{x}"] or 0.0)
        if mean < host_rate:
            weight = min(MOST_WEIGHT, max(weight, 1.000001 * (1 - host_rate) / (host_rate - mean)))
        hosts = hosts.withColumn(f"rate_{x}", (f + F.lit(mean * weight)) / (n + F.lit(weight)))
    return hosts


def prior_weight(rows: int, failures: int, pairs: float) -> float:
    """Rows that a prior weighs: of hosts with two rows or more, their rows, failures and sum of f (f - 1) / (n - 1)."""
    rate = failures / rows if rows else 0.0
    spread = rate * (1 - rate)
    alike = (pairs / rows - rate * rate) / spread if spread > 0 else 0.0
    return MOST_WEIGHT if alike <= 0 else min(MOST_WEIGHT, max(LEAST_WEIGHT, 1 / alike - 1))


def judge(
    docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", rules: tuple[Rule, ...] = RULES,
    host_rate: float = HOST_RATE,
) -> DataFrame:
    """Verdict per row of ``docs``: counts, ``base_failed``, ``host_convicted`` and ``kept``; ``h`` is a hash of the text.

    A null text has no words and fails; a null host is one host. Rows that repeat are judged
    each. Columns of ``docs`` other than key, text and host are not read. An empty table gives
    no rows. Texts are read whole, once, however long; then only counts move. A host whose rate is
    exactly ``host_rate`` is not convicted.
    """
    measured = materialize(measure(docs, key, text, host), "quality-counts")
    total = measured.count()
    hosts = host_rates(measured, rules, host_rate)
    facts = hosts.select(
        "host", F.col("host_rows"), *[(F.col(f"rate_{r.name}") > host_rate).alias(f"convicted_{r.name}") for r in rules]
    )
    joined = attach(measured, facts, ["host"], "host_rows", total)
    base = (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PCT) * F.col("n_words"))
    failed = F.lit(False)
    for r in rules:
        failed = failed | _fails(r, r.outer) | (F.col(f"convicted_{r.name}") & _fails(r, r.inner))
    return (
        joined.withColumn("base_failed", base)
        .withColumn("host_convicted", F.array_compact(F.array(*[F.when(F.col(f"convicted_{r.name}"), F.lit(r.name)) for r in rules])))
        .withColumn("kept", ~base & ~failed)
        .drop(*[f"convicted_{r.name}" for r in rules])
    )


def keep(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", **rules) -> DataFrame:
    """``docs`` without the rows that ``judge`` rejects; rows equal in key, text and host share a verdict by content.

    A null text has no words and goes; null keys and hosts are values like others; every column of
    ``docs`` stays, whatever its name; an empty table stays empty.
    """
    k, h, place = unused(docs, "_k", "_h", "_host")
    good = judge(docs, key, text, host, **rules).where("kept")
    good = good.select(F.col("doc_id").alias(k), F.col("h").alias(h), F.col("host").alias(place))
    same = F.col(key).eqNullSafe(F.col(k)) & F.xxhash64(text).eqNullSafe(F.col(h))
    return docs.join(good, same & F.col(host).cast("string").eqNullSafe(F.col(place)), "left_semi")
