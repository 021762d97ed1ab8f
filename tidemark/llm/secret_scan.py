"""Secret scans over a trigram inverted index, in DataFrame expressions only.

1. Each rule's regex gives a Boolean query over lower-case trigrams that any match must hold
   (``trigram_query``): an OR of ANDs, or none where nothing is mandatory.
2. ``postings`` is the inverted index of those trigrams: one row (trigram, row key) per text
   that has it, read off in one scan.
3. ``candidates`` intersects the postings of each AND and unites the ANDs of each rule.
4. ``find`` joins the candidates back and runs each regex on its candidates only; rules without
   mandatory trigrams scan every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Matches, leftmost and non-overlapping; a match whose ``group`` is under ``least`` drops."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules, then the common shapes of issued keys. A run of hex digits is
# matched whole or not at all, so its least length stands in the pattern.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("payment_key", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
)
RULES = BASE + MORE

Terms = list[frozenset[str]]


def _grams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def _least(terms: Terms) -> Terms:
    """Without terms that ask more than another one does."""
    return [t for t in set(terms) if not any(o < t for o in terms)]


def trigram_query(pattern: str) -> Terms:
    """The trigrams of any match, lower-cased: it has all of at least one of these sets.

    A set may be empty, which says nothing is mandatory. Stretches of the pattern that spell a
    few strings give the trigrams of those strings; what repeats or ranges freely gives none.
    """
    most = 64

    def spelled(node) -> set[str] | None:
        op, arg = str(node[0]), node[1]
        if op == "LITERAL":
            return {chr(arg).lower()}
        if op == "IN" and len(arg) <= 8 and all(str(x[0]) == "LITERAL" for x in arg):
            return {chr(x[1]).lower() for x in arg}
        if op == "SUBPATTERN":
            return sequence(arg[-1])
        if op == "BRANCH":
            parts = [sequence(x) for x in arg[1]]
            return set().union(*parts) if all(p is not None for p in parts) else None
        if op == "MAX_REPEAT" and arg[1] <= 1:
            inner = sequence(arg[2])
            return None if inner is None else inner if arg[0] else inner | {""}
        return None

    def sequence(nodes) -> set[str] | None:
        out = {""}
        for node in nodes:
            part = spelled(node)
            if part is None or len(out) * len(part) > most:
                return None
            out = {a + b for a in out for b in part}
        return out

    def both(a: Terms, b: Terms) -> Terms:
        return _least([x | y for x in a for y in b])

    def need(nodes) -> Terms:
        terms, run = [frozenset()], {""}
        for node in nodes:
            part = spelled(node)
            if part is not None and len(run) * len(part) <= most:
                run = {a + b for a in run for b in part}
                continue
            terms, run = both(terms, _least([_grams(s) for s in run])), {""}
            op, arg = str(node[0]), node[1]
            if op == "SUBPATTERN":
                terms = both(terms, need(arg[-1]))
            elif op == "BRANCH":
                terms = both(terms, _least([t for x in arg[1] for t in need(x)]))
            elif op == "MAX_REPEAT" and arg[0] > 0:
                terms = both(terms, need(arg[2]))
        return both(terms, _least([_grams(s) for s in run]))

    return need(re._parser.parse(pattern))


def _queries(rules: tuple[Rule, ...]) -> dict[int, Terms]:
    """By the rule's place, for the rules that have mandatory trigrams."""
    found = {i: trigram_query(r.pattern) for i, r in enumerate(rules)}
    return {i: terms for i, terms in found.items() if all(terms)}


def row_key(key: str, text: str) -> Column:
    """The same for equal rows; shared by others only by chance, which adds candidates, no matches."""
    return F.xxhash64(F.col(key), F.col(text))


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The inverted index: (trigram, row) for each trigram that the rules ask for."""
    grams = sorted({g for terms in _queries(rules).values() for t in terms for g in t})
    rows = docs.select(row_key(key, text).alias("row"), F.lower(F.col(text)).alias("_low"))
    there = F.array_compact(F.array(*[F.when(F.col("_low").contains(g), F.lit(g)) for g in grams]))
    return rows.select("row", F.explode(there).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(row, rules): the rows that hold what a rule asks for, rules as bits by place.

    The query table (a row per rule, AND and trigram) is fixed by the rules, so it is broadcast.
    An AND holds when the bits of all its trigrams are there.
    """
    asked = [
        (g, k, 1 << i, 1 << b, (1 << len(t)) - 1)
        for i, terms in _queries(rules).items()
        for k, t in enumerate(sorted(map(sorted, terms)))
        for b, g in enumerate(t)
    ]
    row = lambda x: F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(x, fields)])
    fields = [("trigram", "string"), ("term", "int"), ("rule", "long"), ("bit", "long"), ("all", "long")]
    query = index.sparkSession.range(1).select(F.inline(F.array(*map(row, asked))))
    met = (
        index.join(F.broadcast(query), "trigram")
        .groupBy("row", "rule", "term", "all")
        .agg(F.bit_or("bit").alias("has"))
        .where(F.col("has") == F.col("all"))
    )
    return met.groupBy("row").agg(F.bit_or("rule").alias("rules"))


def _before(lengths: Column) -> Column:
    """Sums of all earlier entries. In blocks: an array that grows entry by entry is copied each time."""
    grow = lambda acc, x: F.struct((acc["s"] + x).alias("s"), F.concat(acc["a"], F.array(acc["s"])).alias("a"))
    none = F.struct(F.lit(0).alias("s"), F.array().cast("array<int>").alias("a"))
    size = 256
    starts = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / size).cast("int"))
    blocks = F.transform(starts, lambda b: F.aggregate(F.slice(lengths, b * size + 1, F.lit(size)), none, grow))
    shift = lambda acc, x: F.struct(
        (acc["s"] + x["s"]).alias("s"), F.concat(acc["a"], F.array(F.transform(x["a"], lambda v: v + acc["s"]))).alias("a")
    )
    start = F.struct(F.lit(0).alias("s"), F.array().cast("array<array<int>>").alias("a"))
    return F.flatten(F.aggregate(blocks, start, shift)["a"])


def find(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans): every match of every rule, by start and then the rules' order.

    Positions are code points, ends exclusive. A null text is an empty one and has no spans;
    rows that repeat are found each; a null key is kept. Other columns are not read. No rows
    give no rows. A text holding the two marker characters U+0001 and U+0002 is scanned with
    U+0003 in their place, which no rule matches.
    """
    found = candidates(postings(docs, rules, key, text), rules)
    texts = docs.select(
        F.col(key).alias("doc_id"), row_key(key, text).alias("row"),
        F.translate(F.coalesce(F.col(text), F.lit("")), "\x01\x02", "\x03\x03").alias("_text"),
    )
    rows = texts.join(found, "row", "left")
    asked = _queries(rules)
    pieces, lengths, starts, spans = [], [], [], []
    for i, r in enumerate(rules):
        cut = F.split(F.regexp_replace("_text", r.pattern, "\x01$0\x02"), "\x01")
        if i in asked:
            cut = F.when(F.getbit(F.coalesce(F.col("rules"), F.lit(0)), F.lit(i)) == 1, cut)
        pieces.append(cut.alias(f"_p{i}"))
        # The text before the first match counts whole; a later piece is a match, a mark and what follows.
        whole = F.transform(f"_p{i}", lambda p, k: F.length(p) - F.when(k > 0, 1).otherwise(0))
        lengths.append(F.coalesce(whole, F.array().cast("array<int>")).alias(f"_l{i}"))
        starts.append(F.when(F.size(f"_l{i}") > 1, _before(F.col(f"_l{i}"))).alias(f"_s{i}"))
        spans.append(_spans(f"_p{i}", f"_s{i}", i, r))
    rows = rows.select("doc_id", *pieces)
    rows = rows.select("*", *lengths)
    rows = rows.select("*", *starts)
    ordered = F.array_sort(F.concat(*spans))
    return rows.select("doc_id", ordered.alias("_all")).select(
        "doc_id", F.transform("_all", lambda x: F.struct(x["kind"], x["start"], x["end"])).alias("spans")
    )


def _spans(pieces: str, starts: str, place: int, rule: Rule) -> Column:
    """(start, place, end, kind) of the matches that hold, from the cut text."""
    def long_enough(x: Column) -> Column:
        part = F.regexp_extract(x["m"], rule.pattern, rule.group) if rule.group else x["m"]
        return F.length(part) >= rule.least

    def span(x: Column) -> Column:
        end = x["s"] + F.length(x["m"])
        return F.struct(x["s"].alias("start"), F.lit(place).alias("place"), end.alias("end"), F.lit(rule.kind).alias("kind"))

    zipped = F.zip_with(pieces, starts, lambda p, s: F.struct(F.substring_index(p, "\x02", 1).alias("m"), s.alias("s")))
    made = F.transform(F.filter(F.slice(zipped, 2, F.size(starts)), long_enough), span)
    return F.coalesce(made, F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>"))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
