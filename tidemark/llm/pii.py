"""Personal data and the terms that give it away, by how much they tell of a protected entity.

Mail addresses, numbers of networks, cards and phones are found by pattern. Each of their values
is a protected entity. Over the whole corpus, the words near an entity are counted against all
words: the pointwise mutual information of a term and an entity, over the information content of
the entity, is the share of the entity that the term discloses: 1 if the term is seen nowhere
else, 0 if it is as common elsewhere. How sure that is follows from how often the term was seen: a lower
confidence bound of the rate at which it stands near the entity. Near the entity, terms above a
threshold are replaced by a more general one, and those above higher thresholds are removed. The more
general term is the smallest class of words with the same ending whose own share, by the same
counts, is below the threshold.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import attach, unused
from tidemark.session import materialize, ship_code

KINDS = ("email", "ip", "card", "phone")
#: Words on either side of an entity that count as near it.
WINDOW = 12
#: Different surroundings from which on a term counts as often seen near an entity (``coverage``).
LEAST_CONTEXTS = 3
#: Shares from which on a term is generalised or removed, and the lower bounds (one-sided, 95 %) of the
#: rate at which it stands near the entity that are asked for besides. One sighting, and none
#: elsewhere, gives a bound of 0.27, two give 0.43 and three 0.53, in a corpus of any size.
GENERALISE = 0.8
REMOVE = 0.95
SURE_ENOUGH = 0.25
SURE = 0.5
_Z = 1.645
#: Letters of an ending, longest class last.
ENDINGS = (4, 3, 2, 1)

# The base patterns. Possessive and bound to the start of a digit run, they find
# what the plain forms find, in time that follows the text's length.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = regex.compile(r"[\p{L}\p{N}]+")
_BREAK = re.compile(r"\n|[.!?]+(?=\s)")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns: by kind as listed, then by start."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if at >= last and start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            last = m.end()
        at = text.find("@", at + 1)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def mentions(text: str, spans: list[tuple[str, int, int]]) -> Iterator[dict]:
    """Each entity with the terms near it: words of its sentence, outside all spans, ``WINDOW`` on a side."""
    if not spans:
        return
    breaks = [0, *[m.end() for m in _BREAK.finditer(text)], len(text)]
    covered = sorted((s, e) for _, s, e in spans)
    by_sentence: dict[int, list[tuple[str, int, int]]] = {}
    for kind, s, e in spans:
        by_sentence.setdefault(bisect.bisect_right(breaks, s) - 1, []).append((kind, s, e))
    for k, found in by_sentence.items():
        low, high = breaks[k], breaks[min(k + 1, len(breaks) - 1)]
        words = []
        for m in _WORD.finditer(text, low, max(high, low)):
            i = bisect.bisect_left(covered, (m.start(), m.end()))
            near = covered[max(0, i - 2):i + 1]
            if len(m[0]) > 1 and not any(s < m.end() and m.start() < e for s, e in near):
                words.append((m.start(), m.end(), m[0].lower()))
        starts = [w[0] for w in words]
        for kind, s, e in found:
            i = bisect.bisect_left(starts, s)
            around = words[max(0, i - WINDOW):i + WINDOW]
            value = text[s:e].lower() if kind == "email" else text[s:e] if kind == "ip" else _digits(text[s:e])
            yield {
                "entity": f"{kind}:{value}", "context": hash_of(" ".join(w[2] for w in around)),
                "terms": [{"term": t, "start": a, "end": b} for a, b, t in around],
            }


def hash_of(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode()) - 2**63


_SPANS = "array<struct<kind:string,start:int,end:int>>"
_ALL_SPANS = "array<struct<kind:string,start:int,end:int,general:string>>"
_MENTIONS = "array<struct<entity:string,context:long,terms:array<struct<term:string,start:int,end:int>>>>"


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, h, spans, mentions) per row of ``docs``; ``h`` is a hash of the text."""
    ship_code(docs.sparkSession)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    term = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    mention = pa.list_(pa.struct([("entity", pa.string()), ("context", pa.int64()), ("terms", term)]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = part.column(2).to_pylist()
                found = [base_spans(t) for t in texts]
                spans = pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in f] for f in found], span)
                near = pa.array([list(mentions(t, f)) for t, f in zip(texts, found)], mention)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), spans, near], ["doc_id", "h", "spans", "mentions"])

    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("h"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(task, f"doc_id {dict(docs.dtypes)[key]}, h long, spans {_SPANS}, mentions {_MENTIONS}")


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term, n) over all texts: counted per batch by vectorised functions, then summed."""
    ship_code(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain = pc.replace_substring_regex(pc.utf8_lower(batch.column(0)), r"[^\pL\pN]+", " ")
            found = pc.value_counts(pc.split_pattern(plain, " ").flatten())
            yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["term", "n"])

    rows = docs.where(F.col(text).isNotNull()).select(F.col(text).alias("text"))
    return rows.mapInArrow(task, "term string, n long").where("length(term) > 1").groupBy("term").agg(F.sum("n").alias("n"))


def sureness(near: Column, elsewhere: Column) -> Column:
    """Lower bound (Wilson) of the rate at which a term stands near an entity: ``near`` surroundings against occurrences ``elsewhere``."""
    n = (near + elsewhere).cast("double")
    rate, z2 = near / n, _Z * _Z
    return (rate + z2 / (2 * n) - _Z * F.sqrt(rate * (1 - rate) / n + z2 / (4 * n * n))) / (1 + z2 / n)


def disclosures(scanned: DataFrame, counts: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """(entity, term, n, contexts, share, sure, action, general): terms that disclose an entity, however rare it is.

    With N words in the corpus, n(t) of them t, c(e) of them near e and n(e, t) both:
    PMI = log(n(e, t) N / (n(t) c(e))), IC = log(N / c(e)), share = PMI / IC.
    ``sure`` is the lower bound of the rate k / (k + n(t) - n(e, t)), k being the different
    surroundings of e with t (repeated text is one).

    A term is generalised with a share of at least ``generalise`` and a bound of ``SURE_ENOUGH``,
    and removed with ``remove`` and ``SURE``; so a single sighting generalises and never removes.
    ``general`` is the ending of the class that takes the term's place, null where only all words are
    general enough.
    """
    near = scanned.select(F.explode("mentions").alias("m")).select("m.entity", "m.context", F.explode("m.terms.term").alias("term"))
    # Surroundings first: a pair's rows shrink to one per surroundings before they are counted.
    witnessed = near.groupBy("entity", "term", "context").agg(F.count(F.lit(1)).alias("n"))
    pairs = materialize(witnessed.groupBy("entity", "term").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("contexts")), "pii-pairs")
    words = float(max(counts.agg(F.sum("n")).first()[0] or 0, 1))
    of_entity = pairs.groupBy("entity").agg(F.sum("n").alias("c"), F.count(F.lit(1)).alias("_rows"))
    of_term = pairs.groupBy("term").agg(F.count(F.lit(1)).alias("_rows"))
    of_term = of_term.join(counts.select(F.col("term").alias("_t"), F.col("n").alias("_all")), F.col("term") == F.col("_t"), "left")
    # Common terms are near many entities, and some entities have many terms: neither may be one task's.
    total = pairs.count()
    known = materialize(attach(pairs, materialize(of_entity, "pii-entities"), ["entity"], "_rows", total).drop("_rows"), "pii-known")
    known = attach(known, materialize(of_term.select("term", "_rows", "_all"), "pii-near"), ["term"], "_rows", total)
    everywhere = F.greatest(F.coalesce("_all", F.lit(0)), "n")
    told = known.select(
        "entity", "term", "n", "contexts", "c", _share(F.col("n"), everywhere, F.col("c"), words).alias("share"),
        sureness(F.col("contexts"), everywhere - F.col("n")).alias("sure"),
    )
    action = F.when((F.col("share") >= remove) & (F.col("sure") >= SURE), "remove").otherwise("generalise")
    told = told.where((F.col("share") >= generalise) & (F.col("sure") >= SURE_ENOUGH)).withColumn("action", action)
    return _generalised(materialize(told, "pii-told"), pairs, counts, words, generalise).drop("c")


def _share(n: Column, everywhere: Column, c: Column, words: float) -> Column:
    content = F.log(F.greatest(F.lit(words), c + 1.0) / c)
    return F.least(F.log(n * words / (everywhere * c)) / content, F.lit(1.0))


def _endings(df: DataFrame, *keep: str) -> DataFrame:
    """A row per class of the term: its last letters, while they are not the whole term."""
    parts = [F.when(F.length("term") > k, F.right("term", F.lit(k))) for k in ENDINGS]
    return df.select(*keep, F.explode(F.array_compact(F.array(*parts))).alias("ending"))


def _generalised(told: DataFrame, pairs: DataFrame, counts: DataFrame, words: float, generalise: float) -> DataFrame:
    """``told`` with ``general``, the longest ending whose class of words discloses the entity less than the threshold."""
    asked = materialize(_endings(told, "entity", "c", "term"), "pii-endings")
    needed = asked.groupBy("ending").agg(F.count(F.lit(1)).alias("_rows"))
    everywhere = _endings(counts, "n").groupBy("ending").agg(F.sum("n").alias("_all"))
    of_class = materialize(needed.join(everywhere, "ending"), "pii-classes")
    found = materialize(attach(asked, of_class, ["ending"], "_rows", asked.count()).drop("_rows"), "pii-class-counts")
    # Only entities with told terms have classes to look at.
    close = pairs.join(told.select("entity").distinct(), "entity", "left_semi")
    close = _endings(close, "entity", "n").groupBy("entity", "ending").agg(F.sum("n").alias("_near"))
    share = _share(F.col("_near"), F.greatest("_all", "_near"), F.col("c"), words)
    fit = found.join(close, ["entity", "ending"]).where(share < generalise)
    best = fit.groupBy("entity", "term").agg(F.max_by("ending", F.length("ending")).alias("general"))
    return told.join(best, ["entity", "term"], "left")


def coverage(scanned: DataFrame, told: DataFrame) -> DataFrame:
    """(kind, seen, entities, reached, generalised, removed): what the disclosing terms cover.

    ``seen`` is in how many different surroundings the entities are, ``LEAST_CONTEXTS`` standing for
    that or more; ``reached`` are those with at least one term, the last two count their terms.
    """
    of_entity = scanned.select(F.explode("mentions").alias("m")).select("m.entity", "m.context").distinct().groupBy("entity").count()
    terms = told.groupBy(F.col("entity").alias("_e")).agg(*[F.count_if(F.col("action") == a).alias(a) for a in ("generalise", "remove")])
    rows = of_entity.join(terms, F.col("entity") == F.col("_e"), "left")
    kind, seen = F.substring_index("entity", ":", 1), F.least("count", F.lit(LEAST_CONTEXTS))
    return rows.groupBy(kind.alias("kind"), seen.alias("seen")).agg(
        F.count(F.lit(1)).alias("entities"), F.count("_e").alias("reached"),
        F.coalesce(F.sum("generalise"), F.lit(0)).alias("generalised"), F.coalesce(F.sum("remove"), F.lit(0)).alias("removed"),
    )


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", **thresholds) -> DataFrame:
    """(doc_id, h, spans) per row of ``docs``: base spans, then spans of disclosing terms.

    Spans are (kind, start, end, general): base kinds as listed, then ``generalise`` and ``remove``, each by
    start; positions are code points, ends exclusive; ``general`` is the ending of a generalised term's class. A null text is an empty one; rows that
    repeat are found each and count each as occurrences; null keys are kept; other columns are
    not read; no rows give no rows. Texts are read whole, however long, twice and never shuffled: what moves is counts
    of words, the surroundings of entities and the spans. A place that several entities generalise gets
    the shortest of their endings.
    """
    scanned = materialize(scan(docs, key, text), "pii-scan")
    told = materialize(disclosures(scanned, materialize(word_counts(docs, text), "pii-words"), **thresholds), "pii-terms")
    near = scanned.where(F.size("mentions") > 0).select("doc_id", "h", F.explode("mentions").alias("m"))
    near = near.select("doc_id", "h", "m.entity", F.explode("m.terms").alias("t"))
    near = near.select("doc_id", "h", "entity", F.col("t.term").alias("term"), F.col("t.start").alias("start"), F.col("t.end").alias("end"))
    hits = attach(near, told, ["entity", "term"], "n", near.count())
    ending = F.coalesce("general", F.lit(""))
    worst = hits.groupBy("doc_id", "h", "start", "end").agg(F.max("action").alias("kind"), F.min_by(ending, F.length(ending)).alias("general"))
    general = F.when(F.col("kind") == "generalise", F.col("general")).alias("general")
    added = worst.groupBy(F.col("doc_id").alias("_k"), F.col("h").alias("_h")).agg(
        F.array_sort(F.collect_list(F.struct("kind", "start", "end", general))).alias("_more")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_k")) & F.col("h").eqNullSafe(F.col("_h"))
    rows = scanned.select("doc_id", "h", "spans").join(added, same, "left")
    base = F.transform("spans", lambda x: F.struct(x["kind"], x["start"], x["end"], F.lit(None).cast("string").alias("general")))
    return rows.select("doc_id", "h", F.concat(base.cast(_ALL_SPANS), F.coalesce("_more", F.array().cast(_ALL_SPANS))).alias("spans"))


def written(spans: Column, general: bool = False) -> Column:
    """kind:start:end, comma-joined; with ``general``, and :ending."""
    parts = ["kind", "start", "end"]
    each = lambda x: F.concat_ws(":", *[x[p] for p in parts], *([F.coalesce(x["general"], F.lit(""))] if general else []))
    return F.array_join(F.transform(spans, each), ",")


def general_term(term: str, ending: str) -> str:
    """What takes a term's place: the ending of its class, or the kind of word it is."""
    return f"[-{ending}]" if ending else "[number]" if term.isdigit() else "[word]"


def cleaned(text: str, spans: str) -> str:
    """The text with base spans masked by kind, and disclosing terms generalised or removed.

    ``spans`` are as ``written`` with endings. Where they overlap, the one that starts first wins, and of
    those the longest; the rest of a losing span is masked with it.
    """
    out, at = [], 0
    parts = [p.split(":") for p in spans.split(",")] if spans else []
    for start, end, kind, ending in sorted((int(s), int(e), k, g) for k, s, e, g in parts):
        if end <= at:
            continue
        if start >= at:
            out.append(text[at:start])
            out.append({"generalise": general_term(text[start:end], ending), "remove": ""}.get(kind, f"[{kind}]"))
        at = end
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text", **thresholds) -> DataFrame:
    """``docs`` with sanitised texts; a null text stays null. All other columns are kept as they are, whatever their names.

    Rows that repeat stay as often as they are there; an empty table stays empty.
    """
    k, h, there = unused(docs, "_k", "_h", "_spans")
    spans = find(docs, key, text, **thresholds).where(F.size("spans") > 0)
    spans = spans.select(F.col("doc_id").alias(k), F.col("h").alias(h), written(F.col("spans"), general=True).alias(there))
    spans = spans.groupBy(k, h).agg(F.first(there).alias(there))

    @F.pandas_udf("string")
    def replaced(texts: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([t if f is None else cleaned(t, f) for t, f in zip(texts, found)], dtype=object)

    same = F.col(key).eqNullSafe(F.col(k)) & F.xxhash64(text).eqNullSafe(F.col(h))
    return docs.join(spans, same, "left").withColumn(text, replaced(text, there)).drop(k, h, there)
