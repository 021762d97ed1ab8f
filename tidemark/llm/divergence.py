"""How the vocabulary of each source departs from that of other sources of its language.

Texts are cut into terms by a translate table: one pass over the UTF-8 bytes lowers letters and
blanks separators, ``bytes.split`` gives the terms, and a Counter per document their frequencies.
Tasks add the Counters up per (language, source) before anything is shuffled. Shares are integers
in billionths, smoothed by one count, and the chi-square distance of two shares is an integer too,
so nothing depends on the order of sums.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import by_run, gathered
from tidemark.session import materialize, ship_code

#: Distinct (group, term) entries a task holds before it sends them on.
HELD = 300_000
#: Entries of a language that are compared in one run, and cells of its matrix at a time.
ENTRIES = 400_000
CELLS = 1_000_000
STRIP = 512
UNIT = 1_000_000_000

#: ASCII letters (lowered) and every byte of a longer character stay, the rest becomes a space.
TABLE = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters (lower case) and characters beyond ASCII."""
    return text.translate(TABLE).split()


def _flush(groups: dict[tuple, tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "term", "n", "docs"]
    for (lang, source), (n, docs) in groups.items():
        # A row without a term says that the group is there. Both Counters met their terms in one order.
        found = [None, *n]
        yield pa.RecordBatch.from_arrays(
            [
                pa.repeat(pa.scalar(lang, pa.string()), len(found)), pa.repeat(pa.scalar(source, pa.string()), len(found)),
                pa.array(found, pa.binary()).cast(pa.string()), pa.array([0, *n.values()], pa.int64()), pa.array([0, *docs.values()], pa.int64()),
            ],
            names,
        )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[tuple, tuple[Counter, Counter]] = {}
    held = 0
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
            document = Counter(terms(text.as_py()))
            n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
            before = len(n)
            for term, times in document.items():
                n[term] += times
            docs.update(document.keys())
            held += len(n) - before
            if held >= HELD:
                yield from _flush(groups)
                groups, held = {}, 0
    yield from _flush(groups)


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents per group and term.

    A row with a null term stands for each group, also for one without terms. Null text, language
    and source read as ''.
    """
    ship_code(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    partial = rows.mapInArrow(lambda batches: gathered(_count(batches)), "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: str | Column, total: str, kept: str) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + kept)), exact for any counts."""
    n = F.col(n) if isinstance(n, str) else n
    over, under = (n + 1).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)"), (F.col(total) + F.col(kept)).cast("decimal(20,0)")
    return (F.call_function("div", over, under) + 1).cast("long")


def _compare(run: pa.Table) -> pa.RecordBatch:
    """Sums over the run's terms for every ordered pair of sources of its language.

    The run has a row without a term per source, whose share is that of a term it lacks.
    """
    place = run["place"].to_numpy()
    source = run["source"].to_pylist()
    p = run["p"].to_numpy()
    first = place == 0
    base, names = p[first], [s for s, x in zip(source, first) if x]
    at = {s: i for i, s in enumerate(names)}
    column = np.array([at[s] for s in source], dtype=np.int64)[~first]
    p = p[~first]
    row = pc.dictionary_encode(run["term"].combine_chunks()).indices.to_numpy(zero_copy_only=False)[~first].astype(np.int64)
    order = np.argsort(row, kind="stable")
    row, column, p = row[order], column[order], p[order]
    high, width = int(row[-1]) + 1 if len(row) else 0, max(1, CELLS // len(names))
    out = []
    for low in range(0, len(names), STRIP):
        strip = slice(low, low + STRIP)
        sums = np.zeros((len(base[strip]), len(names)), dtype=np.int64)
        for start in range(0, high, width):
            a, b = np.searchsorted(row, (start, min(start + width, high)))
            q = np.tile(base, (min(width, high - start), 1))
            q[row[a:b] - start, column[a:b]] = p[a:b]
            for i, mine in enumerate(q[:, strip].T):
                gap = mine[:, None] - q
                sums[i] += (gap * gap // q).sum(axis=0)
        out.append(sums)
    sums = np.concatenate(out)
    i, j = np.nonzero(~np.eye(len(names), dtype=bool))
    lang = pa.repeat(run["lang"][0], len(i))
    return pa.RecordBatch.from_arrays(
        [lang, pa.array(names, pa.string()).take(pa.array(i)), pa.array(names, pa.string()).take(pa.array(j)), pa.array(sums[i, j])],
        ["lang", "source", "item", "value"],
    )


def audit(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = 3, top: int = 200,
) -> DataFrame:
    """(lang, source, part, item, value, rank): departures of each source's terms.

    Part ``pair``: every other source of the language, with the distance summed over all kept terms
    of the language (those in at least ``least_docs`` documents; 0 if there are none). Part
    ``term``: the ``top`` terms a source uses more than its language, by their distance. Ties go
    to the smaller item in UTF-8. A source alone in its language has no pairs. Null text, language
    and source read as '', rows that repeat count each, other columns are not read, and no rows
    give no rows. Texts are counted whole, one at a time.

    A term's entries are one per source, whatever number of documents uses it, so no key of the
    shuffles is hot. Sources are compared in runs of some ``ENTRIES`` entries of a language; a run
    gives one row per pair of its sources, as the result does.
    """
    counts = materialize(term_counts(docs, text, lang, source), "divergence-counts")
    kept = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("docs").alias("docs"), F.min("source").alias("head"))
    kept = kept.where(F.col("docs") >= least_docs).drop("docs")
    entries = materialize(counts.drop("docs").join(kept, ["lang", "term"]).withColumn("head", F.col("source") == F.col("head")), "divergence-terms")
    sizes = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("entries"), F.count_if("head").alias("heads"))
    groups = counts.where("term IS NULL").select("lang", "source").join(sizes, ["lang", "source"], "left").na.fill(0, ["total", "entries", "heads"])
    # Every kept term has one head, so these sums over the sources of a language are its own figures.
    of_lang = Window.partitionBy("lang")
    groups = groups.select(
        "lang", "source", "total", F.sum("total").over(of_lang).alias("lang_total"), F.sum("heads").over(of_lang).alias("kept"),
        F.greatest(F.lit(1), F.ceil(F.sum("entries").over(of_lang) / ENTRIES)).cast("int").alias("runs"),
    )
    # Stored, so that the planner knows its size: it is broadcast only below the planner's threshold.
    groups = materialize(groups.withColumn("base", F.when(F.col("kept") > 0, share(F.lit(0), "total", "kept")).otherwise(1)), "divergence-groups")
    shares = entries.join(groups, ["lang", "source"]).withColumn("p", share("n", "total", "kept"))

    q = share("all", "lang_total", "kept")
    more = shares.withColumn("q", q).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    more = more.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top)

    columns = ["lang", "run", "place", "term", "source", "p"]
    # By language and term, so that all sources of a term meet in one run.
    own = shares.withColumn("run", F.pmod(F.xxhash64("term"), F.col("runs")).cast("int")).withColumn("place", F.lit(1))
    heads = groups.select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("runs") - 1)).alias("run"), F.lit(0).alias("place"),
        F.lit(None).cast("string").alias("term"), "source", F.col("base").alias("p"),
    )
    pairs = by_run(own.select(*columns).unionByName(heads), ["lang", "run"], _compare, "lang string, source string, item string, value long")
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(by_value))
    return pairs.select("lang", "source", "part", "item", "value", "rank").unionByName(more)
