"""Toxicity by multiple-instance learning: sentence scores, joined by noisy-or, learnt from document labels.

A sentence's score is a logistic function of its words: of each word itself and of how it begins,
hashed. Words count for toxicity or not at all, so no length of harmless words hides one that
offends, and a sentence without any such word scores 0. A document is toxic unless all of its
sentences are not: ``1 - prod(1 - p)``. Labels are of documents only; the gradient of the
noisy-or sends a toxic label to the sentences that explain it, so afterwards the sentences that
give offence can be pointed out.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import blocks
from tidemark.llm.common import smallest
from tidemark.session import materialize, ship_code

#: The fit takes at most so many labelled rows of each label, those with the smallest hashes of
#: their key, and passes over single texts above a length; all else is over all rows.
TRAIN_ROWS = {1: 2000, 0: 4000}
TRAIN_CHARS = 200_000
BUCKETS = 1 << 18
BEGINNINGS = (4, 5, 6)
#: A hashed word or beginning counts if so many different texts of the sample have it.
LEAST_TEXTS = 3
THRESHOLD = 0.7
#: Logit of a sentence before its words are looked at.
START = -4.0
#: Words whose weights a task keeps at hand.
REMEMBERED = 300_000
SENTENCE_END = "[.!?\n\x01]+"
_LETTERS = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Bags:
    """Texts as word places: ``word`` indexes ``words``; ``sentence`` and ``doc`` say where each is."""

    words: list[str]
    word: np.ndarray
    sentence: np.ndarray
    doc_of_sentence: np.ndarray
    place_of_sentence: np.ndarray


def bags(texts: pa.Array) -> Bags:
    """Words of each sentence, cut by vectorised string functions; only distinct words become Python's."""
    marked = pc.replace_substring_regex(pc.replace_substring_regex(texts, SENTENCE_END, " \x01 "), "[\\s\\x0b]+", " ")
    lists = pc.split_pattern(marked, " ")
    coded = lists.flatten().dictionary_encode()
    words, at = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
    bounds = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
    ends = np.array([w == "\x01" for w in words], dtype=bool)[at] if len(at) else np.zeros(0, bool)
    begins = np.zeros(len(at), dtype=np.int64)
    starts = bounds[:-1][np.diff(bounds) > 0]
    begins[starts] = 1
    sentence = np.cumsum(np.maximum(begins, ends)) - 1
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    first = np.flatnonzero(np.diff(sentence, prepend=-1))
    doc_of = doc[first]
    place = np.arange(len(first)) - np.searchsorted(doc_of, doc_of, side="left") if len(first) else first
    # A text that begins with an end mark has its first, empty sentence before it.
    place = place + ends[starts][np.searchsorted(np.unique(doc_of), doc_of)] if len(first) else place
    return Bags(words, at, sentence, doc_of, place)


def features(word: str) -> list[int]:
    """Hashed features of a word as it stands between spaces."""
    out = []
    for w in _LETTERS.findall(word.lower()):
        out.append(zlib.crc32(w.encode()) % BUCKETS)
        out += [zlib.crc32(f"{n}:{w[:n]}".encode()) % BUCKETS for n in BEGINNINGS if len(w) >= n]
    return out


@dataclass(frozen=True)
class Model:
    """Weights of the features, none below 0. log(1 - p) of a sentence is
    softplus(START) - softplus(START + sum of weights)."""

    weights: np.ndarray
    known: dict[str, float] = field(default_factory=dict)

    def quiet(self, b: Bags) -> np.ndarray:
        """-log(1 - p) of each sentence."""
        of_word, n = self.of_words(b.words), len(b.doc_of_sentence)
        z = np.bincount(b.sentence, weights=of_word[b.word] if len(b.word) else None, minlength=n)[:n]
        return np.logaddexp(0, START + z) - np.logaddexp(0, START)

    def of_words(self, words: list[str]) -> np.ndarray:
        """The summed weights of each word; words are remembered, up to a bound."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = words
        lists = [features(w) for w in new]
        size = [len(x) for x in lists]
        flat = self.weights[np.fromiter((f for x in lists for f in x), dtype=np.int64, count=sum(size))]
        sums = np.bincount(np.repeat(np.arange(len(new)), size), weights=flat, minlength=len(new))
        self.known.update(zip(new, sums.tolist()))
        return np.fromiter((self.known[w] for w in words), dtype=float, count=len(words))

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, Bags]:
        """Noisy-or of each text, the probability of each sentence, and where the sentences are."""
        b = bags(texts)
        each = self.quiet(b)
        quiet = np.bincount(b.doc_of_sentence, weights=each, minlength=len(texts))[:len(texts)]
        return -np.expm1(-quiet), -np.expm1(-each), b


def fit(texts: list[str], labels: list[int], rounds: int = 200, rate: float = 0.2, decay: float = 1e-4) -> Model:
    """Projected full-batch Adam on the noisy-or likelihood of a bounded sample; the same sample gives the same model.

    Without both labels there is nothing to tell apart, and every score is 0.
    """
    distinct = dict(zip(texts, labels))
    texts, labels = list(distinct), np.array(list(distinct.values()), dtype=float)
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(BUCKETS))
    b = bags(pa.array(texts, pa.string()))
    n, docs = len(b.doc_of_sentence), b.doc_of_sentence
    feature, size = array("i"), np.zeros(len(b.words), dtype=np.int64)
    for i, w in enumerate(b.words):
        found = features(w)
        feature.extend(found)
        size[i] = len(found)
    feature = np.frombuffer(feature, dtype=np.int32) if len(feature) else np.zeros(0, dtype=np.int32)
    owner = np.repeat(np.arange(len(size), dtype=np.int32), size)
    keep = _texts_with(feature, size, docs[b.sentence], b.word)[feature] >= LEAST_TEXTS
    feature, owner = feature[keep], owner[keep]
    used = np.unique(feature)
    at = np.searchsorted(used, feature)
    w, m, v = np.zeros(len(used)), np.zeros(len(used)), np.zeros(len(used))
    balance = np.where(labels == 1, (labels == 0).sum() / (labels == 1).sum(), 1.0) ** 0.5
    for t in range(1, rounds + 1):
        of_word = np.bincount(owner, weights=w[at], minlength=len(b.words))
        z = START + np.bincount(b.sentence, weights=of_word[b.word], minlength=n)
        quiet = np.bincount(docs, weights=np.logaddexp(0, z) - np.logaddexp(0, START), minlength=len(labels))
        push = np.where(labels == 1, -np.exp(-quiet) / np.maximum(-np.expm1(-quiet), 1e-3), 1.0) * balance
        slope = push[docs] / (1 + np.exp(-np.clip(z, -500, 500)))
        of_word = np.bincount(b.word, weights=slope[b.sentence], minlength=len(b.words))
        grad = np.bincount(at, weights=of_word[owner], minlength=len(used)) / len(labels) + decay
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w = np.maximum(0, w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-6))
    weights = np.zeros(BUCKETS)
    weights[used] = w
    return Model(weights)


def _texts_with(feature: np.ndarray, size: np.ndarray, text: np.ndarray, word: np.ndarray, step: int = 200) -> np.ndarray:
    """In how many texts each feature is, some texts at a time."""
    starts, known = np.cumsum(size) - size, np.zeros(BUCKETS, dtype=np.int64)
    cuts = np.searchsorted(text, np.arange(0, (int(text[-1]) if len(text) else 0) + step + 1, step))
    for begin, end in zip(cuts, cuts[1:]):
        w, t = word[begin:end], text[begin:end]
        counts = size[w]
        spread = np.arange(counts.sum()) + np.repeat(starts[w] - (np.cumsum(counts) - counts), counts)
        known += np.bincount(np.unique(np.repeat(t, counts) * BUCKETS + feature[spread]) % BUCKETS, minlength=BUCKETS)
    return known


def held_out(key: str) -> Column:
    """Rows that are never learnt from: crc32 of the key as text, modulo 3, is 1. Null keys are not."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def chosen(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(_key, y, t): texts and labels to learn from, at most ``TRAIN_ROWS``; a key with both labels is toxic.

    The keys are chosen first, from narrow columns; only their texts are then fetched, by a
    broadcast of at most that many keys. Of a key with several texts, tasks keep the one with the
    smallest hash, so there is one row per key, however many rows a key has.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).select(F.col(key).alias("_key"), F.col(label).alias("_label"))
    known = known.groupBy("_key").agg(F.max("_label").alias("_label"))
    usable = docs.where(~held_out(key) & F.col(key).isNotNull() & F.col(text).isNotNull() & (F.length(text) <= TRAIN_CHARS))
    usable = usable.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    keys = usable.select("_key").distinct()
    found = materialize(keys.join(known, "_key").withColumn("_h", F.xxhash64("_key")), "toxicity-keys")
    counts = {r["_label"]: r["count"] for r in found.groupBy("_label").count().collect()}
    picked = [smallest(found.where(F.col("_label") == v), "_h", n, counts.get(v, 0)) for v, n in TRAIN_ROWS.items()]
    picked = F.broadcast(picked[0].unionByName(picked[1]).select("_key", "_label"))
    rows = usable.join(picked, "_key").groupBy("_key").agg(F.max("_label").alias("y"), F.min_by("_text", F.xxhash64("_text")).alias("t"))
    return rows


def sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> tuple[list[str], list[int]]:
    """The chosen texts and labels on the driver, in the order in which ``learn`` takes them."""
    rows = sorted((r["_key"], r["t"], r["y"]) for r in chosen(docs, labels, key, text, label).collect())
    return [r[1] for r in rows], [int(r[2]) for r in rows]


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """The model of the chosen rows, fitted in one task: the rows are bounded, and only weights reach the driver."""
    ship_code(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, y = [], []
        for batch in batches:
            texts += batch.column(0).to_pylist()
            y += batch.column(1).to_pylist()
        weights = fit(texts, y).weights
        at = np.flatnonzero(weights)
        cells = [at.astype(np.int64).tobytes(), weights[at].astype(np.float64).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], ["at", "weight"])

    rows = chosen(docs, labels, key, text, label).repartition(1).sortWithinPartitions("_key")
    found = rows.select("t", F.col("y").cast("int")).mapInArrow(task, "at binary, weight binary").collect()
    weights = np.zeros(BUCKETS)
    for r in found:
        weights[np.frombuffer(r["at"], dtype=np.int64)] = np.frombuffer(r["weight"], dtype=np.float64)
    return Model(weights)


def assess(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", floor: float = 0.5) -> DataFrame:
    """(doc_id, score, offending) per row of ``docs``, over its whole text.

    ``offending`` are the sentences (start, end, p) of probability ``floor`` or more; positions
    are code points, ends exclusive, without the marks that end a sentence. A null text is an
    empty one: it has no sentence and scores 0. Rows that repeat are scored each; null keys are
    kept; other columns are not read; no rows give no rows.
    """
    spark = docs.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(model.weights.astype(np.float32))
    kind = dict(docs.dtypes)[key]
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
    ends = re.compile(SENTENCE_END)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Model(shared.value)
        for batch in batches:
            for start, end in blocks(batch.column(1)):
                part = batch.slice(start, end - start)
                scores, p, b = mine.score(part.column(1))
                spans: list[list] = [[] for _ in range(part.num_rows)]
                hits = np.flatnonzero(p >= floor)
                cuts: dict[int, list[int]] = {}
                for s in hits.tolist():
                    doc = int(b.doc_of_sentence[s])
                    if doc not in cuts:
                        found = part.column(1)[doc].as_py()
                        cuts = {doc: [0, *[x for m in ends.finditer(found) for x in m.span()], len(found)]}
                    at = 2 * int(b.place_of_sentence[s])
                    spans[doc].append({"start": cuts[doc][at], "end": cuts[doc][at + 1], "p": float(p[s])})
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores), pa.array(spans, span)], ["doc_id", "score", "offending"])

    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(task, f"doc_id {kind}, score double, offending array<struct<start:int,end:int,p:double>>")


def detect(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """Fit on the bounded sample, then (doc_id, score, offending) for every row of ``docs``."""
    return assess(docs, learn(docs, labels, key, text, label), key, text)


def keep(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more. Rows are dropped where they are read.

    A null text scores 0 and stays; rows that repeat go or stay together; null keys are kept; every
    column of ``docs`` stays, whatever its name; an empty table stays empty. Without usable labels nothing goes.
    """
    spark = docs.sparkSession
    ship_code(spark)
    shared = spark.sparkContext.broadcast(learn(docs, labels, key, text, label).weights.astype(np.float32))
    place = docs.columns.index(text)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Model(shared.value)
        for batch in batches:
            for start, end in blocks(pc.fill_null(batch.column(place), "")):
                part = batch.slice(start, end - start)
                yield part.filter(pa.array(mine.score(pc.fill_null(part.column(place), ""))[0] < threshold))

    return docs.mapInArrow(task, docs.schema)
