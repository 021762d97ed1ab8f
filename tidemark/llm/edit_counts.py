"""Token counts that follow edits: pre-token segment trees, re-encoded only where an edit reaches.

A text's pre-tokens lie in slots; a binary tree over the slots holds sums of characters and of
tokens. An edit finds its place by the character sums, re-cuts the pre-tokens it touches and the
ones whose cutting looked at what it touches, goes on until a cut falls on an old one again, and
renews the sums from the touched slots to the root. The rest of the text is not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import Vocabulary, blocks, vocabulary
from tidemark.session import ship_code

SLOT = 32
#: Characters of text that are counted together.
BLOCK_CHARS = 8_000_000
EDITS = "array<struct<start:int,end:int,replacement:string>>"
#: What the cleaning edits mask: mails (a name of these characters, then a host), and long numbers.
NAME = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
HOST = re.compile(r"@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")
NUMBER = re.compile(r"[0-9]{3,}")


class Counter:
    """Tokens of pre-tokens, remembered up to a bound; unknown ones are encoded together."""

    def __init__(self, vocab: Vocabulary, most: int = 500_000):
        self.vocab, self.most, self.known = vocab, most, {}

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > self.most:
            self.known.clear()
            new = list(words)
        if new:
            offsets = self.vocab.encode_words([w.encode() for w in new])[1]
            self.known.update(zip(new, np.diff(offsets).tolist()))


class Tree:
    """Pre-tokens of one text in slots, with sums of characters and tokens over the slots."""

    def __init__(self, words: list[str], counter: Counter, split):
        self.slots = [words[i:i + SLOT] for i in range(0, len(words), SLOT)] or [[]]
        self.leaves = 1 << (len(self.slots) - 1).bit_length()
        self.counter, self.split, self.recut, self.stale = counter, split, 0, set()
        counter.learn(set(words))
        self.chars, self.tokens = ([0] * (2 * self.leaves) for _ in range(2))
        for i, s in enumerate(self.slots):
            self.chars[self.leaves + i] = sum(map(len, s))
            self.tokens[self.leaves + i] = sum(counter.known[w] for w in s)
        for sums in (self.chars, self.tokens):
            for node in range(self.leaves - 1, 0, -1):
                sums[node] = sums[2 * node] + sums[2 * node + 1]

    def _renew(self, sums: list[int], slot: int, value: int) -> None:
        node = self.leaves + slot
        change, sums[node] = value - sums[node], value
        while node > 1 and change:
            node >>= 1
            sums[node] += change

    def _find(self, at: int) -> tuple[int, int]:
        """The slot that holds character ``at`` (the last one beyond the end), and where it begins."""
        node, begin = 1, 0
        while node < self.leaves:
            node *= 2
            if at >= begin + self.chars[node] and self.chars[node + 1]:
                begin += self.chars[node]
                node += 1
        return min(node - self.leaves, len(self.slots) - 1), begin

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replace characters ``start`` to ``end`` of the text as it is now; out of range is cut off."""
        total = self.chars[1]
        start = max(0, min(start, total))
        end = max(start, min(end, total))
        # A pre-token's cutting may look two characters past its end.
        first, begin = self._find(max(0, start - 2))
        last = max(first, self._find(end)[0])
        while True:
            words = [w for s in self.slots[first:last + 1] for w in s]
            ends = [begin, *accumulate(map(len, words), initial=begin)][1:]
            keep = sum(1 for e in ends[1:] if e < start - 1)
            origin, stop, whole = ends[keep], ends[-1], last == len(self.slots) - 1
            if stop >= end or whole:
                text = "".join(words[keep:])
                fresh = self.split(text[:start - origin] + replacement + text[end - origin:])
                shift = len(replacement) - (end - start)
                old = {e: i for i, e in enumerate(ends) if e >= end}
                at, done = origin, None
                for i, w in enumerate(fresh):
                    at += len(w)
                    if at - shift in old and at >= start + len(replacement) and at - shift <= stop - 2:
                        done = (i + 1, old[at - shift])
                        break
                if done is None and whole:
                    done = (len(fresh), len(words))
                if done is not None:
                    break
            last = min(len(self.slots) - 1, last + max(1, last - first + 1))
        made = [*words[:keep], *fresh[:done[0]], *words[done[1]:]]
        self.recut += done[0]
        span = last - first + 1
        share = max(SLOT, -(-len(made) // span))
        for i in range(span):
            self.slots[first + i] = made[i * share:(i + 1) * share]
            self._renew(self.chars, first + i, sum(map(len, self.slots[first + i])))
            self.stale.add(first + i)

    def settle(self) -> int:
        """Renew the token sums of the slots that edits touched; the tokens of the text."""
        for slot in self.stale:
            self._renew(self.tokens, slot, sum(self.counter.known[w] for w in self.slots[slot]))
        self.stale.clear()
        return self.tokens[1]

    def text(self) -> str:
        return "".join(w for s in self.slots for w in s)


def mails(text: str) -> list[tuple[int, int]]:
    """Where mails are, leftmost and longest. From each sign backwards, so that a long run of name characters is read once."""
    found, free = [], 0
    for m in HOST.finditer(text):
        # A name has no sign in it, so one sign's name never reaches behind the sign before it.
        free = max(free, text.rfind("@", free, m.start()) + 1)
        before = text[free:m.start()]
        if name := len(before) - len(before.rstrip(NAME)):
            found.append((m.start() - name, m.end()))
            free = m.end()
    return found


def cleaning_edits(text: str) -> list[dict]:
    """Mails and long numbers masked, lines equal to an earlier one dropped; from the end to the start.

    Of edits that overlap, the later one stays, and of two with one start the longer.
    """
    found = [(*m.span(), "0") for m in NUMBER.finditer(text)] + [(s, e, "<mail>") for s, e in mails(text)]
    lines = text.split("\n")
    if len(set(lines)) < len(lines):
        seen, at = set(), 0
        for line in lines:
            if line.strip() and line in seen:
                found.append((max(0, at - 1), at + len(line), ""))
            seen.add(line)
            at += len(line) + 1
    kept, bound = [], len(text) + 1
    for s, e, by in sorted(found, reverse=True):
        if e <= bound and s < e:
            kept.append({"start": s, "end": e, "replacement": by})
            bound = s
    return kept


def with_cleaning_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, edits): each row's own ``cleaning_edits``. A null text is empty."""
    ship_code(docs.sparkSession)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("replacement", pa.string())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edits = pa.array([cleaning_edits(t) for t in batch.column(1).to_pylist()], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, edits], ["doc_id", "text", "edits"])

    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(task, f"doc_id {dict(docs.dtypes)[key]}, text string, edits {EDITS}")


def count(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", key: str = "doc_id", text: str = "text", edits: str = "edits") -> DataFrame:
    """(doc_id, n_before, n_after, n_edits, n_recut, edited) per row of ``docs``.

    ``edits`` is an array of (start, end, replacement), applied in its order, each to the text as
    the ones before left it; positions are code points, cut off at the text's ends. ``n_recut``
    counts the pre-tokens that were encoded anew; ``edited`` is the text afterwards (null without
    edits). Special tokens' strings are ordinary text. Null texts, edits, bounds and replacements
    are empty, none, 0 and empty. Rows that repeat are counted each; other columns are not read;
    no rows give no rows.
    """
    ship_code(docs.sparkSession)
    names = ["doc_id", "n_before", "n_after", "n_edits", "n_recut", "edited"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(tokenizer, False)
        counter, known = Counter(vocab), {}
        for batch in batches:
            for start, end in blocks(batch.column(1), BLOCK_CHARS):
                part = batch.slice(start, end - start)
                before = vocab.count_texts(part.column(1), known).tolist()
                edits = [e or [] for e in part.column(2).to_pylist()]
                words = {i: vocab.pattern.findall(part.column(1)[i].as_py()) for i, e in enumerate(edits) if e}
                # Unknown pre-tokens of the block are encoded together: before the edits, and after them.
                counter.learn({w for found in words.values() for w in found})
                trees = {i: Tree(found, counter, vocab.pattern.findall) for i, found in words.items()}
                for i, tree in trees.items():
                    for e in edits[i]:
                        tree.edit(e["start"] or 0, e["end"] or 0, e["replacement"] or "")
                counter.learn({w for tree in trees.values() for s in tree.stale for w in tree.slots[s]})
                for tree in trees.values():
                    tree.settle()
                columns = [
                    before, [trees[i].tokens[1] if i in trees else n for i, n in enumerate(before)], [len(e) for e in edits],
                    [trees[i].recut if i in trees else 0 for i in range(len(edits))],
                ]
                texts = pa.array([trees[i].text() if i in trees else None for i in range(len(edits))], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(c, pa.int64()) for c in columns], texts], names)

    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(edits).cast(EDITS).alias("edits"))
    return rows.mapInArrow(task, f"doc_id {dict(docs.dtypes)[key]}, n_before long, n_after long, n_edits long, n_recut long, edited string")


def count_with(docs: DataFrame, edits: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``count`` with a table of edits (key, seq, start, end, replacement), applied by ``seq``.

    The edits of one text are gathered with it, since each depends on the one before; keys
    without edits keep their counts, edits without a text are for nothing.
    """
    lists = edits.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.array_sort(F.collect_list(F.struct("seq", "start", "end", "replacement"))).alias("_edits")
    )
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(lists, F.col("doc_id") == F.col("_key"), "left")
    only = F.transform("_edits", lambda e: F.struct(e["start"], e["end"], e["replacement"]))
    return count(rows.select("doc_id", "text", only.alias("edits")), key="doc_id")
