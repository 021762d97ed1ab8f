"""Byte-pair encoding by a pair occurrence index, and decoding.

A block of a partition's texts is cut into pre-tokens; its distinct pre-tokens are laid out in
one array of symbols. An index maps each pair of neighbouring symbols that has a merge rank to
all its positions in the block. Ranks are applied in ascending order: all positions of a pair are
merged at once, and the lists of the pairs that this makes are extended. Symbols merged away are
skipped by links to the next and previous symbol.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship_code

#: Characters of text that are indexed together; a longer text is a block by itself.
BLOCK_CHARS = 4_000_000
#: Two spaces of any kind about a space: only there may a text not be cut before a space.
_WHITE = "[\\s\\x0b\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


class Vocabulary:
    """A byte-level BPE vocabulary file: merges by rank, the bytes of each id, special tokens.

    ``specials`` says whether special tokens' strings in a text become those tokens, which is
    what the library does unless told otherwise.
    """

    def __init__(self, file: str, pattern: str, specials: bool = True):
        with open(file, encoding="utf-8") as f:
            said = json.load(f)
        letter = {c: b for b, c in byte_letters().items()}
        vocab = said["model"]["vocab"]
        self.bytes_of: dict[int, bytes] = {i: bytes(letter[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        if not specials:
            self.special = {}
        self.byte_id = np.array([vocab[c] for _, c in sorted(byte_letters().items())], dtype=np.int64)
        merges = [m if isinstance(m, list) else m.split(" ", 1) for m in said["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        self.left, self.right = left, right
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order
        self.pattern = regex.compile(pattern)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 for none."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], -1)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and the ``len(words) + 1`` offsets."""
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        symbol = self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
        n = len(symbol)
        offsets = np.concatenate([[0], np.cumsum(size)])
        if not n:
            return symbol, offsets
        after = np.arange(1, n + 1)
        after[offsets[1:][size > 0] - 1] = n
        before = np.arange(-1, n - 1)
        before[offsets[:-1][size > 0]] = -1
        alive = np.ones(n, dtype=bool)
        start = np.flatnonzero(after < n)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def enter(spots: np.ndarray, ranks: np.ndarray) -> None:
            keep = ranks >= 0
            spots, ranks = spots[keep], ranks[keep]
            order = np.argsort(ranks, kind="stable")
            spots, ranks = spots[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks, prepend=-1))
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(ranks)]):
                r = int(ranks[a])
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(spots[a:b])

        enter(start, self.rank(symbol[start], symbol[after[start]]))
        while heap:
            r = heapq.heappop(heap)
            lists = index.pop(r)
            spots = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            left, right, made = self.left[r], self.right[r], self.made[r]
            spots = spots[alive[spots] & (symbol[spots] == left)]
            spots = spots[after[spots] < n]
            spots = spots[symbol[after[spots]] == right]
            if left == right and len(spots) > 1:
                spots = _apart(spots, after)
            if not len(spots):
                continue
            gone = after[spots]
            symbol[spots] = made
            alive[gone] = False
            nxt = after[gone]
            after[spots] = nxt
            inside = nxt < n
            before[nxt[inside]] = spots[inside]
            prev = before[spots]
            has = prev >= 0
            p, q = prev[has], spots[inside]
            fresh = np.concatenate([p, q])
            ranks = np.concatenate([self.rank(symbol[p], symbol[spots[has]]), self.rank(symbol[q], symbol[nxt[inside]])])
            enter(fresh, ranks)
        return symbol[alive], np.concatenate([[0], np.cumsum(alive)])[offsets]

    def split(self, text: str) -> list[str | int]:
        """Pre-tokens of a text, and ids where it holds special tokens."""
        if self.cut is None:
            return self.pattern.findall(text)
        parts = self.cut.split(text)
        return [w for i, p in enumerate(parts) for w in ([self.special[p]] if i % 2 else self.pattern.findall(p))]

    def encode_texts(self, texts: pa.Array) -> pa.ListArray:
        """The ids of each text of a string array without nulls."""
        chunks, bounds = self._chunks(texts)
        coded = chunks.dictionary_encode()
        distinct, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        parts = [self.split(c) for c in distinct]
        place: dict[str | int, int] = {}
        for p in parts:
            for w in p:
                if w not in place:
                    place[w] = len(place)
        words = [w for w in place if isinstance(w, str)]
        ids, offsets = self.encode_words([w.encode() for w in words])
        special = [w for w in place if not isinstance(w, str)]
        number = {w: i for i, w in enumerate([*words, *special])}
        offsets = np.concatenate([offsets, offsets[-1] + np.arange(1, len(special) + 1)])
        ids = np.concatenate([ids, np.array(special, dtype=np.int64)])
        pieces = np.fromiter((number[w] for p in parts for w in p), dtype=np.int64, count=sum(map(len, parts)))
        of_chunk = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        ids, offsets = gather(ids, offsets, pieces), _summed(offsets, pieces)[of_chunk]
        out, ends = gather(ids, offsets, at), _summed(offsets, at)
        return pa.ListArray.from_arrays(pa.array(ends[bounds].astype(np.int32)), pa.array(out.astype(np.int32)))

    def count_texts(self, texts: pa.Array, known: dict[str, int], most: int = 300_000) -> np.ndarray:
        """How many ids each text has. ``known`` remembers stretches from call to call, up to ``most``."""
        chunks, bounds = self._chunks(texts)
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [c for c in distinct if c not in known]
        if len(known) + len(new) > most:
            known.clear()
            new = distinct
        parts = [self.split(c) for c in new]
        words = list(dict.fromkeys(w for p in parts for w in p if isinstance(w, str)))
        size = dict(zip(words, np.diff(self.encode_words([w.encode() for w in words])[1]).tolist()))
        known.update((c, sum(size.get(w, 1) for w in p)) for c, p in zip(new, parts))
        counts = np.fromiter((known[c] for c in distinct), dtype=np.int64, count=len(distinct))
        return np.diff(np.concatenate([[0], np.cumsum(counts[coded.indices.to_numpy()])])[bounds])

    def _chunks(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Stretches of text that are encoded independently, and where each text's begin.

        A pre-token never reaches across the space before a word, so texts are cut there with
        vectorised string functions; each distinct stretch is then looked at once. Texts with
        runs of white space about a space, or with special tokens, stay whole.
        """
        whole = pc.match_substring_regex(texts, f"{_WHITE} {_WHITE}")
        for token in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        mark = pc.if_else(whole, texts, pc.replace_substring(texts, " ", "\x00 "))
        # A text that holds the mark itself stays whole, too.
        own = pc.match_substring(texts, "\x00")
        lists = pc.split_pattern(pc.if_else(own, "", mark), "\x00")
        if pc.any(own).as_py():
            lists = pa.array([[t] if o else x for t, o, x in zip(texts.to_pylist(), own.to_pylist(), lists.to_pylist())], pa.list_(pa.string()))
        bounds = lists.offsets.to_numpy()
        return lists.flatten(), bounds - bounds[0]

    @cached_property
    def _spelt(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of each id, none where there is no such id, and how many they are."""
        known = np.array([self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)], dtype=object)
        return known, np.array([len(b) for b in known], dtype=np.int64)

    def decode_ids(self, ids: pa.ListArray) -> pa.Array:
        """The text of each list of ids; bytes that are not UTF-8 become U+FFFD, as the library has it."""
        flat = ids.flatten().to_numpy()
        bounds = ids.offsets.to_numpy() - ids.offsets[0].as_py()
        known, length = self._spelt
        size = np.concatenate([[0], np.cumsum(length[flat])])[bounds]
        data = b"".join(known[flat].tolist())
        return pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(size.tolist(), size[1:].tolist())], pa.string())


def _apart(spots: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of pairs of equal symbols, those merged when runs are taken from the left, two at a time."""
    follows = np.zeros(len(spots), dtype=bool)
    follows[1:] = after[spots[:-1]] == spots[1:]
    first = np.maximum.accumulate(np.where(follows, 0, np.arange(len(spots))))
    return spots[(np.arange(len(spots)) - first) % 2 == 0]


def _summed(offsets: np.ndarray, take: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.diff(offsets)[take])])


def gather(values: np.ndarray, offsets: np.ndarray, take: np.ndarray) -> np.ndarray:
    """The lists ``take`` of a flat array of lists, one after the other."""
    size = np.diff(offsets)[take]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.arange(total) + np.repeat(offsets[:-1][take] - (ends - size), size)]


def byte_letters() -> dict[int, str]:
    """The letter by which a vocabulary file writes each byte: printable bytes are themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def vocabulary(name: str, specials: bool = True) -> Vocabulary:
    """The vocabulary of a file of the public tokenizers, once per worker."""
    import public_tokenizers

    return Vocabulary(public_tokenizers.path(name), public_tokenizers.PATTERN, specials)


def blocks(column: pa.Array, chars: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Stretches (start, end) of a string array of about ``chars`` bytes each, at least one row."""
    size = pc.binary_length(column).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    start = 0
    while start < len(size):
        base = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, base + chars, side="right")))
        yield start, end
        start = end


def encode(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) per row of ``docs``: its whole text as the library encodes it, nothing added.

    A null text is empty and has no ids. Rows that repeat are encoded each; null keys are kept;
    other columns are not read; no rows give no rows.
    """
    ship_code(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(tokenizer)
        for batch in batches:
            for start, end in blocks(batch.column(1)):
                part = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays([part.column(0), vocab.encode_texts(part.column(1))], ["doc_id", "ids"])

    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(task, f"doc_id {dict(docs.dtypes)[key]}, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, text): the text that the ids spell."""
    ship_code(encoded.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(tokenizer)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                columns = [*part.columns, vocab.decode_ids(part.column(1))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "text"])

    kind = dict(encoded.dtypes)["doc_id"]
    return encoded.select("doc_id", "ids").mapInArrow(task, f"doc_id {kind}, ids array<int>, text string")


def round_trip(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, text) per row of ``docs``: ``encode`` and ``decode`` of it in one pass, so ids cross to Python once.

    Nulls, repeated rows, other columns and empty tables are as in ``encode``.
    """
    ship_code(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(tokenizer)
        for batch in batches:
            for start, end in blocks(batch.column(1)):
                part = batch.slice(start, end - start)
                ids = vocab.encode_texts(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), ids, vocab.decode_ids(ids)], ["doc_id", "ids", "text"])

    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(task, f"doc_id {dict(docs.dtypes)[key]}, ids array<int>, text string")
