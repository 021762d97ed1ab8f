"""Packing of token sequences by minimum bin slack.

A document longer than a window fills whole windows by itself; what remains of every document is
packed. For each window, the multiset of remaining lengths is asked for the sum closest to the
capacity: subset sums are bits of an integer (a shift by a length adds it), copies of a length
enter as 1, 2, 4, ... of them, and the counts used are read back from the bits before each step.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import _summed, blocks, gather
from tidemark.session import ship_code

WINDOW = 2048
END = 1
#: Tokens that are packed together, so the rest that finds no partner is at most one window in so many.
BLOCK_TOKENS = 2_000_000
#: Bytes of text whose distinct words are looked up together.
BLOCK_CHARS = 32_000_000
#: Open places of a window that are left; with more, a piece is cut to fill it.
SLACK = 8


def closest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length to take so that their sum is as near to ``capacity`` as it can be.

    ``counts`` has the lengths that are there, and how many of each. Longer lengths are tried
    first, and the way back prefers few of the short ones, which fit anywhere later.
    """
    mask = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        left, size = min(counts[length], capacity // length), 1
        while left > 0:
            take = min(size, left)
            wider = reach | (reach << (length * take)) & mask
            if wider != reach:
                steps.append((length, take, reach))
                reach = wider
            left -= take
            size *= 2
        if reach >> capacity:
            break
    goal = reach.bit_length() - 1
    used: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> goal & 1:
            used[length] = used.get(length, 0) + take
            goal -= length * take
    return used


def plan(lengths: np.ndarray, window: int = WINDOW, slack: int = SLACK) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (document, start, length) that hold every position once.

    All windows but the last ones are full up to ``slack``. What is left at the end is dealt into
    windows whose lengths are powers of two, which need no padding.
    """
    out, waiting = [], {}
    for doc, total in enumerate(lengths.tolist()):
        whole = total // window * window
        out += [[(doc, s, window)] for s in range(0, whole, window)]
        if total > whole:
            waiting.setdefault(total - whole, []).append((doc, whole))
    counts = {n: len(w) for n, w in waiting.items()}

    def take(length: int) -> tuple[int, int]:
        counts[length] -= 1
        if not counts[length]:
            del counts[length]
        return waiting[length].pop()

    def put(doc: int, start: int, length: int) -> None:
        counts[length] = counts.get(length, 0) + 1
        waiting.setdefault(length, []).append((doc, start))

    while counts:
        longest = max(counts)
        pieces = [(*take(longest), longest)]
        for length, n in closest(counts, window - longest).items():
            pieces += [(*take(length), length) for _ in range(n)]
        open_ = window - sum(p[2] for p in pieces)
        if open_ > slack and counts:
            # Every length that is left is over the open places: cut the shortest.
            length = min(counts)
            doc, start = take(length)
            pieces.append((doc, start, open_))
            put(doc, start + open_, length - open_)
            open_ = 0
        if counts or open_ <= slack:
            out.append(pieces)
            continue
        out += _powers(pieces)
    return out


def _powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The pieces in windows whose lengths are the powers of two of their sum."""
    total = sum(p[2] for p in pieces)
    out, queue = [], list(reversed(pieces))
    for bit in reversed(range(total.bit_length())):
        if not total >> bit & 1:
            continue
        room, window = 1 << bit, []
        while room:
            doc, start, length = queue.pop()
            used = min(room, length)
            window.append((doc, start, used))
            if length > used:
                queue.append((doc, start + used, length - used))
            room -= used
        out.append(window)
    return out


class Encoder:
    """The library's tokenizer over Arrow strings.

    The tokenizer drops white space and never joins across it, so texts are cut at spaces and line
    feeds, and each distinct stretch is encoded once. It lower-cases and keeps letters apart from
    marks, so a word of ASCII letters is looked up in lower case, without a full stop or comma
    behind it. Distinct stretches are encoded many at a time, with a special token between them.
    """

    MARKS = (".", ",")
    BETWEEN = "<|startoftext|>"
    TOGETHER, CALLS = 1000, 32

    def __init__(self, name: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.between = self.tokenizer.token_to_id(self.BETWEEN)
        self.marks = [self._ids([m])[0][0].tolist() for m in self.MARKS]

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=np.uint32).reshape(1, -1) for e in found]

    def stretches(self, stems: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all stretches, one after the other, and their offsets."""
        own = [i for i, w in enumerate(stems) if self.BETWEEN in w]
        alone = {i: self._ids([stems[i]])[0][0] for i in own}
        plain = ["" if i in alone else w for i, w in enumerate(stems)] if own else stems
        ids, sizes = [], []
        joined = [self.BETWEEN.join(plain[i:i + self.TOGETHER]) for i in range(0, len(plain), self.TOGETHER)]
        for i in range(0, len(joined), self.CALLS):
            for part in self._ids(joined[i:i + self.CALLS]):
                cuts = np.flatnonzero(part[0] == self.between)
                sizes.append(np.diff(cuts, prepend=-1, append=part.shape[1]) - 1)
                ids.append(part[0][part[0] != self.between])
        size = np.concatenate([*sizes, np.zeros(0, dtype=np.int64)]).astype(np.int64)
        offsets, flat = np.concatenate([[0], np.cumsum(size)]), np.concatenate([*ids, np.zeros(0, dtype=np.uint32)])
        if own:
            lists = [alone[i] if i in alone else flat[offsets[i]:offsets[i + 1]] for i in range(len(stems))]
            offsets, flat = np.concatenate([[0], np.cumsum([len(x) for x in lists])]), np.concatenate(lists)
        return flat, offsets

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, ids, offsets) of blocks of rows, whose texts bound the memory."""
        for start, end in blocks(texts, BLOCK_CHARS):
            for s, e, ids, offsets in self._block(texts.slice(start, end - start)):
                yield start + s, start + e, ids, offsets

    def _block(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary
        behind = pc.match_substring_regex(words, "^[A-Za-z]+[.,]$")
        letters = pc.or_(behind, pc.match_substring_regex(words, "^[A-Za-z]+$"))
        cut = pc.if_else(behind, pc.utf8_slice_codeunits(words, 0, -1), words)
        stems = pc.if_else(letters, pc.ascii_lower(cut), cut).dictionary_encode()
        ids, offsets = self.stretches(stems.dictionary.to_pylist())
        n = len(offsets) - 1
        ids = np.concatenate([ids, *[np.array(m, dtype=np.uint32) for m in self.marks]])
        offsets = np.concatenate([offsets, offsets[-1] + np.cumsum([len(m) for m in self.marks])])
        # A word is one list, or two where a mark stands behind it.
        tail = behind.to_numpy(zero_copy_only=False)
        place = np.cumsum(1 + tail) - 1 - tail
        pieces = np.empty(len(words) + int(tail.sum()), dtype=np.int64)
        pieces[place] = stems.indices.to_numpy()
        comma = pc.ends_with(words, ",").to_numpy(zero_copy_only=False)
        pieces[place[tail] + 1] = n + comma[tail]
        of_word = np.append(place, len(pieces))
        ids, offsets = gather(ids, offsets, pieces), _summed(offsets, pieces)[of_word]
        at, bounds = coded.indices.to_numpy(), lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        for s, e in blocks(texts):
            take = at[bounds[s]:bounds[e]]
            yield s, e, gather(ids, offsets, take), _summed(offsets, take)[bounds[s:e + 1] - bounds[s]]


@lru_cache(maxsize=4)
def _encoder(name: str) -> Encoder:
    return Encoder(name)


def pack(
    docs: DataFrame, tokenizer: str = "word_bpe_49k.json", key: str = "doc_id", text: str = "text",
    window: int = WINDOW, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Pieces (doc_id, start, length, tokens, doc_tokens, sequence_id, offset).

    A document is its tokens and the end token; a null or empty text is the end token alone.
    ``tokens`` are unsigned 32-bit integers, little-endian. A piece lies at ``offset`` of its
    sequence; pieces fill a sequence from 0 without gaps. Sequence ids are unique: partition,
    then number in it. Rows that repeat and rows without a key are packed like others; other
    columns are not read; no rows give no pieces.

    Documents are packed where they are read, in blocks of bounded size: nothing is shuffled,
    and a lost task is done again by itself.
    """
    ship_code(docs.sparkSession)
    kind = dict(docs.dtypes)[key]
    names = ["doc_id", "start", "length", "tokens", "doc_tokens", "sequence_id", "offset"]

    def packed(keys: list[pa.Array], parts: list[tuple[np.ndarray, np.ndarray]], first: int) -> Iterator[pa.RecordBatch | int]:
        ids = np.concatenate([p[0] for p in parts])
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p[1]) for p in parts]))])
        windows = plan(np.diff(offsets), window)
        size = np.fromiter(map(len, windows), dtype=np.int64, count=len(windows))
        flat = np.array([p for w in windows for p in w], dtype=np.int64).reshape(-1, 3)
        doc, start, length = flat.T
        ends = np.cumsum(length)
        opens = np.repeat(np.concatenate([[0], np.cumsum(size)])[:-1], size)
        begin = ends - length
        data = gather(ids, np.stack([offsets[doc] + start, offsets[doc] + start + length], axis=1).ravel(), np.arange(0, 2 * len(doc), 2))
        every = pa.concat_arrays(keys)
        raw = pa.py_buffer(data.astype("<u4"))
        for s in range(0, len(doc), 5000):
            e = min(s + 5000, len(doc))
            bounds = np.concatenate([begin[s:e], ends[e - 1:e]]) * 4
            tokens = pa.Array.from_buffers(pa.binary(), e - s, [None, pa.py_buffer((bounds - bounds[0]).astype(np.int32)), raw.slice(bounds[0], bounds[-1] - bounds[0])])
            yield pa.RecordBatch.from_arrays([
                every.take(pa.array(doc[s:e])), pa.array(start[s:e]), pa.array(length[s:e]), tokens,
                pa.array(np.diff(offsets)[doc[s:e]]), pa.array(first + np.repeat(np.arange(len(size)), size)[s:e]),
                pa.array(begin[s:e] - begin[opens[s:e]]),
            ], names)
        yield len(windows)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number = _encoder(tokenizer), TaskContext.get().partitionId() << 36
        keys, parts, held = [], [], 0
        for last, batch in _marked(batches):
            for start, end, ids, offsets in encoder.encode(batch.column(1)) if batch is not None else ():
                size = np.diff(offsets) + 1
                with_end = np.insert(ids, offsets[1:], END)
                keys.append(batch.column(0).slice(start, end - start))
                parts.append((with_end, np.concatenate([[0], np.cumsum(size)])))
                held += len(with_end)
                if held >= block_tokens:
                    for out in packed(keys, parts, number):
                        if isinstance(out, int):
                            number += out
                        else:
                            yield out
                    keys, parts, held = [], [], 0
            if last and keys:
                yield from (out for out in packed(keys, parts, number) if not isinstance(out, int))

    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(task, f"doc_id {kind}, start long, length long, tokens binary, doc_tokens long, sequence_id long, offset long")


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch | None]]:
    """Each batch, and at the end a mark."""
    for batch in batches:
        yield False, batch
    yield True, None
