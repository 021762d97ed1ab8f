import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing, queries


def reachable(counts, capacity):
    sums = {0}
    for length, n in counts.items():
        sums = {s + k * length for s in sums for k in range(n + 1) if s + k * length <= capacity}
    return max(sums)


@given(st.dictionaries(st.integers(1, 60), st.integers(1, 5), max_size=7), st.integers(0, 120))
@settings(max_examples=200)
def test_closest_is_the_best_sum_with_what_is_there(counts, capacity):
    used = packing.closest(counts, capacity)
    assert all(0 < n <= counts[k] for k, n in used.items())
    assert sum(k * n for k, n in used.items()) == reachable(counts, capacity)


@given(st.lists(st.integers(1, 300), max_size=40))
@settings(max_examples=150)
def test_plan_holds_every_position_once_with_little_padding(lengths):
    windows = packing.plan(np.array(lengths, dtype=np.int64), window=64, slack=2)
    covered = Counter((d, p) for w in windows for d, s, n in w for p in range(s, s + n))
    assert covered == Counter((d, p) for d, n in enumerate(lengths) for p in range(n))
    for w in windows:
        total = sum(n for _, _, n in w)
        assert total <= 64 and (total >= 62 or total & (total - 1) == 0)


@pytest.mark.parametrize("block", [packing.BLOCK_TOKENS, 3000])
def test_pieces_are_the_librarys_tokens(spark, tables, documents, block):
    draw = random.Random(5)
    parts = [" ", "  ", "\n", "\t", "a", "B", "the", "É", "日本", "1", "'s", "!!", "<|endoftext|>", "\xa0", "\x1c", "\x00", "é", "😀", "İ", "ΑΣ"]
    rows = [*documents[:60], *[(1000 + i, "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))) for i in range(500)]]
    rows += [(None, None), (None, ""), (5000, None), (5001, "word " * 9000), (5001, "word " * 9000), (5002, "a" * 3000)]
    folder = tables(documents=([(*r, "k") for r in rows], "doc_id long, text string, tokens string"))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = defaultdict(list)
    for d, t in rows:
        ids[d].append(np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4"))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    pieces = packing.pack(docs, block_tokens=block).collect() if block < 5000 else queries.op3_packing(spark, folder).collect()
    held, ends = Counter(), defaultdict(int)
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        crc = zlib.crc32(p.tokens) if "tokens" in p else p.ids_crc32
        match = [x for x in ids[p.doc_id] if len(x) == p.doc_tokens and zlib.crc32(x[p.start:p.start + p.length].tobytes()) == crc]
        assert match and p.offset == ends[p.sequence_id]
        ends[p.sequence_id] += p.length
        held[p.doc_id] += p.length
    assert held == Counter({d: sum(map(len, x)) for d, x in ids.items()})
    assert max(ends.values()) <= 2048
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in ends.values())
    assert padding <= 0.01 * sum(held.values())
