import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, queries

NAME = "byte_bpe_50k.json"
PARTS = [
    " ", "  ", "\n", " \n", "\t", "\r\n", "a", "B", "the", "ing", "é", "日本", "1", "23", "'s", "'re", " '", "!!", "...", "<|endoftext|>",
    "\xa0", "　", "\x1c", "\x1f", "\x85", "\x00", "​", "é", "😀", "aaaa", "hahaha", " ", "_", "ß", "İ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(NAME))


def check(texts, library):
    vocab = bpe.vocabulary(NAME)
    ids = vocab.encode_texts(pa.array(texts, pa.string()))
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids.to_pylist() == expected
    assert vocab.decode_ids(ids).to_pylist() == [library.decode(e, skip_special_tokens=False) for e in expected]


def test_random_texts(library):
    draw = random.Random(3)
    check(["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 14))) for _ in range(8000)], library)


def test_long_and_repetitive_texts(library):
    check(["", "a" * 5000, "ab" * 3000, " " * 999, "\n" * 77 + "x", "the " * 20_000], library)


def test_undecodable_ids(library):
    vocab = bpe.vocabulary(NAME)
    draw = np.random.default_rng(1)
    lists = [draw.integers(0, 256, 9).tolist() for _ in range(500)]
    got = vocab.decode_ids(pa.array(lists, pa.list_(pa.int32()))).to_pylist()
    assert got == [library.decode(x, skip_special_tokens=False) for x in lists]


def test_blocks_cover_all_rows():
    column = pa.array(["a" * n for n in (0, 3, 50, 1, 1, 1, 0)])
    spans = list(bpe.blocks(column, 4))
    assert [i for s, e in spans for i in range(s, e)] == list(range(7)) and len(spans) > 2


def test_query(spark, tables, documents, library):
    rows = [*documents, (1, None), (None, None), (None, ""), (7, "x <|endoftext|>"), (7, "x <|endoftext|>")]
    folder = tables(documents=([(*r, 1, "t") for r in rows], "doc_id long, text string, ids int, lang string"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = Counter()
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected[(d, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))] += 1
    assert Counter(map(tuple, queries.op2_bpe(spark, folder).collect())) == expected


def test_one_pass_equals_encode_then_decode(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None), (2, ""), (3, "日本 x" * 4000)], "k long, t string")
    apart = bpe.decode(bpe.encode(docs, NAME, "k", "t"), NAME)
    both = bpe.round_trip(docs.withColumn("ids", docs.k), NAME, "k", "t")
    assert Counter((r.doc_id, tuple(r.ids), r.text) for r in both.collect()) == Counter((r.doc_id, tuple(r.ids), r.text) for r in apart.collect())
    assert bpe.round_trip(docs.where("k > 9"), NAME, "k", "t").isEmpty()
