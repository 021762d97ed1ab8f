import hashlib
import random
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, edit_counts, queries

PARTS = [" ", "  ", "\n", " \n", "\t", "a", "B", "the", "ing", "é", "日", "1", "23", "'s", "'", " '", "!!", ".", "\xa0", "x", "_"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def applied(text, edits):
    for start, end, by in edits:
        start = min(max(start, 0), len(text))
        text = text[:start] + by + text[max(start, min(end, len(text))):]
    return text


def test_random_edits_give_the_pre_tokens_and_counts_of_the_new_text(library):
    vocab = bpe.vocabulary("byte_bpe_50k.json", False)
    counter, draw = edit_counts.Counter(vocab, most=2000), random.Random(1)
    recut = whole = 0
    for _ in range(1500):
        text = "".join(draw.choice(PARTS) for _ in range(draw.choice([0, 3, 20, 200, 400])))
        tree = edit_counts.Tree(vocab.pattern.findall(text), counter, vocab.pattern.findall)
        for _ in range(draw.randint(1, 8)):
            start = draw.randint(0, len(text) + 1)
            edit = (start, start + draw.choice([0, 0, 1, 2, 5, 40]), "".join(draw.choice(PARTS) for _ in range(draw.choice([0, 0, 1, 2, 6]))))
            tree.edit(*edit)
            text = applied(text, [edit])
            assert [w for s in tree.slots for w in s] == vocab.pattern.findall(text)
        counter.learn({w for s in tree.stale for w in tree.slots[s]})
        assert tree.settle() == len(library.encode(text, add_special_tokens=False).ids)
        recut, whole = recut + tree.recut, whole + len(vocab.pattern.findall(text))
    assert recut < whole / 3


def test_mails_are_found_as_by_one_expression():
    whole, draw = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"), random.Random(3)
    for _ in range(5000):
        text = "".join(draw.choice("aB1._@@@.. -\u00e9com") for _ in range(draw.randint(0, 60)))
        assert edit_counts.mails(text) == [m.span() for m in whole.finditer(text)], text
    long = "x" * 300 + "@" + "h" * 400 + "." + "c" * 60
    assert edit_counts.mails(f"to {long}, {'y' * 2_000_000}") == [(3, 3 + len(long))]


def test_query(spark, tables, documents, library):
    rows = [*documents, (1, None), (None, None), (None, "tel 12345"), (7, "x <|endoftext|> 999"), (7, "x <|endoftext|> 999"), (8, "a\nb\na\na")]
    folder = tables(documents=([(*r, 1, "e") for r in rows], "doc_id long, text string, n_edits int, edits string"))
    tokens = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    expected = []
    for d, t in rows:
        edits = [(e["start"], e["end"], e["replacement"]) for e in edit_counts.cleaning_edits(t or "")]
        new = applied(t or "", edits)
        expected.append((d, tokens(t or ""), tokens(new), len(edits), hashlib.sha256(new.encode()).hexdigest() if edits else None))
    got = [(r.doc_id, r.n_before, r.n_after, r.n_edits, r.edited_sha256) for r in queries.op8_edit_counts(spark, folder).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str) and sum(e[3] for e in expected) > 5


def test_a_table_of_edits_is_applied_in_its_order(spark):
    docs = spark.createDataFrame([(1, "hello big world"), (1, "hello big world"), (2, None), (None, "x y"), (4, "zz")], "doc_id long, text string")
    edits = spark.createDataFrame(
        [(1, 2, 3, None, "!"), (1, 1, 0, 5, "bye"), (2, 1, 0, 0, "abc"), (9, 1, 0, 1, "q"), (4, 1, None, 1, None), (None, 1, 0, 1, "n")],
        "doc_id long, seq int, start int, end int, replacement string",
    )
    got = {(r.doc_id, r.edited, r.n_edits) for r in edit_counts.count_with(docs, edits).collect()}
    assert got == {(1, "bye! big world", 2), (2, "abc", 1), (None, None, 0), (4, "z", 1)}
