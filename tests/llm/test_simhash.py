import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tidemark.llm import common, components, queries, simhash


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def groups(keys, linked):
    """The smallest known key of each row's component; ``linked`` is a square of booleans."""
    parent = list(range(len(keys)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in zip(*np.nonzero(np.triu(linked, 1))):
        parent[root(i)] = root(j)
    least = {}
    for i, k in enumerate(keys):
        if k is not None:
            least[root(i)] = min(least.get(root(i), k), k)
    return [least.get(root(i)) for i in range(len(keys))]


def expected(rows):
    prints = np.array([plain_print(t) for _, t in rows], dtype=np.uint64)
    ids = groups([d for d, _ in rows], np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2)
    return Counter((d, f"{p:016x}", c) for (d, _), p, c in zip(rows, prints.tolist(), ids))


BASE = "the quick brown fox jumps over the lazy dog and runs far away from here until dawn breaks " * 20
ODD = [
    (1, None), (None, None), (None, "token=abcdef1"), (2, ""), (3, "a"), (4, "A"), (5, "a  B\tc"), (6, "a b c"), (6, "a b c"), (7, BASE),
    (9, BASE + " x"), (8, BASE + " x y"), (None, "solo 1 2 3"), (11, "é É ÀÀ 𝄞"), (12, "\x1c\x85 　"), (13, "word " * 70_000),
    *[(100 + i, BASE + f" tail{i}") for i in range(60)],
]


def test_small_table(spark, small, documents):
    assert Counter(map(tuple, queries.op9_simhash(spark, small).collect())) == expected(documents)


@pytest.mark.parametrize("block", [512, 8])
def test_odd_rows_and_large_groups(spark, tables, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    folder = tables(documents=([(*r, 1, "q") for r in ODD], "doc_id long, text string, node long, f0 string"))
    assert Counter(map(tuple, queries.op9_simhash(spark, folder).collect())) == expected(ODD)


def test_every_pair_within_two_bits_meets(spark):
    draw = random.Random(4)
    prints = []
    for _ in range(40):
        p = draw.getrandbits(64)
        prints += [p, p ^ 1 << draw.randrange(64), p ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64)]
    prints += [0, 1, 3, 2**64 - 1, 2**64 - 2, 2**63]
    prints = sorted(set(prints))
    nodes = spark.createDataFrame([(i, p - 2**64 if p >= 2**63 else p) for i, p in enumerate(prints)], "node long, f0 long")
    found = {r.node: r.component for r in components.components(simhash.links(nodes)).collect()}
    a = np.array(prints, dtype=np.uint64)
    wanted = groups(list(range(len(a))), np.bitwise_count(a[:, None] ^ a[None, :]) <= 2)
    assert [found.get(i, i) for i in range(len(a))] == wanted


def test_exploded_entries_are_not_broadcast(spark, tmp_path):
    """A stored table of nodes is small where its 33 entries a node are not: they meet their sizes by a shuffle."""
    spark.range(200).selectExpr("id AS node", "xxhash64(id) AS f0").write.parquet(f"{tmp_path}/nodes")
    plan = simhash.links(spark.read.parquet(f"{tmp_path}/nodes"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_large_facts_are_shuffled_but_for_the_hot_ones(spark, tmp_path):
    spark.range(300).selectExpr("id % 100 AS k").write.parquet(f"{tmp_path}/left")
    spark.range(100).selectExpr("id AS k", "3L AS n", "id * 2 AS v").write.parquet(f"{tmp_path}/facts")
    left, facts = spark.read.parquet(f"{tmp_path}/left"), spark.read.parquet(f"{tmp_path}/facts")
    both = common.attach(left, facts, ["k"], "n", 10_000, large=True)
    assert both._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 1
    assert Counter(map(tuple, both.collect())) == Counter({(k, 3, 2 * k): 3 for k in range(100)})


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)] + [(300, 300), (301, 300), (300, 301), (205, 130)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: 5 if n < 300 else 300 for e in edges for n in e}


def test_one_document_of_each_group_stays(spark):
    draw = random.Random(7)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(draw.randint(3, 9)))
    rows = []
    for g in range(40):
        words = [word() for _ in range(draw.randint(150, 400))]
        for c in range(g % 5):
            copy = list(words)
            if c == 1:
                copy[draw.randrange(len(copy))] = word()
            rows.append((10 * g + c, " ".join(copy) if c != 3 else " ".join(words).upper()))
    rows += [(9000, rows[0][1]), (9000, rows[0][1]), (None, "lone text with a few words"), (None, "lone text with a few words"), (9001, None), (9002, "")]
    wanted = {c for _, _, c in expected(rows).elements()}
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, root int")
    stays = simhash.keep_one(docs)
    assert stays.columns == docs.columns
    kept = [r.doc_id for r in stays.collect()]
    assert len(kept) == len(set(kept)) and set(kept) == wanted
    # All exact copies went.
    texts = dict(rows)
    assert len({texts[d].lower() for d in kept if texts[d]}) == len([d for d in kept if texts[d]])


def test_clean_documents_that_share_passages_stay(spark):
    draw = random.Random(5)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(8))
    shared = [word() for _ in range(100)]
    rows = [(i, " ".join(shared + [word() for _ in range(200)])) for i in range(200)]
    assert simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).count() == len(set(c for _, _, c in expected(rows).elements()))
