import math
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import blockmax


def brute(rows, every, k=10, scale=1024):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for at, (q, v) in enumerate(kept):
        if q is None or q % every:
            continue
        scores = [(-sum(x * y for x, y in zip(v, w)), (0, 0) if i is None else (1, i), i) for j, (i, w) in enumerate(kept) if j != at]
        for rank, (s, _, i) in enumerate(sorted(scores)[:k], 1):
            out[q, rank, i, -s] += 1
    return out


def found(spark, rows, every=100, **settings):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, row int, shard string")
    return Counter(map(tuple, blockmax.top_k(frame, every, **settings).collect()))


@pytest.mark.parametrize("shard, queries", [(32_768, 2048), (100, 7)])
def test_against_all_products(spark, monkeypatch, shard, queries):
    monkeypatch.setattr(blockmax, "SHARD", shard)
    monkeypatch.setattr(blockmax, "QUERIES", queries)
    draw = np.random.default_rng(3)
    places = draw.standard_normal((5, 12))
    rows = [(i, (places[i % 5] + 0.3 * draw.standard_normal(12)).round(2).tolist()) for i in range(900)]
    rows += [(5000 + i, rows[7][1]) for i in range(300)]  # ties beyond k, a hot vector
    rows += [(10, rows[3][1])] * 3
    assert found(spark, rows, 10) == brute(rows, 10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (100, None), (200, []), (300, [1.0]), (400, [nan, 1.0]), (500, [None, 1.0]), (600, [inf, 0.0]),
        (700, [1.0, 2.0, -3.0]), (None, [0.5, -0.5]), (None, [9.0, 9.0]), (9, [-1e-9, 0.0]), (-100, [0.0, 0.0]), (11, [1e4, -1e4]),
    ]
    assert found(spark, rows) == brute(rows, 100)
    assert found(spark, rows, k=3) == brute(rows, 100, 3)
    assert not found(spark, []) and not found(spark, [(1, [1.0])]) and not found(spark, [(100, [1.0])]) and not found(spark, [(100, None)])
    assert found(spark, [(100, []), (200, [])]) == brute([(100, []), (200, [])], 100)


def test_large_weights_stay_exact(spark):
    rows = [(100, [123456.789, -7.1]), (1, [65432.1, 3.3]), (2, [65432.1, 3.4]), (3, [-65432.1, 3.4])]
    assert found(spark, rows) == brute(rows, 100)


def test_bounds_hold_and_spare_blocks():
    draw = np.random.default_rng(4)
    places = draw.integers(-300, 300, (40, 16))
    blocks, at = [], 0
    for b in range(40):
        w = places[b] + draw.integers(-20, 20, (64, 16))
        blocks.append((np.arange(at, at + 64), np.arange(at, at + 64), w, w.max(axis=0), w.min(axis=0)))
        at += 64
    every = np.concatenate([b[2] for b in blocks])
    queries = every[::50]
    own = np.arange(len(every))[::50]
    upper = blockmax.bounds(queries, np.stack([b[3] for b in blocks]), np.stack([b[4] for b in blocks]))
    scores = queries @ every.T
    assert (upper >= scores.reshape(len(queries), 40, 64).max(axis=2)).all()
    floor = np.full(len(queries), np.iinfo(np.int64).min)
    best, rows, work = blockmax.search(queries, own, floor, blocks, 10)
    assert work < 0.5 * scores.size
    for q in range(len(queries)):
        wanted = sorted((-s, i) for i, s in enumerate(scores[q].tolist()) if i != own[q])[:10]
        mine = best.query == q
        assert [(-s, i) for s, i in zip(best.score[mine].tolist(), rows[best.row[mine]].tolist())] == wanted


def test_an_order_that_keeps_like_vectors_together_is_only_an_order(spark, monkeypatch):
    from pyspark.sql import functions as F

    draw = np.random.default_rng(8)
    rows = [(i, draw.standard_normal(6).round(2).tolist()) for i in range(300)]
    before = found(spark, rows, 20)
    monkeypatch.setattr(blockmax, "_locality", lambda dims: F.lit(0))
    assert found(spark, rows, 20) == before == brute(rows, 20)
