import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import kmeans


def brute(rows, k, rounds, dims, scale=1024):
    """(vec_id, cluster, distance, inertia of the cluster, of all, centroid) with Python's integers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centres = [v for _, v in order[:k]]
    far = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))

    def assign():
        return [min((far(v, c), j) for j, c in enumerate(centres))[::-1] for _, v in kept]

    for _ in range(rounds):
        at = assign()
        for j in range(len(centres)):
            mine = [v for (_, v), (c, _) in zip(kept, at) if c == j]
            if mine:
                centres[j] = [sum(x) // len(mine) for x in zip(*mine)]
    at = assign()
    sums = Counter()
    for c, d in at:
        sums[c] += d
    return Counter((i, c, d, sums[c], sum(sums.values()), tuple(centres[c])) for (i, _), (c, d) in zip(kept, at))


def found(spark, rows, kind="float", **settings):
    frame = spark.createDataFrame([(*r, 1, 2.0) for r in rows], f"vec_id long, embedding array<{kind}>, cluster int, distance double")
    return Counter((*r[:5], tuple(r.centroid)) for r in kmeans.cluster(frame, **settings).collect())


@pytest.mark.parametrize("k, rounds", [(8, 10), (3, 2), (1, 10), (8, 0)])
def test_against_plain_rounds(spark, k, rounds):
    draw = np.random.default_rng(k + rounds)
    centre = draw.standard_normal((6, 5))
    rows = [(i, (centre[i % 6] + 0.7 * draw.standard_normal(5)).round(2).tolist()) for i in range(400)]
    rows += [(1000, rows[0][1])] * 150  # a hot vector
    assert found(spark, rows, "double", k=k, rounds=rounds, dims=5) == brute(rows, k, rounds, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, []), (4, [1.0]), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [inf, 0.0]), (8, [1.0, 2.0, 3.0]),
        (None, [0.5, -0.5]), (None, [-3.0, 4.0]), (9, [-1e-9, 0.0]), (10, [0.0, 0.0]), (11, [1000.0, -1000.0]),
    ]
    for k in (2, 8):
        assert found(spark, rows, "double", k=k, dims=2) == brute(rows, k, 10, 2)
    assert not found(spark, [(1, None), (2, [])], dims=2) and not found(spark, [], dims=2)
    assert found(spark, [(None, [1.0, 1.0])], dims=2) == brute([(None, [1.0, 1.0])], 8, 10, 2)
    with pytest.raises(Exception, match="OverflowError"):
        found(spark, [(1, [1e30, 0.0])], "double", dims=2)


def test_equal_distances_go_to_the_first_centroid_and_empty_ones_stay(spark):
    rows = [(i, [float(i % 3), 0.0]) for i in range(30)]
    assert found(spark, rows, dims=2) == brute(rows, 8, 10, 2)


def test_loosening_bounds_what_comes_nearer_and_is_less_than_the_drift():
    draw = np.random.default_rng(5)
    less = negative = 0
    for case in range(200):
        dims = int(draw.integers(2, 9))
        a = draw.integers(-1000, 1000, (4, dims))
        b = a + draw.integers(-120, 120, (4, dims)) * (draw.random((4, 1)) < 0.8).astype(int)
        radii = draw.uniform(0, 900, 4)
        loose = kmeans.loosening(a, b, radii)
        ways = draw.standard_normal((300, dims))
        ways /= np.linalg.norm(ways, axis=1, keepdims=True)
        for i in range(4):
            x = a[i] + ways * radii[i] * draw.random((300, 1)) ** (1 / dims)
            for j in range(4):
                nearer = np.linalg.norm(x - a[j], axis=1) - np.linalg.norm(x - b[j], axis=1)
                assert nearer.max() <= loose[i, j]
                drift = np.linalg.norm(b[j] - a[j])
                assert loose[i, j] <= drift + 1e-3
                less += loose[i, j] < 0.9 * drift
                negative += loose[i, j] < 0
    assert less > 500 and negative > 100


def test_bounds_spare_distances_and_stay_true():
    draw = np.random.default_rng(6)
    places = draw.integers(-4000, 4000, (8, 16))
    vectors = (places[draw.integers(0, 8, 4000)] + draw.integers(-300, 300, (4000, 16))).astype(np.int64)
    centres = vectors[:8].copy()
    state, spent = kmeans.Bounds.start(vectors, centres), []
    for _ in range(8):
        moved = centres.copy()
        for j in range(8):
            if (state.cluster == j).any():
                moved[j] = vectors[state.cluster == j].sum(axis=0) // (state.cluster == j).sum()
        radii = np.array([state.upper[state.cluster == j].max(initial=0) for j in range(8)])
        step = np.linalg.norm(moved - centres, axis=1) * (1 + 1e-9), kmeans.loosening(centres, moved, radii)
        centres, state.scanned = moved, 0
        state.follow(centres, *step)
        far = ((vectors[:, None, :] - centres[None]) ** 2).sum(axis=2)
        assert (state.cluster == far.argmin(axis=1)).all()
        assert (state.upper >= np.sqrt(far[np.arange(4000), state.cluster])).all()
        others = np.arange(8)[None, :] != state.cluster[:, None]
        assert (state.lower <= np.sqrt(far))[others].all()
        spent.append(state.scanned)
    assert spent[-1] < 0.1 * far.size and sum(spent) < 0.5 * 8 * far.size
