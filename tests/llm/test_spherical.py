from collections import Counter

import numpy as np

from tidemark.llm import spherical


def brute(rows, cosine):
    """(key, links, component, kept) of every row, all pairs of a label compared."""
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for label in {r[2] for r in rows}:
        at = [i for i, r in enumerate(rows) if r[2] == label]
        v = np.array([rows[i][1] for i in at])
        v /= np.linalg.norm(v, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(np.triu(v @ v.T >= cosine, 1))):
            links[at[a]] += 1
            links[at[b]] += 1
            parent[root(at[a])] = root(at[b])
    least = {}
    for i, r in enumerate(rows):
        least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return Counter((r[0], links[i], least[root(i)], r[0] == least[root(i)]) for i, r in enumerate(rows))


def vectors():
    draw = np.random.default_rng(1)
    rows = [(i, draw.standard_normal(24).tolist(), i % 3) for i in range(300)]
    centre = draw.standard_normal(24)
    # A large group of close copies, and exact copies of one of them.
    rows += [(1000 + i, (centre + 0.1 * draw.standard_normal(24)).tolist(), 1) for i in range(150)]
    return rows + [(2000 + i, rows[-1][1], 1) for i in range(30)]


def test_links_and_components_of_large_groups(spark, monkeypatch):
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for block in (512, 16):
        monkeypatch.setattr(spherical, "BLOCK", block)
        assert Counter(map(tuple, spherical.near_vectors(frame).collect())) == brute(rows, 0.93)


def test_recall_at_the_threshold(spark):
    draw = np.random.default_rng(2)
    a = draw.standard_normal((500, 32))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = draw.standard_normal((500, 32))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.932 * a + np.sqrt(1 - 0.932**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    code = spherical.make_code(32, 1000, 0.93)
    lists = [[set() for _ in range(500)] for _ in range(2)]
    for side, v in enumerate((a, b)):
        for r, f in zip(*code.decode(v)):
            lists[side][r].add(f)
    assert np.mean([bool(x & y) for x, y in zip(*lists)]) >= 0.9


def test_decoding_lists_all_filters_above_the_bound():
    code = spherical.make_code(12, 40, 0.9)
    unit = np.random.default_rng(4).standard_normal((50, 12))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    expected = set()
    size = code.parts[0][1][0].shape[0]
    for place, (rotation, (first, second)) in enumerate(code.parts):
        turned = unit @ rotation
        for i in range(size):
            for j in range(size):
                score = turned @ np.concatenate([first[i], second[j]])
                expected |= {(int(r), (place * size + i) * size + j) for r in np.flatnonzero(score >= code.bound)}
    assert set(zip(*(x.tolist() for x in code.decode(unit)))) == expected
