import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import cluster
from tidemark.operators import rules as rl


@pytest.fixture(scope="module")
def baskets(spark):
    pairs = [("Night", "Low")] * 3 + [("Night", "High")] + [("Day", "High")] * 3 + [("Day", "Low")]
    return spark.createDataFrame(pairs, "time string, level string")


def _as_set(rows):
    return {(tuple(r["items"]), r["n_rows"], round(r["support"], 6)) for r in rows}


def test_rule_measures(baskets):
    found = rl.rules(rl.itemsets(baskets, ["time", "level"], 0.005), min_lift=0.0)
    out = {(r["antecedents"][0], r["consequents"][0]): r for r in found.collect()}
    assert len(out) == 8
    r = out[("time_Night", "level_Low")]
    assert [r[c] for c in ("support", "confidence", "lift", "leverage", "conviction")] == [0.375, 0.75, 1.5, 0.125, 2.0]
    r = out[("time_Night", "level_High")]
    assert (r["support"], r["lift"], r["leverage"]) == (0.125, 0.5, -0.125)
    assert r["conviction"] == pytest.approx(0.6667, abs=1e-4)
    plain = lambda r: (tuple(sorted(r["antecedents"])), tuple(r["consequents"]), round(r["lift"], 9))
    one = rl.rules(rl.itemsets(baskets, ["time", "level"], 0.005), min_lift=0.0, single=True)
    assert sorted(map(plain, one.collect())) == sorted(plain(r) for r in found.collect() if len(r["consequents"]) == 1)
    kept = rl.rules(rl.itemsets(baskets, ["time", "level"], 0.005))
    level = rl.level_rules(kept, "level", ["Low", "High"]).collect()
    assert [(r["antecedents"], r["consequents"]) for r in level] == [
        ("time_Day", "level_High"), ("time_Night", "level_Low")
    ]


def test_always_true_rule_has_no_conviction(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "p string, q string")
    out = rl.rules(rl.itemsets(df, ["p", "q"], 0.1)).collect()
    assert out and all(r["conviction"] is None for r in out if r["confidence"] == 1)


def test_cube_and_fpgrowth_agree(spark):
    df = spark.range(400).select(
        F.concat(F.lit("a"), (F.hash("id") % 3).cast("string")).alias("p"),
        F.when(F.col("id") % 9 > 0, F.concat(F.lit("b"), (F.hash("id", F.lit(1)) % 4).cast("string"))).alias("q"),
        F.concat(F.lit("c"), (F.hash("id", F.lit(2)) % 2).cast("string")).alias("r"),
    )
    cube = _as_set(rl.itemsets(df, ["p", "q", "r"], 0.02).collect())
    trees = _as_set(rl.itemsets_fpgrowth(df, ["p", "q", "r"], 0.02).collect())
    assert cube == trees and cube


def test_most_common_takes_the_smallest_on_ties(spark):
    rows = [(0, "Clouds"), (0, "Clear"), (0, "Clear"), (0, "Clouds"), (0, None), (0, None), (0, None), (1, "Snow")]
    df = spark.createDataFrame(rows, "cluster int, weather_main string")
    got = {r["cluster"]: r["weather_main"] for r in cluster.most_common(df, "cluster", "weather_main").collect()}
    assert got == {0: "Clear", 1: "Snow"}


def test_nearest_centre(spark):
    df = spark.createDataFrame([(0.0, 0.0), (4.9, 0.0), (5.0, 0.0), (9.0, 1.0)], "a double, b double")
    got = [r["cluster"] for r in cluster.assign_centres(df, ["a", "b"], [[0.0, 0.0], [10.0, 0.0]]).collect()]
    assert got == [0, 0, 0, 1]


@pytest.fixture(scope="module")
def blobs(spark):
    """Three far apart groups of 40 points."""
    group = F.col("id") % 3
    df = spark.range(120).select(
        "id", group.alias("g"), (group * 50.0 + (F.hash("id") % 10) / 10.0).alias("a"),
        (F.when(group == 2, 80.0).otherwise(0.0) + (F.hash("id", F.lit(7)) % 10) / 10.0).alias("b"),
    )
    df = cluster.standardise_population(df, ["a", "b"])
    return cluster.with_cluster_vector(df, ["a", "b"]).cache()


def test_kmeans_finds_the_groups(blobs):
    model = cluster.fit_kmeans(blobs, 3, restarts=4)
    out = model.transform(blobs).groupBy("g").agg(F.countDistinct("prediction").alias("n"), F.min("prediction").alias("p"))
    rows = out.collect()
    assert all(r["n"] == 1 for r in rows) and len({r["p"] for r in rows}) == 3


def test_sweep_prefers_the_true_count(blobs):
    rows = cluster.sweep_clusters(blobs, "id", [2, 3, 4], restarts=2).collect()
    costs = [r["inertia"] for r in rows]
    assert costs == sorted(costs, reverse=True)
    assert max(rows, key=lambda r: r["silhouette"])["k"] == 3


def test_profile_shares_sum_to_all(spark):
    df = spark.createDataFrame(
        [(i % 3, i % 24, i % 6, "Clear", i % 2, i) for i in range(90)],
        "cluster int, hour int, weather_severity int, weather_main string, is_weekend int, traffic_volume int",
    )
    rows = cluster.cluster_profile(df).collect()
    assert sum(r["n_rows"] for r in rows) == 90 and sum(r["pct_of_data"] for r in rows) == pytest.approx(100, abs=0.05)


def test_all_starts_and_counts_fit_in_the_same_passes(spark):
    """Against plain rounds from the same starts; a third of the rows are one point, some are none."""
    import numpy as np

    from tidemark.operators import cluster

    draw = np.random.default_rng(3)
    points = np.concatenate([draw.normal(c, 0.4, (60, 2)) for c in ((0, 0), (4, 0), (0, 5))] + [np.tile([9.0, 9.0], (90, 1))])
    rows = [(i, p) for i, p in enumerate(points.tolist())] + [(999, None)]
    df = spark.createDataFrame(rows, "id long, scaled array<double>").repartition(5)
    wanted = [(k, seed) for k in (1, 2, 4, 300) for seed in (1, 2)]
    fits = cluster.fit_many(df, wanted)
    distinct = np.array([r.scaled for r in df.where("scaled is not null").select("scaled").distinct()
                         .orderBy(F.xxhash64("scaled"), "scaled").limit(cluster.START_ROWS).collect()])
    for (k, seed), fit in zip(wanted, fits):
        centres = cluster._starts(distinct, k, seed)
        assert len(centres) == min(k, len(distinct))
        while True:
            near = ((points[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
            new = np.array([points[near == j].mean(axis=0) if (near == j).any() else centres[j] for j in range(len(centres))])
            if np.sqrt(((new - centres) ** 2).sum(axis=1)).max() <= cluster.TOLERANCE:
                break
            centres = new
        assert fit.cost == pytest.approx(((points - centres[near]) ** 2).sum(), abs=1e-9)
        assert np.allclose(fit.centres, centres)
    best = min(fits[4:6], key=lambda f: f.cost)
    labels = {r.id: r.prediction for r in best.transform(df).collect()}
    assert labels[999] is None and len({labels[i] for i in range(180, 270)}) == 1
    swept = {r.k: r for r in cluster.sweep_clusters(df, "id", (2, 4), restarts=4, sample_size=200).collect()}
    assert swept[4].inertia < swept[2].inertia and swept[4].silhouette > swept[2].silhouette > 0
    assert cluster.fit_many(df.where("false"), [(2, 1)]) == []


def test_rounds_of_k_means_do_not_read_the_rows_again(spark):
    read = spark.sparkContext.accumulator(0)

    def vector(i):
        read.add(1)
        return [float(i % 97), float(i * i % 89)] if i % 10 else None

    rows = spark.range(500, numPartitions=2).select(F.udf(vector, "array<double>")("id").alias("scaled"))
    points = np.array([vector(i) for i in range(500) if i % 10])
    read.value = 0
    fits = cluster.fit_many(rows, [(4, 1), (5, 2), (7, 3)])
    assert 500 <= read.value <= 5 * 500
    for fit, k in zip(fits, (4, 5, 7)):
        far = ((points[:, None] - fit.centres) ** 2).sum(axis=2)
        near = far.argmin(axis=1)
        assert fit.cost == pytest.approx(far.min(axis=1).sum()) and len(fit.centres) == k
        # At rest: every centre is the mean of its rows.
        assert np.allclose([points[near == j].mean(axis=0) for j in range(k)], fit.centres, atol=1e-3)
