from tidemark.llm import quality


def test_a_host_with_many_failures_is_held_to_the_inner_bound(spark):
    clean = " ".join(f"word{i}" for i in range(100))
    doubtful = " ".join(f"word{i}#" if i < 15 else f"word{i}" for i in range(100))
    rows = [(i, doubtful, "bad") for i in range(60)] + [(100 + i, clean, "bad") for i in range(20)]
    rows += [(1000 * h + i, clean, f"good{h}") for h in range(1, 12) for i in range(60)]
    rows += [(90_000, doubtful, "good1"), (90_001, doubtful, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.kept for r in quality.judge(docs).collect()}
    assert not any(kept[i] for i in range(60))
    assert all(kept[100 + i] for i in range(20)) and kept[90_000]
    # One doubtful row does not condemn a host of its own: the prior of all hosts holds it up.
    rate = {r.host: r.rate_symbols for r in quality.host_rates(quality.measure(docs)).collect()}
    assert rate["good1"] < 0.05 < 0.3 < rate["bad"] and rate[None] < 0.3 and kept[90_001]
    stays = quality.keep(docs)
    assert stays.columns == docs.columns and {r.doc_id for r in stays.collect()} == {d for d, k in kept.items() if k}


def test_hosts_of_one_row_are_not_condemned_by_it(spark):
    clean = " ".join(f"word{i}" for i in range(100))
    doubtful = " ".join(f"word{i}#" if i < 15 else f"word{i}" for i in range(100))
    rows = [(100 * h + i, clean, f"big{h}") for h in range(30) for i in range(20)]
    rows += [(10_000 + i, doubtful if i < 10 else clean, f"one{i}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert all(r.kept for r in quality.judge(docs).collect())
    # Also where hosts are all good or all bad, one row is not enough and sixty are.
    rows += [(20_000 + 100 * h + i, doubtful, f"bad{h}") for h in range(4) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {r.doc_id for r in quality.judge(docs).collect() if not r.kept} == {20_000 + 100 * h + i for h in range(4) for i in range(60)}


def test_weight_of_the_prior():
    # Hosts of 10 rows with rates 0.2 and 0.6: E[f (f - 1) / (n - 1)] over rows is the mean squared rate.
    assert abs(quality.prior_weight(2_000, 800, 2_000 * (0.04 + 0.36) / 2) - (0.24 / 0.04 - 1)) < 1e-9
    assert quality.prior_weight(0, 0, 0.0) == quality.prior_weight(100, 0, 0.0) == quality.prior_weight(100, 50, 25.0) == quality.MOST_WEIGHT
    assert quality.prior_weight(100, 50, 50.0) == quality.LEAST_WEIGHT


def test_a_very_long_text_is_measured_whole(spark):
    text = "\n".join(f"word{i} and line" for i in range(200_000)) + "\nword1 and line"
    docs = spark.createDataFrame([(1, text, "a"), (1, text, "a"), (2, None, None)], "doc_id long, text string, source string")
    rows = sorted(map(tuple, quality.measure(docs).select("doc_id", "n_words", "n_dup_lines", "n_repeat_words").collect()))
    assert rows == [(1, 600_003, 1, 10), (1, 600_003, 1, 10), (2, 0, 0, 0)]
