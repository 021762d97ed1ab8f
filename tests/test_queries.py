"""The registered queries: contract, and a sample of them against DuckDB."""

import importlib
import re
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark import plans

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "tools"))
check = importlib.import_module("check_oracle")

# Fits and scored streams, whose numbers no SQL can state.
NO_SQL = {
    "fit_classifiers", "fit_regressors", "top_features", "version_comparison", "batch_score", "kmeans_fit", "k_sweep",
    "sensor_regressors", "next_hour_forecast", "tree_attribution", "tree_attribution_rank", "model_recommendations", "stream_score",
}
SAMPLE = [
    "cleaned_hours", "audit_table", "dedupe_conflicts", "annual_change", "date_summary", "weekend_compare", "histogram",
    "box_stats", "exact_quantiles_sliced", "nearest_lookup", "feature_build", "request_validation", "valid_windows",
    "time_split_ties", "roc_auc", "level_rules", "silhouette", "drift_findings", "alias_latest",
]


def test_every_query_has_sql_or_a_reason():
    assert set(plans.queries()) - set(plans.oracles()) == NO_SQL
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "traffic_volume" in df.columns


@pytest.fixture(scope="module")
def con(small):
    con = duckdb.connect()
    for path in Path(small).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", SAMPLE)
def test_against_duckdb(spark, con, small, name):
    _, rows, verdict = check.compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], small)
    assert verdict == "ok" and rows > 0


def test_the_library_avoids_what_does_not_scale():
    banned = re.compile(r"crossJoin|localCheckpoint|\.rdd\b|F\.udf|toLocalIterator|collect_set\(")
    for path in (ROOT / "tidemark").rglob("*.py"):
        assert not banned.search(path.read_text()), path
