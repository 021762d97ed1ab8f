"""Queries with SQL, over the small tables and over odd rows."""

import importlib
import sys
from pathlib import Path

import duckdb
import pytest

from tidemark.llm import queries

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
check = importlib.import_module("check_oracle")

# doc_id, text, source, and columns whose names the operators use themselves
DOCS = "doc_id long, text string, source string, h string, spans int, row long, host int, n_words string"
ODD_DOCS = [
    (r[0], r[1], r[2], "x", 1, 2, 3, "y") for r in [
        (1, None, "a"), (None, None, None), (None, "token=abcdef1 " * 60, None), (2, "", "a"), (3, " \n\t ", "b"),
        (3, "é\x01 SECRET = 'aaaaaaa' password:x token:secret=abcdefgh secret:token:abcdefgh", "b"),
        (4, "AKIA" + "A" * 16 + "AKIAAAA " + "a1" * 12 + " ghp_" + "x" * 36, "b"),
        (5, "𝄞 api_key='zzzzzz' " * 700, "c"), (5, "𝄞 api_key='zzzzzz' " * 700, "c"),
        (6, "one two three four " * 30, "c"), (7, " ".join(f"w{i}" for i in range(60)), "c"),
        (8, "same line here\n" * 40 + " ".join(f"v{i}" for i in range(900)), "d"),
        (9, " ".join(f"w{i}###" for i in range(80)), "e"), (10, " ".join(f"W{chr(65 + i % 26)}X" for i in range(80)), "e"),
        (11, "-----BEGIN RSA PRIVATE KEY----- sk_live_" + "a" * 20 + " xoxb-1234567890ab", "e"),
    ]
]
PAGES = "page_id long, url string, html string, digest string, first long"
ODD_PAGES = [
    (*r, "k", 1) for r in [
        (1, None, None), (None, "u\r\nX: 1", ""), (2, "http://a%41/\x7f", "x"), (2, "b", "x"), (3, "c", "x"),
        (4, "d", "é\r\n\r\nWARC/1.1"), (None, None, "lone"), (None, None, "lone"), (5, "", "q" * 300000), (6, "", "q" * 300000),
        (7, "P*M", "P*M\x18\0\0\0\0"),
    ]
]
VECTORS = "vec_id long, embedding array<double>, label int, node int, filters string"
ODD_VECTORS = [
    (*r, 1, "f") for r in [
        (1, None, 1), (None, [1.0, 0.0, 0.0], 1), (2, [0.0, 0.0, 0.0], 1), (3, [1.0, 0.0, 0.0], 1), (3, [1.0, 0.0, 0.0], 1),
        (4, [2.0, 0.0, 0.0], 1), (5, [1.0, 0.0, 0.0], None), (6, [1.0, float("nan"), 0.0], 1), (7, [1.0, None, 0.0], 1),
        (8, [], 1), (9, [1.0, 0.1, 0.0], 2), (10, [1.0, 0.1, 0.0], 2), (11, [float("inf"), 0.1, 0.0], 2), (12, [1e-30, 0.0, 0.0], 1),
        (13, [1.0, 0.0], 1),
    ]
]
WIDE_VECTORS = [
    (r[0], None if r[1] is None else [x if i % 7 or x is None else x + i / 64 for i in range(21) for x in r[1]] + [0.25], *r[2:]) for r in ODD_VECTORS if r[0] not in (11, None)
]
AUDITED = "doc_id long, text string, source string, lang string, n int, term string, place int"
TABLES = {
    "op11_centroids": ("embeddings", WIDE_VECTORS, VECTORS), "op12_block_topk": ("embeddings", [*ODD_VECTORS, (100, [1.0, -2.0, 3.0], 1, 1, "f"), (100, [0.5], 1, 1, "f")], VECTORS),
    "op13_divergence": ("documents", [(*r[:3], None if r[0] == 2 else "en", 1, "x", 2) for r in ODD_DOCS], AUDITED),
    "op1_quality_rules": ("documents", ODD_DOCS, DOCS), "op4_secret_scan": ("documents", ODD_DOCS, DOCS),
    "op5_warc": ("pages", ODD_PAGES, PAGES), "op6_spherical_filters": ("embeddings", ODD_VECTORS, VECTORS),
}


def compare(spark, folder, name):
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    return check.compare(spark, con, name, queries.QUERIES[name], queries.SQL[name], folder)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_small_tables(spark, small, name):
    _, rows, verdict = compare(spark, small, name)
    assert verdict == "ok" and rows > 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_odd_rows(spark, tables, name):
    table, rows, schema = TABLES[name]
    _, n, verdict = compare(spark, tables(**{table: (rows, schema)}), name)
    assert verdict == "ok" and (n == len(rows) or name in ("op11_centroids", "op12_block_topk", "op13_divergence")) and n > 0


EMPTY = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long", "labels": "doc_id long, quality int, toxic int",
    "pages": "page_id long, url string, html string", "embeddings": "vec_id long, embedding array<float>, label int",
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(spark, tables, name):
    assert queries.QUERIES[name](spark, tables(**{t: ([], s) for t, s in EMPTY.items()})).count() == 0
