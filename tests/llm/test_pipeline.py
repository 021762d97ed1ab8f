import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import pii, quality, toxicity

from test_simhash import expected


def plain_keep(text):
    """The quality rules on one text of a host that is not convicted of any."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = Counter(grams)
    repeated = len({p for i, g in enumerate(grams) if n[g] > 1 for p in (i, i + 1, i + 2)})
    lines = [s for s in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    parts = {
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_words": len(words), "n_dup_lines": len(lines) - len(set(lines)),
        "n_lines": len(lines), "n_repeat_words": repeated, "n_upper": len(re.findall("[A-Z]", text)), "word_chars": sum(map(len, words)),
    }
    base = len(words) < 50 or 100 * repeated > 50 * len(words)
    return not base and not any(100 * parts[r.part] > r.outer * parts[r.whole] for r in quality.RULES)


def test_each_stage_on_what_its_predecessor_kept(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    before = {r.doc_id: r.text for r in docs.collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "packing":
            break
        assert out.columns == columns
        rows = out.collect()
        after = {r.doc_id: r.text for r in rows}
        assert len(after) == len(rows) and after.keys() <= before.keys()
        if name == "quality_rules":
            assert after == {d: t for d, t in before.items() if plain_keep(t)} and len(after) < len(before)
        elif name == "toxicity":
            texts, y = toxicity.sample(docs, spark.read.parquet(f"{small}/labels.parquet"))
            model = toxicity.fit(texts, y)
            import pyarrow as pa

            score = dict(zip(before, model.score(pa.array(list(before.values())))[0].tolist()))
            assert after == {d: t for d, t in before.items() if score[d] < 0.7}
        elif name == "simhash_near_dedup":
            wanted = {c for _, _, c in expected(list(before.items())).elements()}
            assert after == {d: before[d] for d in wanted} and len(after) < len(before)
        elif name == "pii":
            assert after.keys() == before.keys() and all(r.n_chars == len(r.text) for r in rows)
            for d, t in before.items():
                assert (after[d] == t) if not pii.base_spans(t) else (after[d] != t and len(pii.base_spans(after[d])) < len(pii.base_spans(t)))
        before, docs = after, out
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens = {d: np.array([*library.encode(t, add_special_tokens=False).ids, 1], dtype="<u4") for d, t in before.items()}
    held = Counter()
    for r in out.collect():
        assert zlib.crc32(r.tokens) == zlib.crc32(tokens[r.doc_id][r.start:r.start + r.length].tobytes())
        held[r.doc_id] += r.length
    assert held == Counter({d: len(t) for d, t in tokens.items()})


def test_odd_rows_pass_through_every_stage(spark, tables):
    long = " ".join(f"word{i}" for i in range(80))
    rows = [
        (1, None, None, None, None, "x", 1), (None, long, "en", None, 3, "x", 1), (None, long, "en", None, 3, "x", 1), (2, "", "en", "a", 0, "x", 1),
        (3, long + " bob@corp.com", None, "a", None, "x", 1), (3, long + " bob@corp.com", None, "a", None, "x", 1), (4, long * 3000, "en", "b", 1, "x", 1),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, spans string, h int"
    folder = tables(documents=(rows, schema), labels=([(3, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int"))
    pieces = corpus_pipeline.run(spark, folder).collect()
    # The longest text repeats itself and goes; a mail address makes a text of its own.
    assert {p.doc_id for p in pieces} <= {None, 3} and 3 in {p.doc_id for p in pieces}
    empty = tables(documents=([], schema), labels=([], "doc_id long, quality int, toxic int"))
    assert corpus_pipeline.run(spark, empty).count() == 0


NAMES = [
    "node", "family", "root", "h", "f0", "n", "_k", "_h", "_host", "_hash", "_spans", "_key", "_label", "_text", "_words", "score", "spans", "kept",
    "host", "component_id", "_size_key", "_fact_host", "text_", "offending", "first", "entity", "term",
]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_columns_named_like_a_stage_s_own_stay(spark, tables, name, stage):
    long = " ".join(f"word{i}" for i in range(80))
    rows = [(i, f"{long} number{i} bob{i % 2}@corp.com", "en", f"s{i % 2}", 9, *[f"{n}{i}" for n in NAMES]) for i in range(6)] + [(None,) * (5 + len(NAMES))]
    schema = ", ".join(["doc_id long, text string, lang string, source string, n_chars long", *[f"{n} string" for n in NAMES]])
    folder = tables(documents=(rows, schema), labels=([(i, 1, i % 2) for i in range(6)], "doc_id long, quality int, toxic int"))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = stage(spark, docs, folder)
    found = out.collect()
    assert found
    if name != "packing":
        assert out.columns == docs.columns
        assert all(r[n] == (None if r.doc_id is None else f"{n}{r.doc_id}") for r in found for n in NAMES)


def test_order_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "simhash_near_dedup", "pii", "packing"]
