import re
import zlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidemark.llm import queries, toxicity

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labelled():
    text = {r["doc_id"]: r["text"] for r in pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()}
    rows = pq.read_table(f"{FOLDER}/labels.parquet").to_pylist()
    return [(r["doc_id"], text[r["doc_id"]], r["toxic"]) for r in rows if r["doc_id"] in text]


@pytest.fixture(scope="module")
def model(labelled):
    learn = [r for r in labelled if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    return toxicity.fit([r[1] for r in learn], [r[2] for r in learn])


def test_scores_are_the_noisy_or_of_the_sentences(model):
    texts = ["", "!!! a. b", "Hello idiot. fine\nbad moron!", " . . ", ".x", "stupid stupid trash", "a\x01b", "tab\tand nbsp\xa0idiot"]
    scores, p, bags = model.score(pa.array(texts))
    for i, text in enumerate(texts):
        sentences = re.split(toxicity.SENTENCE_END, text)
        quiet = 1.0
        for s in sentences:
            z = sum(model.weights[f].sum() for w in re.split(r"[\t-\r ]+", s) if (f := toxicity.features(w)))
            quiet *= (1 + np.exp(toxicity.START)) / (1 + np.exp(toxicity.START + z))
        assert scores[i] == pytest.approx(1 - quiet)
        assert set(bags.place_of_sentence[bags.doc_of_sentence == i].tolist()) <= set(range(len(sentences)))
    assert scores[0] == scores[3] == 0


def test_held_out_documents_are_told_apart(spark, labelled):
    rows = {r.doc_id: r for r in queries.op7_toxicity(spark, FOLDER).collect()}
    held = [(rows[d].score, y, rows[d].predicted) for d, _, y in labelled if rows[d].held_out]
    pos, neg = ([s for s, y, _ in held if y == v] for v in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert auc > 0.85
    assert sum(p for _, y, p in held if y == 0) <= 0.06 * len(neg) and sum(p for _, y, p in held if y == 1) > 0.7 * len(pos)
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows.values())


def test_offending_sentences_are_located(spark, model):
    text = "é 𝄞 fine day.All is well!\n\nYou stupid worthless idiot moron... bye"
    row = toxicity.assess(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert [text[s.start:s.end] for s in row.offending] == ["You stupid worthless idiot moron"]


def test_odd_rows_and_labels(spark, tables):
    rows = [(1, None), (None, None), (None, "You idiot. ok"), (2, ""), (3, "...."), (3, "idiot"), (3, "idiot"), (4, "a\x01b " * 50)]
    folder = tables(
        documents=([(*r, 1.0, "k") for r in rows], "doc_id long, text string, score double, toxic string"),
        labels=([(3, 1), (2, 0), (3, 0), (None, 1), (1, None)], "doc_id long, toxic int"),
    )
    found = queries.op7_toxicity(spark, folder).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    stays = toxicity.keep(docs, labels)
    assert stays.columns == docs.columns and stays.count() == len(rows)


def test_the_sample_never_has_held_out_rows(spark, tables, labelled):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts, y = toxicity.sample(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    learn = {(t, v) for d, t, v in labelled if zlib.crc32(str(d).encode()) % 3 != 1}
    assert set(zip(texts, y)) == learn
    assert list(accumulate(y)) and len(texts) <= sum(toxicity.TRAIN_ROWS.values())


def test_a_key_with_many_rows_is_learnt_from_once(spark):
    rows = [(i, f"text number {i}") for i in range(30)] + [(0, f"another text {i}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, toxic int")
    learnt = {r.doc_id for r in docs.where(~toxicity.held_out("doc_id")).collect()}
    assert 0 in learnt
    texts, y = toxicity.sample(docs, labels)
    assert len(texts) == len(y) == len(learnt) and set(texts) <= {t for _, t in rows}
