"""From raw documents to packed training sequences, a stage at a time.

Each stage takes the documents its predecessor kept and returns those it keeps, with the same
columns; the last returns packed pieces. Stages meet only as Parquet in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import packing, pii, quality, simhash, toxicity
from tidemark.session import run_folder, scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or a rule at the bound their host is held to, go.

    A null text has no words and goes; rows that repeat share a verdict.
    """
    return quality.keep(docs)


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at the threshold or above go; the model is fitted to labels of what is left.

    A null text scores 0 and stays; without usable labels nothing goes.
    """
    return toxicity.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (fingerprints of 3-word shingles, 2 bits at most apart) the smallest doc_id stays."""
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked, disclosing terms are generalised or removed; ``n_chars`` follows the text.

    A null text stays null; rows that repeat stay as often as they are there.
    """
    clean = pii.sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else clean


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens. A null text is an empty one."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("toxicity", toxic_documents),
    ("simhash_near_dedup", near_duplicates),
    ("pii", personal_data),
    ("packing", packed),
]

#: SQL can express neither the fitted model nor the tokenizer; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. No documents give no pieces.

    The tables a stage makes on its way are removed when its result is stored. Every stage keeps
    columns it does not know, whatever their names.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = run_folder(spark, f"pipeline-{name}")
        with scratch(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
