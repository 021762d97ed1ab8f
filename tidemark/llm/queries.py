"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import blockmax, bpe, divergence, edit_counts, kmeans, packing, pii, quality, secret_scan, simhash, spherical, toxicity, warc
from tidemark.llm.sql import SQL  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.judge(_read(spark, folder, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.concat_ws(",", "host_convicted").alias("host_convicted"),
    )


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    rows = bpe.round_trip(_read(spark, folder, "documents"), "byte_bpe_50k.json")
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(_read(spark, folder, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("tokens").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def _count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = secret_scan.find(_read(spark, folder, "documents"))
    kinds = [r.kind for r in secret_scan.BASE]
    base = F.filter("spans", lambda x: x["kind"].isin(kinds))
    return rows.select(
        "doc_id",
        *[_count_of("spans", k) for k in kinds],
        F.sha2(secret_scan.written(base), 256).alias("base_sha256"),
        secret_scan.written(F.col("spans")).alias("spans"),
    )


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    back = warc.round_trip(_read(spark, folder, "pages"))
    return back.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_spherical_filters(spark: SparkSession, folder: str) -> DataFrame:
    return spherical.near_vectors(_read(spark, folder, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.detect(_read(spark, folder, "documents"), _read(spark, folder, "labels"))
    return scored.select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.array_join(F.transform("offending", lambda x: F.concat_ws(":", x["start"], x["end"])), ",").alias("offending"),
    )


def op8_edit_counts(spark: SparkSession, folder: str) -> DataFrame:
    edited = edit_counts.with_cleaning_edits(_read(spark, folder, "documents"))
    counts = edit_counts.count(edited)
    return counts.select("doc_id", "n_before", "n_after", "n_edits", "n_recut", F.sha2("edited", 256).alias("edited_sha256"))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    rows = simhash.near_duplicates(_read(spark, folder, "documents"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("f0")), 16, "0").alias("fingerprint"), "component_id")


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    rows = pii.find(_read(spark, folder, "documents"))
    base = F.filter("spans", lambda x: x["kind"].isin(list(pii.KINDS)))
    return rows.select(
        "doc_id", *[_count_of("spans", k) for k in pii.KINDS],
        F.sha2(pii.written(base), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"),
    )


def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    rows = kmeans.cluster(_read(spark, folder, "embeddings"))
    return rows.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256")
    )


def op12_block_topk(spark: SparkSession, folder: str) -> DataFrame:
    return blockmax.top_k(_read(spark, folder, "embeddings"))


def op13_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(_read(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_bpe": op2_bpe,
    "op3_packing": op3_packing,
    "op4_secret_scan": op4_secret_scan,
    "op5_warc": op5_warc,
    "op6_spherical_filters": op6_spherical_filters,
    "op7_toxicity": op7_toxicity,
    "op8_edit_counts": op8_edit_counts,
    "op9_simhash": op9_simhash,
    "op10_pii": op10_pii,
    "op11_centroids": op11_centroids,
    "op12_block_topk": op12_block_topk,
    "op13_divergence": op13_divergence,
}
