"""Registered queries of this subpackage, over the whole given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import (
    chat_format,
    decontamination,
    filter_audit,
    grammar_store,
    jaccard_join,
    license_scan,
    packing,
    prefix_trie,
    pu_quality,
    secret_scan,
    sentencepiece_codec,
    substring_dedup,
    topk,
)
from pairloom.llm.check_sql import CHECKS
from pairloom.sources.tables import load_dir

__all__ = ["CHECKS", "QUERIES", "tokenizer"]


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(load_dir(spark, sf_dir, "conversations.parquet"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load_dir(spark, sf_dir, "documents.parquet"), tokenizer("byte_bpe_50k.json"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.whole_vectors(load_dir(spark, sf_dir, "embeddings.parquet"))
    return topk.top_k(vectors.where("vec_id % 50 = 0"), vectors, k=5)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and license found in it."""
    found = license_scan.find_licenses(load_dir(spark, sf_dir, "documents.parquet"), carry=["doc_id"])
    return (
        found.select("row.doc_id", F.explode("matches").alias("match"))
        .groupBy("doc_id", "match.license")
        .agg(
            F.count(F.lit(1)).alias("n_matches"),
            F.min("match.start").alias("first_word"),
            F.max("match.containment").alias("containment"),
        )
    )


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_dir(spark, sf_dir, "documents.parquet")
    hits = decontamination.find_hits(docs, load_dir(spark, sf_dir, "benchmark.parquet"), ["doc_id"])
    ids = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return hits.select(
        "row.doc_id",
        "n_words",
        decontamination.n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        decontamination.contaminated().alias("contaminated"),
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(load_dir(spark, sf_dir, "documents.parquet"), ["doc_id"])

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "row.doc_id",
        *[count(kind) for kind in secret_scan.KINDS],
        F.sha2(secret_scan.joined(base), 256).alias("base_sha256"),
        secret_scan.joined(F.col("spans")).alias("spans"),
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_components(load_dir(spark, sf_dir, "documents.parquet"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(load_dir(spark, sf_dir, "documents.parquet"))


def op9_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grammar_store.round_trip(load_dir(spark, sf_dir, "documents.parquet"), tokenizer("word_bpe_49k.json"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (load_dir(spark, sf_dir, f"{t}.parquet") for t in ("documents", "labels"))
    scored = pu_quality.score_quality(docs, labels, ["doc_id"])
    return scored.select(
        "row.doc_id",
        pu_quality.held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= pu_quality.CUT).cast("int").alias("predicted"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (load_dir(spark, sf_dir, f"{t}.parquet") for t in ("documents", "labels"))
    return filter_audit.audit(docs, labels)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(load_dir(spark, sf_dir, "conversations.parquet"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_dir(spark, sf_dir, "documents.parquet").select("doc_id", "text")
    coded = sentencepiece_codec.round_trip(docs, tokenizer("piece_bpe_32k.model"), ["doc_id"])
    return coded.select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_packing": op2_packing,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_license_scan": op4_license_scan,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_secret_scan": op6_secret_scan,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_token_id_output": op9_token_id_output,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_filter_audit": op11_filter_audit,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_sentencepiece": op13_sentencepiece,
}
