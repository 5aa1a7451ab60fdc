"""Registered queries of the operators in this package, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, decontam, embeddings, langid, minhash, ngram_lm, packing, pii, prefix_trie, secrets, sharding, toxicity, vector_codes
from .common import read, scratch


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = scratch(secrets.scan_unseen(docs), "ledger")
    return secrets.digest(secrets.findings_by_path(docs, ledger))


def op2_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.train(docs, read(spark, sf_dir, "labels").where(~toxicity.held_out()))
    found = toxicity.score(docs, machine)
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op3_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op4_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.linked_vectors(read(spark, sf_dir, "embeddings"))


def op5_seed_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.preferences(turns, chat.swapped_replies(turns))


def op7_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.shard_documents(read(spark, sf_dir, "documents"))
    return shards.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"))


def op9_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(read(spark, sf_dir, "documents")))


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = ngram_lm.train(docs.where(~ngram_lm.held_out()))
    found = ngram_lm.score(docs, model)
    return found.select("doc_id", ngram_lm.held_out().alias("held_out"), "n_tokens", "n_known",
                        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op11_resident_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(read(spark, sf_dir, "embeddings"))


def op12_byte_convolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    network = langid.train(docs.where(~langid.held_out()))
    found = langid.predict(docs.select("doc_id", "text", langid.held_out().alias("held_out")), network)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op13_centroid_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_rollup(read(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_secret_scan, op2_string_kernel, op3_prob_minhash, op4_collision_counting, op5_seed_alignment, op6_preference_format, op7_label_propagation, op8_best_fit_packing, op9_candidate_boosting, op10_kneser_ney, op11_resident_lloyd, op12_byte_convolution, op13_centroid_rollup)}
ORACLES: dict[str, str] = {
    "op6_preference_format": chat.ORACLE, "op11_resident_lloyd": vector_codes.ORACLE, "op13_centroid_rollup": prefix_trie.ORACLE}
