"""The pipeline's stages: an operator, and what its decision does to the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..shipping import ship
from . import decontam, minhash, packing, secrets, toxicity
from .common import free_name, read, scratch, whole

#: Findings of at most so many bytes are sent to every executor; more are joined by a shuffle.
BROADCAST_BYTES = 32 << 20


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, trained on the labels it may see, does not call toxic; rows and columns as they are.

    Null and empty texts, and all documents where there is nothing to learn
    from, score alike and stay unless the only label is toxic.
    """
    machine = toxicity.train(docs.select("doc_id", "text"), read(spark, sf_dir, "labels").where(~toxicity.held_out()))
    return toxicity.drop_toxic(docs, machine)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: that with the smallest id, null ids last; of one id's texts that with the smallest hash.

    An id's different texts are different documents. Of rows equal in id and
    text one stays: that whose columns' hash is smallest, so a rerun keeps the
    same. Null and empty texts are one text. Empty tables stay empty; other
    columns are kept, whatever their names.
    """
    ship(spark)
    key, name, pick = (free_name(docs, n) for n in ("kept_key", "kept_text", "kept_pick"))
    body = whole("text")
    # The class's smallest document is told by id and text together.
    document = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.xxhash64(body).alias("text"))
    classes = minhash.near_duplicates(docs.select(document.alias("doc_id"), body.alias("text")))
    kept = classes.where("kept").select(F.col("doc_id.id").alias(key), F.col("doc_id.text").alias(name)).distinct()
    left = docs.withColumn(pick, F.xxhash64(body)).join(kept, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(pick) == F.col(name)), "left_semi")
    row = F.struct(*[F.col(c) for c in docs.columns])
    once = left.groupBy(F.col("doc_id").alias(key), F.col(pick).alias(name)).agg(F.min_by(row, F.xxhash64(row)).alias(pick))
    return once.select(f"{pick}.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontam.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced; ``n_chars``, if there is one, follows the text where it changed.

    Null and clean texts stay as they are, repeated rows stay repeated, and
    empty tables empty; other columns are kept, whatever their names.
    """
    ship(spark)
    blob, spans, fresh = (free_name(docs, name) for name in ("hit_blob", "hit_spans", "fresh_text"))
    found = secrets.scan_unseen(docs.select("doc_id", "text")).where(F.size("spans") > 0)
    hits = scratch(found.select(F.col("blob").alias(blob), F.col("spans").alias(spans)), "hits")
    size = hits.agg(F.sum(F.size(spans) * 32 + 64)).first()[0] or 0
    held = docs.join(F.broadcast(hits) if size <= BROADCAST_BYTES else hits, secrets.address("text") == F.col(blob), "left")
    changed = F.col(spans).isNotNull()
    held = held.withColumn(fresh, F.when(changed, secrets.redact(F.col("text"), F.col(spans))).otherwise(F.col("text")))
    new = {"text": F.col(fresh)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length(fresh).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return held.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences; null texts are empty, repeated rows are packed each, no rows give none."""
    ship(spark)
    return packing.pack(docs)
