"""From documents to packed sequences: the operators, one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from genflow.llm import stages
from genflow.llm.common import read, scratch

STAGES = [
    ("toxicity", stages.drop_toxic),
    ("minhash", stages.drop_near_copies),
    ("decontamination", stages.drop_contaminated),
    ("secrets", stages.redact_secrets),
    ("packing", stages.pack_sequences),
]
# Tokenizers and trained models are beyond SQL: tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
