"""A training corpus from raw documents, in five written stages.

Toxic documents go, then exact copies, then all but one document of each SimHash
class; sources are mixed to target weights, and what is left is packed. Every stage
reads what its predecessor wrote. Stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyguard.llm import exact_dedup, mixing, packing, simhash, toxicity
from tallyguard.llm.common import stage
from tallyguard.llm.queries import TARGETS, quality_domains, table, tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near(docs, width=3, distance=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, quality_domains(table(spark, sf_dir, "labels")), TARGETS, whole="clean")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs, tokenizer("byte_bpe_50k.json"), 2048, 0)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_exact), ("simhash_near_dedup", drop_near),
          ("mixing", mix_sources), ("packing", pack_sequences)]

ORACLE_SQL = None  # a trained classifier decides in the first stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
