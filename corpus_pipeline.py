"""A corpus pipeline of the operators in tillroll.llm: each stage's result is written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm.common import stored, table
from tillroll.llm.exact_dedup import drop_copies
from tillroll.llm.minhash import drop_near_copies
from tillroll.llm.packing import pack
from tillroll.llm.queries import tokenizer_file
from tillroll.llm.secrets import mask_secrets
from tillroll.llm.toxicity import drop_toxic


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine doesn't take for toxic."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates."""
    return drop_near_copies(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts."""
    return mask_secrets(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in training sequences."""
    return pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_stage),
    ("minhash near dedup", near_stage),
    ("secret scans", secrets_stage),
    ("packing", packing_stage),
]

#: SQL can express neither the learnt scores nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
