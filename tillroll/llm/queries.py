"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.bpe import round_trip
from tillroll.llm.chat import format_chats, read_back
from tillroll.llm.common import table
from tillroll.llm.exact_dedup import exact_dedup
from tillroll.llm.jaccard import jaccard_join
from tillroll.llm.licenses import license_scan
from tillroll.llm.minhash import near_duplicates
from tillroll.llm.packing import pack
from tillroll.llm.pii import personal_data
from tillroll.llm.prefixes import conversation_trie
from tillroll.llm.quality import quality
from tillroll.llm.resampling import resample
from tillroll.llm.secrets import secrets
from tillroll.llm.toxicity import toxicity


def tokenizer_file(name: str) -> str:
    """Where the public tokenizers' files are on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: A conversation that looks like control strings.
ODD = "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = spark.createDataFrame([(-1, 0, "user", ODD), (-1, 1, "assistant", ODD)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(odd)
    return read_back(format_chats(turns.withColumns({"seq": F.col("turn"), "kind": F.lit("message")})))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents")).drop("rejected_by")


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    base = F.sha2("base_spans", 256).alias("base_sha256")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", base, "spans", "n_term")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return license_scan(documents.withColumn("path", F.concat_ws("/", "source", "lang", "doc_id")))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_random"
    )


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_quality_rules": op2_quality_rules,
    "op3_bpe_round_trip": op3_bpe_round_trip,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_personal_data": op5_personal_data,
    "op6_toxicity": op6_toxicity,
    "op7_license_scan": op7_license_scan,
    "op8_minhash": op8_minhash,
    "op9_packing": op9_packing,
    "op10_secrets": op10_secrets,
    "op11_resampling": op11_resampling,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_prefix_trie": op13_prefix_trie,
}
