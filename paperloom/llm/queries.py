"""The registered queries of the training-data operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperloom.llm import chat_format, exact_dedup, jaccard_join, lm_score, packing, pii, piece_codec, quality_rules, sharding, suffix_dedup, token_alignment, url_filter, whitening
from paperloom.llm.common import read


#: The limit of the sharding query: small, so that tables of any size are split.
SHARD_BYTES = 256 << 10


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"), SHARD_BYTES)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat_format.read_back(chat_format.format_segments(turns))


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file; only the queries know where these are, the operators take a path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json")).drop("ids")


def op7_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digests(read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(read(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(read(spark, sf_dir, "documents"), "crc32(cast(doc_id as string)) % 5 = 1")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(read(spark, sf_dir, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_url_filter": op2_url_filter,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_quality_rules": op4_quality_rules,
    "op5_chat_format": op5_chat_format,
    "op6_packing": op6_packing,
    "op7_piece_codec": op7_piece_codec,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_lm_score": op10_lm_score,
    "op11_whitening": op11_whitening,
    "op12_token_alignment": op12_token_alignment,
    "op13_pii": op13_pii,
}
ORACLES = {
    "op1_sharding": sharding.oracle(SHARD_BYTES),
    "op3_jaccard_join": jaccard_join.ORACLE,
    "op5_chat_format": chat_format.oracle_sql(),
    "op9_exact_dedup": exact_dedup.ORACLE,
}
