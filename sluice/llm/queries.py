"""The registered queries of the numbered operators, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluice.llm import bitpack, bpe, divergence, fertility, jaccard, langid, linedup, packing, phrases, quality, topk, toxicity, urlfilter
from sluice.llm.common import table


def op1_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.query(table(spark, sf_dir, "documents"))


def op2_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.query(table(spark, sf_dir, "documents"))


def op3_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.query(table(spark, sf_dir, "documents"))


def op5_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.query(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_url_bloom_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.query(table(spark, sf_dir, "pages"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_token_bitpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitpack.query(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op9_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


def op10_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.query(table(spark, sf_dir, "embeddings"))


def op11_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.query(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_vertical_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.query(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.query(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {"op2_line_runs": linedup.ORACLE, "op4_signature_trees": jaccard.ORACLE, "op6_url_bloom_rules": urlfilter.ORACLE, "op10_impact_topk": topk.ORACLE, "op12_vertical_phrases": phrases.ORACLE, "op13_source_divergence": divergence.ORACLE}
