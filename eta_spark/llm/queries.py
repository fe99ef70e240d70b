"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eta_spark.llm import bpe, chat, decontaminate, html, license, neardup, packing, quality, repair, search, toxicity, variants, warc
from eta_spark.llm.common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(table(spark, sf_dir, "documents"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(table(spark, sf_dir, "embeddings"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), path))


def op4_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN)


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("failed_rules")


def op7_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op8_warc_in_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).drop("url")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("spans")


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(table(spark, sf_dir, "conversations")))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_byte_level_bpe": op4_byte_level_bpe,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_quality_rules": op6_quality_rules,
    "op7_html_main_text": op7_html_main_text,
    "op8_warc_in_zip": op8_warc_in_zip,
    "op9_toxicity": op9_toxicity,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_decontamination": op12_decontamination,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLE: dict[str, str] = {
    "op1_license_scan": license.SQL,
    "op2_exact_top_k": search.SQL,
    "op5_chat_formatting": chat.SQL,
    "op6_quality_rules": quality.SQL,
    "op8_warc_in_zip": warc.SQL,
    "op11_conversation_repair": repair.SQL,
    "op12_decontamination": decontaminate.SQL,
    "op13_spelling_variants": variants.SQL,
}
