"""Documents to packed training sequences: quality rules, toxicity, near duplicates, packing.

Each stage takes what its predecessor kept, written as Parquet and read again.
The first three return the columns of documents, the last one row for each
piece of a document. Null texts have no words, so the quality rules reject
them; toxicity is learned from the labels of the documents that reach it.

The first two stages carry each row's columns through the operator beside its
verdict, so rows without doc_id and repeated rows are judged like others, and
no verdict depends on how a table is read again. The third numbers the rows in
a stored table and compares these, whatever their doc_id: of rows with near
texts the one with the smallest doc_id stays, those without one come last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eta_spark.llm import neardup, packing, quality, toxicity
from eta_spark.llm.common import stored, table

ROW = "_corpus_row"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.withColumn(ROW, F.struct(*(F.col(f"`{name}`") for name in docs.columns)))
    verdicts = quality.quality_rules(rows, table(spark, sf_dir, "labels"), carry=(ROW,))
    return verdicts.where("kept").select(f"{ROW}.*")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")
    found = neardup.near_duplicates(rows.select(F.col(ROW).alias("doc_id"), "text")).select(F.col("doc_id").alias(ROW), "component_id")
    content = F.xxhash64(*(F.col(f"`{name}`").cast("string") for name in docs.columns))
    order = rows.select(ROW, F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), content.alias("content"), F.col(ROW).alias("row")).alias("order"))
    kept = found.join(order, ROW).groupBy("component_id").agg(F.min("order").alias("first")).select(F.col("first.row").alias(ROW))
    return rows.join(kept, ROW, "left_semi").drop(ROW)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near duplicates", near_duplicate_stage),
    ("best-fit packing", packing_stage),
]

#: SQL has no tokenizer and fits no classifier; tests/llm holds a plain version beside it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
