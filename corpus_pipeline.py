"""The training-data pipeline over ``documents``: five stages, each one operator.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written and read again
as the next stage's ``docs``.  All but the last return the columns of ``documents``.

1. quality: co-trained classifier, fitted on ``labels``; documents that it rejects go;
2. lines: winnowing line dedup; later repeated runs of lines go whole from the texts, and
   documents with nothing left but blanks go;
3. near_duplicates: token-group Jaccard join over sets of five words at 0.8; of each group
   of linked documents the one with the smallest id stays;
4. mixing: raking to target weights; documents are drawn by their probability;
5. packing: pieces of at most 2048 tokens with their sequence and place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.llm import cotraining, line_dedup, packing, raking, token_groups
from feedlens.llm.common import saved, table
from feedlens.llm.queries import RANKS, VOCABULARY


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = cotraining.classify(docs, table(spark, sf_dir, "labels"))
    return out.where("keep").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(docs, extend=True)
    emptied = (F.col("lines_removed") > 0) & (F.trim("text") == "")
    return out.where(~F.coalesce(emptied, F.lit(False))).withColumn(
        "n_chars", F.when(F.col("lines_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = token_groups.jaccard_components(docs, width=5, percent=80)
    others = found.where("id <> component").select(F.col("id").alias("doc_id"))
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return raking.mix(docs).where("mix_kept").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, VOCABULARY, RANKS).withColumnRenamed("id", "doc_id")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mixing", mixing), ("packing", pack)]

#: The classifier and the tokenizer have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = saved(docs, f"stage-{name}")
    return docs
