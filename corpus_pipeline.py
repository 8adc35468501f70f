"""Corpus pipeline: from raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes
each stage's result as Parquet in the cluster's shared folder and rereads it as
the next stage's docs, so an executor lost in one stage never costs another.
All stages but the last keep the columns of ``documents``.

1. toxicity: documents that score `toxicity.THRESHOLD` or more go.
2. near_duplicates: of each group linked by 5-word shingles at Jaccard 0.8, one row stays, of the least id.
3. decontamination: documents that hold a benchmark item go.
4. secrets: documents that hold a secret go, of the fixed patterns or found by token efficiency.
5. packing: what is left becomes pieces of sequences of at most 2,048 tokens, with their ids.

Every row is judged by itself: stages 2 and 3 give each a key, written with the
row, and search and remove by that, so rows with a null or repeated id are treated
as any other (null ids come last in a group).  Null and empty texts pass every
filter and are one end token in the last.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import decontaminate, ngram_join, packing, secrets, toxicity
from tollgate.llm.storage import settle, table

def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each_group(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.keep_clean(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("toxicity", remove_toxic), ("near_duplicates", remove_near_duplicates), ("decontamination", remove_contaminated),
          ("secrets", remove_secrets), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


#: Learned scores, tokenizers and the closure of links are beyond one SQL text; the tests hold each stage against brute force.
ORACLE_SQL = None
