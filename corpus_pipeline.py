"""From raw documents to packed training sequences, in stages that are written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import minhash, mixing, packing, quality
from seriesloom.llm.encoding import tokenizer_path
from seriesloom.llm.shared import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.judged(docs, labels, COLUMNS).where("kept").select(*COLUMNS)


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the least doc_id."""
    kept = minhash.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("kept_id"), F.col("hash").alias("kept_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.xxhash64("text") == F.col("kept_hash"))
    # Rows equal in id and text are one document: a kept one goes on once.
    return docs.select(*COLUMNS).join(kept.distinct(), same, "left_semi").dropDuplicates(["doc_id", "text"])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs.select(*COLUMNS), mixing.Target(repeated=mixing.REPEATED)).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("quality rules", good), ("near duplicates", unique), ("mixing", mix), ("packing", pack)]

#: The model of the rules and the tokenizer are not to be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
