"""The corpus pipeline: toxicity, exact copies, near copies, mixing by source, packing into sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm.common import stage, table
from cardwarden.llm.exact_dedup import exact_dedup
from cardwarden.llm.jaccard_join import jaccard_join
from cardwarden.llm.mixing import fair_mix, word_count
from cardwarden.llm.packing import pack_documents
from cardwarden.llm.toxicity import THRESHOLD, score_toxicity, trained_on_tables


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold."""
    scored = score_toxicity(docs, trained_on_tables(spark, sf_dir))
    return scored.where(F.col("score") < THRESHOLD).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact_dedup(docs).where("kept").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies. Rows are told apart by a number that is written with them, so repeated
    and null ids do no harm."""
    numbered = stage(docs.withColumn("__row", F.monotonically_increasing_id()), "pipeline-numbered")
    joined = jaccard_join(numbered, name="pipeline-near", row="__row")
    kept = joined.where("kept").select(F.col("row_id").alias("__kept"))
    return numbered.join(kept, F.col("__row") == F.col("__kept"), "left_semi").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Takes are decided per (doc_id, source, words)."""
    mixed = fair_mix(docs, name="pipeline-mix").where("copies > 0")
    taken = mixed.groupBy("doc_id", "source", "size").agg(F.max("copies").alias("__copies"))
    taken = taken.select(F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.col("size").alias("__words"), "__copies")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source")) & (word_count() == F.col("__words"))
    return docs.join(taken, same).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and its place there."""
    return pack_documents(docs, name="pipeline-pieces")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

# A trained network, MinHash candidates and a linear program have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
