"""From raw documents to packed token sequences, in stages that each write their result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import staged
from stratiform.llm.containment import contained_items
from stratiform.llm.language_crf import UNKNOWN, identify
from stratiform.llm.line_dedup import line_dedup
from stratiform.llm.ngram_join import jaccard_join
from stratiform.llm.packing import pack
from stratiform.session import new_folder

#: Texts whose words' likeliest labels have a lower mean probability are rejected, in whatever languages they are.
MIN_CERTAINTY = 0.5

#: Neither language models nor packing can be written in SQL.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one or several languages that the random field knows; null, letterless and undecided texts go."""
    judged = identify(docs, certainty=True)
    return judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("certainty") >= MIN_CERTAINTY)).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with each repeated line only in the smallest ``doc_id`` that holds it."""
    return line_dedup(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the first by ``doc_id`` and text hash, of each group that n-gram similarity connects.

    Rows are numbered in that order, null ids last, and compared under their numbers, so that repeated rows,
    several texts of one ``doc_id`` and rows without one are each judged by their own text. Of repeated rows
    without words, which are like nothing, one stays too.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    rows = staged(docs.orderBy(*order).withColumn("__row", F.monotonically_increasing_id()), "numbered")
    classes = jaccard_join(rows.select(F.col("__row").alias("doc_id"), "text"))
    alike = classes.where(F.col("doc_id") != F.col("class_id")).select(F.col("doc_id").alias("__row"))
    named = rows.select("__row", "doc_id", F.xxhash64("text").alias("text_hash"))
    repeated = named.groupBy("doc_id", "text_hash").agg(F.min("__row").alias("first"), F.count("*").alias("n")).where("n > 1")
    same_id = F.col("r.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("r.text_hash") == F.col("f.text_hash"))
    again = named.alias("r").join(repeated.alias("f"), same_id & (F.col("r.__row") > F.col("f.first"))).select("__row")
    gone = alike.unionByName(again).distinct()
    return rows.join(gone, "__row", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    found = contained_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.size("items") == 0).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens, with their ids."""
    return pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
