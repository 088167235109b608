"""A corpus from raw documents to packed sequences.

Five stages, in order: documents of low quality go, lines that many documents share go, one
document of each group of near-duplicates stays, documents with benchmark passages go, and what is
left is packed. Every stage reads all rows that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehaul.llm.leaks import benchmark_leaks
from tablehaul.llm.lines import drop_common_lines
from tablehaul.llm.minhash import near_duplicates
from tablehaul.llm.packing import pack
from tablehaul.llm.quality import quality_scores
from tablehaul.llm.queries import tokenizer
from tablehaul.llm.rows import free_name, numbered
from tablehaul.shared import stage

MIN_SCORE = 0.3
#: SQL has no quadratic discriminant, MinHash or tokenizer.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that score at least 0.3, also of rows with a null or repeated id."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    row = free_name(docs, "row")
    rows = numbered(docs, "doc_id", row)
    known = labels.where(fold != 0).join(rows.select("doc_id", row), "doc_id")
    scores = quality_scores(rows, known, id_col=row)
    low = scores.where(F.col("score") < MIN_SCORE).select(row)
    return rows.join(low, row, "left_anti").select(docs.columns)


def common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that ten or more of them have; lengths follow the text."""
    cut = drop_common_lines(docs)
    length = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group of near-duplicates; null ids come last."""
    row = free_name(docs, "row")
    rows = numbered(docs, "doc_id", row)
    groups = near_duplicates(rows, id_col=row).select(row, "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    first = groups.join(rows.select(row, "doc_id"), row).groupBy("component_id").agg(F.min_by(row, order).alias(row))
    return rows.join(first.select(row), row, "left_semi").select(docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark passage."""
    row = free_name(docs, "row")
    rows = numbered(docs, "doc_id", row)
    leaks = benchmark_leaks(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=row)
    return rows.join(leaks.select(row).distinct(), row, "left_anti").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1,024 tokens: which part of which document lies where, and its ids."""
    return pack(docs, tokenizer("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("quality", quality),
    ("common_lines", common_lines),
    ("near_copies", near_copies),
    ("decontaminated", decontaminated),
    ("packed", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage before it is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
