"""From raw documents to a mix for training: five stages, each on what the one before kept.

Every stage's output is written as Parquet and read again as the next one's input.
All but the last return the columns of ``documents``.

Nulls, empty texts, repeated rows and further columns are handled by the
operators as their docstrings say; an empty table passes through every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwise.llm.decontaminate import find_benchmark_text
from meterwise.llm.line_dedup import WHOLE, dedup_lines
from meterwise.llm.mixing import mix_sources
from meterwise.llm.near_dup import near_duplicate_groups
from meterwise.llm.packed import small_batches
from meterwise.llm.quality_classifier import classify_quality
from meterwise.llm.store import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify_quality(docs, labels).filter("kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents that lose their last word by it."""
    small_batches(spark)
    cleaned = dedup_lines(docs, **WHOLE).filter("NOT emptied")
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("n_exact") + F.col("n_near") > 0, F.length("text"))
                                     .otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (rows equal in id and text stay once)."""
    small_batches(spark)
    groups = near_duplicate_groups(docs)
    # Written, so that its size is known: while it's under Spark's threshold, no document is shuffled.
    gone = Scratch(spark, "near-duplicates").stage(groups.filter("NOT kept").select("doc_id").distinct(), "gone", keep=True)
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    again = groups.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if again.isEmpty():
        return kept
    # Of rows equal in id and text, the one whose columns have the least hash.
    once = (kept.join(again, "doc_id", "left_semi").groupBy("doc_id", F.xxhash64("text").alias("_text"))
            .agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("_row")).select("_row.*"))
    return kept.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(once)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark text go."""
    small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_benchmark_text(docs, benchmark).filter("NOT contaminated").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often, and with how many words, the mix takes each document."""
    return mix_sources(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("minhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix),
]

#: SQL can't express the fitted classifier or the random rounding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the mix of what is left."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    scratch.paths.pop()  # the result is read by the caller
    scratch.clear()
    return docs
