"""The corpus pipeline: from raw documents to a mixture, in five stages.

Every stage reads the columns of documents alone, keeps whole texts, and gives an empty table for an empty one.  Null and
empty texts are documents like any other.  Rows that repeat a ``doc_id`` are judged together wherever a stage tells
documents apart by number; rows without a number cannot be told apart, so no stage drops them, and the mix treats them as
documents of their source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm.decontaminate import find_leaks
from basketlens.llm.lines import drop_shared_lines
from basketlens.llm.mixing import mix, word_count
from basketlens.llm.quality import score_quality
from basketlens.llm.simhash import near_duplicates
from basketlens.session import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _of_documents(docs: DataFrame) -> DataFrame:
    """The columns of documents alone: later joins cannot meet clashing names."""
    return docs.select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, unchanged.

    The classifier learns from the labelled documents among ``docs``.  Rows without ``doc_id`` cannot be told apart and stay.
    """
    docs = _of_documents(docs)
    scores = score_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), Scratch(spark, "pipeline-quality"))
    rejected = scores.where("predicted = 0").select("doc_id").distinct()
    return docs.join(rejected, "doc_id", "left_anti").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many share; ``n_chars`` is counted anew."""
    kept = drop_shared_lines(_of_documents(docs), Scratch(spark, "pipeline-lines"), carry=("lang", "source"))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest ``doc_id`` of every SimHash component.

    Rows without ``doc_id`` stay.  Rows that share a ``doc_id`` are one document: they stay if any of them is the first of its component.
    """
    docs = _of_documents(docs)
    found = near_duplicates(docs, Scratch(spark, "pipeline-simhash")).where("doc_id is not null")
    gone = found.groupBy("doc_id").agg(F.bool_or(F.expr("doc_id = component_id")).alias("first")).where("not first").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage; the whole document goes, not the passage alone."""
    docs = _of_documents(docs)
    leaked = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct()
    return docs.join(leaked, "doc_id", "left_anti").select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mixture, with the ``copies`` that the mix takes of each (one or more).

    Rows that share ``doc_id``, ``source`` and size are interchangeable and all get the larger number of copies.
    """
    docs = _of_documents(docs)
    taken = (
        mix(docs, Scratch(spark, "pipeline-mix"), carry=("source",)).groupBy("doc_id", "source", "size")
        .agg(F.max("copies").alias("copies"), F.max("target").alias("target")).where("copies > 0")
        .selectExpr("doc_id as of_doc", "source as of_source", "size as of_size", "copies", "target")
    )
    sized = docs.withColumn("size", word_count(F.col("text")))
    return sized.join(taken, F.expr("doc_id <=> of_doc and source <=> of_source and size = of_size")).select(
        *COLUMNS, "size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixture),
]

#: The classifier has no SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"stage-{at}")
    return docs
