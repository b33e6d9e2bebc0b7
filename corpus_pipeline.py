"""Training-corpus pipeline over ``documents``: quality, line dedup, near-duplicates, decontamination, packing.

Every stage takes all rows that the one before kept and returns the columns
of documents, the last one the packed pieces.  Between stages rows are
written as Parquet and read again, so a lost executor costs part of one stage.

Defined cases: documents with a null or empty text have nothing to judge: the
quality stage keeps or drops them as its classifier scores a text without
bytes, lines and benchmark leave them as they are, near-duplicates keep one of them,
and packing gives them their end id.  Repeated rows fare alike until near-duplicates keep one.
An empty table gives no pieces.  Columns beyond those of documents, also with
clashing names, are carried up to packing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from navlib.llm import dart_minhash, decontaminate, kneser_ney, line_dedup, packing
from navlib.llm._frames import remove, remove_at_end, shuffle_cleanup, table
from navlib.llm.queries import vocabulary
from navlib.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the Kneser-Ney classifier keeps."""
    return kneser_ney.good_documents(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that are boilerplate on their source."""
    return line_dedup.drop_boilerplate_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return dart_minhash.deduplicate(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), mode="document")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 ids."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark_free),
    ("packing", packed),
]

#: SQL can't express a trained model, hashed signatures or a tokenizer
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``.

    Each stage's rows go to a new folder below the checkpoint folder; a
    folder goes when the next stage is written, the last one with the application.
    """
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    remove_at_end(spark, folder)
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        with shuffle_cleanup(spark):
            stage(spark, docs, sf_dir).select("*").write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{name}"
    return docs
