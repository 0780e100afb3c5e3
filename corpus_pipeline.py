"""The training-data pipeline: ``documents`` in, packed sequences out.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its
predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from charloom.llm.common import prepare
from charloom.llm.langid import apply_language
from charloom.llm.line_dedup import dedup_lines
from charloom.llm.packing import pack_documents
from charloom.llm.quality import apply_quality
from charloom.llm.simhash import apply_simhash


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality rules reject, and lines above the limits."""
    prepare(spark)
    return apply_quality(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language."""
    return apply_language(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of repeated line runs."""
    prepare(spark)
    return dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return apply_simhash(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", quality), ("language ID", language), ("line dedup", lines),
          ("SimHash near-dedup", near_duplicates), ("packing", packing)]

#: Trained classifiers, XXH64 majorities and BPE are not SQL; the operators' tests hold each against brute
#: force or held-out rows, the pipeline's tests its stages against what they are given.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared checkpoint folder and read again; a
    stage's folder goes once the next one is written, the last one's rows are the
    result's input and stay."""
    prepare(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        if i:
            files.delete(path(f"{folder}/{i - 1}"), True)
    return STAGES[-1][1](spark, docs, sf_dir)
