"""Turning text into the ``lines(doc_id, line_no, line)`` table.

A corpus is an ordered sequence of lines.  Order is explicit: ``doc_id`` then
``line_no``.  Line terminators (``\\r\\n``, ``\\r``, ``\\n``) are dropped, as a
text-file reader drops them, so they never enter a vocabulary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_BREAK = r"\r\n|\r|\n"
#: the characters that line breaks are made of
LINE_ENDS = "\r\n"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one parquet table of the test layout, pruned to ``columns``."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def corpus_lines(df: DataFrame, text_col: str = "text", key_col: str = "doc_id") -> DataFrame:
    """Any text column as a corpus: one row per line, numbered within its row.

    Narrow (no shuffle): each document row is split in the task that read it.
    """
    return (df.select(F.col(key_col).cast("bigint").alias("doc_id"),
                      F.posexplode(F.split(F.col(text_col), LINE_BREAK, -1)).alias("line_no", "line"))
            .withColumn("line_no", F.col("line_no").cast("bigint")))


#: lists of files up to this size are sent to every task that reads text
FILE_LIST_BYTES = 64 << 20


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text file(s) as a corpus.  ``doc_id`` numbers the files in path order;
    ``line_no`` is an increasing order key within the file (not dense): Spark reads a
    file's blocks in order, as parts of growing number.

    The list of files is what is sent to the tasks, never the text; a list beyond
    ``FILE_LIST_BYTES`` is joined by sorting, which moves the text once."""
    raw = spark.read.text(path)
    names = sorted(raw.inputFiles())
    files = spark.createDataFrame(list(enumerate(names)), "doc_id bigint, file string")
    files = F.broadcast(files) if sum(map(len, names)) + 64 * len(names) <= FILE_LIST_BYTES else files.hint("merge")
    return (raw.select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line_no"),
                       F.col("value").alias("line"))
            .join(files, "file").select("doc_id", "line_no", "line"))


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Sink for models, metrics and samples (parquet)."""
    df.write.mode(mode).parquet(path)
