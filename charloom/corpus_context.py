"""One corpus (a text table) with its derived tables, built lazily and once."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from charloom.config import RnnConfig
from charloom.operators import corpus as C
from charloom.operators.scan import CorpusSegments, corpus_segments, line_positions
from charloom.session import ship_package
from charloom.sources.text import LINE_ENDS, corpus_lines, read_table


def spread(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A table with fewer file splits than cores (one parquet row group is one split)
    would leave cores idle: its rows are dealt over them, so a core takes in no more
    than it would read.  A table with a split for every core is read as it is."""
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


class Corpus:
    def __init__(self, spark: SparkSession, docs: DataFrame, cfg: RnnConfig | None = None,
                 text_col: str = "text", key_col: str = "doc_id", partitions: int | None = None):
        self.spark = spark
        ship_package(spark)
        self.cfg = cfg or RnnConfig()
        self.partitions = partitions
        plain = docs.select(key_col, text_col)
        self.docs = spread(spark, plain)
        self.lines = corpus_lines(self.docs, text_col, key_col)
        #: whole texts, for positions by text instead of by line
        self.texts = plain.select(F.col(key_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("line"))

    @classmethod
    def from_table(cls, spark: SparkSession, sf_dir: str, table: str = "documents",
                   cfg: RnnConfig | None = None, text_col: str = "text", key_col: str = "doc_id"):
        return cls(spark, read_table(spark, sf_dir, table, key_col, text_col), cfg, text_col, key_col)

    @classmethod
    def from_lines(cls, spark: SparkSession, lines: DataFrame, cfg: RnnConfig | None = None):
        """A corpus of ``lines(doc_id, line_no, line)`` as they are (e.g. from
        ``read_text_lines``): the order of lines and their paragraph keys stay."""
        self = cls.__new__(cls)
        self.spark, self.cfg, self.partitions = spark, cfg or RnnConfig(), None
        ship_package(spark)
        self.lines, self.texts = lines.select("doc_id", "line_no", "line"), None
        return self

    @cached_property
    def docs(self) -> DataFrame:
        """Whole documents without line breaks, for a corpus that came as lines."""
        return (self.lines.groupBy("doc_id")
                .agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("own"))
                .select("doc_id", F.array_join(F.transform("own", lambda x: x["line"]), "").alias("text")))

    @cached_property
    def vocab_df(self) -> DataFrame:
        # the lines' characters are those of the texts without line ends
        return C.vocab_table(self.lines) if self.texts is None else C.vocab_table(self.texts, LINE_ENDS)

    @cached_property
    def vocab(self) -> C.Vocab:
        return C.collect_vocab(self.vocab_df)

    @cached_property
    def corpus(self) -> CorpusSegments:
        return corpus_segments(self.spark, self.lines, halo=self.cfg.seq_len, piece=256,
                               partitions=self.partitions, docs=self.texts)

    def line_positions(self) -> DataFrame:
        return line_positions(self.lines, self.partitions)
