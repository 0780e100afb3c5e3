"""Adding per-task partial vectors across the cluster.

Every task of a training or gradient job produces one dense vector (gradient or
weight sums plus a few counters).  It is shipped as ``chunk``-sized arrays
(``(chunk int, v array<double>)`` rows) and added with Spark ML's element-wise
vector sum, a typed aggregate with partial aggregation: the shuffle carries
tasks x (params / chunk) rows of packed doubles, and each reducer keeps one
chunk-sized sum.  The result -- one vector of the model's size, bounded by
vocabulary and hidden size -- is the only thing collected.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PARTIAL_SCHEMA = "chunk int, v array<double>"
CHUNK = 512


def pack(vec: np.ndarray, chunk: int = CHUNK) -> pd.DataFrame:
    parts = [vec[i:i + chunk] for i in range(0, len(vec), chunk)]
    return pd.DataFrame({"chunk": np.arange(len(parts), dtype=np.int32), "v": parts})


def summed(partials: DataFrame) -> DataFrame:
    """``chunk, s``: the packed vectors added chunk by chunk.  Every task has one row
    per chunk, so they are added in two levels: no reducer gets a row from every task."""
    part = F.spark_partition_id() % max(1, math.isqrt(partials.sparkSession.sparkContext.defaultParallelism))
    return (partials.select("chunk", part.alias("part"), array_to_vector("v").alias("v"))
            .groupBy("chunk", "part").agg(Summarizer.sum(F.col("v")).alias("v"))
            .groupBy("chunk").agg(Summarizer.sum(F.col("v")).alias("s"))
            .select("chunk", vector_to_array("s").alias("s")))


def total(partials: DataFrame, size: int, chunk: int = CHUNK) -> np.ndarray | None:
    """Sum of all packed vectors of ``size`` entries; None if no task emitted one."""
    rows = summed(partials).collect()
    if not rows:
        return None
    out = np.zeros(size)
    for r in rows:
        i = r["chunk"] * chunk
        out[i:i + len(r["s"])] = r["s"]
    return out
