"""The model as a table: ``model(layer, block, i, j, w, acc)``.

The table is the durable form (written as parquet, joined with gradients for
the AdaGrad step).  Tasks receive it as NumPy arrays through a broadcast; its
size is ``layers * (2*H*V + H*H + H + V)``, bounded by the vocabulary and the
hidden size, never by the corpus.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from charloom.functions import kernels as K
from charloom.functions.exprs import sine_weight

MODEL_SCHEMA = "layer int, block string, i int, j int, w double, acc double"
EPS = 1e-8


def parameter_index(df: DataFrame, k: str, layers: int, hidden: int, vocab: int, *keep: str) -> DataFrame:
    """``layer, block_no, block, i, j`` of flat parameter numbers ``k`` (the layout of
    ``kernels.flatten``), next to the columns ``keep``."""
    H, V = hidden, vocab
    sizes = [H * V, H * H, V * H, H, V]
    per_layer = sum(sizes)
    r = F.col(k) % per_layer
    starts = np.cumsum([0] + sizes)
    block_no = F.lit(4)
    for b in range(3, -1, -1):
        block_no = F.when(r < int(starts[b + 1]), F.lit(b)).otherwise(block_no)
    off = r - F.element_at(F.array(*[F.lit(int(s)) for s in starts[:5]]), block_no + 1)
    ncols = F.element_at(F.array(F.lit(V), F.lit(H), F.lit(H), F.lit(1), F.lit(1)), block_no + 1)
    blocks = F.element_at(F.array(*[F.lit(b) for b in K.BLOCKS]), block_no + 1)
    return df.select((F.col(k) / per_layer).cast("int").alias("layer"), block_no.cast("int").alias("block_no"),
                     blocks.alias("block"), (off / ncols).cast("int").alias("i"), (off % ncols).cast("int").alias("j"), *keep)


def model_table(spark: SparkSession, layers: int, hidden: int, vocab: int,
                init: str = "gaussian", seed: int = 7) -> DataFrame:
    """N1 as a Spark job: one row per parameter, decoded from a flat index.

    gaussian: N(0,1)*0.01 for the three matrices (seeded ``randn`` over a fixed
    single-partition range, so the draw is reproducible), zero biases;
    zero: all zero; sine / sine_static: the closed form of ``kernels.init_params``.
    Accumulators start at zero.
    """
    df = parameter_index(spark.range(0, K.n_params(layers, hidden, vocab), numPartitions=1), "id", layers, hidden, vocab)
    is_matrix = F.col("block_no") < 3
    if init == "zero":
        w = F.lit(0.0)
    elif init == "gaussian":
        w = F.when(is_matrix, F.randn(seed) * 0.01).otherwise(F.lit(0.0))
    elif init in ("sine", "sine_static"):
        w = sine_weight(F.col("block_no"), F.col("i"), F.col("j"), F.col("layer"))
        if init == "sine_static":
            w = F.when(F.col("block_no") == 1, F.lit(0.0)).otherwise(w)
    else:
        raise ValueError(init)
    return df.select("layer", "block", "i", "j", w.alias("w"), F.lit(0.0).alias("acc"))


def table_to_arrays(model_df: DataFrame, layers: int, hidden: int, vocab: int):
    """Collect the (bounded) model table into (params, accs) arrays."""
    pdf = model_df.select("layer", "block", "i", "j", "w", "acc").toPandas()
    return frame_to_arrays(pdf, layers, hidden, vocab)


def frame_to_arrays(pdf: pd.DataFrame, layers: int, hidden: int, vocab: int):
    params, accs = K.zeros(layers, hidden, vocab), K.zeros(layers, hidden, vocab)
    for b, g in pdf.groupby("block"):
        l, i, j = g["layer"].to_numpy(), g["i"].to_numpy(), g["j"].to_numpy()
        if params[b].ndim == 3:
            params[b][l, i, j] = g["w"].to_numpy()
            accs[b][l, i, j] = g["acc"].to_numpy()
        else:
            params[b][l, i] = g["w"].to_numpy()
            accs[b][l, i] = g["acc"].to_numpy()
    return params, accs


def arrays_to_frame(params: dict, accs: dict) -> pd.DataFrame:
    layers, hidden, vocab = K.dims(params)
    idx = K.index_table(layers, hidden, vocab)
    return pd.DataFrame({
        "layer": idx[:, 1].astype("int32"),
        "block": np.array(K.BLOCKS)[idx[:, 2]],
        "i": idx[:, 3].astype("int32"), "j": idx[:, 4].astype("int32"),
        "w": K.flatten(params), "acc": K.flatten(accs)})


def arrays_to_table(spark: SparkSession, params: dict, accs: dict) -> DataFrame:
    return spark.createDataFrame(arrays_to_frame(params, accs), MODEL_SCHEMA)


def adagrad_update(model_df: DataFrame, grads_df: DataFrame, lr: float) -> DataFrame:
    """N5 as a join of the model with (mean) gradients ``grads(layer, block, i, j, g)``:
    acc += g^2 first, then w -= lr * g / sqrt(acc + 1e-8).  Parameters without
    a gradient row get g = 0 (unchanged)."""
    g = F.coalesce(F.col("g"), F.lit(0.0))
    acc = F.col("acc") + g * g
    return (model_df.join(grads_df.select("layer", "block", "i", "j", "g"), ["layer", "block", "i", "j"], "left")
            .select("layer", "block", "i", "j", (F.col("w") - F.lit(lr) * g / F.sqrt(acc + F.lit(EPS))).alias("w"),
                    acc.alias("acc")))


def model_stats(params: dict, accs: dict) -> dict:
    """Compact fingerprint of a model state for metrics rows."""
    w, a = K.flatten(params), K.flatten(accs)
    return {"w_sum": float(w.sum()), "w_sq": float((w * w).sum()), "acc_sum": float(a.sum())}
