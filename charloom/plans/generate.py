"""Batch text generation and free-running evaluation.

Prompts are rows; every prompt in an Arrow batch advances together (one
vectorised step per generated character).  Sampling draws are reproducible:
the uniform for prompt ``p`` at step ``t`` is the library hash of
``(seed, p, t)``, the same value the SQL oracles compute.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from charloom.functions import kernels as K
from charloom.operators.corpus import Vocab, encode_concat, encode_known
from charloom.sources.text import LINE_BREAK

GEN_SCHEMA = "prompt_id bigint, seed_id bigint, text string"
EVAL_SCHEMA = "prompt_id bigint, n_scored bigint, n_unknown bigint, loss double"


def uniforms(seed: int, prompt_ids: np.ndarray, steps: int, offset: int = 0) -> np.ndarray:
    t = np.arange(offset, offset + steps, dtype=np.int64)[None, :]
    return K.unit_uniform(seed, prompt_ids.astype(np.int64)[:, None], t)


def without_breaks(text: F.Column) -> F.Column:
    """A text as the line reader sees it: line ends never enter a vocabulary."""
    return F.regexp_replace(text, LINE_BREAK, "")


def prompts_from_text(df: DataFrame, key_col: str, text_col: str) -> DataFrame:
    """``(prompt_id, seed_ch)`` of every row: the first character of its text after
    line breaks are dropped (null where there is none)."""
    text = without_breaks(F.col(text_col))
    return df.select(F.col(key_col).cast("bigint").alias("prompt_id"),
                     F.when(F.length(text) > 0, F.substring(text, 1, 1)).alias("seed_ch"))


def generate_text(spark: SparkSession, prompts: DataFrame, params: dict, vocab: Vocab, steps: int,
                  greedy: bool, seed: int = 7) -> DataFrame:
    """G1: ``steps`` characters after each prompt's seed character (the seed is
    not emitted).  Greedy picks the highest logit (ties to the lowest id);
    otherwise inverse-CDF sampling (G2).

    One row per prompt: where the seed character is null or not in the
    vocabulary, ``seed_id`` and ``text`` are null.  Optional columns of
    ``prompts``: ``n`` (that prompt's number of characters instead of
    ``steps``) and ``h0`` (array<double>, the hidden states of all layers to
    start from, layer by layer)."""
    own = [c for c in ("n", "h0") if c in prompts.columns]
    bc = spark.sparkContext.broadcast({"params": params, "codepoints": vocab.codepoints,
                                       "chars": np.array(vocab.chars, dtype=object)})

    def run(batches):
        K.single_thread_blas()
        p, cps, chars = bc.value["params"], bc.value["codepoints"], bc.value["chars"]
        layers, hidden, _ = K.dims(p)
        for pdf in batches:
            if pdf.empty:
                continue
            pid = pdf["prompt_id"].to_numpy(dtype=np.int64)
            ids = encode_concat(pdf["seed_ch"].fillna("\n").str[:1].tolist(), cps)[0].astype(np.int64)
            known = np.flatnonzero(ids >= 0)
            n = pdf["n"].fillna(steps).to_numpy(dtype=np.int64) if "n" in own else np.full(len(pid), steps)
            text = np.full(len(pid), None, dtype=object)
            if len(known):
                most = int(max(0, n[known].max()))
                h0 = None
                if "h0" in own:
                    h0 = np.stack([np.zeros(layers * hidden) if x is None else np.asarray(x, dtype=float)
                                   for x in pdf["h0"].iloc[known]]).reshape(-1, layers, hidden).swapaxes(0, 1)
                u = None if greedy else uniforms(seed, pid[known], most)
                out = K.generate(p, ids[known], most, u, h0)
                text[known] = ["".join(chars[r[:max(0, k)]]) for r, k in zip(out, n[known])]
            yield pd.DataFrame({"prompt_id": pid, "seed_id": pd.Series([int(i) if i >= 0 else None for i in ids], dtype="Int64"),
                                "text": text})

    return prompts.select("prompt_id", "seed_ch", *own).mapInPandas(run, GEN_SCHEMA)


def free_running_loss(spark: SparkSession, items: DataFrame, params: dict, vocab: Vocab,
                      offset: int = 10, greedy: bool = False, seed: int = 7) -> DataFrame:
    """Feed the item's first character, then the model's own (sampled or
    greedy) outputs; add -ln p(target_t) for t >= offset, targets being the
    item's following characters.  One row per item: line breaks are dropped,
    characters outside the vocabulary are skipped and counted in ``n_unknown``,
    and an item with fewer than two characters left has nothing scored."""
    bc = spark.sparkContext.broadcast({"params": params, "codepoints": vocab.codepoints})

    def run(batches):
        K.single_thread_blas()
        p, cps = bc.value["params"], bc.value["codepoints"]
        layers, hidden, _ = K.dims(p)
        for pdf in batches:
            if pdf.empty:
                continue
            seqs, unknown = encode_known(pdf["text"].fillna("").tolist(), cps)
            pid = pdf["prompt_id"].to_numpy(dtype=np.int64)
            lens = np.array([len(s) for s in seqs])
            loss = np.zeros(len(seqs))
            # longest first: those still running are a prefix
            order = np.argsort(-lens, kind="stable")
            order = order[lens[order] >= 2]
            if len(order):
                cur = np.array([seqs[i][0] for i in order], dtype=np.int64)
                h = np.zeros((layers, len(order), hidden))
                for t in range(int(lens[order[0]]) - 1):
                    live = order[:int((lens[order] - 1 > t).sum())]
                    m, inp = len(live), None
                    for l in range(layers):
                        pre = p["Win"][0].T[cur[:m]] if l == 0 else inp @ p["Win"][l].T
                        h[l, :m] = np.tanh(pre + h[l, :m] @ p["Wh"][l].T + p["bh"][l])
                        inp = h[l, :m] @ p["Wout"][l].T + p["bout"][l]
                    lp = K.log_softmax(inp)
                    if t >= offset:
                        loss[live] -= lp[np.arange(m), [seqs[i][t + 1] for i in live]]
                    cur[:m] = (np.argmax(inp, axis=1) if greedy
                               else K.inverse_cdf(np.exp(lp), K.unit_uniform(seed, pid[live], t)))
            yield pd.DataFrame({"prompt_id": pid, "n_scored": np.maximum(0, lens - 1 - offset).astype(np.int64),
                                "n_unknown": unknown, "loss": loss})

    return items.select("prompt_id", without_breaks(F.col("text")).alias("text")).mapInPandas(run, EVAL_SCHEMA)
