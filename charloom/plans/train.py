"""Training jobs.

Every epoch is one Spark job whose plan does not grow with the epoch count:
the current model (bounded by vocabulary and hidden size) is broadcast, tasks
run the NumPy kernels over their own rows and emit one packed partial-sum
vector each (``plans.partials``), an element-wise vector-sum aggregate adds them
up, and the driver applies the update to the bounded model.  Inputs (corpus segments, lines) come from checkpointed or narrow plans,
so a lost task is simply recomputed.

* ``fit_windows``   -- T1 full-batch gradient descent over every window, or T2
  mini-batch SGD over a reproducible Bernoulli sample of window starts;
``on_epoch(epoch, params)`` is called after every update (G6: periodic samples).

* ``fit_sequences`` -- T3 local training of sampled paragraphs from the global
  weights and accumulators, then averaging; T4 the same per document with
  tumbling windows (the serial trainer's carried-state loop, one run per document).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from charloom.config import RnnConfig
from charloom.corpus_context import Corpus
from charloom.functions import kernels as K
from charloom.functions.exprs import bernoulli_keep
from charloom.operators.corpus import encode_text, nonempty_lines, windows_ids
from charloom.operators.windows import corpus_sliding_windows, line_pieces, line_sliding_windows
from charloom.plans.model import arrays_to_table, model_stats, model_table, table_to_arrays
from charloom.plans.partials import PARTIAL_SCHEMA, pack, total
from charloom.sources.text import LINE_BREAK

METRICS_SCHEMA = ("epoch int, loss double, loss_per_char double, loss_per_predicted double, "
                  "smooth_loss double, n bigint, w_sum double, w_sq double, acc_sum double")


@dataclass
class TrainResult:
    params: dict
    accs: dict
    metrics: list = field(default_factory=list)

    def model_df(self, spark: SparkSession) -> DataFrame:
        return arrays_to_table(spark, self.params, self.accs)

    def metrics_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(pd.DataFrame(self.metrics, columns=[
            "epoch", "loss", "loss_per_char", "loss_per_predicted", "smooth_loss", "n",
            "w_sum", "w_sq", "acc_sum"]), METRICS_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        """Sink: model and metrics as parquet under ``path``."""
        self.model_df(spark).write.mode("overwrite").parquet(f"{path}/model")
        self.metrics_df(spark).write.mode("overwrite").parquet(f"{path}/metrics")


class EpochStore:
    """IO3, durable: every epoch's model and metrics are appended under ``path`` as they
    are made, the metrics last, so an epoch counts once its metrics are there.  A job
    that starts again on the same path goes on after the last complete epoch;
    ``settings`` (all that training depends on) must be the same."""

    def __init__(self, spark: SparkSession, path: str, settings: str):
        self.spark, self.path, self.settings = spark, path.rstrip("/"), settings

    def metrics(self) -> DataFrame:
        return self.spark.read.schema(METRICS_SCHEMA + ", settings string").parquet(f"{self.path}/metrics/*")

    def _exists(self) -> bool:
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(f"{self.path}/metrics")
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place)

    def append(self, epoch: int, params: dict, accs: dict, row: dict) -> None:
        arrays_to_table(self.spark, params, accs).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/model/{epoch}")
        one = TrainResult(params, accs, [row]).metrics_df(self.spark).withColumn("settings", F.lit(self.settings))
        one.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/metrics/{epoch}")

    def last(self, layers: int, hidden: int, vocab: int):
        """``(params, accs, metrics)`` after the last of the epochs 0, 1, ... that are
        complete; None before the first."""
        if not self._exists():
            return None
        rows = {r["epoch"]: r.asDict() for r in self.metrics().collect()}
        done = []
        while len(done) in rows:
            row = rows[len(done)]
            if row.pop("settings") != self.settings:
                raise ValueError(f"{self.path} holds training with other settings")
            done.append(row)
        if not done:
            return None
        model = self.spark.read.parquet(f"{self.path}/model/{len(done) - 1}")
        return *table_to_arrays(model, layers, hidden, vocab), done


def _resumed(store: str | None, corpus: Corpus, cfg: RnnConfig, job: str, params: dict, accs: dict):
    """The store (or None), and the model and metrics to go on from."""
    if store is None:
        return None, params, accs, []
    settings = f"{job}, {cfg.with_(epochs=0, model_bytes=0)}, characters {corpus.vocab.size}"
    kept = EpochStore(corpus.spark, store, settings)
    found = kept.last(*K.dims(params))
    return (kept, params, accs, []) if found is None else (kept, *found)


def _start(corpus: Corpus, cfg: RnnConfig):
    V = corpus.vocab.size
    # weights, accumulators, gradient and a packed copy, as doubles
    need = 4 * 8 * K.n_params(cfg.num_layers, cfg.hidden, V)
    if need > cfg.model_bytes:
        raise ValueError(f"a model over {V} characters needs {need} bytes in every task; model_bytes is {cfg.model_bytes}")
    model = model_table(corpus.spark, cfg.num_layers, cfg.hidden, V, cfg.init, cfg.seed)
    return table_to_arrays(model, cfg.num_layers, cfg.hidden, V)


# ---------------------------------------------------------------- T1 / T2
def _window_task(bc, cfg: RnnConfig):
    L = cfg.seq_len

    def run(batches):
        K.single_thread_blas()
        st = bc.value
        params, cps = st["params"], st["codepoints"]
        layers, hidden, vocab = K.dims(params)
        cap = K.group_rows(vocab)
        grad = np.zeros(K.n_params(layers, hidden, vocab))
        acc = {"loss": 0.0, "n": 0}
        buf, size = [], 0
        plain = K.bias_only(params)

        def flush():
            w = np.concatenate(buf)
            losses, g = K.grad_sums(params, w[:, :-1], w[:, 1:], cfg.clip, cfg.compat_untransposed)
            grad[:] += K.flatten(g)
            acc["loss"] += float(losses.sum())
            acc["n"] += len(w)

        for pdf in batches:
            if pdf.empty:
                continue
            ids, lens = windows_ids(pdf["text"].tolist(), cps)
            if plain:
                loss, g, n = K.bias_grad_sum(params, ids, lens, pdf["n_own"].to_numpy(), L, cfg.clip)
                grad[-vocab:] += g  # the last output bias is the last block
                acc["loss"] += loss
                acc["n"] += n
                continue
            rows, starts = K.window_starts(lens, pdf["n_own"].to_numpy(), L)
            for c0 in range(0, len(rows), cap):
                buf.append(K.gather_windows(ids, lens, rows[c0:c0 + cap], starts[c0:c0 + cap], L))
                size += len(buf[-1])
                if size >= cap:
                    flush()
                    buf, size = [], 0
        if buf:
            flush()
        if acc["n"]:  # gradient sums, then loss and window count
            yield pack(np.r_[grad, acc["loss"], acc["n"]])
    return run


def window_source(corpus: Corpus, windows: str = "corpus") -> DataFrame:
    """Rows holding whole windows: corpus segments (W1, across line borders) or
    line pieces (W2, inside lines)."""
    L = corpus.cfg.seq_len
    if windows == "corpus":
        return corpus.corpus.segments.select("goff", "n_own", "text")
    if windows == "line":
        lines = corpus.lines.where(F.length("line") > L)
        return line_pieces(lines, halo=L).select("doc_id", "line_no", "offset", "n_own", "text")
    raise ValueError(windows)


def sampled_windows(corpus: Corpus, windows: str, rate: float, seed: int, epochs: list) -> DataFrame:
    """One row per window of each epoch's sample, with its ``epoch``: the corpus is read
    once for all of them.  Only sampled windows are cut and leave their task."""
    L, sample = corpus.cfg.seq_len, (rate, seed, epochs)
    wins = (corpus_sliding_windows(corpus.corpus.segments, L, sample) if windows == "corpus"
            else line_sliding_windows(corpus.lines, L, sample))
    return wins.select("epoch", F.lit(1).alias("n_own"), F.col("win").alias("text"))


def fit_windows(corpus: Corpus, cfg: RnnConfig | None = None, rate: float = 1.0,
                windows: str = "corpus", on_epoch=None, store: str | None = None) -> TrainResult:
    """T1 (rate 1: every window every epoch) or T2 (Bernoulli sample of window
    starts per epoch, reproducible from seed and epoch).  Mean of per-window
    clipped gradients, one AdaGrad step per epoch.  An epoch whose sample is
    empty leaves the model unchanged and is logged with n = 0.  ``store`` names a
    folder that takes every epoch's model and metrics, and is gone on from."""
    cfg = cfg or corpus.cfg
    spark = corpus.spark
    kept, params, accs, done = _resumed(store, corpus, cfg, f"windows {windows} {rate}", *_start(corpus, cfg))
    layers, hidden, vocab = K.dims(params)
    src = window_source(corpus, windows)
    if rate >= 1.0 and cfg.epochs > 1:
        # an epoch reads the rows once, in order; in memory they would fill it with the whole text
        src = src.persist(StorageLevel.DISK_ONLY)
    # samples do not depend on the model: one reading of the corpus draws as many epochs' as hold no more text than it
    ahead = max(1, int(1.0 / (max(rate, 1e-6) * (cfg.seq_len + 1))))
    drawn = None
    smooth = done[-1]["smooth_loss"] if done else -math.log(1.0 / vocab) * cfg.seq_len
    res = TrainResult(params, accs, done)
    try:
        for epoch in range(len(done), cfg.epochs):
            bc = spark.sparkContext.broadcast({"params": params, "codepoints": corpus.vocab.codepoints})
            size = K.n_params(layers, hidden, vocab)
            rows = src
            if rate < 1.0:
                if drawn is None or epoch not in kept_epochs:
                    if drawn is not None:
                        drawn.unpersist()
                    kept_epochs = range(epoch, min(epoch + ahead, cfg.epochs))
                    drawn = sampled_windows(corpus, windows, rate, cfg.seed, list(kept_epochs))
                    drawn = drawn.persist(StorageLevel.DISK_ONLY) if len(kept_epochs) > 1 else drawn
                rows = drawn.where(F.col("epoch") == epoch).select("n_own", "text")
            sums = total(rows.mapInPandas(_window_task(bc, cfg), PARTIAL_SCHEMA), size + 2)
            bc.unpersist()
            loss, n = (float(sums[size]), int(round(sums[size + 1]))) if sums is not None else (0.0, 0)
            if n > 0:
                g = sums[:size]
                K.adagrad(params, accs, K.unflatten(g / n, layers, hidden, vocab), cfg.learn_rate)
                smooth = 0.999 * smooth + 0.001 * (loss / n)
            per_char = loss / (n * cfg.seq_len) if n else float("nan")
            res.metrics.append({"epoch": epoch, "loss": loss, "loss_per_char": per_char,
                                "loss_per_predicted": per_char, "smooth_loss": smooth, "n": n,
                                **model_stats(params, accs)})
            if kept is not None:
                kept.append(epoch, params, accs, res.metrics[-1])
            if on_epoch is not None:
                on_epoch(epoch, params)
    finally:
        src.unpersist()
        if drawn is not None:
            drawn.unpersist()
    return res


# ---------------------------------------------------------------- T3 / T4
def _sequence_task(bc, cfg: RnnConfig, mode: str):
    def run(batches):
        K.single_thread_blas()
        st = bc.value
        params, accs, cps = st["params"], st["accs"], st["codepoints"]
        layers, hidden, vocab = K.dims(params)
        w_tot = np.zeros(K.n_params(layers, hidden, vocab))
        a_tot = np.zeros_like(w_tot)
        loss = length = count = pred = 0
        for pdf in batches:
            seqs = encode_text(pdf["line"].tolist(), cps)
            if not seqs:
                continue
            l, w, a, ln, c = K.train_sequences(params, accs, seqs, cfg, mode)
            w_tot += K.flatten(w)
            a_tot += K.flatten(a)
            loss += l
            length += ln
            count += c
            pred += int(K.chunk_count([len(s) for s in seqs], cfg.seq_len, mode).sum()) * cfg.seq_len
        if count:  # weight sums, accumulator sums, then loss, count, length, predictions
            yield pack(np.r_[w_tot, a_tot, loss, count, length, pred])
    return run


def sequence_source(corpus: Corpus, unit: str, rate: float, seed: int, epoch: int, keys: bool = False) -> DataFrame:
    """Sampled training sequences: paragraphs (non-empty lines) or whole
    documents with their line breaks removed (the reader drops them); with ``keys``
    next to ``doc_id`` and ``line_no`` (null for documents)."""
    if unit == "paragraph":
        rows = nonempty_lines(corpus.lines).select("doc_id", "line_no", "line")
        named = (F.col("doc_id"), F.col("line_no"))
    elif unit == "document":
        rows = corpus.docs.select(F.col(corpus.docs.columns[0]).cast("bigint").alias("doc_id"), F.lit(None).cast("bigint").alias("line_no"),
                                  F.regexp_replace(F.col(corpus.docs.columns[1]), LINE_BREAK, "").alias("line"))
        rows = rows.where(F.col("line") != "")
        named = (F.col("doc_id"),)
    else:
        raise ValueError(unit)
    if rate < 1.0:
        rows = rows.where(bernoulli_keep(rate, seed, epoch, *named))
    return rows if keys else rows.select("line")


GOLDEN = 0.6180339887498949


def rotating_table(corpus: Corpus, unit: str, seed: int) -> DataFrame:
    """Sequences with one uniform ``u`` per key, written once to the shared
    checkpoint folder range-partitioned and sorted on ``u``.  Epoch e samples
    the interval [frac(-e*golden), frac(-e*golden) + rate) of ``u``: a range
    predicate that reaches the parquet scan, so row-group statistics skip the
    unsampled data and an epoch reads about ``rate`` of the corpus."""
    import uuid

    from charloom.functions.exprs import unit_uniform
    from charloom.operators.scan import default_partitions
    from charloom.session import ensure_checkpoint_dir
    spark = corpus.spark
    if unit == "paragraph":
        rows = nonempty_lines(corpus.lines).select("doc_id", "line_no", "line")
        keys = (F.col("doc_id"), F.col("line_no"))
    else:
        rows = sequence_source(corpus, unit, 1.0, seed, 0, keys=True).select("doc_id", "line")
        keys = (F.col("doc_id"),)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/charloom-rotating-{uuid.uuid4().hex}"
    (rows.withColumn("u", unit_uniform(seed, 0, *keys))
     .repartitionByRange(default_partitions(spark, rows), "u").sortWithinPartitions("u")
     .write.parquet(path))
    return spark.read.parquet(path)


def rotating_sample(table: DataFrame, rate: float, epoch: int) -> DataFrame:
    lo = (-epoch * GOLDEN) % 1.0
    hi = lo + rate
    cond = (F.col("u") >= lo) & (F.col("u") < min(hi, 1.0))
    if hi > 1.0:
        cond = cond | (F.col("u") < hi - 1.0)
    return table.where(cond).select("line")


def fit_sequences(corpus: Corpus, cfg: RnnConfig | None = None, rate: float = 1.0,
                  unit: str = "paragraph", on_epoch=None, keep_tail: bool = False,
                  sampler: str = "hash", on_states=None, store: str | None = None) -> TrainResult:
    """T3 (unit paragraph, paragraph chunks) or T4 (unit document, tumbling
    windows).  Each sampled sequence trains locally from the global weights and
    accumulators; weights and accumulators are then averaged with equal weight
    per sequence (sequences too short for a window count with unchanged copies).
    Reported losses: per character present (original metric) and per predicted
    character.  ``keep_tail`` also trains the last whole chunk of a paragraph
    that the original per-paragraph loop skips.

    ``sampler="hash"`` draws an independent Bernoulli sample per epoch (every
    epoch evaluates the hash of every key); ``sampler="rotating"`` keeps the
    per-epoch Bernoulli(rate) marginals but makes each epoch a range read of a
    table written once (see ``rotating_table``), so an epoch's I/O follows the
    sample size rather than the corpus size.

    ``on_states(epoch, params, states)`` is called after every update with the
    updated model and the table of :func:`training_states` of that epoch (made only
    if it is read).  ``store`` names a folder that takes every epoch's model and
    metrics, and is gone on from."""
    cfg = cfg or corpus.cfg
    spark = corpus.spark
    mode = "paragraph" if unit == "paragraph" and not keep_tail else "tumbling"
    kept, params, accs, done = _resumed(store, corpus, cfg, f"sequences {unit} {rate} {keep_tail} {sampler}", *_start(corpus, cfg))
    layers, hidden, vocab = K.dims(params)
    smooth = done[-1]["smooth_loss"] if done else -math.log(1.0 / vocab) * cfg.seq_len
    res = TrainResult(params, accs, done)
    table = None
    for epoch in range(len(done), cfg.epochs):
        before = params, accs
        bc = spark.sparkContext.broadcast({"params": params, "accs": accs,
                                           "codepoints": corpus.vocab.codepoints})
        if sampler == "rotating" and rate < 1.0:
            if table is None:
                table = rotating_table(corpus, unit, cfg.seed)
            src = rotating_sample(table, rate, epoch)
        else:
            src = sequence_source(corpus, unit, rate, cfg.seed, epoch)
        size = K.n_params(layers, hidden, vocab)
        sums = total(src.mapInPandas(_sequence_task(bc, cfg, mode), PARTIAL_SCHEMA), 2 * size + 4)
        bc.unpersist()
        if sums is None:
            sums = np.zeros(2 * size + 4)
        loss, cnt, length, pred = float(sums[2 * size]), int(round(sums[2 * size + 1])), \
            float(sums[2 * size + 2]), float(sums[2 * size + 3])
        if cnt > 0:
            params = K.unflatten(sums[:size] / cnt, layers, hidden, vocab)
            accs = K.unflatten(sums[size:2 * size] / cnt, layers, hidden, vocab)
            if pred:  # per chunk, the unit it starts at
                smooth = 0.999 * smooth + 0.001 * (loss / (pred / cfg.seq_len))
        res.params, res.accs = params, accs
        res.metrics.append({
            "epoch": epoch, "loss": loss,
            "loss_per_char": loss / length if length else float("nan"),
            "loss_per_predicted": loss / pred if pred else float("nan"),
            "smooth_loss": smooth, "n": cnt, **model_stats(params, accs)})
        if kept is not None:
            kept.append(epoch, params, accs, res.metrics[-1])
        if on_epoch is not None:
            on_epoch(epoch, params)
        if on_states is not None:
            on_states(epoch, params, training_states(corpus, cfg, *before, rate, unit, epoch, mode))
    return res


def training_states(corpus: Corpus, cfg: RnnConfig, params: dict, accs: dict, rate: float, unit: str, epoch: int,
                    mode: str) -> DataFrame:
    """Where local training stands at the end of an epoch that began with the given
    model: ``doc_id, line_no`` of each of its sequences, ``seed_ch``, the character at
    the current position, and ``h0``, the hidden states of all layers there -- what
    :func:`charloom.plans.generate.generate_text` goes on from.  The sequences are
    trained again when the table is read."""
    bc = corpus.spark.sparkContext.broadcast({"params": params, "accs": accs, "codepoints": corpus.vocab.codepoints})
    L = cfg.seq_len

    def run(batches):
        K.single_thread_blas()
        st = bc.value
        layers, hidden, _ = K.dims(st["params"])
        for pdf in batches:
            seqs = encode_text(pdf["line"].tolist(), st["codepoints"])
            if not seqs:
                continue
            states = np.zeros((len(seqs), layers, hidden))
            K.train_sequences(st["params"], st["accs"], seqs, cfg, mode, states=states)
            at = K.chunk_count([len(s) for s in seqs], L, mode) * L
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "line_no": pdf["line_no"],
                                "seed_ch": [t[k] for t, k in zip(pdf["line"], at)], "h0": list(states.reshape(len(seqs), -1))})

    rows = sequence_source(corpus, unit, rate, cfg.seed, epoch, keys=True)
    return rows.mapInPandas(run, "doc_id bigint, line_no bigint, seed_ch string, h0 array<double>")
