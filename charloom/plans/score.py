"""Scoring with a fixed model (forward passes only).

* ``window_scores`` -- N2: loss of windows cut from corpus segments, each from
  a zero hidden state (the full-batch step's forward half);
* ``line_scores`` / ``doc_scores`` -- G5: teacher-forced loss of every line with
  the hidden state carried through the line, summed per document.

Per-line work runs in Arrow batches inside tasks; the per-document sum is a
hash aggregate with map-side combine, so a document with very many lines costs
one partial row per task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from charloom.functions import kernels as K
from charloom.operators.corpus import Vocab, encode_known, nonempty_lines, windows_ids

LINE_SCORE_SCHEMA = "doc_id bigint, line_no bigint, loss double, n_pred bigint, n_unknown bigint"
WINDOW_SCORE_SCHEMA = "doc_id bigint, n_windows bigint, loss double"


def _bc(spark: SparkSession, params: dict, vocab: Vocab):
    return spark.sparkContext.broadcast({"params": params, "codepoints": vocab.codepoints})


def line_scores(spark: SparkSession, lines: DataFrame, params: dict, vocab: Vocab) -> DataFrame:
    bc = _bc(spark, params, vocab)

    def run(batches):
        K.single_thread_blas()
        p, cps = bc.value["params"], bc.value["codepoints"]
        for pdf in batches:
            if pdf.empty:
                continue
            seqs, unknown = encode_known(pdf["line"].tolist(), cps)
            loss, npred = K.sequence_losses(p, seqs)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].to_numpy(), "line_no": pdf["line_no"].to_numpy(),
                                "loss": loss, "n_pred": npred.astype(np.int64), "n_unknown": unknown})

    return nonempty_lines(lines).select("doc_id", "line_no", "line").mapInPandas(run, LINE_SCORE_SCHEMA)


def doc_scores(spark: SparkSession, lines: DataFrame, params: dict, vocab: Vocab) -> DataFrame:
    """Per document: predicted characters, mean nats per prediction, perplexity
    (both null without a prediction), and characters outside the vocabulary,
    which are skipped."""
    scored = line_scores(spark, lines, params, vocab).select("doc_id", "loss", "n_pred", "n_unknown")
    blank = lines.where(F.col("line") == "").select(
        "doc_id", F.lit(0.0).alias("loss"), F.lit(0).cast("bigint").alias("n_pred"), F.lit(0).cast("bigint").alias("n_unknown"))
    per = scored.unionByName(blank).groupBy("doc_id").agg(
        F.sum("loss").alias("loss"), F.sum("n_pred").alias("n_pred"), F.sum("n_unknown").alias("n_unknown"))
    mean = F.when(F.col("n_pred") > 0, F.col("loss") / F.col("n_pred"))
    return per.select("doc_id", "n_pred", mean.alias("mean_loss"), F.exp(mean).alias("perplexity"), "n_unknown")


def window_scores(spark: SparkSession, segments: DataFrame, params: dict, vocab: Vocab,
                  seq_len: int, stride: int = 1, each: bool = False) -> DataFrame:
    """Loss of every whole window whose start ``s`` satisfies s % stride == 0
    (stride 1: W1, stride seq_len: W3), each from a zero hidden state; summed
    per document of the window start, or with ``each`` a row ``start, doc_id, loss``
    for every window."""
    bc = _bc(spark, params, vocab)
    L = seq_len

    def run(batches):
        K.single_thread_blas()
        p, cps = bc.value["params"], bc.value["codepoints"]
        cap = K.batch_rows(1, K.dims(p)[1], L)
        buf, docs, places, size = [], [], [], 0
        out = []

        def flush():
            w = np.concatenate(buf)
            d = np.concatenate(docs)
            losses = K.window_nll(p, w[:, :-1], w[:, 1:])
            if each:
                return pd.DataFrame({"start": np.concatenate(places), "doc_id": d, "loss": losses})
            frame = pd.DataFrame({"doc_id": d, "loss": losses}).groupby("doc_id")["loss"].agg(["size", "sum"])
            out.append(frame)

        for pdf in batches:
            if pdf.empty:
                continue
            ids, lens = windows_ids(pdf["text"].tolist(), cps)
            rows, starts = K.window_starts(lens, pdf["n_own"].to_numpy(), L, stride,
                                           pdf["goff"].to_numpy(dtype=np.int64))
            doc = pdf["doc_id"].to_numpy(dtype=np.int64)
            for c0 in range(0, len(rows), cap):
                r = rows[c0:c0 + cap]
                buf.append(K.gather_windows(ids, lens, r, starts[c0:c0 + cap], L))
                docs.append(doc[r])
                places.append(pdf["goff"].to_numpy(dtype=np.int64)[r] + starts[c0:c0 + cap])
                size += len(r)
                if size >= cap:
                    frame = flush()
                    if each:
                        yield frame
                    buf, docs, places, size = [], [], [], 0
        if buf:
            frame = flush()
            if each:
                yield frame
        if out:
            tot = pd.concat(out).groupby(level=0).sum()
            yield pd.DataFrame({"doc_id": tot.index.to_numpy(dtype=np.int64),
                                "n_windows": tot["size"].to_numpy(dtype=np.int64),
                                "loss": tot["sum"].to_numpy()})

    if each:
        return segments.select("doc_id", "goff", "n_own", "text").mapInPandas(run, "start bigint, doc_id bigint, loss double")
    return (segments.select("doc_id", "goff", "n_own", "text").mapInPandas(run, WINDOW_SCORE_SCHEMA)
            .groupBy("doc_id").agg(F.sum("n_windows").alias("n_windows"), F.sum("loss").alias("loss")))


PAIR_SCHEMA = "input_id bigint, target_id bigint, n bigint, p double, xent double"


def pair_xent(spark: SparkSession, pairs: DataFrame, params: dict, vocab: Vocab) -> DataFrame:
    """P7/P8 on ``pairs(input_id, target_id, n)``: the model's probability of the
    target after the input (one step from a zero state) and its cross-entropy."""
    bc = spark.sparkContext.broadcast(params)

    def run(batches):
        K.single_thread_blas()
        p = bc.value
        for pdf in batches:
            if pdf.empty:
                continue
            x = pdf["input_id"].to_numpy(dtype=np.int64)[:, None]
            y = pdf["target_id"].to_numpy(dtype=np.int64)
            _, ys = K.forward(p, x)
            lp = K.log_softmax(ys[-1][:, 0])[np.arange(len(y)), y]
            yield pd.DataFrame({"input_id": x[:, 0], "target_id": y, "n": pdf["n"].to_numpy(dtype=np.int64),
                                "p": np.exp(lp), "xent": -lp})

    return pairs.select("input_id", "target_id", "n").mapInPandas(run, PAIR_SCHEMA)


def window_grad_sums(spark: SparkSession, segments: DataFrame, cfg, vocab: Vocab, stride: int = 1) -> DataFrame:
    """Summed per-window clipped gradients of a freshly initialised
    model over the windows with start % stride == 0, as table rows (none without
    a window) ``(layer, block, i, j, n_windows, g_sum, g_mean)``."""
    from charloom.plans.model import parameter_index
    from charloom.plans.partials import CHUNK, PARTIAL_SCHEMA, pack, summed
    params = K.init_params(cfg.num_layers, cfg.hidden, vocab.size, cfg.init, cfg.seed)
    bc = _bc(spark, params, vocab)
    L = cfg.seq_len

    def run(batches):
        K.single_thread_blas()
        p, cps = bc.value["params"], bc.value["codepoints"]
        layers, hidden, V = K.dims(p)
        cap = K.group_rows(V)
        total = np.zeros(K.n_params(layers, hidden, V))
        count = 0
        buf, nbuf = [], 0
        for pdf in batches:
            if pdf.empty:
                continue
            ids, lens = windows_ids(pdf["text"].tolist(), cps)
            rows, starts = K.window_starts(lens, pdf["n_own"].to_numpy(), L, stride,
                                           pdf["goff"].to_numpy(dtype=np.int64))
            for c0 in range(0, len(rows), cap):
                buf.append(K.gather_windows(ids, lens, rows[c0:c0 + cap], starts[c0:c0 + cap], L))
                nbuf += len(buf[-1])
                if nbuf >= cap:
                    w = np.concatenate(buf)
                    total += K.flatten(K.grad_sums(p, w[:, :-1], w[:, 1:], cfg.clip, cfg.compat_untransposed)[1])
                    count += len(w)
                    buf, nbuf = [], 0
        if buf:
            w = np.concatenate(buf)
            total += K.flatten(K.grad_sums(p, w[:, :-1], w[:, 1:], cfg.clip, cfg.compat_untransposed)[1])
            count += len(w)
        if count:
            parts = pack(total)
            parts["v"] = [np.r_[v, count] for v in parts["v"]]
            yield parts

    size = K.n_params(cfg.num_layers, cfg.hidden, vocab.size)
    sums = summed(segments.select("goff", "n_own", "text").mapInPandas(run, PARTIAL_SCHEMA))
    # every chunk ends with the window count
    flat = sums.select("chunk", F.element_at("s", -1).cast("bigint").alias("n_windows"), F.posexplode("s").alias("pos", "g_sum"))
    flat = flat.select((F.col("chunk") * CHUNK + F.col("pos")).alias("k"), "pos", "n_windows", "g_sum")
    flat = flat.where((F.col("pos") < CHUNK) & (F.col("k") < size))
    return parameter_index(flat, "k", cfg.num_layers, cfg.hidden, vocab.size, "n_windows", "g_sum").select(
        "layer", "block", "i", "j", "n_windows", "g_sum", (F.col("g_sum") / F.col("n_windows")).alias("g_mean"))


CARRIED_SCHEMA = "key bigint, loss double, n_pred bigint, n_unknown bigint"


def carried_scores(spark: SparkSession, rows: DataFrame, params: dict, vocab: Vocab,
                   partitions: int | None = None) -> DataFrame:
    """N4 across rows: ``rows(key, ord, text)`` form one sequence per key, read in
    ``ord`` order with line breaks dropped; the hidden state and the last
    character are handed from row to row, so predictions continue across row
    borders.  Returns ``(key, loss, n_pred)``.

    One range shuffle on ``key`` (all rows of a key land in one task, sorted by
    ``ord``) and a streaming pass.  The keys that a batch of rows completes go
    forward together, in lock-step; the key at a batch's end hands its state to
    the next batch, so memory per task is a batch of rows plus the states,
    whatever the size of a key.  A key's characters are necessarily read in one
    sequence, so a single huge key is one (streamed) task.  Characters outside
    the vocabulary are skipped and counted.
    """
    from charloom.sources.text import LINE_BREAK
    from charloom.operators.scan import default_partitions
    p = partitions or default_partitions(spark, rows)
    bc = _bc(spark, params, vocab)
    ordered = (rows.select(F.col("key").cast("bigint").alias("key"), F.col("ord").cast("bigint").alias("ord"),
                           F.regexp_replace("text", LINE_BREAK, "").alias("text"))
               .repartitionByRange(p, "key").sortWithinPartitions("key", "ord"))

    def run(batches):
        K.single_thread_blas()
        prm, cps = bc.value["params"], bc.value["codepoints"]
        layers, hidden, _ = K.dims(prm)
        open_key, last, state, done = None, None, np.zeros((layers, hidden)), [0.0, 0, 0]
        for pdf in batches:
            if pdf.empty:
                continue
            seqs, unknown = encode_known(pdf["text"].fillna("").tolist(), cps)
            keys = pdf["key"].to_numpy()
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            ends = np.r_[first[1:], len(keys)]
            own = [np.concatenate(seqs[a:b]).astype(np.int64) for a, b in zip(first, ends)]
            skipped = np.add.reduceat(unknown, first)
            h0 = np.zeros((layers, len(first), hidden))
            carry = keys[first[0]] == open_key
            if carry:
                own[0] = own[0] if last is None else np.r_[last, own[0]]
                h0[:, 0] = state
            elif open_key is not None:
                yield pd.DataFrame([(open_key, *done)], columns=["key", "loss", "n_pred", "n_unknown"])
            loss, n_pred, h = K.sequence_losses(prm, own, h0=h0)
            if carry:
                loss[0], n_pred[0], skipped[0] = loss[0] + done[0], n_pred[0] + done[1], skipped[0] + done[2]
            open_key, state = keys[-1], h[:, -1]
            last = int(own[-1][-1]) if len(own[-1]) else None
            done = [float(loss[-1]), int(n_pred[-1]), int(skipped[-1])]
            yield pd.DataFrame({"key": keys[first[:-1]], "loss": loss[:-1], "n_pred": n_pred[:-1], "n_unknown": skipped[:-1]})
        if open_key is not None:
            yield pd.DataFrame([(open_key, *done)], columns=["key", "loss", "n_pred", "n_unknown"])

    return ordered.mapInPandas(run, CARRIED_SCHEMA)
