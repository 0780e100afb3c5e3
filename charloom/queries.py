"""Registered queries: each reads the test tables of ``sf_dir`` and returns a
DataFrame whose columns match the DuckDB oracle of the same name in
``charloom.oracles``.  Large intermediate results (windows, tokens) are reduced
to per-document counts and md5 checksums of every window, so the whole corpus is
still checked while the compared result stays small.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from charloom.config import RnnConfig
from charloom.corpus_context import Corpus
from charloom.functions.exprs import bernoulli_keep, clip_col, md5_int
from charloom.operators import corpus as C
from charloom.operators import windows as W
from charloom.sources.text import read_table

CFG = RnnConfig()
L = CFG.seq_len
# sampling rates of the registered sampling queries (fixed values)
WINDOW_SAMPLE_RATE = 0.001
PARAGRAPH_SAMPLE_RATE = 0.05
SAMPLE_EPOCHS = (0, 1)


def _corpus(spark: SparkSession, sf_dir: str) -> Corpus:
    return Corpus.from_table(spark, sf_dir, "documents", CFG)


def _epochs():
    return F.explode(F.array(*[F.lit(e).cast("bigint") for e in SAMPLE_EPOCHS]))


def _window_summary(wins: DataFrame, by: str = "doc_id") -> DataFrame:
    return (wins.groupBy(by).agg(F.count(F.lit(1)).cast("bigint").alias("n_windows"),
                                 F.sum(md5_int(F.col("win"))).cast("bigint").alias("checksum")))


# ---------------------------------------------------------------- sources / tokens
def q_corpus_lines(spark, sf_dir):
    c = _corpus(spark, sf_dir)
    return c.lines.select("doc_id", "line_no", F.length("line").cast("bigint").alias("n"),
                          md5_int(F.col("line")).alias("checksum"))


def q_nonempty_lines(spark, sf_dir):
    c = _corpus(spark, sf_dir)
    return C.nonempty_lines(c.lines).select("doc_id", "line_no", F.length("line").cast("bigint").alias("n"))


def q_char_tokens(spark, sf_dir):
    c = _corpus(spark, sf_dir)
    return (C.char_tokens(c.lines).groupBy("doc_id")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_chars"),
                 F.countDistinct("ch").cast("bigint").alias("n_distinct"),
                 F.sum((F.col("pos") + 1).cast("bigint") * F.ascii("ch")).cast("bigint").alias("checksum")))


def q_word_tokens(spark, sf_dir):
    c = _corpus(spark, sf_dir)
    return C.word_tokens(c.lines).groupBy("word").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def q_vocab(spark, sf_dir):
    c = _corpus(spark, sf_dir)
    return c.vocab_df.select("ch", F.col("id").cast("bigint").alias("id"), F.col("n").cast("bigint").alias("n"))


def q_corpus_summary(spark, sf_dir):
    c = _corpus(spark, sf_dir)
    stats = c.lines.agg(
        F.countDistinct("doc_id").cast("bigint").alias("n_docs"),
        F.count(F.lit(1)).cast("bigint").alias("n_lines"),
        F.sum(F.when(F.col("line") != "", 1).otherwise(0)).cast("bigint").alias("n_nonempty"),
        F.sum(F.length("line")).cast("bigint").alias("n_chars"))
    return stats.select(
        F.lit(c.vocab.size).cast("bigint").alias("vocab_size"), "n_docs", "n_lines", "n_nonempty", "n_chars",
        F.lit(CFG.num_layers).cast("bigint").alias("num_layers"),
        F.lit(CFG.hidden).cast("bigint").alias("hidden"),
        F.lit(CFG.seq_len).cast("bigint").alias("seq_len"))


def q_encoded_lines(spark, sf_dir):
    c = _corpus(spark, sf_dir)
    enc = C.encode_lines(spark, c.lines, c.vocab)
    return enc.select("doc_id", "line_no", F.array_join("ids", " ").alias("ids"))


def q_decoded_lines(spark, sf_dir):
    c = _corpus(spark, sf_dir)
    enc = C.encode_lines(spark, c.lines, c.vocab)
    dec = C.decoder_udf(spark, c.vocab)(F.col("ids"))
    return enc.select("doc_id", "line_no", F.size("ids").cast("bigint").alias("n"),
                      md5_int(dec).alias("checksum"))


def q_one_hot(spark, sf_dir):
    """Sum of the one-hot codes of every character of a document (its
    character histogram), as a dense vector of V counts.  Characters are
    counted per document first; the vocabulary is joined to the counts, and each
    document's vector is built once, from at most V counts."""
    c = _corpus(spark, sf_dir)
    v = c.vocab
    per = (C.char_tokens(c.lines).groupBy("doc_id", "ch").agg(F.count(F.lit(1)).alias("cnt"))
           .join(v.to_df(spark).select("ch", "id"), "ch"))
    counts = per.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("id", "cnt"))).alias("counts"))
    return counts.select("doc_id", F.array_join(F.transform(
        F.sequence(F.lit(0), F.lit(v.size - 1)),
        lambda k: F.coalesce(F.element_at("counts", k), F.lit(0)).cast("string")), ",").alias("hist"))


def q_shifted_pairs(spark, sf_dir):
    """Input/target pairs (target = next char in the line), counted."""
    c = _corpus(spark, sf_dir)
    enc = C.encode_lines(spark, c.lines, c.vocab).where(F.size("ids") > 1)
    n = F.size("ids")
    pairs = F.arrays_zip(F.slice("ids", 1, n - 1).alias("x"), F.slice("ids", 2, n - 1).alias("y"))
    return (enc.select(F.explode(pairs).alias("p"))
            .groupBy(F.col("p.x").cast("bigint").alias("input_id"), F.col("p.y").cast("bigint").alias("target_id"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def q_text_round_trip(spark, sf_dir):
    """IO1: the corpus written as text files and read back: every distinct line
    with its length and number of copies."""
    import uuid

    from charloom.session import ensure_checkpoint_dir
    from charloom.sources.text import read_text_lines
    c = _corpus(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/charloom-text-{uuid.uuid4().hex}"
    c.lines.select("line").write.text(path)
    lines = Corpus.from_lines(spark, read_text_lines(spark, path), CFG).lines
    return (lines.groupBy(F.length("line").cast("bigint").alias("n"), md5_int(F.col("line")).alias("checksum"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("copies")))


def q_text_order(spark, sf_dir):
    """IO1 + O2: the corpus written as text files in its order and read back: every
    line with a character at the position that file order gives it."""
    import uuid

    from charloom.session import ensure_checkpoint_dir
    from charloom.sources.text import read_text_lines
    c = _corpus(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/charloom-text-{uuid.uuid4().hex}"
    c.lines.repartitionByRange("doc_id", "line_no").sortWithinPartitions("doc_id", "line_no").select("line").write.text(path)
    read = Corpus.from_lines(spark, read_text_lines(spark, path), CFG)
    sums = read.lines.select("doc_id", "line_no", md5_int(F.col("line")).alias("checksum"))
    return read.line_positions().join(sums, ["doc_id", "line_no"]).select("goff", "n", "checksum")


# ---------------------------------------------------------------- positions / windows
def q_line_offsets(spark, sf_dir):
    c = _corpus(spark, sf_dir)
    return c.line_positions()


def q_eval_prefix(spark, sf_dir):
    """The first 51 characters of the corpus, as ids (the evaluation sequence)."""
    c = _corpus(spark, sf_dir)
    eval_len = 51
    # every line that counts has a character, so the first 51 of them hold the prefix: a top-k, no shuffle of the text
    first = C.nonempty_lines(c.lines).orderBy("doc_id", "line_no").limit(eval_len)
    order = Window.orderBy("doc_id", "line_no").rowsBetween(Window.unboundedPreceding, -1)
    lines = first.select((F.coalesce(F.sum(F.length("line")).over(order), F.lit(0))).alias("goff"),
                         F.substring("line", 1, eval_len).alias("line"))
    chars = lines.select("goff", F.posexplode(F.split("line", "", -1)).alias("k", "ch"))
    chars = chars.select((F.col("goff") + F.col("k")).alias("gpos"), "ch").where(F.col("gpos") < eval_len)
    return chars.join(F.broadcast(c.vocab.to_df(spark).select("ch", "id")), "ch").select(
        F.col("gpos").cast("bigint").alias("gpos"), "ch", F.col("id").cast("bigint").alias("id"))


def q_corpus_sliding(spark, sf_dir):
    c = _corpus(spark, sf_dir)
    return _window_summary(W.corpus_sliding_windows(c.corpus.segments, L))


def q_corpus_tumbling(spark, sf_dir):
    c = _corpus(spark, sf_dir)
    return _window_summary(W.corpus_tumbling_windows(c.corpus.segments, L))


def q_line_sliding(spark, sf_dir):
    c = _corpus(spark, sf_dir)
    return _window_summary(W.line_sliding_windows(c.lines, L))


def q_paragraph_chunks(spark, sf_dir):
    """W4 + F4 in one pass: every piece of a line yields its windows, or one row
    without a window; a line is counted at the first row of its first piece."""
    c = _corpus(spark, sf_dir)
    pieces = W.line_pieces(C.nonempty_lines(c.lines), halo=L)
    chunks = W.paragraph_chunks(F.col("n_line"), L)
    starts = W.piece_starts(L, L, F.col("offset"), chunks * F.lit(L))
    rows = pieces.select("doc_id", "piece", chunks.alias("chunks"), "text", F.posexplode_outer(starts).alias("k", "s"))
    line = (F.col("piece") == 0) & (F.coalesce("k", F.lit(0)) == 0)
    win = F.when(F.col("s").isNotNull(), F.substring("text", F.col("s") + 1, F.lit(L + 1)))
    return rows.groupBy("doc_id").agg(
        F.sum(line.cast("bigint")).alias("n_paragraphs"),
        F.sum((line & (F.col("chunks") == 0)).cast("bigint")).alias("n_idle"),
        F.sum(F.when(line, F.col("chunks")).otherwise(0)).cast("bigint").alias("n_chunks"),
        F.count("s").cast("bigint").alias("n_windows"),
        F.coalesce(F.sum(md5_int(win)), F.lit(0)).cast("bigint").alias("checksum"))


def q_sampled_windows(spark, sf_dir):
    """Bernoulli sample of corpus window starts, reproducible per epoch."""
    c = _corpus(spark, sf_dir)
    wins = W.corpus_sliding_windows(c.corpus.segments, L, sample=(WINDOW_SAMPLE_RATE, CFG.seed, SAMPLE_EPOCHS))
    return wins.select("epoch", F.col("start").cast("bigint").alias("start"), "win")


def q_sampled_paragraphs(spark, sf_dir):
    """Bernoulli sample of paragraphs (non-empty lines) per epoch."""
    c = _corpus(spark, sf_dir)
    ne = C.nonempty_lines(c.lines)
    return (ne.withColumn("epoch", _epochs())
            .where(bernoulli_keep(PARAGRAPH_SAMPLE_RATE, CFG.seed, F.col("epoch"), F.col("doc_id"), F.col("line_no")))
            .select("epoch", "doc_id", "line_no", F.length("line").cast("bigint").alias("n")))


# ---------------------------------------------------------------- model maths and training
# Fixed settings of the registered model queries.  Models that SQL can rebuild:
# "sine" (closed-form weights; with a few hidden units SQL follows the recurrence
# step by step) and "sine_static" (sine with Wh = 0, so each step depends on its
# own input only and per-character logit tables are exact);
# "zero" (only the output bias can learn, so training has a closed form).
STACKED = 2
T2_RATE = 0.01
T2_EPOCHS = 3
T3_RATE = 0.05
T3_EPOCHS = 2
T1_EPOCHS = 2
T4_EPOCHS = 2
# hidden units of the recurrent models that SQL follows
SQL_HIDDEN = 4
GEN_STEPS = 25
EVAL_OFFSET = 10


def _static_model(c: Corpus, layers: int = STACKED):
    from charloom.functions.kernels import init_params
    return init_params(layers, CFG.hidden, c.vocab.size, "sine_static")


def _recurrent_model(c: Corpus, layers: int = 1):
    from charloom.functions.kernels import init_params
    return init_params(layers, SQL_HIDDEN, c.vocab.size, "sine")


def _metrics_out(df: DataFrame) -> DataFrame:
    return df.select(F.col("epoch").cast("bigint").alias("epoch"), "n", *[F.round(x, 6).alias(x) for x in
                                    ("loss_per_char", "smooth_loss", "w_sum", "w_sq", "acc_sum")])


def q_model_init(spark, sf_dir):
    from charloom.plans.model import model_table
    c = _corpus(spark, sf_dir)
    m = model_table(spark, STACKED, CFG.hidden, c.vocab.size, "sine")
    return m.select(*[F.col(x).cast("bigint").alias(x) for x in ("layer",)], "block",
                    *[F.col(x).cast("bigint").alias(x) for x in ("i", "j")],
                    F.round("w", 6).alias("w"), F.round("acc", 6).alias("acc"))


def q_softmax_xent(spark, sf_dir):
    """Softmax of the logits after each input character and the
    cross-entropy of every (input, target) pair seen in the corpus."""
    from charloom.plans.score import pair_xent
    c = _corpus(spark, sf_dir)
    pairs = q_shifted_pairs(spark, sf_dir)
    out = pair_xent(spark, pairs, _static_model(c), c.vocab)
    return out.select("input_id", "target_id", "n", F.round("p", 6).alias("p"), F.round("xent", 6).alias("xent"))


def _tumbling_bout_grads(c: Corpus) -> DataFrame:
    """Per-window output-bias gradient of the all-zero model on tumbling windows,
    in SQL form: with h = 0 the gradient of window w for char k is
    L/V - count_w(k).  Clipped per window (P9), then summed per char."""
    V = c.vocab.size
    wins = W.corpus_tumbling_windows(c.corpus.segments, L)
    nwin = max(0, c.corpus.total_chars - 1) // L
    # counts inside the window's own row; only V partial sums per task are shuffled
    tg = wins.select(F.substring("win", 2, L).alias("t")).select(
        "t", F.explode(F.array_distinct(F.split("t", "", -1))).alias("ch"))
    tg = tg.select("ch", (F.length("t") - F.length(F.replace("t", F.col("ch"), F.lit("")))).alias("cnt"))
    tg = tg.join(F.broadcast(c.vocab.to_df(c.spark).select("ch", "id")), "ch")
    base = float(L) / V
    present = tg.groupBy("id").agg(
        F.sum(clip_col(F.lit(base) - F.col("cnt"), CFG.clip)).alias("g_present"),
        F.count(F.lit(1)).alias("n_present"))
    allv = c.vocab.to_df(c.spark).select("id")
    return (allv.join(present, "id", "left").select(
        F.col("id").cast("bigint").alias("i"),
        (F.coalesce("g_present", F.lit(0.0)) + (F.lit(nwin) - F.coalesce("n_present", F.lit(0)))
         * clip_col(F.lit(base), CFG.clip)).alias("g_sum"), F.lit(nwin).cast("bigint").alias("n_windows")))


def q_clipped_grads(spark, sf_dir):
    c = _corpus(spark, sf_dir)
    g = _tumbling_bout_grads(c)
    return g.select("i", "n_windows", F.round("g_sum", 6).alias("g_sum"),
                    F.round(F.col("g_sum") / F.col("n_windows"), 6).alias("g_mean"))


def q_window_grads(spark, sf_dir):
    """N3 + A3 + A4 (+P10): back-propagation of every tumbling window through the
    kernel, per-window clip, sum and mean -- zero model, so the SQL oracle is exact."""
    from charloom.plans.score import window_grad_sums
    c = _corpus(spark, sf_dir)
    g = window_grad_sums(spark, c.corpus.segments, CFG.with_(init="zero"), c.vocab, stride=L)
    return g.select(F.col("layer").cast("bigint").alias("layer"), "block", F.col("i").cast("bigint").alias("i"),
                    F.col("j").cast("bigint").alias("j"), "n_windows", F.round("g_sum", 6).alias("g_sum"),
                    F.round("g_mean", 6).alias("g_mean"))


def q_adagrad_step(spark, sf_dir):
    """N5 on tables: sine model joined with the mean tumbling-window gradient."""
    from charloom.plans.model import adagrad_update, model_table
    c = _corpus(spark, sf_dir)
    m = model_table(spark, 1, CFG.hidden, c.vocab.size, "sine")
    g = _tumbling_bout_grads(c).select(F.lit(0).alias("layer"), F.lit("bout").alias("block"),
                                       F.col("i").cast("int").alias("i"), F.lit(0).alias("j"),
                                       (F.col("g_sum") / F.col("n_windows")).alias("g"))
    out = adagrad_update(m, g, CFG.learn_rate)
    return out.select(F.col("layer").cast("bigint").alias("layer"), "block", F.col("i").cast("bigint").alias("i"),
                      F.col("j").cast("bigint").alias("j"), F.round("w", 6).alias("w"), F.round("acc", 6).alias("acc"))


def q_window_loss(spark, sf_dir):
    """Stacked forward pass and loss of every corpus tumbling window (zero
    start state), per document of the window start."""
    from charloom.plans.score import window_scores
    c = _corpus(spark, sf_dir)
    s = window_scores(spark, c.corpus.segments, _recurrent_model(c, STACKED), c.vocab, L, stride=L)
    return s.select("doc_id", F.col("n_windows").cast("bigint").alias("n_windows"),
                    F.round(F.col("loss") / F.col("n_windows"), 6).alias("mean_loss"))


def q_smoothed_loss(spark, sf_dir):
    """The loss of every corpus tumbling window, smoothed window by window in
    corpus order; each document's value after its last window."""
    from charloom.operators.scan import smoothed
    from charloom.plans.score import window_scores
    c = _corpus(spark, sf_dir)
    steps = window_scores(spark, c.corpus.segments, _recurrent_model(c, STACKED), c.vocab, L, stride=L, each=True)
    run = smoothed(steps, ["start"], "loss", float(np.log(c.vocab.size)) * L)
    return run.groupBy("doc_id").agg(F.count("*").alias("n_steps"), F.round(F.max_by("smooth", "start"), 6).alias("smooth_loss"))


def q_doc_scores(spark, sf_dir):
    """G5 (flagship): every line scored with the hidden state carried through it;
    documents ranked by mean nats per predicted character."""
    from charloom.plans.score import doc_scores
    c = _corpus(spark, sf_dir)
    s = doc_scores(spark, c.lines, _recurrent_model(c, STACKED), c.vocab)
    return s.select("doc_id", F.col("n_pred").cast("bigint").alias("n_pred"),
                    F.round("mean_loss", 6).alias("mean_loss"),
                    F.round("perplexity", 6).alias("perplexity"), "n_unknown").orderBy(F.col("mean_loss").desc(), "doc_id")


def q_train_full_batch(spark, sf_dir):
    """T1 + A3/A4/A6/A8/IO3: epochs over every corpus window (zero model)."""
    from charloom.plans.train import fit_windows
    c = _corpus(spark, sf_dir)
    res = fit_windows(c, CFG.with_(init="zero", epochs=T1_EPOCHS), rate=1.0)
    return _metrics_out(res.metrics_df(spark))


def q_train_mini_batch(spark, sf_dir):
    """T2 + F2: sampled window starts per epoch (zero model)."""
    from charloom.plans.train import fit_windows
    c = _corpus(spark, sf_dir)
    res = fit_windows(c, CFG.with_(init="zero", epochs=T2_EPOCHS), rate=T2_RATE)
    return _metrics_out(res.metrics_df(spark))


def q_train_param_avg(spark, sf_dir):
    """T3 + A5/A7: sampled paragraphs trained locally, weights and accumulators averaged."""
    from charloom.plans.train import fit_sequences
    c = _corpus(spark, sf_dir)
    res = fit_sequences(c, CFG.with_(init="zero", epochs=T3_EPOCHS), rate=T3_RATE, unit="paragraph")
    return _metrics_out(res.metrics_df(spark))


def q_train_per_document(spark, sf_dir):
    """T4: carried-state sequential training per document, averaged across documents."""
    from charloom.plans.train import fit_sequences
    c = _corpus(spark, sf_dir)
    res = fit_sequences(c, CFG.with_(init="zero", epochs=T4_EPOCHS), rate=1.0, unit="document")
    return _metrics_out(res.metrics_df(spark))


def q_inverse_cdf_sample(spark, sf_dir):
    """One draw per document from the corpus character distribution."""
    from charloom.functions.exprs import unit_uniform
    c = _corpus(spark, sf_dir)
    cum = np.cumsum(np.array(c.vocab.counts, dtype=np.int64))
    bc = spark.sparkContext.broadcast((cum / cum[-1], np.array(c.vocab.chars, dtype=object)))

    @F.pandas_udf("id bigint, ch string")
    def draw(u: pd.Series) -> pd.DataFrame:
        cdf, chars = bc.value
        v = u.to_numpy()
        k = np.where(v <= cdf[0], 0, np.minimum(np.searchsorted(cdf, v, side="right"), len(cdf) - 1))
        return pd.DataFrame({"id": k, "ch": chars[k]})

    docs = c.docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))
    return docs.select("doc_id", draw(unit_uniform(CFG.seed, 0, F.col("doc_id"))).alias("d")).select("doc_id", "d.*")


def _prompts(spark, sf_dir):
    from charloom.plans.generate import prompts_from_text
    bench = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    return prompts_from_text(bench, "item_id", "text")


def q_generate_greedy(spark, sf_dir):
    """G1 + G3: greedy continuation of every benchmark item's first character."""
    from charloom.plans.generate import generate_text
    c = _corpus(spark, sf_dir)
    return generate_text(spark, _prompts(spark, sf_dir), _recurrent_model(c), c.vocab, GEN_STEPS, greedy=True)


def q_generate_sampled(spark, sf_dir):
    """G1 + G2 + IO5: sampled continuation with reproducible draws."""
    from charloom.plans.generate import generate_text
    c = _corpus(spark, sf_dir)
    return generate_text(spark, _prompts(spark, sf_dir), _recurrent_model(c), c.vocab, GEN_STEPS,
                         greedy=False, seed=CFG.seed)


def q_free_running_loss(spark, sf_dir):
    """Free-running (sampled) loss of every benchmark item after 10 chars."""
    from charloom.plans.generate import free_running_loss
    c = _corpus(spark, sf_dir)
    items = read_table(spark, sf_dir, "benchmark", "item_id", "text").select(
        F.col("item_id").cast("bigint").alias("prompt_id"), "text")
    out = free_running_loss(spark, items, _recurrent_model(c), c.vocab, EVAL_OFFSET, seed=CFG.seed)
    return out.select("prompt_id", "n_scored", "n_unknown", F.round("loss", 6).alias("loss"))


def q_carried_state_loss(spark, sf_dir):
    """Each conversation read turn by turn with the hidden state and last
    character handed over between turns; mean nats per predicted character."""
    from charloom.plans.score import carried_scores
    conv = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    c = Corpus(spark, conv.select("conv_id", "text"), CFG, text_col="text", key_col="conv_id")
    rows = conv.select(F.col("conv_id").alias("key"), F.col("turn").alias("ord"), "text")
    s = carried_scores(spark, rows, _recurrent_model(c), c.vocab)
    return s.select(F.col("key").alias("conv_id"), "n_pred", "n_unknown",
                    F.round(F.when(F.col("n_pred") > 0, F.col("loss") / F.col("n_pred")), 6).alias("mean_loss"))


# training from non-zero weights: the sine model with a few hidden units, whose gradients reach every block.
# Per-window clipping at SINE_CLIP meets some entries of every kind; the item texts are a corpus whose every
# stride-1 window SQL can follow.
SINE_CLIP = 1.0
SINE_RATE = 0.002
SINE_SEQUENCE_RATE = 0.5
SINE = CFG.with_(init="sine", hidden=SQL_HIDDEN, clip=SINE_CLIP, epochs=2)


def _items(spark, sf_dir) -> Corpus:
    return Corpus.from_table(spark, sf_dir, "benchmark", SINE, key_col="item_id")


def q_window_grads_sine(spark, sf_dir):
    """N3 + A3 + A4 + P10 with non-zero weights: every block's gradient, through time,
    of every tumbling window of the corpus, clipped per window, summed and averaged."""
    from charloom.plans.score import window_grad_sums
    c = _corpus(spark, sf_dir)
    g = window_grad_sums(spark, c.corpus.segments, SINE, c.vocab, stride=L)
    return g.select("block", F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), "n_windows",
                    F.round("g_sum", 3).alias("g_sum"), F.round("g_mean", 8).alias("g_mean"))


def q_train_full_batch_sine(spark, sf_dir):
    """T1 from non-zero weights: every stride-1 window of the item texts, two epochs,
    so the second epoch uses what the first learned."""
    from charloom.plans.train import fit_windows
    return _metrics_out(fit_windows(_items(spark, sf_dir), SINE).metrics_df(spark))


def q_train_mini_batch_sine(spark, sf_dir):
    """T2 from non-zero weights, over sampled windows of the documents."""
    from charloom.plans.train import fit_windows
    c = _corpus(spark, sf_dir)
    return _metrics_out(fit_windows(c, SINE, rate=SINE_RATE).metrics_df(spark))


def q_train_param_avg_sine(spark, sf_dir):
    """T3 + A5 from non-zero weights: paragraphs of the item texts, weights,
    accumulators and states carried from window to window, then averaged."""
    from charloom.plans.train import fit_sequences
    return _metrics_out(fit_sequences(_items(spark, sf_dir), SINE, rate=SINE_SEQUENCE_RATE).metrics_df(spark))


def q_train_per_document_sine(spark, sf_dir):
    """T4 + N4 from non-zero weights: every item text one sequence."""
    from charloom.plans.train import fit_sequences
    return _metrics_out(fit_sequences(_items(spark, sf_dir), SINE, unit="document").metrics_df(spark))


def q_train_resumed_sine(spark, sf_dir):
    """IO3: the parameter averaging above, stopped after its first epoch and started
    again on the same folder; the metrics are those that the folder holds."""
    import uuid

    from charloom.plans.train import EpochStore, fit_sequences
    from charloom.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/charloom-epochs-{uuid.uuid4().hex}"
    for epochs in (1, SINE.epochs):
        fit_sequences(_items(spark, sf_dir), SINE.with_(epochs=epochs), rate=SINE_SEQUENCE_RATE, store=path)
    return _metrics_out(EpochStore(spark, path, "").metrics())


def q_state_samples_sine(spark, sf_dir):
    """G6 + N4: after every epoch of per-document training, characters sampled from
    where each document's training stands: its hidden state and its next character."""
    from functools import reduce

    from charloom.plans.generate import generate_text
    from charloom.plans.train import fit_sequences
    c = _items(spark, sf_dir)
    parts = []

    def sample(epoch, params, states):
        prompts = states.select(F.col("doc_id").alias("prompt_id"), "seed_ch", "h0")
        parts.append(generate_text(spark, prompts, params, c.vocab, GEN_STEPS, greedy=False, seed=CFG.seed)
                     .select(F.lit(epoch).cast("bigint").alias("epoch"), "prompt_id", "text"))

    fit_sequences(c, SINE, unit="document", on_states=sample)
    return reduce(DataFrame.unionByName, parts)


SAMPLE_LEN = 200


def q_training_samples(spark, sf_dir):
    """G6 + IO5: after every epoch of parameter-averaging training, 200
    characters sampled from each benchmark prompt with that epoch's model
    (zero start, so SQL can follow the model)."""
    from functools import reduce

    from charloom.plans.generate import generate_text
    from charloom.plans.train import fit_sequences
    c = _corpus(spark, sf_dir)
    prompts = _prompts(spark, sf_dir)
    parts = []

    def sample(epoch, params):
        parts.append(generate_text(spark, prompts, params, c.vocab, SAMPLE_LEN, greedy=False, seed=CFG.seed)
                     .select(F.lit(epoch).cast("bigint").alias("epoch"), "prompt_id", "text"))

    fit_sequences(c, CFG.with_(init="zero", epochs=T3_EPOCHS), rate=T3_RATE, unit="paragraph", on_epoch=sample)
    return reduce(DataFrame.unionByName, parts)


QUERIES = {
    "corpus_lines": q_corpus_lines,
    "nonempty_lines": q_nonempty_lines,
    "char_tokens": q_char_tokens,
    "word_tokens": q_word_tokens,
    "vocab": q_vocab,
    "corpus_summary": q_corpus_summary,
    "encoded_lines": q_encoded_lines,
    "decoded_lines": q_decoded_lines,
    "one_hot": q_one_hot,
    "shifted_pairs": q_shifted_pairs,
    "text_round_trip": q_text_round_trip,
    "text_order": q_text_order,
    "line_offsets": q_line_offsets,
    "eval_prefix": q_eval_prefix,
    "corpus_sliding": q_corpus_sliding,
    "corpus_tumbling": q_corpus_tumbling,
    "line_sliding": q_line_sliding,
    "paragraph_chunks": q_paragraph_chunks,
    "sampled_windows": q_sampled_windows,
    "sampled_paragraphs": q_sampled_paragraphs,
    "model_init": q_model_init,
    "softmax_xent": q_softmax_xent,
    "clipped_grads": q_clipped_grads,
    "window_grads": q_window_grads,
    "adagrad_step": q_adagrad_step,
    "window_loss": q_window_loss,
    "doc_scores": q_doc_scores,
    "train_full_batch": q_train_full_batch,
    "train_mini_batch": q_train_mini_batch,
    "train_param_avg": q_train_param_avg,
    "train_per_document": q_train_per_document,
    "inverse_cdf_sample": q_inverse_cdf_sample,
    "generate_greedy": q_generate_greedy,
    "generate_sampled": q_generate_sampled,
    "free_running_loss": q_free_running_loss,
    "training_samples": q_training_samples,
    "carried_state_loss": q_carried_state_loss,
    "window_grads_sine": q_window_grads_sine,
    "train_full_batch_sine": q_train_full_batch_sine,
    "train_mini_batch_sine": q_train_mini_batch_sine,
    "train_param_avg_sine": q_train_param_avg_sine,
    "train_per_document_sine": q_train_per_document_sine,
    "train_resumed_sine": q_train_resumed_sine,
    "state_samples_sine": q_state_samples_sine,
    "smoothed_loss": q_smoothed_loss,
}

FLAGSHIP = "doc_scores"
