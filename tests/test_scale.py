"""Findings of round 3 on time and memory: the work grows with what is distinct, moved
or sampled, and results are those of the plain way."""
import numpy as np
import pyarrow as pa
import pytest

from charloom.config import RnnConfig
from charloom.corpus_context import Corpus
from charloom.functions import kernels as K
from charloom.operators import corpus as C
from charloom.operators import scan as S
from charloom.plans import train

KINDS = ["zero", "bias", "gaussian", "sine", "sine_static"]


def _model(kind, layers=1, hidden=5, vocab=12):
    p = K.init_params(layers, hidden, vocab, "zero" if kind == "bias" else kind)
    if kind == "bias":
        p["bout"][:] = 2 * np.random.default_rng(3).standard_normal(p["bout"].shape)
    return p


def _windows(n, vocab=12, L=25):
    odds = 1 / np.arange(1, vocab + 1) ** 1.5  # some characters come more than `clip` times in a window
    return np.random.default_rng(n).choice(vocab, size=(n, L + 1), p=odds / odds.sum()).astype(np.int32)


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("compat", [False, True])
@pytest.mark.parametrize("lim", [0.4, 5.0])
def test_group_gradients_are_the_sum_of_single_windows(kind, compat, lim):
    p, w = _model(kind), _windows(700)
    losses, g = K.grad_sums(p, w[:, :-1], w[:, 1:], lim, compat)
    want = {b: np.zeros_like(p[b]) for b in K.BLOCKS}
    for k in range(len(w)):
        one, part = K.grad_sum(p, w[k:k + 1, :-1], w[k:k + 1, 1:], lim, compat_untransposed=compat)
        assert np.isclose(losses[k], one[0], rtol=1e-12)
        for b in K.BLOCKS:
            want[b] += part[b]
    assert np.allclose(K.flatten(g), K.flatten(want), rtol=1e-9, atol=1e-9)


def test_windows_of_few_states_share_their_logits(monkeypatch):
    """no window of a model with few states has logits of its own."""
    seen = []
    monkeypatch.setattr(K, "grad_sum", lambda p, x, *a, **k: seen.append(len(x)))
    w = _windows(4000)
    K.grad_sums(_model("zero"), w[:, :-1], w[:, 1:], 5.0)
    assert not seen
    numbers, states, first = K.distinct_states(_model("sine_static"), w[:, :-1])
    assert len(states) <= 12 * 25 and np.array_equal(first[[0, -1]], [0, len(states)])
    assert np.allclose(states[numbers], K.forward(_model("sine_static"), w[:, :-1])[0][0])
    assert K.distinct_states(_model("sine"), w[:400, :-1]) is None


@pytest.mark.parametrize("layers", [1, 2])
@pytest.mark.parametrize("kind", [*KINDS, "large"])
def test_scores_without_logits_of_all_steps(layers, kind, monkeypatch):
    """losses need no array of all steps' logits, nor those of lower layers."""
    p = _model("sine" if kind == "large" else kind, layers)
    if kind == "large":
        p["Wout"] *= 9000
    w = _windows(90)
    want = K.window_losses(K.forward(p, w[:, :-1])[1][-1], w[:, 1:])
    monkeypatch.delattr(K, "forward")
    assert np.allclose(K.window_nll(p, w[:, :-1], w[:, 1:]), want, rtol=1e-9)
    assert np.allclose(K.sequence_losses(p, list(w), chunk=7)[0], want, rtol=1e-9)


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("compat", [False, True])
def test_local_step_is_the_plain_step(kind, compat):
    """the step in place against gradients of every block."""
    cfg = RnnConfig(hidden=5, clip=1.0, compat_untransposed=compat)
    p, w = _model(kind), _windows(9, L=100)
    got = K.train_sequences(p, K.zeros(1, 5, 12), list(w), cfg, "tumbling")
    ws, accs = ({b: np.repeat(x[b][None], 9, axis=0) for b in K.BLOCKS} for x in (p, K.zeros(1, 5, 12)))
    h, loss = np.zeros((9, 1, 5)), 0.0
    for k in range(4):
        x = w[:, 25 * k:25 * k + 26]
        losses, g, h = K.sequence_step(ws, x[:, :-1], x[:, 1:], h, 1.0, compat)
        loss += losses.sum()
        for b in K.BLOCKS:
            accs[b] += g[b] ** 2
            ws[b] -= cfg.learn_rate * g[b] / np.sqrt(accs[b] + K.EPS)
    assert np.isclose(got[0], loss, rtol=1e-12)
    for b in K.BLOCKS:
        assert np.allclose(got[1][b], ws[b].sum(axis=0), rtol=1e-10, atol=1e-10)
        assert np.allclose(got[2][b], accs[b].sum(axis=0), rtol=1e-10, atol=1e-10)


def test_texts_are_cut_in_place_and_in_slices(spark, monkeypatch):
    """segments have no join by document, and a task few texts at once."""
    rows = [(k * 7 % 60, "ab\ncde\r\n"[:k % 9] + "x" * (k % 3)) for k in range(60)]
    c = Corpus(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), RnnConfig(seq_len=5))
    segs = S.corpus_segments(spark, c.lines, 5, piece=4, partitions=4, docs=c.texts).segments
    plan = segs._jdf.queryExecution().optimizedPlan().toString()
    assert "(pid" in plan and "(doc_id" not in plan
    whole = "".join(t.replace("\r", "").replace("\n", "") for _, t in sorted(rows))
    got = segs.collect()
    for r in got:
        assert r["text"] == whole[r["goff"]:r["goff"] + r["n_own"] + 5]
    assert sum(r["n_own"] for r in got) == len(whole)
    monkeypatch.setattr(S, "SLICE_CHARS", 10)
    batch = pa.record_batch([pa.array([4, 5, 6, 30, 1, 1])], names=["n"])
    assert [p.num_rows for p in S._slices(batch)] == [2, 1, 3]


def test_samples_of_several_epochs_read_the_corpus_once(spark, docs, monkeypatch):
    """F4, F14."""
    calls, real = [], train.sampled_windows
    monkeypatch.setattr(train, "sampled_windows", lambda c, w, r, s, epochs: calls.append(epochs) or real(c, w, r, s, epochs))
    cfg = RnnConfig(hidden=3, seq_len=4, epochs=5, init="sine")
    rows = train.fit_windows(Corpus(spark, docs, cfg), cfg, rate=0.05).metrics
    assert calls == [[0, 1, 2, 3], [4]] and len(rows) == 5


def test_smoothing_makes_its_steps_once(spark):
    """finding the ranges does not compute the losses a second time."""
    made = spark.sparkContext.accumulator(0)

    def loss(batches):
        for pdf in batches:
            made.add(len(pdf))
            yield pdf.assign(loss=1.0)
    steps = spark.range(200).withColumnRenamed("id", "start").mapInPandas(loss, "start bigint, loss double")
    assert S.smoothed(steps, ["start"], "loss", 1.0, partitions=4).count() == 200
    assert made.value == 200


def test_encoding_takes_slices_of_a_batch(spark, docs, monkeypatch):
    """ids are those of the texts, in Arrow lists, a slice of the batch at a time."""
    c = Corpus(spark, docs, RnnConfig())
    enc = C.encode_lines(spark, c.lines, c.vocab)
    assert "MapInArrow" in enc._jdf.queryExecution().optimizedPlan().toString()
    lines = {(r["doc_id"], r["line_no"]): r["line"] for r in c.lines.collect() if r["line"]}
    got = {(r["doc_id"], r["line_no"]): "".join(c.vocab.chars[i] for i in r["ids"]) for r in enc.collect()}
    assert got == lines
    ids, lens = C.encode_concat(["ab", "", "zé"], np.array([97, 233]))
    assert ids.tolist() == [0, -1, -1, 1] and lens.tolist() == [2, 0, 2]


@pytest.mark.parametrize("na,nb,vocab", [(4, 5, 60), (40, 30, 2000)])
@pytest.mark.parametrize("lim", [0.3, 40.0])
def test_clipped_sums_are_those_of_single_windows(na, nb, vocab, lim):
    """Round 4, F1: small and large windows' gradients, and small and large vocabularies."""
    rng = np.random.default_rng(na)
    a, b, x = rng.standard_normal((30, 25, na)), rng.standard_normal((30, 25, nb)), rng.integers(0, vocab, (30, 25))
    x[3] = 7
    want = sum(np.clip(a[w].T @ b[w], -lim, lim) for w in range(30))
    assert np.allclose(K.clipped_outer_sum(a, b, lim), want, rtol=1e-11, atol=1e-11)
    want = np.zeros((na, vocab))
    for w in range(30):
        own = np.zeros((vocab, na))
        np.add.at(own, x[w], a[w])
        want += np.clip(own.T, -lim, lim)
    assert np.allclose(K.clipped_onehot_sum(a, x, vocab, lim), want, rtol=1e-11, atol=1e-11)


def test_gradients_sort_no_characters_and_bound_no_rows(monkeypatch):
    """Round 4, F1: over few characters a window's own sums are made and clipped as they are."""
    p, w = _model("sine", hidden=4, vocab=90), np.random.default_rng(1).integers(0, 90, (300, 26)).astype(np.int32)
    shapes, real = [], K.clipped_outer_sum
    monkeypatch.setattr(K, "clipped_outer_sum", lambda a, b, lim: shapes.append((a.shape[2], b.shape[2])) or real(a, b, lim))
    monkeypatch.delattr(np, "unique")
    K.grad_sum(p, w[:, :-1], w[:, 1:], 1.0)
    assert shapes == [(4, 5)]


def test_logits_beyond_exponentials_have_gradients():
    """Round 4, F1: probabilities that are divided late are the same where logits are large."""
    p, w = _model("sine", hidden=4), _windows(40)
    p["bout"] += 900 * np.random.default_rng(2).standard_normal(p["bout"].shape)
    p["Wout"] *= 50
    losses, g = K.grad_sum(p, w[:, :-1], w[:, 1:], 1.0)
    hs, ys = K.forward(p, w[:, :-1])
    delta = K.softmax(ys[-1])
    assert np.allclose(losses, K.window_losses(ys[-1], w[:, 1:]), rtol=1e-12)
    np.subtract.at(delta, (np.arange(40)[:, None], np.arange(25), w[:, 1:]), 1.0)
    assert np.allclose(g["Wout"][0], sum(K.clip(d.T @ h, 1.0) for d, h in zip(delta, hs[-1])), rtol=1e-10, atol=1e-10)
    assert np.allclose(g["bout"][0], K.clip(delta.sum(axis=1), 1.0).sum(axis=0), rtol=1e-10, atol=1e-10)


def test_characters_are_counted_in_tasks(spark, docs, monkeypatch):
    """Round 4, F1, F2: no row for each character; line ends are no characters, null and empty texts have none."""
    from collections import Counter
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(9, None), (10, ""), (11, "é☃\U0001f600\r\na"), (12, "\r\r\n")]
    monkeypatch.setattr(C, "ENCODE_BYTES", 50)
    c = Corpus(spark, spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), RnnConfig())
    plan = c.vocab_df._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan
    want = Counter("".join(t for _, t in rows if t).replace("\r", "").replace("\n", ""))
    got = c.vocab_df.collect()
    assert sorted((r["id"], r["ch"], r["n"]) for r in got) == [(i, ch, want[ch]) for i, ch in enumerate(sorted(want))]
    assert Corpus.from_lines(spark, c.lines, RnnConfig()).vocab_df.collect() == got
    none = Corpus(spark, spark.createDataFrame([(1, None), (2, "\n")], "doc_id bigint, text string"), RnnConfig())
    assert none.vocab.size == 0


def test_ranges_are_found_from_texts_as_they_are(spark, docs, monkeypatch):
    """Round 4, F1, F2: lengths and heads are made after the texts are in order, not for finding the ranges."""
    plans, real = [], S.ordered
    monkeypatch.setattr(S, "ordered", lambda rows, *a: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()) or real(rows, *a))
    c = Corpus(spark, docs, RnnConfig(seq_len=5))
    found = S.corpus_segments(spark, c.lines, 5, piece=4, partitions=3, docs=c.texts)
    assert len(plans) == 1 and "length" not in plans[0] and "substring" not in plans[0]
    assert found.total_chars == sum(len(r["line"]) for r in c.lines.collect())


@pytest.mark.parametrize("layers", [1, 2])
@pytest.mark.parametrize("vocab,L,lim,scale", [(12, 25, 5.0, 0), (12, 25, 5.0, 2), (12, 25, 0.4, 2), (300, 5, 1.0, 1), (3, 7, 2.5, 3), (2, 1, 0.3, 2), (1, 4, 1.0, 0), (12, 25, 1e9, 1)])
def test_bias_gradients_are_those_of_built_windows(layers, vocab, L, lim, scale, monkeypatch):
    """Round 4, F2: rows of any length with more or fewer starts than windows, low and high counts clipped."""
    rng = np.random.default_rng(vocab + L)
    p = K.init_params(layers, 4, vocab, "zero")
    p["bout"][-1] = scale * rng.standard_normal(vocab)
    p["Wh"][:] = 0.3
    odds = 1 / np.arange(1, vocab + 1) ** 1.5
    lens, n_own = rng.integers(0, 4 * L + 3, 80), rng.integers(0, 3 * L + 1, 80)
    ids = rng.choice(vocab, size=lens.sum(), p=odds / odds.sum()).astype(np.int32)
    w = K.gather_windows(ids, lens, *K.window_starts(lens, n_own, L), L)
    losses, want = K.grad_sum(p, w[:, :-1], w[:, 1:], lim)
    assert K.bias_only(p) and not any(want[b].any() for b in ("Win", "Wh", "Wout", "bh"))
    for size in (1, 50, 1 << 17):
        monkeypatch.setattr(K, "COUNT_CHARS", size)
        loss, got, n = K.bias_grad_sum(p, ids, lens, n_own, L, lim)
        assert n == len(w) and np.isclose(loss, losses.sum(), rtol=1e-12)
        assert np.allclose(got, want["bout"][-1], rtol=1e-10, atol=1e-10)


def test_full_batch_of_a_bias_builds_no_windows(monkeypatch):
    """Round 4, F2: and other models still go through every window."""
    import types

    import pandas as pd
    cfg, text = RnnConfig(seq_len=5, clip=1.0), "abcabcaab bca cab"
    pdf = pd.DataFrame({"goff": [0, 9], "n_own": [9, 8], "text": [text[:14], text[9:]]})
    cps = np.array(sorted({ord(c) for c in text}))

    def sums(p):
        task = train._window_task(types.SimpleNamespace(value={"params": p, "codepoints": cps}), cfg)
        return np.concatenate([v for part in task(iter([pdf])) for v in part["v"]])
    near = K.init_params(1, 3, len(cps), "zero")
    near["Wout"][:] = 1e-300  # no bias only, but all the same
    assert not any(K.bias_only(_model(k)) for k in ("gaussian", "sine", "sine_static"))
    want = sums(near)
    monkeypatch.delattr(K, "gather_windows")
    assert np.allclose(sums(K.init_params(1, 3, len(cps), "zero")), want, rtol=1e-12, atol=1e-12)
    assert want[-1] == len(text) - 5
    with pytest.raises(AttributeError):
        sums(near)


def test_epochs_keep_no_text_in_memory(spark, docs, monkeypatch):
    """Round 4, F2: what all epochs read is on disk, so memory does not grow with the corpus."""
    from pyspark import StorageLevel
    cfg = RnnConfig(hidden=3, seq_len=4, epochs=2, init="zero")
    c = Corpus(spark, docs, cfg)
    kind, levels = type(c.corpus.segments), []
    real = kind.persist
    monkeypatch.setattr(kind, "persist", lambda self, *level: levels.append(level) or real(self, *level))
    assert len(train.fit_windows(c, cfg).metrics) == 2
    assert levels == [(StorageLevel.DISK_ONLY,)]
