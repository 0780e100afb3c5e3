import math

import numpy as np
import pytest

from charloom.config import RnnConfig
from charloom.corpus_context import Corpus
from charloom.functions import kernels as K
from charloom.plans.model import adagrad_update, arrays_to_table, model_table, table_to_arrays
from charloom.plans.train import fit_sequences, fit_windows
from tests.plain_model import Size, adagrad, chunk_bounds, clipped_gradient, train_locally


@pytest.fixture(scope="module")
def corpus(spark, docs):
    return Corpus(spark, docs, RnnConfig(hidden=6, seq_len=5, epochs=2, learn_rate=0.1, clip=0.7))


def _corpus_ids(corpus):
    rows = sorted((r["doc_id"], r["line_no"], r["line"]) for r in corpus.lines.collect() if r["line"])
    text = "".join(r[2] for r in rows)
    return np.array([corpus.vocab.chars.index(c) for c in text]), rows


@pytest.mark.parametrize("init", ["sine", "gaussian"])
def test_model_table_matches_numpy(spark, init):
    m = model_table(spark, 2, 4, 7, init, seed=3)
    p, a = table_to_arrays(m, 2, 4, 7)
    if init == "sine":
        exp = K.init_params(2, 4, 7, "sine")
        for b in K.BLOCKS:
            np.testing.assert_allclose(p[b], exp[b], atol=1e-15)
    else:
        assert np.all(p["bh"] == 0) and np.all(p["bout"] == 0) and 0 < np.abs(p["Win"]).std() < 0.05
    assert all(np.all(a[b] == 0) for b in K.BLOCKS)


def test_adagrad_table_update_matches_numpy(spark):
    p = K.init_params(1, 3, 4, "sine")
    a = {b: np.full_like(p[b], 0.5) for b in K.BLOCKS}
    g = {b: np.cos(np.arange(p[b].size)).reshape(p[b].shape) for b in K.BLOCKS}
    model = arrays_to_table(spark, p, a)
    grads = arrays_to_table(spark, g, a).withColumnRenamed("w", "g")
    got_p, got_a = table_to_arrays(adagrad_update(model, grads, 0.1), 1, 3, 4)
    K.adagrad(p, a, g, 0.1)
    for b in K.BLOCKS:
        np.testing.assert_allclose(got_p[b], p[b], rtol=1e-12)
        np.testing.assert_allclose(got_a[b], a[b], rtol=1e-12)


def _window_gradients(theta, size, windows, clip):
    parts = [clipped_gradient(theta, size, w, limit=clip) for w in windows]
    return sum(p[0] for p in parts), sum(p[1] for p in parts)


def _plain_start(corpus):
    size = Size(1, corpus.cfg.hidden, corpus.vocab.size)
    return size, K.flatten(K.init_params(*size, "sine"))


def test_full_batch_matches_plain_gradients(corpus):
    cfg = corpus.cfg.with_(init="sine", epochs=2)
    res = fit_windows(corpus, cfg)
    ids, _ = _corpus_ids(corpus)
    L, (size, theta) = cfg.seq_len, _plain_start(corpus)
    windows = [ids[s:s + L + 1] for s in range(len(ids) - L)]
    acc = np.zeros_like(theta)
    for e in range(2):
        total, slope = _window_gradients(theta, size, windows, cfg.clip)
        theta, acc = adagrad(theta, acc, slope / len(windows), cfg.learn_rate)
        assert res.metrics[e]["n"] == len(windows)
        assert math.isclose(res.metrics[e]["loss_per_char"], total / (len(windows) * L), rel_tol=1e-10)
    np.testing.assert_allclose(K.flatten(res.params), theta, rtol=1e-8, atol=1e-12)
    np.testing.assert_allclose(K.flatten(res.accs), acc, rtol=1e-8, atol=1e-12)


def test_empty_sample_epoch_is_skipped(corpus):
    res = fit_windows(corpus, corpus.cfg.with_(init="sine", epochs=1), rate=1e-9)
    assert res.metrics[0]["n"] == 0
    exp = K.init_params(1, corpus.cfg.hidden, corpus.vocab.size, "sine")
    for b in K.BLOCKS:
        np.testing.assert_array_equal(res.params[b], exp[b])


def _trained(corpus, cfg, texts, mode, theta=None, acc=None):
    size, start = _plain_start(corpus)
    theta = start if theta is None else theta
    acc = np.zeros_like(theta) if acc is None else acc
    parts = [train_locally(theta, acc, size, np.array([corpus.vocab.chars.index(c) for c in t]), cfg.seq_len,
                           cfg.learn_rate, cfg.clip, cfg.iters, mode) for t in texts]
    return sum(p[0] for p in parts), sum(p[1] for p in parts) / len(parts), sum(p[2] for p in parts) / len(parts)


def test_param_averaging_matches_fold(corpus):
    cfg = corpus.cfg.with_(init="sine", epochs=2, iters=2)
    res = fit_sequences(corpus, cfg, rate=1.0, unit="paragraph")
    texts = [line for _, _, line in _corpus_ids(corpus)[1]]
    chunks = sum(len(chunk_bounds(len(t), cfg.seq_len, "paragraph")) for t in texts)
    theta = acc = None
    smooth = cfg.seq_len * math.log(corpus.vocab.size)
    for m in res.metrics:
        total, theta, acc = _trained(corpus, cfg, texts, "paragraph", theta, acc)
        smooth = 0.999 * smooth + 0.001 * total / chunks
        assert m["n"] == len(texts) and math.isclose(m["loss"], total, rel_tol=1e-10)
        assert math.isclose(m["smooth_loss"], smooth, rel_tol=1e-12)
    np.testing.assert_allclose(K.flatten(res.params), theta, rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(K.flatten(res.accs), acc, rtol=1e-9, atol=1e-12)


def test_training_lowers_loss(corpus):
    cfg = corpus.cfg.with_(init="gaussian", epochs=12, learn_rate=0.3, clip=5.0)
    res = fit_windows(corpus, cfg)
    first, last = res.metrics[0]["loss_per_char"], res.metrics[-1]["loss_per_char"]
    assert abs(first - math.log(corpus.vocab.size)) < 0.05 and last < first - 0.2


def test_per_document_matches_fold(corpus):
    cfg = corpus.cfg.with_(init="sine", epochs=2, iters=1)
    res = fit_sequences(corpus, cfg, unit="document")
    docs = {}
    for d, _, line in _corpus_ids(corpus)[1]:
        docs[d] = docs.get(d, "") + line
    theta = acc = None
    for m in res.metrics:
        total, theta, acc = _trained(corpus, cfg, docs.values(), "tumbling", theta, acc)
        assert m["n"] == len(docs) == 4 and math.isclose(m["loss"], total, rel_tol=1e-10)
    np.testing.assert_allclose(K.flatten(res.params), theta, rtol=1e-9, atol=1e-12)


def test_training_result_sink(spark, corpus, tmp_path):
    res = fit_windows(corpus, corpus.cfg.with_(init="zero", epochs=1), rate=0.5)
    res.save(spark, str(tmp_path / "run"))
    assert spark.read.parquet(str(tmp_path / "run" / "metrics")).count() == 1
    assert spark.read.parquet(str(tmp_path / "run" / "model")).count() == K.n_params(1, corpus.cfg.hidden,
                                                                                   corpus.vocab.size)


def test_param_averaging_keep_tail_trains_every_whole_chunk(corpus):
    cfg = corpus.cfg.with_(init="sine", epochs=1, iters=1)
    res = fit_sequences(corpus, cfg, rate=1.0, unit="paragraph", keep_tail=True)
    total, _, _ = _trained(corpus, cfg, [line for _, _, line in _corpus_ids(corpus)[1]], "tumbling")
    assert math.isclose(res.metrics[0]["loss"], total, rel_tol=1e-10)


def test_rotating_sampler_reads_ranges_of_a_written_table(spark, corpus):
    from charloom.plans.train import rotating_sample, rotating_table
    table = rotating_table(corpus, "paragraph", 7)
    us = sorted(r["u"] for r in table.select("u").collect())
    rate = 0.4
    for epoch in range(3):
        lo = (-epoch * 0.6180339887498949) % 1.0
        exp = sum(1 for u in us if lo <= u < lo + rate or u < lo + rate - 1.0)
        df = rotating_sample(table, rate, epoch)
        assert df.count() == exp
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters" in plan and "GreaterThanOrEqual(u" in plan
    res = fit_sequences(corpus, corpus.cfg.with_(init="sine", epochs=2), rate=rate, sampler="rotating")
    assert [m["n"] for m in res.metrics] == [
        sum(1 for u in us if lo <= u < lo + rate or u < lo + rate - 1.0)
        for lo in ((-e * 0.6180339887498949) % 1.0 for e in range(2))]


def test_full_batch_on_line_windows_matches_plain_gradients(corpus):
    cfg = corpus.cfg.with_(init="sine", epochs=1)
    res = fit_windows(corpus, cfg, windows="line")
    L, (size, theta) = cfg.seq_len, _plain_start(corpus)
    lines = [[corpus.vocab.chars.index(c) for c in line] for _, _, line in _corpus_ids(corpus)[1]]
    windows = [np.array(ids[s:s + L + 1]) for ids in lines for s in range(len(ids) - L)]
    total, _ = _window_gradients(theta, size, windows, cfg.clip)
    assert res.metrics[0]["n"] == len(windows)
    assert math.isclose(res.metrics[0]["loss"], total, rel_tol=1e-10)
    sampled = fit_windows(corpus, cfg, rate=0.5, windows="line")
    assert 0 < sampled.metrics[0]["n"] < len(windows)


def test_training_refuses_unknown_characters_and_oversized_models(spark, corpus):
    other = Corpus(spark, spark.createDataFrame([(0, "abc ☃ def ghi")], "doc_id bigint, text string"), corpus.cfg)
    other.__dict__["vocab"] = corpus.vocab
    with pytest.raises(Exception, match="outside the vocabulary"):
        fit_windows(other, corpus.cfg.with_(init="zero", epochs=1))
    with pytest.raises(ValueError, match="model_bytes"):
        fit_windows(corpus, corpus.cfg.with_(model_bytes=1000))


def test_text_files_train_like_a_table(spark, tmp_path):
    """T1 and T3 from a text folder: line order and paragraphs as in the files."""
    from charloom.sources.text import read_text_lines
    texts = ["one line here\n\nand another of them", "the second file\nhas two lines"]
    for i, t in enumerate(texts):
        (tmp_path / f"{i}.txt").write_text(t + "\n", encoding="utf-8")
    cfg = RnnConfig(hidden=4, seq_len=5, epochs=2, init="sine", clip=0.7)
    table = Corpus(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), cfg)
    files = Corpus.from_lines(spark, read_text_lines(spark, str(tmp_path)), cfg)
    assert files.vocab.chars == table.vocab.chars
    for fit in (fit_windows, fit_sequences):
        a, b = fit(table, cfg), fit(files, cfg)
        for x, y in zip(a.metrics, b.metrics):
            assert {k: pytest.approx(v) for k, v in x.items()} == y
