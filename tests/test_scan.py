"""Scans over partitions, sampling by gaps, durable epochs, reading of split files."""

import gzip
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from charloom.config import RnnConfig
from charloom.corpus_context import Corpus
from charloom.functions import kernels as K
from charloom.functions.sql import gap_sample_ctes
from charloom.operators import scan as S
from charloom.operators import windows as W
from charloom.plans.train import EpochStore, fit_sequences, fit_windows, training_states
from charloom.sources.text import read_text_lines


@pytest.mark.parametrize("n", [1, 2, 7, 30])
def test_exclusive_folds_before_and_after(spark, n):
    parts = spark.createDataFrame([(i, chr(97 + i % 26)) for i in range(n)], "pid int, value string")
    word = "".join(chr(97 + i % 26) for i in range(n))
    before = S.exclusive(parts, n, F.lit(""), lambda d, x: F.concat(d, x)).collect()
    assert {r["pid"]: r["value"] for r in before} == {i: word[:i] for i in range(n)}
    after = S.exclusive(parts, n, F.lit(""), lambda d, x: F.substring(F.concat(x, d), 1, 4), ahead=True).collect()
    assert {r["pid"]: r["value"] for r in after} == {i: word[i + 1:i + 5] for i in range(n)}


@pytest.mark.parametrize("parts", [1, 4, 11])
def test_smoothed_is_the_running_average(spark, parts):
    rnd = random.Random(parts)
    rows = [(i, rnd.random() * 100) for i in range(500)]
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "step bigint, loss double")
    got = {r["step"]: r["smooth"] for r in S.smoothed(df, ["step"], "loss", 7.0, keep=0.9, partitions=parts).collect()}
    x = 7.0
    for step, loss in rows:
        x = 0.9 * x + 0.1 * loss
        assert math.isclose(got[step], x, rel_tol=1e-12)
    assert S.smoothed(df.limit(0), ["step"], "loss", 7.0).count() == 0


def test_positions_by_text_and_by_line_agree(spark, docs):
    c = Corpus(spark, docs, RnnConfig(seq_len=5))
    cols = ["doc_id", "line_no", "piece", "n_line", "goff", "doff", "n_own", "text"]
    by_text = S.corpus_segments(spark, c.lines, 5, piece=8, partitions=3, docs=c.texts)
    by_line = S.corpus_segments(spark, c.lines, 5, piece=8, partitions=3)
    a, b = (sorted(map(tuple, x.segments.select(cols).collect())) for x in (by_text, by_line))
    assert a == b and by_text.total_chars == by_line.total_chars
    offsets = sorted(map(tuple, S.line_positions(c.lines, 4).select("doc_id", "line_no", "goff", "doff", "n").collect()))
    assert offsets == sorted(map(tuple, S.line_offsets(by_line.segments).collect()))


def test_large_positions_join_by_key(spark, docs, monkeypatch):
    c = Corpus(spark, docs, RnnConfig(seq_len=5))
    want = sorted(map(tuple, S.corpus_segments(spark, c.lines, 5, docs=c.texts).segments.collect()))
    monkeypatch.setattr(S, "BROADCAST_BYTES", 0)
    far = S.corpus_segments(spark, c.lines, 5, docs=c.texts).segments
    assert sorted(map(tuple, far.collect())) == want
    assert "BroadcastHashJoin" not in far._jdf.queryExecution().executedPlan().toString()


def test_two_texts_of_one_key_are_refused(spark):
    df = spark.createDataFrame([(1, "abc"), (1, "abd")], "doc_id bigint, text string")
    with pytest.raises(ValueError, match="one key"):
        Corpus(spark, df, RnnConfig(seq_len=2)).corpus


def test_no_text_is_moved_for_positions(spark, docs):
    plan = S.line_positions(Corpus(spark, docs).lines)._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in plan and "line#" not in plan


@pytest.mark.parametrize("rate", [0.0003, 0.02, 0.7])
def test_gap_sample_is_bernoulli_and_equals_sql(rate):
    n = 60_000
    row, place = K.sampled_places(rate, 7, 0, np.array([0, 20_000, 20_001]), np.array([20_000, 1, n - 20_001]))
    got = np.sort(np.array([0, 20_000, 20_001])[row] + place)
    ctes = ", ".join(gap_sample_ctes("picked", rate, 7, 1, str(n)))
    want = [r[0] for r in duckdb.sql(f"WITH RECURSIVE {ctes} SELECT pos FROM picked ORDER BY 1").fetchall()]
    assert got.tolist() == want
    assert abs(len(got) - rate * n) < 5 * math.sqrt(rate * n) + 1
    if rate > 0.01:  # gaps of one come as often as they should
        assert abs((np.diff(got) == 1).mean() - rate) < 5 * math.sqrt(rate / len(got))
    other = K.sampled_places(rate, 7, 1, np.array([0]), np.array([n]))[1]
    assert not np.array_equal(other, got)


def test_sampled_windows_do_not_depend_on_pieces(spark, docs):
    c = Corpus(spark, docs, RnnConfig(seq_len=4))
    out = []
    for piece, parts in ((3, 5), (64, 1)):
        segs = S.corpus_segments(spark, c.lines, 4, piece=piece, partitions=parts).segments
        out.append(sorted((r["epoch"], r["start"], r["win"]) for r in W.corpus_sliding_windows(segs, 4, (0.3, 5, [0, 1])).collect()))
    assert out[0] == out[1] and out[0]
    lines = W.line_sliding_windows(c.lines, 4, (0.3, 5, [0])).collect()
    assert 0 < len(lines) and all(len(r["win"]) == 5 for r in lines)
    assert W.line_sliding_windows(c.lines, 4, (1.0, 5, [0])).count() == W.line_sliding_windows(c.lines, 4).count()
    assert W.line_sliding_windows(c.lines, 4, (0.0, 5, [0])).count() == 0


@pytest.mark.parametrize("fit", [fit_windows, fit_sequences])
def test_training_goes_on_after_a_stop(spark, docs, tmp_path, fit):
    cfg = RnnConfig(hidden=3, seq_len=4, epochs=3, init="sine")
    c, path = Corpus(spark, docs, cfg), str(tmp_path / "run")
    whole = fit(c, cfg, rate=0.6)

    def lost(epoch, params):
        if epoch == 1:
            raise KeyboardInterrupt
    with pytest.raises(KeyboardInterrupt):
        fit(c, cfg, rate=0.6, on_epoch=lost, store=path)
    assert sorted(r["epoch"] for r in EpochStore(spark, path, "").metrics().collect()) == [0, 1]
    # an epoch whose model was written, but not its metrics, is not complete
    spark.range(1).write.parquet(f"{path}/model/2")
    seen = []
    again = fit(c, cfg, rate=0.6, on_epoch=lambda e, p: seen.append(e), store=path)
    assert seen == [2] and [m["epoch"] for m in again.metrics] == [0, 1, 2]
    for a, b in zip(whole.metrics, again.metrics):
        assert {k: pytest.approx(v, rel=1e-9) for k, v in a.items()} == b
    with pytest.raises(ValueError, match="other settings"):
        fit(c, cfg.with_(learn_rate=0.3), rate=0.6, store=path)


def test_states_are_those_of_the_sequences(spark, docs):
    cfg = RnnConfig(hidden=3, seq_len=4, epochs=1, init="sine", num_layers=2)
    c = Corpus(spark, docs, cfg)
    params = K.init_params(2, 3, c.vocab.size, "sine")
    accs = K.zeros(2, 3, c.vocab.size)
    rows = training_states(c, cfg, params, accs, 1.0, "document", 0, "tumbling").collect()
    texts = {r["doc_id"]: r["text"].replace("\r\n", "").replace("\n", "") for r in docs.collect()}
    assert {r["doc_id"] for r in rows} == {d for d, t in texts.items() if t}
    for r in rows:
        text = texts[r["doc_id"]]
        at = (len(text) - 1) // 4 * 4
        assert r["seed_ch"] == text[at] and len(r["h0"]) == 6
        assert (np.abs(r["h0"]).sum() > 0) == (at > 0)


def test_split_and_compressed_files_keep_their_order(spark, tmp_path):
    lines = [f"{i} " + "x" * (i % 97) for i in range(9000)]
    (tmp_path / "b.txt").write_text("\n".join(lines) + "\n", encoding="utf-8")
    with gzip.open(tmp_path / "a.txt.gz", "wt") as f:
        f.write("\n".join(lines[:500]) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        read = read_text_lines(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 5
        rows = read.orderBy("doc_id", "line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r["line"] for r in rows] == lines[:500] + lines
    assert [r["doc_id"] for r in rows] == [0] * 500 + [1] * 9000
