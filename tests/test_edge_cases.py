import math

import numpy as np
from pyspark.sql import functions as F

from charloom.config import RnnConfig
from charloom.corpus_context import Corpus
from charloom.operators import windows as W
from charloom.operators.scan import ranged_lines
from charloom.plans.train import fit_sequences, fit_windows
from charloom.sources.text import corpus_lines


def test_non_bmp_characters_flow_through(spark):
    docs = spark.createDataFrame([(0, "a\U0001F600b\U0001F600\nab")], "doc_id bigint, text string")
    c = Corpus(spark, docs, RnnConfig(hidden=3, seq_len=2, epochs=1, init="sine"))
    assert c.vocab.chars == ("a", "b", "\U0001F600")
    wins = sorted(r["win"] for r in W.corpus_sliding_windows(c.corpus.segments, 2).collect())
    text = "a\U0001F600b\U0001F600ab"
    assert wins == sorted(text[s:s + 3] for s in range(len(text) - 2))
    res = fit_windows(c)
    assert res.metrics[0]["n"] == len(text) - 2 and math.isfinite(res.metrics[0]["loss"])


def test_single_character_vocabulary(spark):
    docs = spark.createDataFrame([(0, "aaaaaa\naaaaaaaaa")], "doc_id bigint, text string")
    c = Corpus(spark, docs, RnnConfig(hidden=3, seq_len=3, epochs=2, init="gaussian"))
    assert c.vocab.size == 1
    res = fit_windows(c)
    assert abs(res.metrics[0]["loss"]) < 1e-9 and res.metrics[0]["n"] == 15 - 3
    res = fit_sequences(c, unit="paragraph")
    assert res.metrics[0]["n"] == 2


def test_hot_document_is_split_across_range_partitions(spark):
    rows = [(0, "\n".join("line %d of the big one" % i for i in range(3000)))] + \
           [(d, "small doc %d" % d) for d in range(1, 30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    ranged = ranged_lines(corpus_lines(docs), 8)
    sizes = [r["n"] for r in ranged.groupBy("pid").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 2.0 * (sum(sizes) / 8)


def test_training_does_not_depend_on_partitioning(spark, docs):
    cfg = RnnConfig(hidden=5, seq_len=4, epochs=2, init="sine", learn_rate=0.2, clip=0.5)
    out = []
    for parts in (1, 5):
        c = Corpus(spark, docs.repartition(parts), cfg, partitions=parts + 2)
        r1 = fit_windows(c, rate=0.7)
        r3 = fit_sequences(c, rate=0.8, unit="paragraph")
        out.append((r1, r3))
    for a, b in zip(out[0], out[1]):
        for ma, mb in zip(a.metrics, b.metrics):
            assert ma["n"] == mb["n"]
            assert math.isclose(ma["loss"], mb["loss"], rel_tol=1e-9)
        for blk in a.params:
            np.testing.assert_allclose(a.params[blk], b.params[blk], rtol=1e-9, atol=1e-12)
