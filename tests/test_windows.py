import random

import pytest
from pyspark.sql import functions as F

from charloom.operators import windows as W
from charloom.operators.scan import corpus_segments, line_offsets
from charloom.sources.text import corpus_lines


def _brute(lines_rows):
    rows = sorted((r["doc_id"], r["line_no"], r["line"]) for r in lines_rows if r["line"])
    text = "".join(r[2] for r in rows)
    offs, g, doc_pos = {}, 0, {}
    for d, ln, line in rows:
        offs[(d, ln)] = (g, doc_pos.get(d, 0))
        g += len(line)
        doc_pos[d] = doc_pos.get(d, 0) + len(line)
    return text, offs


@pytest.mark.parametrize("parts", [1, 3, 7, 40])
def test_offsets_and_corpus_windows_match_brute_force(spark, docs, parts):
    L = 5
    lines = corpus_lines(docs)
    text, offs = _brute(lines.collect())
    cs = corpus_segments(spark, lines, halo=L, piece=8, partitions=parts)
    assert cs.total_chars == len(text)
    got = {(r["doc_id"], r["line_no"]): (r["goff"], r["doff"]) for r in line_offsets(cs.segments).collect()}
    assert got == offs
    wins = sorted((r["start"], r["win"]) for r in W.corpus_sliding_windows(cs.segments, L).collect())
    assert wins == [(s, text[s:s + L + 1]) for s in range(len(text) - L)]
    tum = sorted((r["start"], r["win"]) for r in W.corpus_tumbling_windows(cs.segments, L).collect())
    assert tum == [(s, text[s:s + L + 1]) for s in range(0, len(text) - L, L)]
    assert len(tum) == (len(text) - 1) // L


def test_random_corpora_partition_invariance(spark):
    rnd = random.Random(5)
    rows = []
    for d in range(6):
        lines = ["".join(rnd.choice("ab c") for _ in range(rnd.choice([0, 1, 3, 4, 5, 6, 11, 30])))
                 for _ in range(rnd.randint(1, 6))]
        rows.append((d, "\n".join(lines)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    lines = corpus_lines(df)
    text, _ = _brute(lines.collect())
    L = 4
    for parts in (2, 5, 13):
        cs = corpus_segments(spark, lines, halo=L, piece=3, partitions=parts)
        wins = sorted((r["start"], r["win"]) for r in W.corpus_sliding_windows(cs.segments, L).collect())
        assert wins == [(s, text[s:s + L + 1]) for s in range(len(text) - L)]


@pytest.mark.parametrize("L", [3, 5])
def test_line_windows_and_paragraph_chunks(spark, L):
    lens = [0, 1, L, L + 1, L + 2, 2 * L + 1, 3 * L + 1, 50]
    rows = [(0, i, "".join(chr(97 + (k * 7 + i) % 26) for k in range(n))) for i, n in enumerate(lens)]
    df = spark.createDataFrame(rows, "doc_id bigint, line_no bigint, line string")
    sl = sorted((r["line_no"], r["start"], r["win"]) for r in W.line_sliding_windows(df, L).collect())
    exp = [(i, s, line[s:s + L + 1]) for _, i, line in rows for s in range(len(line) - L)]
    assert sl == sorted(exp)
    pc = sorted((r["line_no"], r["start"], r["win"]) for r in W.paragraph_windows(df, L).collect())
    exp = [(i, k * L, line[k * L:(k + 1) * L + 1]) for _, i, line in rows
           for k in range(max(0, -(-(len(line) - 1) // L) - 1))]
    assert pc == sorted(exp)
    counts = {r["line_no"]: r["c"] for r in df.select("line_no", W.paragraph_chunks(F.length("line"), L).alias("c")).collect()}
    assert counts == {i: len([e for e in exp if e[0] == i]) for _, i, _ in rows}


@pytest.mark.parametrize("L", [255, 256, 257, 515])
def test_windows_around_and_beyond_the_piece_length(spark, L):
    line = "".join(chr(97 + (k * k + k // 7) % 26) for k in range(2000))
    df = spark.createDataFrame([(0, 0, line)], "doc_id bigint, line_no bigint, line string")
    got = sorted((r["start"], r["win"]) for r in W.line_sliding_windows(df, L).collect())
    assert got == [(s, line[s:s + L + 1]) for s in range(2000 - L)]
    got = sorted((r["start"], r["win"]) for r in W.paragraph_windows(df, L).collect())
    assert got == [(k * L, line[k * L:(k + 1) * L + 1]) for k in range(-(-1999 // L) - 1)]
