"""Training windows over characters.

A window of ``seq_len + 1`` characters holds ``seq_len`` inputs and the same
characters shifted by one as targets.  Four layouts:

* W1 corpus sliding   -- stride 1 over the whole corpus, across line borders;
* W2 line sliding     -- stride 1 inside each line;
* W3 corpus tumbling  -- stride ``seq_len`` over the corpus, neighbours share a char;
* W4 paragraph chunks -- stride ``seq_len`` inside a line; the last full chunk is
  dropped when ``n - 1`` is a multiple of ``seq_len`` and lines of at most
  ``seq_len + 1`` characters get none (the original per-paragraph loop).

All windows are generated per bounded piece of text: a row never holds more
than ``piece + halo`` characters, so a huge line or document cannot blow up one
row, and the substring work per window is O(seq_len).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from charloom.functions import kernels as K

WINDOW_PIECE = 256


def paragraph_chunks(n: Column, seq_len: int) -> Column:
    """Number of steps the per-paragraph loop takes on a line of ``n`` chars."""
    return F.greatest(F.lit(0), F.ceil((n - 1) / F.lit(seq_len)) - 1).cast("int")


def line_pieces(df: DataFrame, halo: int, piece: int = WINDOW_PIECE, text_col: str = "line",
                keep=("doc_id", "line_no")) -> DataFrame:
    """Cut each text into pieces (one linear regex pass) and append the next
    ``halo`` characters of the same text to each.  A piece has at most ``piece``
    characters, or ``halo`` if that is more, so the halo lies in one piece."""
    piece = max(piece, halo)
    parts = F.regexp_extract_all(F.col(text_col), F.lit(f"(?s).{{1,{piece}}}"), 0)
    # zipped with the pieces from the second on: the parts are computed twice, not per element
    with_halo = F.zip_with(parts, F.slice(parts, 2, F.greatest(F.lit(1), F.size(parts))), lambda p, after: F.struct(
        F.length(p).alias("n_own"),
        F.concat(p, F.coalesce(F.substring(after, 1, halo), F.lit(""))).alias("text")))
    return (df.select(*keep, F.length(text_col).alias("n_line"),
                      F.posexplode(with_halo).alias("piece", "pc"))
            .select(*keep, "n_line", "piece", (F.col("piece") * piece).alias("offset"),
                    "pc.n_own", "pc.text"))


def piece_starts(seq_len: int, stride: int = 1, origin: Column | None = None, limit: Column | None = None) -> Column:
    """Starts, inside a piece, of its whole windows (see ``window_rows``)."""
    origin = origin if origin is not None else F.lit(0)
    first = F.lit(0) if stride == 1 else F.pmod(-origin, F.lit(stride)).cast("int")
    # whole windows only: the last start leaves seq_len more characters in the piece
    last = F.least(F.col("n_own") - 1, F.length("text") - F.lit(seq_len + 1))
    if limit is not None:
        last = F.least(last, limit - origin - 1)
    last = last.cast("int")
    return F.when(last >= first, F.sequence(first, last, F.lit(stride))).otherwise(F.array().cast("array<int>"))


def window_rows(pieces: DataFrame, seq_len: int, stride: int = 1, origin: Column | None = None,
                limit: Column | None = None, keep=("doc_id", "line_no")) -> DataFrame:
    """Explode whole windows of ``seq_len + 1`` chars starting in each piece.

    ``origin`` is the position of the piece's first char in the frame the
    stride is aligned to (starts satisfy ``(origin + s) % stride == 0``);
    ``limit`` optionally bounds starts to ``origin + s < limit``.
    """
    origin = origin if origin is not None else F.lit(0)
    starts = piece_starts(seq_len, stride, origin, limit)
    # explode + substring stays inside whole-stage codegen; pieces are at most
    # piece + halo characters, so the UTF-8 scan of substring is bounded
    rows = pieces.select(*keep, origin.alias("_origin"), "text", F.explode(starts).alias("_s"))
    return rows.select(*keep, (F.col("_origin") + F.col("_s")).alias("start"),
                       F.substring(F.col("text"), F.col("_s") + 1, F.lit(seq_len + 1)).alias("win"))


def sampled_window_rows(pieces: DataFrame, seq_len: int, origin: str, sample, keys=(), keep=("doc_id", "line_no")) -> DataFrame:
    """``sample=(rate, seed, epochs)`` keeps, per epoch, a Bernoulli sample of the
    whole stride-1 windows (adds an ``epoch`` column).  Starts are drawn by gaps
    (``kernels.sampled_places``) along the position ``origin`` of the sequence that
    ``keys`` name, and only sampled windows are cut: the work beside reading the
    pieces follows the sample, not the number of starts."""
    rate, seed, epochs = sample
    schema = ", ".join(f"{c} bigint" for c in keep) + ", epoch bigint, start bigint, win string"

    def run(batches):
        for pdf in batches:
            texts = pdf["text"].tolist()
            lens = np.fromiter(map(len, texts), np.int64, len(texts))
            whole = np.maximum(0, np.minimum(pdf["n_own"].to_numpy(dtype=np.int64), lens - seq_len))
            first = pdf[origin].to_numpy(dtype=np.int64)
            named = [pdf[k].to_numpy(dtype=np.int64) for k in keys]
            for epoch in epochs:
                if rate >= 1.0:
                    rows, places = K.window_starts(lens, pdf["n_own"].to_numpy(), seq_len)
                elif rate > 0.0:
                    rows, places = K.sampled_places(rate, seed, epoch, first, whole, *named)
                else:
                    continue
                out = {c: pdf[c].to_numpy()[rows] for c in keep}
                yield pd.DataFrame(out | {"epoch": epoch, "start": first[rows] + places, "win": pd.Series(
                    [texts[r][p:p + seq_len + 1] for r, p in zip(rows, places)], dtype=object)})

    return pieces.select(*dict.fromkeys((*keep, *keys, origin, "n_own", "text"))).mapInPandas(run, schema)


def line_sliding_windows(lines: DataFrame, seq_len: int, sample=None) -> DataFrame:
    """``(doc_id, line_no, start, window)``, start = position in the line."""
    pieces = line_pieces(lines.where(F.length("line") > seq_len), halo=seq_len)
    if sample is not None:
        return sampled_window_rows(pieces, seq_len, "offset", sample, keys=("doc_id", "line_no"))
    return window_rows(pieces, seq_len, 1, origin=F.col("offset"))


def paragraph_windows(lines: DataFrame, seq_len: int) -> DataFrame:
    """The chunks the per-paragraph trainer steps through."""
    long_lines = lines.where(paragraph_chunks(F.length("line"), seq_len) > 0)
    pieces = line_pieces(long_lines, halo=seq_len)
    limit = paragraph_chunks(F.col("n_line"), seq_len) * F.lit(seq_len)
    return window_rows(pieces, seq_len, seq_len, origin=F.col("offset"), limit=limit)


def corpus_sliding_windows(segments: DataFrame, seq_len: int, sample=None) -> DataFrame:
    """W1 from corpus segments: ``(doc_id, line_no, start, window)``,
    start = global corpus position.  N - seq_len windows in total."""
    if sample is not None:
        return sampled_window_rows(segments, seq_len, "goff", sample)
    return window_rows(segments, seq_len, 1, origin=F.col("goff"))


def corpus_tumbling_windows(segments: DataFrame, seq_len: int) -> DataFrame:
    """Stride ``seq_len`` from corpus position 0; floor((N-1)/seq_len) windows."""
    return window_rows(segments, seq_len, seq_len, origin=F.col("goff"))
