"""Tokens, vocabulary and id codes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: text that an encoding task has as Python strings at once
ENCODE_BYTES = 1 << 20


def nonempty_lines(lines: DataFrame) -> DataFrame:
    """Blank lines carry no characters and are not paragraphs."""
    return lines.where(F.col("line") != "")


def char_tokens(lines: DataFrame) -> DataFrame:
    """One row per character: ``(doc_id, line_no, pos, ch)``.

    ``split(line, '')`` of an empty string yields one empty token, so blank
    lines are removed first.
    """
    return (nonempty_lines(lines)
            .select("doc_id", "line_no", F.posexplode(F.split("line", "", -1)).alias("pos", "ch")))


def word_tokens(lines: DataFrame, keep_empty: bool = True) -> DataFrame:
    """One row per word, split on single spaces as a JVM ``split(" ")`` does:
    trailing empty tokens are dropped, leading and inner ones kept; an empty line
    gives one empty token and a line of only spaces gives none.  With
    ``keep_empty=False`` empty tokens are dropped as well (positions keep their
    place in the split)."""
    stripped = F.rtrim(F.col("line"), F.lit(" "))
    words = (F.when((F.col("line") != "") & (stripped == ""), F.array().cast("array<string>"))
             .otherwise(F.split(stripped, " ", -1)))
    out = lines.select("doc_id", "line_no", F.posexplode(words).alias("pos", "word"))
    return out if keep_empty else out.where(F.col("word") != "")


def _text_slices(column: pa.Array):
    """Texts of an Arrow column as lists of about ``ENCODE_BYTES``, so that only so much is in Python at once."""
    sizes = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False)) // ENCODE_BYTES
    cuts = [0, *(np.flatnonzero(sizes[1:] != sizes[:-1]) + 1).tolist(), len(column)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield column.slice(a, b - a).to_pylist()


def _count_chars(without: str):
    def run(batches):
        found = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for texts in _text_slices(batch.column(0).drop_null().cast(pa.binary())):
                cps = b"".join(texts).decode("utf-8", "replace").encode("utf-32-le")
                counts = np.bincount(np.frombuffer(cps, dtype="<u4"))
                short, long = sorted((found, counts), key=len)
                found = long
                found[:len(short)] += short
        found[[ord(c) for c in without if ord(c) < len(found)]] = 0
        seen = np.flatnonzero(found)
        yield pa.record_batch([pa.array([chr(c) for c in seen], pa.string()), pa.array(found[seen], pa.int64())], names=["ch", "n"])
    return run


def vocab_table(lines: DataFrame, without: str = "") -> DataFrame:
    """``(ch, id, n)``: distinct characters of ``lines.line`` numbered 0..V-1 in
    code-point order, but for those in ``without``.

    A task counts its own characters and has one row for each, so a very frequent
    character (space) costs one row per task.  The numbering window runs over the
    V distinct characters only.
    """
    counts = lines.select("line").mapInArrow(_count_chars(without), "ch string, n bigint").groupBy("ch").agg(F.sum("n").alias("n"))
    return counts.select("ch", (F.row_number().over(Window.orderBy("ch")) - 1).cast("int").alias("id"), "n")


@dataclass(frozen=True)
class Vocab:
    """Driver copy of the vocabulary: one entry per distinct character, so bounded
    by Unicode's 1,114,112 code points whatever the corpus; it may be broadcast."""

    chars: tuple
    counts: tuple

    @property
    def size(self) -> int:
        return len(self.chars)

    @property
    def codepoints(self) -> np.ndarray:
        return np.array([ord(c) for c in self.chars], dtype=np.int64)

    def to_df(self, spark: SparkSession) -> DataFrame:
        rows = [(c, i, int(n)) for i, (c, n) in enumerate(zip(self.chars, self.counts))]
        return spark.createDataFrame(rows, "ch string, id int, n bigint")


def collect_vocab(vocab_df: DataFrame) -> Vocab:
    """One job over the counted characters."""
    rows = sorted(vocab_df.collect(), key=lambda r: r["id"])
    return Vocab(tuple(r["ch"] for r in rows), tuple(int(r["n"]) for r in rows))


def encode_concat(texts, codepoints: np.ndarray):
    """NumPy helper: strings -> (all ids concatenated as int32, lengths);
    characters outside the vocabulary become -1 (no kernel takes that id)."""
    if not len(codepoints):
        lens = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        return np.full(int(lens.sum()), -1, np.int32), lens
    table = np.full(int(codepoints[-1]) + 2, -1, np.int32)  # the last entry is no character's
    table[codepoints] = np.arange(len(codepoints), dtype=np.int32)
    cps = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
    ids = table[np.minimum(cps, np.uint32(len(table) - 1))]
    lens = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    return ids, lens


def encode_text(texts, codepoints: np.ndarray) -> list:
    """NumPy helper: list of strings -> list of int32 id arrays (unknown -> -1)."""
    ids, lens = encode_concat(texts, codepoints)
    return np.split(ids, np.cumsum(lens)[:-1]) if len(texts) else []


def encode_known(texts, codepoints: np.ndarray):
    """Id arrays without the characters outside the vocabulary, and how many
    each text had: scoring skips them, and says so."""
    seqs = encode_text(texts, codepoints)
    known = [s[s >= 0] for s in seqs]
    return known, np.array([len(s) - len(k) for s, k in zip(seqs, known)], dtype=np.int64)


def windows_ids(texts, codepoints: np.ndarray):
    """:func:`encode_concat` for training, where every character must be known."""
    ids, lens = encode_concat(texts, codepoints)
    if len(ids) and ids.min() < 0:
        raise ValueError("a training window holds a character outside the vocabulary")
    return ids, lens


def encode_lines(spark: SparkSession, lines: DataFrame, vocab: Vocab) -> DataFrame:
    """``encoded(doc_id, line_no, ids)`` for every non-empty line, with the vocabulary
    broadcast once; characters outside the vocabulary have id -1.  A task has about
    ``ENCODE_BYTES`` of text in Python at once, whatever the size of its Arrow batches."""
    bc = spark.sparkContext.broadcast(vocab.codepoints)

    def run(batches):
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column("line").cast(pa.string())).to_numpy(zero_copy_only=False)) // ENCODE_BYTES
            cuts = [0, *(np.flatnonzero(sizes[1:] != sizes[:-1]) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    part = batch.slice(a, b - a)
                    ids, lens = encode_concat(part.column("line").to_pylist(), bc.value)
                    ends = np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)
                    yield pa.record_batch([part.column("doc_id"), part.column("line_no"), pa.ListArray.from_arrays(ends, ids)],
                                          names=["doc_id", "line_no", "ids"])

    rows = nonempty_lines(lines).select("doc_id", "line_no", "line")
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:2], T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decoder_udf(spark: SparkSession, vocab: Vocab):
    """Vectorised decoder ``array<int> -> string``, the encoder's inverse; ids that
    are no character's (such as -1) become U+FFFD."""
    bc = spark.sparkContext.broadcast(np.array([*vocab.chars, "\ufffd"], dtype=object))

    @F.pandas_udf(T.StringType())
    def decode(s: pd.Series) -> pd.Series:
        chars = bc.value
        def one(ids):
            ids = np.asarray(ids, dtype=np.int64)
            return "".join(chars[np.where((ids < 0) | (ids >= len(chars) - 1), len(chars) - 1, ids)])
        return s.map(one, na_action="ignore")

    return decode


def one_hot(idx: F.Column, size: int) -> F.Column:
    """Dense one-hot ``array<double>`` of length ``size``."""
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)),
                       lambda k: F.when(k == idx, F.lit(1.0)).otherwise(F.lit(0.0)))
