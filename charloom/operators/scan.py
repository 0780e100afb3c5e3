"""Ordered scans over the corpus: positions, following characters, running values.

The corpus order is ``(doc_id, line_no)``; every character has a global position
(``goff``) and a position inside its document (``doff``).  Positions are prefix
sums over lengths, so only keys, lengths and the first ``halo`` characters of a
row are moved, never its text:

1. the small rows (keys, length, head) are range-partitioned on the order, which
   splits a document of any size, and checkpointed, so partitions stay as they are
   even if executors are lost;
2. each partition is summed up to one value, and the values are scanned as a tree:
   within blocks of about sqrt(P) partitions, over the blocks, then joined back.
   A scan works for any associative step (``exclusive``): sums, the characters that
   follow, or affine maps.  Nothing of size P reaches the driver;
3. a row's result is its partition's value put together with the rows before (or
   after) it in the partition.

Where text and positions must meet (windows), whole texts move once, into their
order, and are kept there (``text_segments``): a partition then needs no more than
its own start and the characters after its end.  Lines that come without their
texts are joined on the key: positions go to all tasks if they are small by count
(``BROADCAST_BYTES``), else the text moves, by key.  Windows that cross line, document and partition borders are then local
to a row: a segment's ``text`` holds its own characters and the next ``halo``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from charloom.session import ensure_checkpoint_dir
from charloom.sources.text import LINE_BREAK, LINE_ENDS

SEGMENT_SCHEMA = ("doc_id bigint, line_no bigint, piece int, n_line int, goff bigint, doff bigint, "
                  "n_own int, text string")
#: positions up to this size are sent to every task that reads text
BROADCAST_BYTES = 64 << 20
_SEG_COLS = ["doc_id", "line_no", "piece", "n_line", "goff", "doff", "n_own", "text"]
_SEG_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
#: characters of text that a task has as Python strings at once
SLICE_CHARS = 1 << 20


@dataclass
class CorpusSegments:
    """Segments plus corpus totals known on the driver."""

    segments: DataFrame   # SEGMENT_SCHEMA
    total_chars: int
    partitions: int


def default_partitions(spark: SparkSession, df: DataFrame | None = None) -> int:
    """Range partitions for the corpus scan: as many as the input has splits
    (which track its size, one per file split) and at least one per core."""
    p = spark.sparkContext.defaultParallelism
    if df is not None:
        p = max(p, df.rdd.getNumPartitions())
    return max(1, p)


def ordered(rows: DataFrame, order: list[str], partitions: int, then=None) -> DataFrame:
    """``rows`` range-partitioned in order, tagged with their partition (``pid``) and
    checkpointed to the shared checkpoint folder.  Ranges are found by reading the rows
    a first time; what is derived from a row (``then``) is made once, in its place."""
    ensure_checkpoint_dir(rows.sparkSession)
    placed = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order).withColumn("pid", F.spark_partition_id())
    return (placed if then is None else then(placed)).checkpoint(eager=True)


def exclusive(parts: DataFrame, partitions: int, zero: Column, step, ahead: bool = False) -> DataFrame:
    """``pid, value``: for every partition, ``step`` folded over the values of the
    partitions before it (``ahead``: of those after it, the farthest first).

    ``parts`` has one row ``pid, value`` per partition; ``step(done, value)`` is
    associative and starts from ``zero``.  A tree of two levels: no list is longer
    than about the square root of the number of partitions."""
    size = math.isqrt(partitions) + 1

    def towards(c: str) -> Column:
        return F.col(c).desc() if ahead else F.col(c).asc()

    def folded(values: Column) -> Column:
        return F.aggregate(values, zero, step)
    before = (Window.unboundedPreceding, -1)
    rows = parts.withColumn("block", F.floor(F.col("pid") / size))
    inner = rows.withColumn("inner", folded(F.collect_list("value").over(
        Window.partitionBy("block").orderBy(towards("pid")).rowsBetween(*before))))
    listed = F.sort_array(F.collect_list(F.struct("pid", "value")), asc=not ahead)
    totals = rows.groupBy("block").agg(folded(F.transform(listed, lambda x: x["value"])).alias("total"))
    outer = totals.select("block", folded(F.collect_list("total").over(
        Window.orderBy(towards("block")).rowsBetween(*before))).alias("outer"))
    return inner.join(outer, "block").select("pid", step(F.col("outer"), F.col("inner")).alias("value"))


def _plus(done: Column, value: Column) -> Column:
    return done + value


def ranged_lines(lines: DataFrame, partitions: int, halo: int = 0) -> DataFrame:
    """Keys, length and head of every line with a character, in corpus order."""
    return ordered(lines.where(F.length("line") > 0).select(
        "doc_id", "line_no", F.length("line").cast("bigint").alias("n"), F.substring("line", 1, halo).alias("head")),
        ["doc_id", "line_no"], partitions)


def positions(ranged: DataFrame, partitions: int, halo: int = 0) -> DataFrame:
    """``doc_id, line_no, n, goff, after`` of the rows of :func:`ranged_lines`: the
    characters before each, and the ``halo`` characters that follow it."""
    here = Window.partitionBy("pid").orderBy("doc_id", "line_no")
    zero = F.lit(0).cast("bigint")
    # every row has a character, so the next `halo` rows hold what follows
    ahead = F.array_join(F.collect_list("head").over(here.rowsBetween(1, max(1, halo))), "") if halo else F.lit("")
    inside = ranged.select(
        "pid", "doc_id", "line_no", "n", F.coalesce(F.sum("n").over(here.rowsBetween(Window.unboundedPreceding, -1)), zero).alias("before"),
        F.row_number().over(here).alias("at"), "head", F.substring(ahead, 1, halo).alias("ahead"))
    parts = inside.groupBy("pid").agg(F.sum("n").alias("n"), F.min_by(F.concat("head", "ahead"), "at").alias("front"))
    base = exclusive(parts.select("pid", F.col("n").alias("value")), partitions, zero, _plus).withColumnRenamed("value", "base")
    out = inside.join(base, "pid")
    if halo:
        def follows(done: Column, front: Column) -> Column:
            return F.substring(F.concat(front, done), 1, halo)
        rest = exclusive(parts.select("pid", F.substring("front", 1, halo).alias("value")), partitions, F.lit(""), follows, ahead=True)
        out = out.join(rest.withColumnRenamed("value", "rest"), "pid")
    after = F.substring(F.concat("ahead", "rest"), 1, halo) if halo else F.lit("")
    return out.select("doc_id", "line_no", "n", (F.col("base") + F.col("before")).alias("goff"), after.alias("after"))


def line_positions(lines: DataFrame, partitions: int | None = None) -> DataFrame:
    """O2: ``doc_id, line_no, goff, doff, n`` of every line with a character.  Keys and
    lengths are all that is moved; a document's start is its lines' smallest position."""
    p = partitions or default_partitions(lines.sparkSession, lines)
    found = positions(ranged_lines(lines, p), p)
    starts = found.groupBy("doc_id").agg(F.min("goff").alias("start"))
    return found.join(starts, "doc_id").select("doc_id", "line_no", "goff", (F.col("goff") - F.col("start")).alias("doff"), "n")


def _cut(rows, piece: int, halo: int) -> pa.RecordBatch:
    """Segments of rows ``(doc_id, line_no, lines, whole, goff, doff)``, ``whole`` being the
    text of the lines and the characters after it."""
    out = []
    for doc, first, lines, whole, goff, doff in rows:
        at = 0
        for no, line in enumerate(lines):
            n = len(line)
            for k in range(0, n, piece):
                own = min(piece, n - k)
                out.append((doc, first + no, k // piece, n, goff + at + k, doff + at + k, own, whole[at + k:at + k + own + halo]))
            at += n
    columns = zip(*out) if out else [()] * len(_SEG_COLS)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _SEG_TYPES)], names=_SEG_COLS)


def _slices(batch: pa.RecordBatch, n: str = "n"):
    """A batch in parts of about ``SLICE_CHARS`` characters, so that only so much text is in Python at once."""
    upto = np.cumsum(batch.column(n).to_numpy()) // SLICE_CHARS
    cuts = [0, *(np.flatnonzero(upto[1:] != upto[:-1]) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def _emit_segments(halo: int, piece: int):
    """Rows that come with the characters after them (``after``)."""
    def run(batches):
        for batch in batches:
            for part in _slices(batch):
                d = part.to_pydict()
                yield _cut(((doc, no, [line], line + after, goff, doff) for doc, no, line, goff, doff, after in zip(
                    d["doc_id"], d["line_no"], d["line"], d["goff"], d["doff"], d["after"])), piece, halo)
    return run


def _emit_text_segments(halo: int, piece: int):
    """Texts in corpus order, with their partition's number, start (``base``) and the
    characters after its end (``rest``): a text waits until those after it are known."""
    import re
    breaks = re.compile(LINE_BREAK)

    def known(held: list, tail: str, all_of: bool):
        """The held texts whose next ``halo`` characters are known, and the others."""
        done, wait = [], []
        for doc, no, lines, bare, goff in reversed(held):
            if all_of or len(tail) >= halo:
                done.append((doc, no, lines, bare + tail, goff, 0))
            else:
                wait.append((doc, no, lines, bare, goff))
            tail = (bare[:halo] + tail)[:halo]
        return done[::-1], wait[::-1]

    def run(batches):
        held, here, at, rest = [], None, 0, ""
        for batch in batches:
            for part in _slices(batch):
                d = part.to_pydict()
                for pid, doc, no, text, base, after in zip(d["pid"], d["doc_id"], d["line_no"], d["line"], d["base"], d["rest"]):
                    if pid != here:
                        if held:
                            yield _cut(known(held, rest, True)[0], piece, halo)
                        held, here, at, rest = [], pid, base, after
                    lines = breaks.split(text)
                    bare = "".join(lines)
                    held.append((doc, no, lines, bare, at))
                    at += len(bare)
                done, held = known(held, "", False)
                yield _cut(done, piece, halo)
        if held:
            yield _cut(known(held, rest, True)[0], piece, halo)
    return run


def _partition_ends(halo: int):
    """Of each partition of ordered rows: its characters, its first ``halo``, and whether
    two rows have one key (or a row none)."""
    def run(batches):
        found = {}
        for pdf in batches:
            for pid, own in pdf.groupby("pid"):
                n, front, twice, last = found.get(pid, (0, "", False, None))
                keys = own[["doc_id", "line_no"]]
                same = bool(keys.isna().any(axis=None) or keys.duplicated().any() or tuple(keys.iloc[0]) == last)
                for head in own["head"]:
                    if len(front) >= halo:
                        break
                    front = (front + head)[:halo]
                found[pid] = (n + int(own["n"].sum()), front, twice or same, tuple(keys.iloc[-1]))
        yield pd.DataFrame([(pid, n, front, twice) for pid, (n, front, twice, _) in found.items()], columns=["pid", "n", "front", "twice"])
    return run


def text_segments(spark: SparkSession, docs: DataFrame, halo: int, piece: int, partitions: int) -> CorpusSegments:
    """Segments of whole texts ``docs(doc_id, line)``.  The text is moved once, into its order,
    and kept there; every job then reads it in place, whatever the size of the table:
    a partition needs only its start and the characters after its end."""
    def measured(rows: DataFrame) -> DataFrame:
        bare = F.col("line")
        for c in LINE_ENDS:
            bare = F.replace(bare, F.lit(c), F.lit(""))
        rows = rows.select("pid", "doc_id", F.lit(0).cast("bigint").alias("line_no"), "line", bare.alias("bare"))
        rows = rows.select("pid", "doc_id", "line_no", "line", F.length("bare").cast("bigint").alias("n"), F.substring("bare", 1, halo).alias("head"))
        return rows.where(F.col("n") > 0)
    placed = ordered(docs.select("doc_id", "line"), ["doc_id"], partitions, measured)
    parts = placed.select("pid", "doc_id", "line_no", "n", "head").mapInPandas(
        _partition_ends(halo), "pid int, n bigint, front string, twice boolean").checkpoint(eager=True)
    sums = parts.agg(F.sum("n").alias("n"), F.max("twice").alias("twice")).first()
    if sums["twice"]:
        raise ValueError("two texts of the corpus have one key; their order is not defined")
    base = exclusive(parts.select("pid", F.col("n").alias("value")), partitions, F.lit(0).cast("bigint"), _plus).withColumnRenamed("value", "base")
    rest = exclusive(parts.select("pid", F.col("front").alias("value")), partitions, F.lit(""),
                     lambda done, front: F.substring(F.concat(front, done), 1, halo), ahead=True).withColumnRenamed("value", "rest")
    ends = base.join(rest, "pid").checkpoint(eager=True)  # a row for each partition
    whole = placed.select("pid", "doc_id", "line_no", "n", "line")
    if partitions * (64 + 4 * halo) <= BROADCAST_BYTES:
        whole = whole.join(F.broadcast(ends), "pid")
    else:  # the text moves again, by partition
        whole = whole.join(ends.hint("merge"), "pid").sortWithinPartitions("pid", "doc_id", "line_no")
    segs = whole.mapInArrow(_emit_text_segments(halo, piece), SEGMENT_SCHEMA)
    return CorpusSegments(segs, int(sums["n"] or 0), partitions)


def corpus_segments(spark: SparkSession, lines: DataFrame, halo: int, piece: int = 1024,
                    partitions: int | None = None, docs: DataFrame | None = None) -> CorpusSegments:
    """Segments of the whole corpus (see module doc).  ``halo`` is the number of
    characters a window needs beyond its start (``seq_len`` for windows of
    ``seq_len + 1``).  ``docs(doc_id, line)`` are the texts that the lines come
    from, where there are such: positions are then found per text, a row for each
    text instead of each line."""
    p = partitions or default_partitions(spark, lines)
    if docs is not None:
        return text_segments(spark, docs, halo, piece, p)
    rows = lines.select("doc_id", "line_no", "line")
    ranged = ranged_lines(rows, p, halo)
    sums = ranged.agg(F.sum("n").alias("n"), F.count("*").alias("rows"), F.countDistinct("doc_id", "line_no").alias("keys")).first()
    if sums["rows"] != sums["keys"]:
        raise ValueError("two texts of the corpus have one key; their order is not defined")
    found = positions(ranged, p, halo)
    starts = found.groupBy("doc_id").agg(F.min("goff").alias("start"))
    found = found.join(starts, "doc_id").withColumn("doff", F.col("goff") - F.col("start")).drop("start")
    # read again by every job: an epoch reads positions and texts, and moves neither sums nor heads
    found = found.checkpoint(eager=True)
    # a position's size is known: keys, sums and twice the halo; beyond the limit the text moves once, by key
    small = sums["rows"] * (64 + 4 * halo) <= BROADCAST_BYTES
    joined = rows.join(F.broadcast(found) if small else found.hint("merge"), ["doc_id", "line_no"])
    segs = joined.select("doc_id", "line_no", "n", "line", "goff", "doff", "after").mapInArrow(_emit_segments(halo, piece), SEGMENT_SCHEMA)
    return CorpusSegments(segs, int(sums["n"] or 0), p)


def line_offsets(segments: DataFrame) -> DataFrame:
    """``(doc_id, line_no, goff, doff, n)`` from the first piece of each line, where
    segments are at hand (a line's pieces never leave the task that emitted them)."""
    return (segments.where(F.col("piece") == 0)
            .select("doc_id", "line_no", "goff", "doff", F.col("n_line").cast("bigint").alias("n")))


# ---------------------------------------------------------------- running values
def smoothed(steps: DataFrame, order: list[str], loss: str, start: float, keep: float = 0.999,
             partitions: int | None = None) -> DataFrame:
    """A8 per step: ``smooth = keep * smooth + (1 - keep) * loss`` in ``order`` over a
    table of any size, from ``start``; all columns of ``steps`` and ``smooth``.

    A run of k steps is the affine map ``x -> keep**k * x + b``; maps of partitions
    are put together by :func:`exclusive`."""
    p = partitions or default_partitions(steps.sparkSession, steps)
    # ranges are found by a pass of their own: the steps are kept for it, not made twice
    kept = steps.persist(StorageLevel.DISK_ONLY)
    rows = ordered(kept, order, p)
    kept.unpersist()
    schema = T.StructType([*rows.schema.fields, T.StructField("_k", T.LongType()), T.StructField("_b", T.DoubleType())])

    def run(batches):
        b, k = 0.0, 0
        for pdf in batches:
            values = pdf[loss].to_numpy(dtype=float)
            out = np.empty(len(values))
            for i in range(len(values)):
                b = keep * b + (1.0 - keep) * values[i]
                out[i] = b
            yield pdf.assign(_k=np.arange(k + 1, k + len(values) + 1), _b=out)
            k += len(values)

    run_rows = rows.mapInPandas(run, schema)
    parts = run_rows.groupBy("pid").agg(F.max(F.struct("_k", "_b")).alias("last")).select("pid", F.struct(
        F.pow(F.lit(keep), F.col("last._k")).alias("a"), F.col("last._b").alias("b")).alias("value"))
    zero = F.struct(F.lit(1.0).alias("a"), F.lit(0.0).alias("b"))
    entry = exclusive(parts, p, zero, lambda done, x: F.struct((done["a"] * x["a"]).alias("a"), (done["b"] * x["a"] + x["b"]).alias("b")))
    value = F.pow(F.lit(keep), F.col("_k")) * (F.col("value.a") * F.lit(float(start)) + F.col("value.b")) + F.col("_b")
    return run_rows.join(entry, "pid").select(*steps.columns, value.alias("smooth"))
