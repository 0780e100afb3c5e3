"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are made per text in Arrow batches.  Distinct fingerprints are
compared exactly, in tiles: two that differ in at most ``radius`` bits agree in
at least one of ``radius + 1`` bit blocks, so for each block the fingerprints are
dealt into buckets by the block's value, and a bucket is one tile, or, if many
share a value, several tiles that all meet: groups of bounded size for many
tasks.  Where tiles meet, rows sorted by population count are cut into runs; a
pair of runs is skipped if its population counts lie further apart than the
radius, the others are compared with one exclusive-or and bit count.  No pair
list leaves a task, only each fingerprint's link to the smallest one it reaches
there.  (Without the blocks every tile would meet every other: quadratic.)

Results in the odd cases: null and word-less texts have fingerprint zero and
link like any other; rows with a null id have a fingerprint and the component
of their fingerprint; a component of null ids only has a null id; repeated rows
get one result row each; extra columns are neither read nor returned.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from charloom.llm.common import cut, row_key
from charloom.llm.components import components, spanning_links


@dataclass(frozen=True)
class SimHashRules:
    shingle: int = 3
    radius: int = 2
    seed: int = 42
    tile: int = 2048


_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz     ")
#: hashes whose bits are counted at a time, so that a long text takes bounded memory
_CHUNK = 1 << 16


def fingerprint(text: str | None, rules: SimHashRules) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes."""
    import xxhash
    words = [w for w in (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split(b" ") if w]
    if not words:
        return 0
    k, seed, hash64 = rules.shingle, rules.seed, xxhash.xxh64_intdigest
    n = max(1, len(words) - k + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        own = words[at:at + _CHUNK + k - 1]
        rows = zip(*[own[i:] for i in range(k)]) if len(words) >= k else [words]
        hashes = np.fromiter((hash64(x, seed) for x in map(b" ".join, rows)), np.uint64)
        counts += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, rules: SimHashRules = SimHashRules(), text: str = "text",
                 doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) and ``rk``, the key of the row's id and text."""
    def run(batches):
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), rules) for t in b.column(2)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "rk", "fp"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), row_key(docs[doc_id], docs[text]).alias("rk"),
                       F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, rk string, fp long")


def _blocks(rules: SimHashRules) -> list[tuple[int, int]]:
    """(shift, mask) of ``radius + 1`` blocks that cover the 64 bits."""
    cuts = [64 * i // (rules.radius + 1) for i in range(rules.radius + 2)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(cuts, cuts[1:])]


def _near(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with at most ``radius`` differing bits, a few rows at a time."""
    left, right = [], []
    step = max(1, (1 << 21) // max(1, len(b)))
    for at in range(0, len(a), step):
        i, j = np.nonzero(np.bitwise_count(a[at:at + step, None] ^ b[None, :]) <= radius)
        left.append(i + at)
        right.append(j)
    return np.concatenate(left), np.concatenate(right)


def fingerprint_links(fps: DataFrame, rules: SimHashRules = SimHashRules()) -> DataFrame:
    """Links ``u, v`` that join what ``radius`` bits join, from distinct ``fp``."""
    # block values are dealt into buckets of about a tile; one with many rows becomes several tiles
    buckets = max(1, fps.count() // (rules.tile // 2))
    spread = fps.select("fp", F.bit_count("fp").alias("pop"), F.posexplode(F.array(
        *[F.shiftrightunsigned("fp", s).bitwiseAND(F.lit(m)) for s, m in _blocks(rules)])).alias("block", "value"))
    spread = spread.select("block", F.pmod(F.xxhash64("block", "value"), F.lit(buckets)).alias("bucket"), "fp", "pop")
    sizes = spread.groupBy("block", "bucket").agg(F.ceil(F.count("*") / rules.tile).cast("int").alias("tiles"))
    sizes = sizes.select(F.col("block").alias("s_block"), F.col("bucket").alias("s_bucket"), "tiles")
    placed = spread.join(sizes, (F.col("block") == F.col("s_block")) & (F.col("bucket") == F.col("s_bucket")))
    met = (placed.withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
           .select("block", "bucket", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"),
                   "mine", "fp", "pop"))
    radius = rules.radius

    def compare(key, pdf):
        import pandas as pd
        _, _, lo, hi = key
        pdf = pdf.sort_values("pop", kind="stable")
        fp, pop, mine = (pdf[c].to_numpy() for c in ("fp", "pop", "mine"))
        bits, runs_a, runs_b = fp.view(np.uint64), [], []
        side_a = np.flatnonzero(mine == lo)
        side_b = side_a if lo == hi else np.flatnonzero(mine == hi)
        # runs of rows in order of population count; those further apart than the radius are skipped
        for at in range(0, len(side_a), 256):
            own = side_a[at:at + 256]
            first = np.searchsorted(pop[side_b], pop[own[0]] - radius, "left")
            last = np.searchsorted(pop[side_b], pop[own[-1]] + radius, "right")
            if first < last:
                i, j = _near(bits[own], bits[side_b[first:last]], radius)
                keep = own[i] != side_b[first + j]
                runs_a.append(own[i][keep])
                runs_b.append(side_b[first + j][keep])
        a = np.concatenate(runs_a) if runs_a else np.zeros(0, int)
        b = np.concatenate(runs_b) if runs_b else np.zeros(0, int)
        root = spanning_links(len(fp), a, b)
        out = np.flatnonzero(root != np.arange(len(fp)))
        return pd.DataFrame({"u": fp[out], "v": fp[root[out]]})

    return met.groupBy("block", "bucket", "lo", "hi").applyInPandas(compare, "u long, v long").distinct()


def simhash_components(docs: DataFrame, rules: SimHashRules = SimHashRules(), text: str = "text",
                       doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, rk, fingerprint`` (16 hex digits) and ``component_id`` per row."""
    prints = cut(fingerprints(docs, rules, text, doc_id))
    # copies of a text share the fingerprint: one row stands for all of them
    firsts = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(fingerprint_links(firsts.select("fp"), rules)).withColumnRenamed("node", "fp")
    member = firsts.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    lowest = member.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_fp = member.join(lowest, "root").select(F.col("fp").alias("c_fp"), "component_id")
    return prints.join(of_fp, F.col("fp") == F.col("c_fp")).select(
        "doc_id", "rk", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def apply_simhash(docs: DataFrame, rules: SimHashRules = SimHashRules(), text: str = "text",
                  doc_id: str = "doc_id") -> DataFrame:
    """One document of each component: that with the component's id (all columns).
    Repeated rows are one document and stay together; a component of null ids
    stays whole, as nothing names the one to keep."""
    drop = (simhash_components(docs, rules, text, doc_id)
            .filter("component_id is not null and not (doc_id <=> component_id)")
            .select(F.col("rk").alias("_s_drop")).distinct())
    return docs.join(drop, row_key(docs[doc_id], docs[text]) == F.col("_s_drop"), "left_anti")
