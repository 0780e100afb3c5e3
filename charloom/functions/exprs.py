"""Spark column expressions used across the library.

Each expression that an oracle must reproduce has a DuckDB spelling in
``charloom.functions.sql`` and, where tasks need it, a NumPy twin in
``charloom.functions.kernels``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Values of the reproducible hash have so many bits.
HASH_BITS = 60
# Fixed constants of the hash: the two start words, and the mixer's multipliers and
# shifts.  Words have 32 bits and multipliers 31, so products fit 64 signed bits.
HASH_STARTS = (0x1E3779B9, 0x05EBCA6B)
HASH_MULTIPLIERS = (0x21F0AAAD, 0x735A2D97)
HASH_SHIFTS = (16, 15, 15)
WORD = 0xFFFFFFFF


def _bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _mixed(word: Column) -> Column:
    (a, b, c), (m, n) = HASH_SHIFTS, HASH_MULTIPLIERS
    return _bound(word, lambda x: _bound(
        (x.bitwiseXOR(F.shiftright(x, a)) * F.lit(m)).bitwiseAND(F.lit(WORD)), lambda y: _bound(
            (y.bitwiseXOR(F.shiftright(y, b)) * F.lit(n)).bitwiseAND(F.lit(WORD)), lambda z: z.bitwiseXOR(F.shiftright(z, c)))))


def unit_hash(seed: int, epoch, *keys) -> Column:
    """Deterministic hash in [0, 2**HASH_BITS) of (seed, epoch, keys...): two chains of
    32-bit words, each key's low and high word mixed in in turn.  ``epoch`` and
    ``keys`` are ints or columns."""
    words = []
    for v in (seed, epoch, *keys):
        v = v.cast("bigint") if isinstance(v, Column) else F.lit(int(v)).cast("bigint")
        words += [v.bitwiseAND(F.lit(WORD)), F.shiftright(v, 32).bitwiseAND(F.lit(WORD))]
    high, low = (F.aggregate(F.array(*words), F.lit(s).cast("bigint"), lambda h, w: _mixed(h.bitwiseXOR(w))) for s in HASH_STARTS)
    return F.shiftleft(high, HASH_BITS - 32) + F.shiftright(low, 64 - HASH_BITS)


def keep_threshold(rate: float) -> int:
    """Rows whose hash is below this value are kept (rate 1 keeps all)."""
    return max(0, min(1 << HASH_BITS, int(rate * (1 << HASH_BITS))))


def bernoulli_keep(rate: float, seed: int, epoch, *keys) -> Column:
    return unit_hash(seed, epoch, *keys) < F.lit(keep_threshold(rate))


def unit_uniform(seed: int, epoch, *keys) -> Column:
    """Reproducible uniform draw in [0, 1): the hash's 53 highest bits."""
    return F.shiftright(unit_hash(seed, epoch, *keys), HASH_BITS - 53).cast("double") / F.lit(float(1 << 53))


def clip_col(g: Column, lim: float) -> Column:
    """Element-wise clip to [-lim, lim] that lets NaN through.

    Spark orders NaN above every number, so a bare ``least/greatest`` or a
    ``g > lim`` test would turn NaN into ``lim``; NaN is tested first.
    """
    return (F.when(F.isnan(g), g)
            .when(g > F.lit(lim), F.lit(lim))
            .when(g < F.lit(-lim), F.lit(-lim))
            .otherwise(g))


def md5_int(s: Column) -> Column:
    """First 32 bits of md5(s) as a bigint: a content checksum DuckDB can repeat."""
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def sine_weight(block_no: Column, i: Column, j: Column, layer: Column) -> Column:
    """Closed-form initial weight used by the SQL-checkable models."""
    k = layer * F.lit(5) + block_no
    return F.lit(0.1) * F.sin(k.cast("double") + F.lit(0.7) * i + F.lit(1.3) * j)
