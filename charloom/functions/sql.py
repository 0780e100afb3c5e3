"""DuckDB spellings of the expressions in ``exprs`` (used by the oracles)."""

from __future__ import annotations

import math

from charloom.functions.exprs import HASH_BITS, HASH_MULTIPLIERS, HASH_SHIFTS, HASH_STARTS, WORD, keep_threshold
from charloom.functions.kernels import GAP_BLOCK


def _mixed_sql(word: str) -> str:
    (a, b, c), (m, n) = HASH_SHIFTS, HASH_MULTIPLIERS
    return (f"list_transform([{word}], lambda x: list_transform([(xor(x, x >> {a}) * {m}) & {WORD}], lambda y: "
            f"list_transform([(xor(y, y >> {b}) * {n}) & {WORD}], lambda z: xor(z, z >> {c}))[1])[1])[1]")


def unit_hash_sql(seed: int, epoch, *keys: str) -> str:
    words = []
    for k in (seed, epoch, *keys):
        k = f"CAST({k} AS BIGINT)"
        words += [f"({k} & {WORD})", f"(({k} >> 32) & {WORD})"]
    high, low = (f"list_reduce([{', '.join(words)}], lambda h, w: {_mixed_sql('xor(h, w)')}, CAST({s} AS BIGINT))" for s in HASH_STARTS)
    return f"(({high} << {HASH_BITS - 32}) + ({low} >> {64 - HASH_BITS}))"


def keep_sql(rate: float, seed: int, epoch, *keys: str) -> str:
    return f"({unit_hash_sql(seed, epoch, *keys)}) < {keep_threshold(rate)}"


def uniform_sql(seed: int, epoch, *keys: str) -> str:
    return f"CAST({unit_hash_sql(seed, epoch, *keys)} >> {HASH_BITS - 53} AS DOUBLE) / {float(1 << 53)}"


def gap_sample_ctes(name: str, rate: float, seed: int, epochs: int, positions: str) -> list:
    """``name(e, pos)``: positions 0.. below the number ``positions``, sampled by gaps
    (see ``kernels.gap_positions``)."""
    def gap(k: str) -> str:
        return f"CAST(floor(ln(1 - {uniform_sql(seed, 'e', 'b', k)}) / {math.log(1 - rate)!r}) AS BIGINT)"
    return [f"{name}_run AS (SELECT e, b, 0 AS k, b * {GAP_BLOCK} + {gap('0')} AS pos FROM (SELECT r.range AS e, s.range AS b FROM range({epochs}) r, "
            f"range(({positions}) // {GAP_BLOCK} + 1) s) UNION ALL "
            f"SELECT e, b, k + 1, pos + 1 + {gap('(k + 1)')} FROM {name}_run WHERE pos < (b + 1) * {GAP_BLOCK})",
            f"{name} AS MATERIALIZED (SELECT e, pos FROM {name}_run WHERE pos < (b + 1) * {GAP_BLOCK} AND pos < ({positions}))"]


def md5_int_sql(s: str) -> str:
    return f"CAST(('0x' || substr(md5({s}), 1, 8)) AS BIGINT)"


def clip_sql(g: str, lim: float) -> str:
    return (f"CASE WHEN isnan({g}) THEN {g} WHEN {g} > {lim} THEN {lim} "
            f"WHEN {g} < {-lim} THEN {-lim} ELSE {g} END")


# corpus-wide line split used by every oracle (same breaks as Spark's text reader)
LINES_CTE = (
    "lines AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(u.ord - 1 AS BIGINT) AS line_no, u.line AS line "
    "FROM documents, unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) WITH ORDINALITY AS u(line, ord))"
)
NONEMPTY_CTE = "nonempty AS (SELECT * FROM lines WHERE line <> '')"
CHARS_CTE = (
    "chars AS (SELECT doc_id, line_no, CAST(u.ord - 1 AS INTEGER) AS pos, u.ch AS ch "
    "FROM nonempty, unnest(string_split(line, '')) WITH ORDINALITY AS u(ch, ord))"
)
VOCAB_CTE = (
    "vocab AS (SELECT ch, CAST(row_number() OVER (ORDER BY ch) - 1 AS INTEGER) AS id, n "
    "FROM (SELECT ch, count(*) AS n FROM chars GROUP BY ch))"
)
# characters with their place in the whole corpus (file order = doc_id, line_no)
GCHARS_CTE = (
    "gchars AS (SELECT c.doc_id, c.line_no, c.pos, c.ch, v.id, "
    "row_number() OVER (ORDER BY c.doc_id, c.line_no, c.pos) - 1 AS gpos "
    "FROM chars c JOIN vocab v USING (ch))"
)


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
