"""Conversation structure repair by a grammar-compressed dynamic program.

A conversation is a sequence of symbols, one a row: the role's initial (``s``,
``u``, ``a`` or another) and what its first fault forces (nothing, a deletion, or
a price for staying).  The cheapest edits that lead to the role pattern
``(s?(ua)+)?`` are a path through four states (nothing yet, after ``s``, after
``u``, after ``a``), so a symbol is a 4 x 4 matrix over (cost, audit) pairs, where
"times" adds costs and joins audits and "plus" takes the smaller pair.  Two audits
of one cost between the same states never begin each other (they would differ by
insertions alone, which cost), so the least of the joined audits is the join of
the least ones, and products may be taken in any order.

Conversations repeat themselves, so the sequences share a grammar: Re-Pair turns
the most frequent neighbouring pairs into rules, many at a time (no symbol on
both sides), one count over all sequences per round.  Each rule's matrix is the
product of its halves, made once, bottom up; its audits are ropes, pairs of the
halves' audits.  A task then multiplies a conversation's start vector by what is
left of its sequence.  The grammar is bounded (``max_rules``); it only saves
work, the product is exact with any grammar.

Sequences are cut into blocks of ``block`` rows, so no row holds a whole large
conversation; they are counted, rewritten and grouped by block, and the vector is
handed from block to block.  Numbering a conversation's rows and hashing its
repaired text are sequential by nature: its rows stand sorted in one task, which
streams through them (the sort spills); only a batch of rows and the audit are in
memory.

Results in the odd cases: null ids, roles and texts are one blank where text is
made of them (a null id is one conversation); rows of one turn follow role, then
text, in byte order; an empty or unknown role can not stay; repeated rows are
duplicates; a conversation without rows after damage has zeros, an empty audit
and the hash of the empty text; an empty table gives no rows; extra columns are
not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from charloom.llm.common import SPACES, Remembered, cut, row_key


@dataclass(frozen=True)
class RepairRules:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    #: for a truncated row that stays
    truncated: int = 5
    #: rows per block of a sequence
    block: int = 1024
    #: bounds of the grammar: rules in all, rules per round
    max_rules: int = 4096
    per_round: int = 256


ROLES = ("system", "user", "assistant")
#: states: nothing yet, after s, after u, after a
STATES, START, ENDS = 4, 0, (0, 3)
#: where a kept or inserted initial leads, by state
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: symbols 0-11: initial (s, u, a, other) x (fine, must go, truncated)
INITIALS, FAULTS = "sua?", 3


# ---------------------------------------------------------------- damage and faults
def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text`` after the prescribed damage: a checksum of
    ``conv:turn`` drops, empties, strips, repeats or reassigns a row."""
    blank = F.lit(" ")
    own = rows.select(rows[conv].alias("conv"), rows[turn].alias("turn"),
                      F.coalesce(rows[role], blank).alias("role"), F.coalesce(rows[text], blank).alias("text"))
    key = F.concat(F.coalesce(F.col("conv").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    own = own.withColumn("hit", F.crc32(F.encode(key, "UTF-8")) % 20).filter("hit <> 0")
    own = own.withColumn("text", F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", ""))
                         .otherwise(F.col("text")))
    own = own.withColumn("role", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")))
    copies = F.when(F.col("hit") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return own.select("conv", "turn", "role", "text", F.explode(copies).alias("copy")).drop("copy")


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def faults(rows: DataFrame) -> DataFrame:
    """``conv, turn, role, text, pos, prev, fault, symbol`` for every row, numbered in
    order within its conversation; ``prev`` is the row before's initial."""
    # a row is a copy if its conversation has the role and text before: at an earlier turn, or just before it
    rows = rows.withColumn("rk", row_key(F.col("conv"), F.col("role"), F.col("text")))
    early = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = (rows.groupBy(F.col("rk").alias("f_rk")).agg(F.count("*").alias("k"), F.min(early).alias("early"))
              .filter("k > 1").drop("k"))
    rows = rows.join(firsts, F.col("rk") == F.col("f_rk"), "left")
    in_order = Window.partitionBy("conv").orderBy(*_order())
    later = F.col("f_rk").isNotNull() & ((early > F.col("early")) | (F.lag("rk").over(in_order).eqNullSafe(F.col("rk"))))
    bare = F.btrim("text", F.lit(SPACES))
    fault = (F.when(bare == "", "blank").when(F.coalesce(later, F.lit(False)), "duplicate")
             .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated"))
    initial = F.substring("role", 1, 1)
    numbered = rows.select("conv", "turn", "role", "text", (F.row_number().over(in_order) - 1).alias("pos"),
                           F.lag(initial).over(in_order).alias("prev"), fault.alias("fault"), initial.alias("initial"))
    which = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    kind = F.when(F.col("fault").isin("blank", "duplicate"), 1).when(F.col("fault") == "truncated", 2).otherwise(0)
    return numbered.withColumn("symbol", which * FAULTS + kind)


def counts(rows: DataFrame) -> DataFrame:
    """Per conversation: gaps and faults, from the rows of :func:`faults`."""
    pair = F.concat("prev", "initial")
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0))
    return rows.groupBy("conv").agg(
        gaps.cast("long").alias("gaps"), *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.count_if(F.col("prev").isNotNull() & ~pair.isin("su", "ua", "au")).alias("illegal"))


# ---------------------------------------------------------------- the semiring
class Rope:
    """Text joined by reference: a leaf holds letters, a node two ropes."""

    __slots__ = ("left", "right", "letters")

    def __init__(self, left, right=None):
        self.letters, self.left, self.right = (left, None, None) if right is None else (None, left, right)

    def parts(self):
        open_ = [self]
        while open_:
            r = open_.pop()
            if r.letters is None:
                open_ += (r.right, r.left)
            elif r.letters:
                yield r.letters

    def __str__(self):
        return "".join(self.parts())

    def before(self, other) -> bool:
        """ASCII order, read only as far as the two agree."""
        if self is other:
            return False
        a, b = (x for p in self.parts() for x in p), (x for p in other.parts() for x in p)
        for x in a:
            y = next(b, "")
            if x != y:
                return x < y
        return next(b, "") != ""


NOTHING = Rope("")


def _better(new, old) -> bool:
    return old is None or new[0] < old[0] or (new[0] == old[0] and new[1].before(old[1]))


def _joined(a: Rope, b: Rope) -> Rope:
    return b if a.letters == "" else a if b.letters == "" else Rope(a, b)


def times(a: list, b: list) -> list:
    """Rows of ``a`` (any number) times the matrix ``b``; None is no path."""
    out = []
    for row in a:
        new = [None] * STATES
        for k, x in enumerate(row):
            if x is None:
                continue
            for j, y in enumerate(b[k]):
                if y is not None and (new[j] is None or x[0] + y[0] <= new[j][0]):
                    z = (x[0] + y[0], _joined(x[1], y[1]))
                    if _better(z, new[j]):
                        new[j] = z
        out.append(new)
    return out


@lru_cache(maxsize=8)
def inserted(rules: RepairRules) -> list:
    """Insertions between two rows: every path without a state twice."""
    out = [[(0, NOTHING) if i == j else None for j in range(STATES)] for i in range(STATES)]
    for i in range(STATES):
        here, seen = i, {i}
        while True:
            here = next((STEPS[c][here] for c in "ua" if here in STEPS[c]), None)
            if here is None or here in seen:
                break
            seen.add(here)
            out[i][here] = ((len(seen) - 1) * rules.insert, Rope("I" * (len(seen) - 1)))
    return out


@lru_cache(maxsize=64)
def symbol_matrix(symbol: int, rules: RepairRules) -> list:
    """Insertions, then one row kept, reassigned or deleted."""
    own, kind = INITIALS[symbol // FAULTS], symbol % FAULTS
    out = [[None] * STATES for _ in range(STATES)]

    def offer(i, j, cost, letter):
        if _better((cost, Rope(letter)), out[i][j]):
            out[i][j] = (cost, Rope(letter))

    for i in range(STATES):
        offer(i, i, rules.delete, "D")
        if kind != 1:
            stay = rules.truncated if kind == 2 else 0
            if i in STEPS.get(own, {}):
                offer(i, STEPS[own][i], stay, "K")
            for c in "ua":
                if i in STEPS[c]:
                    offer(i, STEPS[c][i], stay + rules.rerole, "R")
    return times(inserted(rules), out)


# ---------------------------------------------------------------- the grammar
class Grammar:
    """Re-Pair rules in rounds; rule ``12 + k`` stands for two symbols."""

    def __init__(self):
        self.rounds: list[dict] = []
        self.pairs: list[tuple] = []

    def add(self, counted: list, limit: int) -> bool:
        """One round from ``(x, y, count)``, most frequent first: pairs that share
        no symbol on opposite sides, so that replacing one disturbs no other."""
        lefts, rights, chosen = set(), set(), {}
        for x, y, n in counted:
            if n < 2 or len(self.pairs) >= limit:
                break
            if x in rights or y in lefts or x == y and (x in lefts or y in rights):
                continue
            chosen[(x, y)] = len(INITIALS) * FAULTS + len(self.pairs)
            self.pairs.append((x, y))
            lefts.add(x)
            rights.add(y)
        if chosen:
            self.rounds.append(chosen)
        return bool(chosen)

    def rewrite(self, symbols: list[int]) -> list[int]:
        for chosen in self.rounds:
            out, i, last = [], 0, len(symbols) - 1
            while i <= last:
                rule = chosen.get((symbols[i], symbols[i + 1])) if i < last else None
                out.append(symbols[i] if rule is None else rule)
                i += 1 if rule is None else 2
            symbols = out
        return symbols

    def matrices(self, rules: RepairRules) -> list:
        """A matrix per symbol and rule, each from its halves."""
        out = [symbol_matrix(s, rules) for s in range(len(INITIALS) * FAULTS)]
        for x, y in self.pairs:
            out.append(times(out[x], out[y]))
        return out


def _unpack(packed: str) -> list[int]:
    return [ord(c) - 97 for c in packed]


def _pair_counts(sequences: DataFrame, grammar: Grammar) -> DataFrame:
    """``x, y, n``: how often two symbols stand side by side (runs of one symbol
    count every second place), as the grammar so far rewrites the sequences."""
    known = sequences.sparkSession.sparkContext.broadcast(grammar)

    def run(batches):
        from collections import Counter
        memo = Remembered(lambda s: known.value.rewrite(_unpack(s)), 100_000)
        for pdf in batches:
            found: Counter = Counter()
            for packed, copies in pdf["symbols"].value_counts().items():
                symbols, taken = memo[packed], False
                for x, y in zip(symbols, symbols[1:]):
                    taken = x == y and not taken
                    if x != y or taken:
                        found[x, y] += copies
            yield pd.DataFrame([(x, y, n) for (x, y), n in found.items()], columns=["x", "y", "n"])

    return sequences.select("symbols").mapInPandas(run, "x int, y int, n long").groupBy("x", "y").agg(F.sum("n").alias("n"))


def learn_grammar(sequences: DataFrame, rules: RepairRules) -> Grammar:
    grammar = Grammar()
    # a round at least halves the most frequent pairs; a block of n rows needs no more than log2 n of nesting
    for _ in range(2 * rules.block.bit_length()):
        top = _pair_counts(sequences, grammar).orderBy(F.col("n").desc(), "x", "y").limit(rules.per_round).collect()
        if not grammar.add([(r["x"], r["y"], r["n"]) for r in top], rules.max_rules):
            break
    return grammar


def cheapest(sequences: DataFrame, rules: RepairRules = RepairRules()) -> DataFrame:
    """``conv, cost, audit`` from ``conv, block, symbols``."""
    grammar = learn_grammar(sequences, rules)
    sent = sequences.sparkSession.sparkContext.broadcast(grammar)

    def run(batches):
        grammar = sent.value
        matrices, closing = grammar.matrices(rules), inserted(rules)
        start = [[(0, NOTHING) if s == START else None for s in range(STATES)]]

        def onward(state, packed):
            for s in grammar.rewrite(_unpack(packed)):
                state = times(state, matrices[s])
            return state

        def ended(state):
            row = times(state, closing)[0]
            best = None
            for s in ENDS:
                if row[s] is not None and _better(row[s], best):
                    best = row[s]
            return best[0], str(best[1])

        whole = Remembered(lambda packed: ended(onward(start, packed)), 100_000)
        open_, blocks, state = None, [], None
        for pdf in batches:
            out = []
            for conv, block, packed in zip(pdf["ck"], pdf["block"], pdf["symbols"]):
                if block == 0:
                    if open_ is not None:
                        out.append((open_, *(whole[blocks[0]] if state is None else ended(state))))
                    open_, blocks, state = conv, [packed], None
                else:
                    state = onward(onward(start, blocks[0]) if state is None else state, packed)
            yield pd.DataFrame(out, columns=["ck", "cost", "audit"])
        if open_ is not None:
            yield pd.DataFrame([(open_, *(whole[blocks[0]] if state is None else ended(state)))], columns=["ck", "cost", "audit"])

    keyed = sequences.select(_conv_key(F.col("conv")).alias("ck"), "block", "symbols")
    return keyed.repartition("ck").sortWithinPartitions("ck", "block").mapInPandas(run, "ck string, cost long, audit string")


def _conv_key(conv: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("-"))


# ---------------------------------------------------------------- the repaired text
def repaired_lines(rows: DataFrame, audits: DataFrame):
    """Rows of a conversation behind its audit, in one sorted stream per task."""
    head = audits.select("ck", F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    body = rows.select(_conv_key(F.col("conv")).alias("ck"), "pos", "role", "text")
    return head.union(body).repartition("ck").sortWithinPartitions("ck", "pos")


class _Replay:
    """Edits of an audit applied to the rows as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def inserted(self):
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield f"{self._next()}:"

    def row(self, role: str, text: str):
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = STEPS[role[0]][self.state]
            yield f"{role}:{text}"
        elif edit == "R":
            yield f"{self._next()}:{text}"

    def _next(self) -> str:
        c = "u" if self.state in STEPS["u"] else "a"
        self.state = STEPS[c][self.state]
        return ROLES["sua".index(c)]


def text_hashes(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """``ck, repaired_sha256``."""
    def run(batches):
        conv = replay = digest = None
        first = True

        def add(lines):
            nonlocal first
            for line in lines:
                if not first:
                    digest.update(b"\n")
                digest.update(line.encode("utf-8", "surrogatepass"))
                first = False

        for pdf in batches:
            out = []
            for ck, pos, role, text in zip(pdf["ck"], pdf["pos"], pdf["role"], pdf["text"]):
                if pos < 0:
                    if conv is not None:
                        add(replay.inserted())
                        out.append((conv, digest.hexdigest()))
                    conv, replay, digest, first = ck, _Replay(text), hashlib.sha256(), True
                else:
                    add(replay.row(role, text))
            yield pd.DataFrame(out, columns=["ck", "repaired_sha256"])
        if conv is not None:
            add(replay.inserted())
            yield pd.DataFrame([(conv, digest.hexdigest())], columns=["ck", "repaired_sha256"])

    return repaired_lines(rows, audits).mapInPandas(run, "ck string, repaired_sha256 string")


def repair_damaged(rows: DataFrame, rules: RepairRules = RepairRules(), conv: str = "conv_id", turn: str = "turn",
                   role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation of ``rows``: faults after the prescribed damage, the
    cheapest repair and the hash of its text."""
    checked = cut(faults(damaged(rows, conv, turn, role, text)))
    letters = F.char(F.col("symbol") + 97)
    blocks = (checked.groupBy("conv", F.floor(F.col("pos") / rules.block).cast("int").alias("block"))
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", letters.alias("c")))), lambda x: x["c"]), "")
                   .alias("symbols")))
    sequences = cut(blocks)
    audits = cut(cheapest(sequences, rules))
    found = (counts(checked).withColumn("ck", _conv_key(F.col("conv"))).drop("conv")
             .join(audits, "ck").join(text_hashes(checked, audits), "ck"))
    every = rows.select(rows[conv].alias("conv_id")).distinct().withColumn("ck", _conv_key(F.col("conv_id")))
    zero = {c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    empty = hashlib.sha256(b"").hexdigest()
    return every.join(found, "ck", "left").select(
        "conv_id", *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
