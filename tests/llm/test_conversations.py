"""Conversation repair against a plain search over edits, and its parts."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from charloom.llm.conversations import Grammar, RepairRules, Rope, cheapest, learn_grammar, repair_damaged, times, symbol_matrix
from charloom.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def _damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 0:
            continue
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (2 if hit == 3 else 1)
    for conv, own in out.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def _faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        words = WORD.findall(text)
        out.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def _search(rows, found):
    """Cheapest edits, least audit first: uniform-cost search over whole edit sequences."""
    open_, done = [(0, "", 0, "", ())], set()
    while open_:
        cost, audit, i, shape, lines = heapq.heappop(open_)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", shape):
            return cost, audit, "\n".join(lines)
        tail = (i, shape[-1:])
        if tail in done:
            continue
        done.add(tail)
        steps = []
        if i < len(rows):
            _, role, text = rows[i]
            steps.append((2, "D", 1, "", None))
            if found[i] not in ("blank", "duplicate"):
                more = 5 if found[i] == "truncated" else 0
                if role:
                    steps.append((more, "K", 1, role[0], f"{role}:{text}"))
                steps += [(more + 1, "R", 1, r[0], f"{r}:{text}") for r in ("user", "assistant")]
        steps += [(5, "I", 0, r[0], f"{r}:") for r in ("user", "assistant")]
        for price, letter, by, c, line in steps:
            if re.fullmatch("s?(ua)*u?", shape + c):
                heapq.heappush(open_, (cost + price, audit + letter, i + by, shape + c, lines if line is None else lines + (line,)))


def _plain(rows):
    out = {}
    for conv, own in _damage(rows).items():
        found = _faults(own)
        cost, audit, text = _search(own, found)
        turns = [t for t, _, _ in own if t is not None]
        pairs = [(a[1][:1] + b[1][:1]) for a, b in zip(own, own[1:])]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[found.count(f) for f in ("blank", "duplicate", "truncated")],
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def _got(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert _got(LLM_QUERIES["op11_conversation_repair"](spark, SF)) == _plain(rows)


def test_odd_rows(spark):
    rng = random.Random(3)
    texts = ["", " \t\n", "Fine.", "cut off", "Why?", "é…", None, "so\x0b!\x0c", " "]
    roles = ["system", "user", "assistant", "tool", "", None, "s"]
    rows = [(c, rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts)) for c in [None, *range(120)] for _ in range(rng.randrange(1, 10))]
    rows += [(500, 0, "user", "x" * 100000 + "."), (501, None, None, None)] + [(502, 4, "user", "Same.")] * 5
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for name in ("conv", "pos", "symbol", "ck", "audit", "rk"):
        df = df.withColumn(name, __import__("pyspark").sql.functions.lit("own"))
    want = _plain(rows)
    assert _got(repair_damaged(df)) == want
    assert _got(repair_damaged(df, RepairRules(block=2, max_rules=3, per_round=1))) == want
    assert repair_damaged(df.limit(0)).count() == 0


def test_grammar_keeps_sequences(spark):
    rng = random.Random(5)
    rows = [(i, 0, "".join(rng.choice("dgdgdgj") for _ in range(rng.randrange(1, 60)))) for i in range(50)]
    df = spark.createDataFrame(rows, "conv long, block int, symbols string")
    rules = RepairRules(block=64)
    grammar = learn_grammar(df, rules)

    def spelt(s):
        if s < 12:
            return chr(97 + s)
        x, y = grammar.pairs[s - 12]
        return spelt(x) + spelt(y)

    total = 0
    for _, _, symbols in rows:
        short = grammar.rewrite([ord(c) - 97 for c in symbols])
        assert "".join(map(spelt, short)) == symbols
        total += len(short)
    assert len(grammar.rounds) > 2 and total * 2 < sum(len(s) for _, _, s in rows)
    with_rules = {r["ck"]: (r["cost"], r["audit"]) for r in cheapest(df, rules).collect()}
    without = {r["ck"]: (r["cost"], r["audit"]) for r in cheapest(df, RepairRules(max_rules=0)).collect()}
    assert with_rules == without


def test_products_in_any_order():
    rules, rng = RepairRules(), random.Random(1)

    def plain(m):
        return [[None if x is None else (x[0], str(x[1])) for x in row] for row in m]
    for _ in range(100):
        a, b, c = (symbol_matrix(rng.randrange(12), rules) for _ in range(3))
        assert plain(times(times(a, b), c)) == plain(times(a, times(b, c)))


@pytest.mark.parametrize("a,b", [("", "D"), ("DK", "DKK"), ("I", "K"), ("KD", "KD")])
def test_rope_order(a, b):
    def rope(s):
        return Rope(Rope(s[:1]), Rope(s[1:])) if len(s) > 1 else Rope(s)
    assert rope(a).before(rope(b)) == (a < b) and rope(b).before(rope(a)) == (b < a)
    assert str(rope(b)) == b
    assert Grammar().rewrite([1, 2]) == [1, 2]
