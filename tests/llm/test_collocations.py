"""Phrase mining against plain counts, with budgets from tiny to large."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from charloom.llm.collocations import PhraseRules, collocations, phrase_counts


def _plain(rows, rules):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, rules.max_words + 1):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= rules.min_count}
        own = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= rules.covered_percent * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in found.items()):
                continue
            cuts = [(1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
            score, _, l, r = min(cuts)
            own.append((score, a, " ".join(p), l, r))
        own.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, l, r, n[lang], s) for i, (s, a, p, l, r) in enumerate(own[:rules.top])]
    return sorted(out)


def _got(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = ["the", "The", "of", "a", "b", "é", "x-y", "#1", "long" * 30, "and", "so", " ", "\x85", "\x1c"]
    out = [(rng.choice(["en", "fr", None]), "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ","])
                                                     for _ in range(rng.randrange(0, 60)))) for _ in range(150)]
    out += [("en", "the the the the the the the the the the"), ("en", None), (None, ""), ("und", "a b a b"), ("fr", " . ,\t")] * 4
    return out + [("en", "of the a " * 4000)]


@pytest.mark.parametrize("rules", [PhraseRules(min_count=5), PhraseRules(min_count=5, budget=40, block=64, top=7),
                                   PhraseRules(min_count=3, budget=1, block=1000, covered_percent=60),
                                   PhraseRules(min_count=5, budget=500, table_bits=13, max_words=3)], ids=str)
def test_counts(spark, rows, rules):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    for c in ("ids", "a", "n", "word", "grp"):
        df = df.withColumn(c, F.lit("own"))
    assert _got(collocations(df, rules)) == _plain(rows, rules)


def test_empty(spark):
    df = spark.createDataFrame([(None, None), ("en", "")], "lang string, text string")
    assert collocations(df).count() == 0 and collocations(df.limit(0)).count() == 0


def test_prefixes_fit_the_budget(spark, rows):
    """With a small budget heavy prefixes go deep, and nothing is counted twice."""
    df = spark.createDataFrame(rows, "lang string, text string")
    _, few = phrase_counts(df, PhraseRules(min_count=5, budget=10))
    _, many = phrase_counts(df, PhraseRules(min_count=5))
    a, b = ({(r["lang"], tuple(r["ids"])): r["a"] for r in x.collect()} for x in (few, many))
    assert a == b and few.count() == len(a)
