"""License scan: an Aho-Corasick automaton finds notice phrases and identifier
tags; the expressions after tags are parsed by the shunting-yard algorithm.

Texts are lower-cased (A-Z) and cut into words of letters, digits and non-ASCII
characters.  The automaton runs over the words joined by single blanks, so a
phrase is found wherever its words stand consecutively, whatever lies between
them.  A second automaton finds identifier tags (``SPDX-License-Identifier:``) in
the text itself.  An expression ends where operands and operators stop to
alternate, so prose after it is none of it; it is evaluated to the licences it
names, and to whether it can be met with permissive licences alone (``or``: one
side, ``and``: both, ``with``: the licence before it).

Results in the odd cases: null and empty texts have no words and no labels; a
malformed expression (an operator or an open bracket is left) gives all licences
that it names, however many, and the label ``bad-expression``; null ids and repeated rows are carried through row by row;
texts are scanned whole; extra columns are neither read nor returned.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from charloom.llm.common import prepare

#: Base phrases and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: The method's own notice phrases and labels.
NOTICE_PHRASES = {
    "apache license": "apache", "mit license": "mit", "bsd license": "bsd", "mozilla public license": "mpl",
    "lesser general public license": "lgpl", "affero general public license": "agpl", "public domain": "public-domain",
    "creative commons": "creative-commons", "cc0": "cc0", "cc by nc": "cc-by-nc", "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd", "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
}

PERMISSIVE = ("mit", "apache", "bsd", "isc", "zlib", "unlicense", "cc0", "cc-by-4.0", "cc-by-3.0", "0bsd")

#: Tags that an expression follows.
TAGS = ("spdx-license-identifier:",)


@dataclass(frozen=True)
class LicenseRules:
    base: dict = field(default_factory=lambda: dict(BASE_PHRASES), hash=False)
    notices: dict = field(default_factory=lambda: dict(NOTICE_PHRASES), hash=False)
    permissive: tuple = PERMISSIVE


_TOKEN = re.compile(r"\(|\)|[a-z0-9][a-z0-9.+\-:]*")
_RANK = {"or": 1, "and": 2, "with": 3}


def to_postfix(expression: str) -> list[str]:
    """Shunting yard: operands in order, operators by rank (with, and, or).
    Raises ValueError where operands and operators don't alternate."""
    out, pending, operand_next = [], [], True
    for t in _TOKEN.findall(expression.lower()):
        if t in _RANK:
            if operand_next:
                raise ValueError(expression)
            while pending and pending[-1] != "(" and _RANK[pending[-1]] >= _RANK[t]:
                out.append(pending.pop())
            pending.append(t)
            operand_next = True
        elif t == "(":
            if not operand_next:
                raise ValueError(expression)
            pending.append(t)
        elif t == ")":
            while pending and pending[-1] != "(":
                out.append(pending.pop())
            if not pending or operand_next:
                raise ValueError(expression)
            pending.pop()
        else:
            if not operand_next:
                raise ValueError(expression)
            out.append(t)
            operand_next = False
    if operand_next or "(" in pending:
        raise ValueError(expression)
    return out + pending[::-1]


def leading_expression(source: str) -> list[str]:
    """Tokens from the start of ``source`` as long as operands and operators alternate."""
    tokens, operand_next, depth = [], True, 0
    for m in _TOKEN.finditer(source):
        t = m[0]
        if t in _RANK or t == ")":
            if operand_next or t == ")" and not depth:
                break
        elif not operand_next:
            break
        depth += (t == "(") - (t == ")")
        operand_next = t in _RANK or t == "("
        tokens.append(t)
    return tokens


def evaluate(expression: str, permissive: tuple = PERMISSIVE) -> tuple[set[str], bool]:
    """Licences that the expression names, and whether permissive ones meet it."""
    stack: list[tuple[set[str], bool]] = []
    for t in to_postfix(expression):
        if t not in _RANK:
            stack.append(({t}, t.startswith(permissive)))
            continue
        (b, b_ok), (a, a_ok) = stack.pop(), stack.pop()
        stack.append((a, a_ok) if t == "with" else (a | b, a_ok or b_ok) if t == "or" else (a | b, a_ok and b_ok))
    return stack[0]


#: A-Z to a-z; other ASCII that is no letter or digit to a blank; the bytes of other characters as they are.
_WORD_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


class LicenseScanner:
    def __init__(self, rules: LicenseRules = LicenseRules()):
        import ahocorasick
        self.rules = rules
        # a phrase between blanks; a blank may end one phrase and begin the next
        own: dict[str, list] = {}
        for kind, phrases in (("base", rules.base), ("notice", rules.notices)):
            for phrase, label in phrases.items():
                own.setdefault(" " + phrase.encode().decode("latin-1") + " ", []).append((kind, label))
        self.automaton = ahocorasick.Automaton()
        for phrase, found in own.items():
            self.automaton.add_word(phrase, (len(phrase), found))
        self.automaton.make_automaton()
        self.tags = ahocorasick.Automaton()
        for tag in TAGS:
            self.tags.add_word(tag, tag)
        self.tags.make_automaton()

    def scan(self, text: str) -> tuple:
        """n_words, n_base, first_word, last_word, base labels, labels, score."""
        words = text.encode("utf-8", "replace").translate(_WORD_BYTES).split()
        line = (b" " + b" ".join(words) + b" ").decode("latin-1")
        starts, base, labels = [], set(), set()
        for end, (size, found) in self.automaton.iter(line):
            for kind, label in found:
                labels.add(label)
                if kind == "base":
                    base.add(label)
                    starts.append(end - size + 1)
        tags = 0
        lowered = text.lower() if ":" in text else ""
        for last_of_tag, _ in self.tags.iter(lowered):
            end = lowered.find("\n", last_of_tag)
            tokens = leading_expression(lowered[last_of_tag + 1:end if end >= 0 else None].split("*/")[0])
            try:
                names, ok = evaluate(" ".join(tokens), self.rules.permissive)
                labels.update(names, ["permissive" if ok else "restricted"])
                tags += 1
            except ValueError:
                labels.update(["bad-expression"], (t for t in tokens if t not in _RANK and t not in "()"))
        first = last = None
        if starts:
            first = line.count(" ", 0, min(starts))
            last = first + line.count(" ", min(starts), max(starts))
        # a tag is proof; every further label halves what is left to doubt
        score = 1.0 if tags else 1.0 - 0.5 ** len(labels)
        return (len(words), len(starts), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score)


_SCANNERS: dict = {}
_COLUMNS = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
            "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64()}


def scan_licenses(docs: DataFrame, rules: LicenseRules = LicenseRules(), text: str = "text",
                  doc_id: str = "doc_id") -> DataFrame:
    """``doc_id`` and the scan's columns for every row."""
    prepare(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    key = (tuple(rules.base.items()), tuple(rules.notices.items()), rules.permissive)

    def run(batches):
        if key not in _SCANNERS:
            _SCANNERS[key] = LicenseScanner(rules)
        scanner = _SCANNERS[key]
        for b in batches:
            rows = list(zip(*(scanner.scan(t.as_py() or "") for t in b.column(1)))) or [()] * len(_COLUMNS)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(r, t) for r, t in zip(rows, _COLUMNS.values()))], names=["doc_id", *_COLUMNS])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, "
             "base_labels string, labels string, score double")
