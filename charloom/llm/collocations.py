"""Phrase collocations by vertical partitioning of a word suffix tree.

The corpus is the sequence of word numbers of every piece of every text.  No
task could hold its suffix tree, so it is cut vertically: the tree below a word
prefix is independent of all others.

1. *Words.*  Tasks count their words, Spark adds the counts.  A word's number is
   its XXH64; all distinct words are checked for two with one number (then the
   numbers are salted anew), so numbers stand for words exactly and no
   dictionary is sent anywhere.
2. *Prefixes.*  A phrase that counts begins with a word that does.  A word with
   more suffixes than the memory budget is extended by one word, and again,
   until every prefix fits or is as deep as the tree; one scan per depth, over
   the heavy prefixes alone.  There are at most ``depth * words / budget`` of
   them, which bounds what is broadcast.
3. *Groups.*  Prefixes are dealt by number into cells, their suffixes summed per
   cell, and cells over the budget split, so a group's suffixes fit one task.
4. *Subtrees.*  Tasks cut the suffixes (``max_words`` words, ended by a rare word
   or the piece), add up equal ones and send each group one block of numbers.  A
   group sorts its suffixes, which is its subtree in depth-first order: a leaf is
   a distinct suffix, and a node's count is the sum of the leaves that share its
   path.

A suffix ends before a rare word and between two words that are rarely
neighbours.  Both are told by tables of fixed size, one bit a hash value: set for
frequent words, and for pairs whose hash value counts often enough, so a rare one
that shares a bit only lengthens suffixes.  Scores are exact decimals.

Results in the odd cases: a null text is empty, a null language ``und``; repeated
rows count each; texts of any length are cut at piece ends into bounded blocks
(a single piece longer than a block is one block); an empty table gives no rows;
only the language and the text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from charloom.llm.common import Remembered, cut

#: A-Z lower, piece ends as a full stop, tab as a blank; other bytes stay
_BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"." * 10 + b" ")


@dataclass(frozen=True)
class PhraseRules:
    #: a phrase counts from so many occurrences
    min_count: int = 100
    max_words: int = 5
    #: a phrase goes if a longer one has this share of its occurrences, in percent
    covered_percent: int = 100
    #: phrases reported per language
    top: int = 2000
    #: suffixes that one task holds at a time
    budget: int = 1 << 20
    #: bytes of text that are numbered at a time
    block: int = 1 << 22
    #: the tables that tell rare words and pairs have 2 ** so many bits each
    table_bits: int = 26


def _blocks(texts, limit: int):
    """The texts' bytes, lower-cased, in blocks of about ``limit`` bytes that end
    where a piece does."""
    part, size = [], 0
    for text in texts:
        data, at = text.encode("utf-8", "surrogatepass").translate(_BYTES), 0
        while at < len(data):
            end = len(data)
            if end - at > limit:
                end = data.rfind(b".", at, at + limit) + 1 or data.find(b".", at + limit) + 1 or len(data)
            part.append(data[at:end])
            size += end - at
            at = end
            if size >= limit:
                yield b".".join(part)
                part, size = [], 0
    if part:
        yield b".".join(part)


def _tokens(block: bytes) -> list[bytes]:
    """Words of a block; a full stop stands where a piece ends."""
    return block.replace(b".", b" . ").split()


def _by_lang(pdf: pd.DataFrame):
    for lang, texts in pdf.groupby("lang")["text"]:
        yield lang, texts.tolist()


def _corpus(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("lang"), docs[text].alias("text")).filter("text <> ''")


def _number(word: bytes, salt: int) -> int:
    # words hold no blank, so the salt cannot make one word another
    return xxhash.xxh64_intdigest(word + b" " * salt, 42)


def word_counts(corpus: DataFrame, rules: PhraseRules) -> DataFrame:
    """``lang, word, n`` over all words."""
    block = rules.block

    def run(batches):
        from collections import Counter
        held: dict[str, Counter] = {}
        for pdf in batches:
            for lang, texts in _by_lang(pdf):
                counts = held.setdefault(lang, Counter())
                for data in _blocks(texts, block):
                    counts.update(_tokens(data))
                    if sum(map(len, held.values())) > 400_000:
                        yield from map(out, held.items())
                        for c in held.values():
                            c.clear()
        yield from map(out, held.items())

    def out(item):
        lang, counts = item
        counts.pop(b".", None)
        if not counts:
            return pd.DataFrame({"lang": [], "word": [], "n": []}, dtype=object)
        return pd.DataFrame({"lang": lang, "word": [w.decode("utf-8", "replace") for w in counts], "n": list(counts.values())})

    return (corpus.mapInPandas(run, "lang string, word string, n long")
            .groupBy("lang", "word").agg(F.sum("n").alias("n")))


def _salt(words: DataFrame) -> int:
    """The first salt under which no two words share a number, and none has zero."""
    distinct = words.select("word").distinct()
    for salt in range(8):
        number = F.xxhash64(F.concat("word", F.lit(" " * salt)))
        shared = distinct.groupBy(number.alias("id")).agg(F.count("*").alias("k")).filter("k > 1 or id = 0")
        if shared.isEmpty():
            return salt
    raise RuntimeError("no salt tells all words apart")


def _table(frequent: DataFrame, bits: int) -> np.ndarray:
    """One bit per hash value, set for the numbers of frequent words: a table of
    fixed size, put together from its set bytes."""
    cell = F.shiftrightunsigned("id", 64 - bits)
    rows = (frequent.select(cell.alias("c")).distinct()
            .groupBy(F.shiftright("c", 3).alias("at")).agg(F.bit_or(F.expr("shiftleft(1, int(c % 8))")).alias("v")))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for part in rows.toLocalIterator():
        out[part["at"]] = part["v"]
    return out


class _Suffixes:
    """What tasks know: the salt, the table of frequent words, heavy prefixes by
    depth and how groups are dealt."""

    def __init__(self, salt: int, table: np.ndarray, rules: PhraseRules):
        self.salt, self.table, self.rules = salt, table, rules
        #: by language: a list by depth 1, 2, ... of (sorted keys, prefixes) arrays
        self.heavy: dict[str, list] = {}
        self.base = self.splits = self.pairs = self.memo = None

    @staticmethod
    def key(columns) -> np.ndarray:
        """One number for a prefix; only a place to look, prefixes are compared in full."""
        with np.errstate(over="ignore"):
            out = np.zeros(len(columns[0]), np.uint64)
            for c in columns:
                out = (out ^ c) * np.uint64(0x9E3779B97F4A7C15)
                out ^= out >> np.uint64(29)
        return out

    def add_heavy(self, found: pd.DataFrame) -> None:
        """Prefixes (one depth) over the budget, as ``lang, ids`` rows."""
        for lang, part in found.groupby("lang"):
            rows = np.array(part["ids"].tolist(), np.int64).astype(np.uint64)
            keys = self.key(list(rows.T))
            order = np.argsort(keys)
            if len(np.unique(keys)) < len(keys):
                raise RuntimeError("two heavy prefixes have one key")
            self.heavy.setdefault(lang, []).append((keys[order], rows[order]))

    def depth(self, lang: str, cols: list) -> np.ndarray:
        """Words by which each suffix is dealt: one more than its longest heavy prefix."""
        out = np.ones(len(cols[0]), np.uint8)
        live = np.arange(len(out))
        for d, (keys, rows) in enumerate(self.heavy.get(lang, []), 1):
            at = np.minimum(np.searchsorted(keys, self.key([c[live] for c in cols[:d]])), len(keys) - 1)
            same = np.all([rows[at, j] == cols[j][live] for j in range(d)], axis=0)
            live = live[same]
            out[live] = d + 1
        return out

    def _set(self, table: np.ndarray, cell: np.ndarray) -> np.ndarray:
        return (table[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def numbers(self, lang: str, texts):
        """Blocks of word numbers; zero where a word is rare or a piece ends."""
        if self.memo is None:  # in the task
            self.memo = Remembered(lambda w: 0 if w == b"." else _number(w, self.salt), 300_000)
        shift = np.uint64(64 - self.rules.table_bits)
        for data in _blocks(texts, self.rules.block):
            tokens = _tokens(data)
            ids = np.fromiter(map(self.memo.__getitem__, tokens), np.uint64, len(tokens))
            ids[~self._set(self.table, ids >> shift)] = 0
            yield np.r_[ids, np.zeros(self.rules.max_words, np.uint64)]

    def pair_cells(self, lang: str, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        seed = np.full(len(at), xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 11), np.uint64)
        return self.key([seed, ids[at], ids[at + 1]]) >> np.uint64(64 - self.rules.table_bits)

    def cut(self, lang: str, texts):
        """Blocks of suffixes: for each, the columns of ``max_words`` numbers (zero
        from the suffix's end on)."""
        for ids in self.numbers(lang, texts):
            at = np.flatnonzero((ids[:-1] != 0) & (ids[1:] != 0))
            at = at[self._set(self.pairs, self.pair_cells(lang, ids, at))]
            joined = np.zeros(len(ids), bool)  # to the next word
            joined[at] = True
            cols = [ids[at], ids[at + 1]]
            for j in range(2, self.rules.max_words):
                cols.append(np.where((cols[-1] != 0) & joined[at + j - 1], ids[at + j], np.uint64(0)))
            yield cols

    def groups(self, lang: str, cols: list, depth: np.ndarray) -> np.ndarray:
        """The group of each suffix, by its prefix of ``depth`` words."""
        seed = np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 7))
        used = [np.where(depth > j, c, np.uint64(0)) for j, c in enumerate(cols)]
        key = self.key([np.full(len(depth), seed), *used])
        cells = np.uint64(len(self.splits))
        cell = (key % cells).astype(np.int64)
        return self.base[cell] + ((key // cells) % self.splits[cell]).astype(np.int64)


def _added(cols: list, weights: np.ndarray | None = None):
    """Distinct rows of the columns in sorted order, and how often (or how heavy) each is."""
    order = np.lexsort(cols[::-1])
    cols = [c[order] for c in cols]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(new)
    counts = np.diff(np.r_[at, len(order)]) if weights is None else np.add.reduceat(weights[order], at) if len(at) else weights[:0]
    return [c[at] for c in cols], counts.astype(np.int64)


def _pair_table(corpus: DataFrame, know, rules: PhraseRules) -> np.ndarray:
    """One bit per hash value of two neighbours, set where it counts ``min_count``
    times.  The table is added up in parts, streamed, counts no higher than they
    matter; what returns has a fixed size."""
    part = max(0, rules.table_bits - 10)
    most = min(rules.min_count, 65535)

    def count(batches):
        s = know.value
        held, size = [], 0

        def out():
            cells, n = np.unique(np.concatenate(held), return_counts=True)
            edges = np.flatnonzero(np.r_[True, np.diff(cells >> np.uint64(part)) != 0])
            n = np.minimum(n, most).astype(np.uint16)
            return pd.DataFrame({"part": (cells[edges] >> np.uint64(part)).astype(np.int64), "counts": [
                zstandard.compress((cells[a:b] & np.uint64((1 << part) - 1)).astype(np.uint32).tobytes() + n[a:b].tobytes())
                for a, b in zip(edges, [*edges[1:], len(cells)])]})

        for pdf in batches:
            for lang, texts in _by_lang(pdf):
                for ids in s.numbers(lang, texts):
                    at = np.flatnonzero((ids[:-1] != 0) & (ids[1:] != 0))
                    if len(at):
                        held.append(s.pair_cells(lang, ids, at))
                        size += len(at)
                    if size > 1 << 22:
                        yield out()
                        held, size = [], 0
        if held:
            yield out()

    def add(batches):
        totals = {}
        for pdf in batches:
            for k, data in zip(pdf["part"], pdf["counts"]):
                raw = zstandard.decompress(data)
                cells = np.frombuffer(raw, np.uint32, len(raw) // 6)
                table = totals.setdefault(k, np.zeros(1 << part, np.uint16))
                # no sum of two passes what 32 bits hold
                table[cells] = np.minimum(table[cells].astype(np.uint32) + np.frombuffer(raw[4 * len(cells):], np.uint16), most)
        for k, table in totals.items():
            yield pd.DataFrame({"part": [k], "bits": [np.packbits(table >= most, bitorder="little").tobytes()]})

    rows = corpus.mapInPandas(count, "part long, counts binary").repartition("part").mapInPandas(add, "part long, bits binary")
    out = np.zeros(1 << (rules.table_bits - 3), np.uint8)
    width = max(1, (1 << part) >> 3)
    for r in rows.toLocalIterator():
        out[r["part"] * width:(r["part"] + 1) * width] = np.frombuffer(r["bits"], np.uint8)
    return out


def _extended(corpus: DataFrame, know, depth: int) -> DataFrame:
    """``lang, ids, n``: the heavy prefixes of ``depth - 1`` words, each followed by
    every frequent word that follows it."""
    def run(batches):
        s = know.value
        for pdf in batches:
            for lang, texts in _by_lang(pdf):
                if len(s.heavy.get(lang, [])) < depth - 1:
                    continue
                for cols in s.cut(lang, texts):
                    here = np.flatnonzero((s.depth(lang, cols) == depth) & (cols[depth - 1] != 0))
                    if len(here):
                        rows, n = _added([c[here] for c in cols[:depth]])
                        yield pd.DataFrame({"lang": lang, "ids": list(np.stack(rows, 1).astype(np.int64)), "n": n})

    return corpus.mapInPandas(run, "lang string, ids array<long>, n long").groupBy("lang", "ids").agg(F.sum("n").alias("n"))


def _loads(prefixes: DataFrame, know, cells: int) -> np.ndarray:
    """Suffixes per cell, of prefixes ``lang, ids, n`` that fit the budget."""
    def run(batches):
        s = know.value
        for pdf in batches:
            for (lang, depth), part in pdf.assign(depth=pdf["ids"].map(len)).groupby(["lang", "depth"]):
                cols = list(np.array(part["ids"].tolist(), np.int64).astype(np.uint64).T)
                zero = np.zeros(len(part), np.uint64)
                cols += [zero] * (s.rules.max_words - depth)
                cell = s.groups(lang, cols, np.full(len(part), depth))
                yield pd.DataFrame({"cell": cell, "n": part["n"]})

    rows = prefixes.mapInPandas(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(cells, np.int64)
    for r in rows.toLocalIterator():
        out[r["cell"]] = r["n"]
    return out


def _packed(cols: list, depth: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted suffixes column by column: equal numbers stand together, and compress."""
    return zstandard.ZstdCompressor(level=3).compress(b"".join(x.tobytes() for x in (*cols, depth, n)))


def _unpacked(data: bytes, words: int):
    raw = zstandard.ZstdDecompressor().decompress(data)
    k = len(raw) // (8 * words + 9)
    cols = [np.frombuffer(raw, np.uint64, k, 8 * k * j) for j in range(words)]
    return [*cols, np.frombuffer(raw, np.uint8, k, 8 * k * words)], np.frombuffer(raw[(8 * words + 1) * k:], np.int64)


def _sent(corpus: DataFrame, know) -> DataFrame:
    """``grp, lang, suffixes``: distinct suffixes of a block of text, one row of
    packed numbers for each group."""
    def run(batches):
        s = know.value
        for pdf in batches:
            for lang, texts in _by_lang(pdf):
                for cols in s.cut(lang, texts):
                    rows, n = _added(cols)
                    depth = s.depth(lang, rows)
                    # what is shorter than its prefix has been counted with the heavy prefixes
                    length = np.sum([c != 0 for c in rows], axis=0)
                    keep = np.flatnonzero(length >= depth)
                    grp = s.groups(lang, [c[keep] for c in rows], depth[keep])
                    order = np.argsort(grp, kind="stable")
                    keep, grp = keep[order], grp[order]
                    if not len(grp):
                        continue
                    edges = np.flatnonzero(np.r_[True, grp[1:] != grp[:-1]])
                    rows, depth, n = [c[keep] for c in rows], depth[keep], n[keep]
                    yield pd.DataFrame({"grp": grp[edges], "lang": lang, "suffixes": [
                        _packed([c[a:b] for c in rows], depth[a:b], n[a:b]) for a, b in zip(edges, [*edges[1:], len(grp)])]})

    return corpus.mapInPandas(run, "grp long, lang string, suffixes binary")


def _subtrees(rules: PhraseRules):
    """The nodes of a group's subtrees that count, from its sorted suffixes."""
    words, least = rules.max_words, rules.min_count

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for lang, part in pdf.groupby("lang"):
            blocks = [_unpacked(x, words) for x in part["suffixes"]]
            leaves, n = _added([np.concatenate([cols[j] for cols, _ in blocks]) for j in range(words + 1)],
                               np.concatenate([n for _, n in blocks]))
            depth = leaves.pop()
            new = np.zeros(len(n), bool)
            new[:1] = True
            for k in range(words):
                new[1:] |= leaves[k][1:] != leaves[k][:-1]
                at = np.flatnonzero(new)
                totals = np.add.reduceat(n, at)
                # nodes above a group's prefix are heavy, and known
                hit = at[(totals >= least) & (leaves[k][at] != 0) & (depth[at] <= k + 1)] if k else at[:0]
                if len(hit):
                    path = np.stack([c[hit] for c in leaves[:k + 1]], 1).astype(np.int64)
                    out.append(pd.DataFrame({"lang": lang, "ids": list(path), "a": totals[np.searchsorted(at, hit)]}))
        return pd.concat(out) if out else pd.DataFrame({"lang": [], "ids": [], "a": []}, dtype=object)

    return run


def phrase_counts(docs: DataFrame, rules: PhraseRules = PhraseRules(), text: str = "text", lang: str = "lang"):
    """``(words, phrases)``: ``lang, word, id, n`` of all words (``id`` null for the
    rare ones), and ``lang, ids, a`` of all phrases of 2 to ``max_words`` words with
    ``min_count`` occurrences."""
    spark, corpus = docs.sparkSession, _corpus(docs, text, lang)
    words = cut(word_counts(corpus, rules))
    salt = _salt(words)
    number = F.xxhash64(F.concat("word", F.lit(" " * salt)))
    words = words.select("lang", "word", F.when(F.col("n") >= rules.min_count, number).alias("id"), "n")
    frequent = words.filter("id is not null")
    know = _Suffixes(salt, _table(frequent, rules.table_bits), rules)
    know.pairs = _pair_table(corpus, spark.sparkContext.broadcast(know), rules)
    fits, heavy = [], []
    level = frequent.select("lang", F.array("id").alias("ids"), "n")
    for depth in range(1, rules.max_words + 1):
        # as deep as the tree: a prefix is a leaf, whatever its count
        if depth == rules.max_words:
            fits.append(level)
            break
        over = level.filter(F.col("n") > rules.budget)
        fits.append(level.filter(F.col("n") <= rules.budget))
        found = over.toPandas()  # at most words / budget rows
        if not len(found):
            break
        heavy.append(over)
        know.add_heavy(found)
        sent = spark.sparkContext.broadcast(know)
        level = cut(_extended(corpus, sent, depth + 1).filter(F.col("n") >= rules.min_count))
        sent.unpersist()
    prefixes = fits[0]
    for part in fits[1:]:
        prefixes = prefixes.union(part)
    suffixes = prefixes.agg(F.sum("n")).first()[0] or 0
    cells = max(1, -(-suffixes // rules.budget))
    know.base, know.splits = np.arange(cells), np.ones(cells, np.uint64)
    loads = _loads(prefixes, spark.sparkContext.broadcast(know), cells)
    know.splits = np.maximum(1, -(-loads // rules.budget)).astype(np.uint64)
    know.base = np.cumsum(know.splits).astype(np.int64) - know.splits.astype(np.int64)
    groups = _sent(corpus, spark.sparkContext.broadcast(know)).groupBy("grp")
    phrases = groups.applyInPandas(_subtrees(rules), "lang string, ids array<long>, a long")
    for over in heavy[1:]:  # single words are no phrases
        phrases = phrases.union(over.select("lang", "ids", F.col("n").alias("a")))
    return words, cut(phrases)


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(38,0)")


def collocations(docs: DataFrame, rules: PhraseRules = PhraseRules(), text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's best phrases."""
    words, phrases = phrase_counts(docs, rules, text, lang)
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    parts = phrases.select("lang", "ids", F.col("a").alias("f")).union(
        words.filter("id is not null").select("lang", F.array("id").alias("ids"), F.col("n").alias("f")))
    # a phrase inside a longer one lies inside one that is a word longer, with at least the same count
    inner = [F.slice("ids", 1, F.size("ids") - 1), F.slice("ids", 2, F.size("ids") - 1)]
    longer = (phrases.filter(F.size("ids") > 2).select("lang", F.explode(F.array(*inner)).alias("ids"), "a")
              .groupBy("lang", "ids").agg(F.max("a").alias("longer")))
    kept = (phrases.join(longer, ["lang", "ids"], "left")
            .filter(F.col("longer").isNull() | (100 * F.col("longer") < rules.covered_percent * F.col("a"))).drop("longer"))
    cuts = kept.join(total, "lang").select("lang", "ids", "a", "n", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.withColumn("head", F.slice("ids", F.lit(1), F.col("k"))).withColumn("tail", F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")))
    for side, name in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(parts.select("lang", F.col("ids").alias(side), F.col("f").alias(name)), ["lang", side])
    product, below = F.lit(1000).cast("decimal(5,0)") * _exact("a") * _exact("n"), _exact("l") * _exact("r")
    scored = cuts.withColumn("over", product).withColumn("below", below).withColumn("score", F.expr("over div below"))
    worst = scored.groupBy("lang", "ids").agg(
        F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = _spelt(worst, words)
    order = Window.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    # row_number below a limit keeps the best rows of every task before they are moved
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= rules.top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n",
                    F.col("cut.score").cast("long").alias("score")))


def _spelt(rows: DataFrame, words: DataFrame) -> DataFrame:
    """``rows`` with ``phrase`` in place of word numbers."""
    names = words.filter("id is not null").select("lang", "id", "word")
    spelt = (rows.select("lang", "ids", F.posexplode("ids").alias("at", "id")).join(names, ["lang", "id"])
             .groupBy("lang", "ids").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("own")))
    return rows.join(spelt, ["lang", "ids"]).withColumn("phrase", F.array_join(F.col("own.word"), " ")).drop("own")


#: DuckDB SQL for the report with the default rules.
PHRASE_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, generate_subscripts(ps, 1) AS p, unnest(ps) AS t
  FROM (SELECT lang, doc_id, string_split_regex(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps
        FROM documents WHERE text <> '')),
ws AS (SELECT lang, list_filter(string_split_regex(t, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece),
spans AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM ws, range(1, 6) AS s(k) WHERE len(w) >= k),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM spans GROUP BY ALL),
tot AS (SELECT lang, sum(a)::HUGEINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE a >= 100 AND k >= 2),
inside AS (
  SELECT c.lang, array_to_string(c.w[i:i + m - 1], ' ') AS phrase, max(c.a) AS longer
  FROM c, range(2, 5) AS s(m), range(1, 5) AS o(i) WHERE m < c.k AND i + m - 1 <= c.k GROUP BY ALL),
kept AS (
  SELECT c.* FROM c LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a),
cuts AS (
  SELECT kept.lang, kept.phrase, kept.a, j, l.a AS l, r.a AS r, n,
         (1000 * kept.a::HUGEINT * n) // (l.a::HUGEINT * r.a::HUGEINT) AS score
  FROM kept JOIN tot USING (lang), range(1, 5) AS s(j)
  JOIN f l ON l.lang = kept.lang AND l.phrase = array_to_string(kept.w[1:j], ' ')
  JOIN f r ON r.lang = kept.lang AND r.phrase = array_to_string(kept.w[j + 1:], ' ')
  WHERE j < kept.k),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""
