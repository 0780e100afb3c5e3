"""Language identification by error-correcting output codes.

Every language gets a binary codeword; for each bit a logistic classifier on
hashed character n-grams tells the languages with that bit from the others.  A
text's language is the one whose codeword has the least loss, bits weighted by
the margin of their classifiers; a text whose two nearest codewords lie almost
equally near is flagged as ambiguous.

The classifiers are fitted on a bounded sample of labelled texts:
``sample_per_language`` texts for each language, fewer where there are so many
languages that they would pass ``sample_rows``, but at least one; chosen by a hash of
the text, copies of a text count once.  A text of over ``sample_chars``
characters gives an excerpt of that length from a place told by its hash.  Every
language that has a text is learned.  Predictions read whole texts and nothing else.

Results in the odd cases: a null text, or one without a letter, is ``und`` with
score 1 and not ambiguous; with no labelled text at all every text is ``und``
with score 0; with one language every other text has that language; null ids
are never held out nor learned from; repeated rows are carried through row by
row; extra columns are neither read nor returned.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from charloom.llm.common import prepare

UNKNOWN = "und"


@dataclass(frozen=True)
class LangRules:
    features: int = 4096
    orders: tuple = (1, 2, 3)
    sample_per_language: int = 500
    sample_rows: int = 8192
    sample_chars: int = 20_000
    rounds: int = 250
    rate: float = 8.0
    #: flagged if the best codeword is ahead of the next by less than this share of a probability
    ambiguous: float = 0.2


def codewords(n: int) -> np.ndarray:
    """One row of +1/-1 per class: all splits of up to 5 classes, else random rows
    (fixed seed) of 10 log2 n bits, the most distant of several draws."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 5:
        bits = range(2 ** (n - 1) - 1)
        return np.array([[1 if c == 0 or (b >> (c - 1)) & 1 else -1 for b in bits] for c in range(n)], float)
    rng = np.random.default_rng(11)
    width = math.ceil(10 * math.log2(n))
    draws = [rng.choice([-1.0, 1.0], (n, width)) for _ in range(64)]
    return max(draws, key=lambda m: np.min(width - np.triu(np.abs(m @ m.T), 1).max()))


def gram_counts(texts: list[str], rules: LangRules) -> np.ndarray:
    """Hashed n-gram counts, a row per text; runs of other characters than letters
    count as one blank.  Long texts are read in pieces that hand over their last
    characters, so every n-gram counts once and memory stays bounded."""
    out = np.zeros((len(texts), rules.features), np.float32)
    step, longest = 200_000, max(rules.orders)
    for row, text in enumerate(texts):
        last = np.zeros(0, np.uint32)
        for at in range(0, len(text), step):
            c = np.frombuffer(text[at:at + step].lower().encode("utf-32-le", "replace"), "<u4").astype(np.uint32)
            c = np.concatenate([last, np.where(_IS_LETTER[np.minimum(c, 0xFFFF)], c, np.uint32(32))])
            old = len(last)
            keep = np.r_[True, (c[1:] != 32) | (c[:-1] != 32)]
            keep[:old] = True
            c, h = c[keep], np.zeros(keep.sum(), np.uint32)
            for n in range(1, longest + 1):
                if len(c) < n:
                    break
                h = (h[:len(c) - n + 1] * np.uint32(0x01000193)) ^ (c[n - 1:] * np.uint32(0x9E3779B1))
                if n in rules.orders:
                    new = h[max(0, old - n + 1):]  # those that end in this piece
                    mixed = (new ^ (new >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(7)
                    out[row] += np.bincount(mixed % np.uint32(rules.features), minlength=rules.features)
            last = c[max(0, len(c) - (longest - 1)):]
    return out


#: letters among the first 65,536 code points (later ones count as one letter class)
_IS_LETTER = np.array([chr(i).isalpha() for i in range(0xD800)] + [False] * 0x800 + [chr(i).isalpha() for i in range(0xE000, 0xFFFF)] + [True])


def scaled(counts: np.ndarray) -> np.ndarray:
    x = np.sqrt(counts)
    return x / np.maximum(1e-9, np.sqrt((x ** 2).sum(1, keepdims=True)))


@dataclass
class LangModel:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    rules: LangRules

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        out = []
        for at in range(0, len(texts), 32):
            own = texts[at:at + 32]
            margins = scaled(gram_counts([t or "" for t in own], self.rules)) @ self.weights + self.bias
            # logistic loss of each codeword's bits, each bit weighted by its margin's size
            loss = np.log1p(np.exp(-margins[:, None, :] * self.code[None]))
            weight = np.abs(margins) / np.maximum(1e-9, np.abs(margins).sum(1, keepdims=True))
            total = (loss * weight[:, None, :]).sum(2)
            p = np.exp(-4 * (total - total.min(1, keepdims=True)))
            p /= p.sum(1, keepdims=True)
            best = p.argmax(1)
            for t, b, row in zip(own, best, p):
                if not t or not any(map(str.isalpha, t)):
                    out.append((UNKNOWN, 1.0, False))
                    continue
                top = np.sort(row)[::-1]
                out.append((self.languages[b], float(row[b]), bool(len(top) > 1 and top[0] - top[1] < self.rules.ambiguous)))
        return out


def held_out_column(doc_id, parts: int, part: int):
    """crc32(doc_id as text) mod ``parts`` is ``part``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def fit_languages(docs: DataFrame, rules: LangRules = LangRules(), text: str = "text", lang: str = "lang") -> LangModel:
    """Model from the labelled rows of ``docs`` (null labels and texts are left out)."""
    own = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    # a row per language
    sizes = {r["lang"]: r["n"] for r in own.select("lang", F.xxhash64("text")).distinct()
             .groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return LangModel([], np.ones((0, 1)), np.zeros((rules.features, 1)), np.zeros(1), rules)
    wanted = max(1, min(rules.sample_per_language, rules.sample_rows // len(sizes)))
    # distinct texts below a hash threshold per language, twice as many as wanted at most in expectation; then the first of them
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[x for k, n in sizes.items()
                           for x in (F.lit(k), F.lit(min(1.0, (2.0 * wanted + 20) / n)))])
    place = F.pmod(F.xxhash64(F.lit("place"), "text"), F.greatest(F.length("text") - rules.sample_chars, F.lit(0)) + 1).cast("int") + 1
    excerpt = F.when(F.length("text") > rules.sample_chars, F.substring("text", place, rules.sample_chars)).otherwise(F.col("text"))
    rows = (own.withColumn("u", draw).filter(F.col("u") < share[F.col("lang")]).dropDuplicates(["lang", "text"])
            .select("lang", "u", excerpt.alias("text")))
    picked: dict[str, list[str]] = {k: [] for k in sizes}
    for r in rows.orderBy("u", "lang").toLocalIterator():
        if len(picked[r["lang"]]) < wanted:
            picked[r["lang"]].append(r["text"])
    if not any(picked.values()):
        return LangModel([], np.ones((0, 1)), np.zeros((rules.features, 1)), np.zeros(1), rules)
    languages = sorted(sizes)
    x = np.concatenate([scaled(gram_counts(picked[k], rules)) for k in languages if picked[k]])
    label = np.concatenate([np.full(len(picked[k]), i) for i, k in enumerate(languages) if picked[k]]).astype(int)
    code = codewords(len(languages))
    y, w, b = code[label], np.zeros((rules.features, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    # equal say for every language
    say = (1.0 / np.bincount(label, minlength=len(languages)))[label][:, None] / len(languages)
    for _ in range(rules.rounds):
        pull = say * y / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30)))
        w += rules.rate * (x.T @ pull - 1e-5 * w)
        b += rules.rate * 0.1 * pull.sum(0)
    return LangModel(languages, code, w.astype(np.float32), b, rules)


def identify(docs: DataFrame, model: LangModel, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, lang_pred, score, ambiguous`` for every row, from the text alone."""
    spark = docs.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(model)  # features x bits: bounded by the rules
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        m = sent.value
        for b in batches:
            texts = [t.as_py() for t in b.column(1)]
            found = m.predict(texts) if m.languages else [
                (UNKNOWN, 0.0 if t and any(map(str.isalpha, t)) else 1.0, False) for t in texts]
            lang, score, ambiguous = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(ambiguous, pa.bool_())],
                names=[key, "lang_pred", "score", "ambiguous"])

    return docs.select(F.col(key), F.col(text).alias("_text")).mapInArrow(
        run, f"`{key}` {kind}, lang_pred string, score double, ambiguous boolean")


def language_predictions(docs: DataFrame, rules: LangRules = LangRules(), text: str = "text", lang: str = "lang",
                         doc_id: str = "doc_id", parts: int = 4, part: int = 2) -> DataFrame:
    """Fits on the rows that are not held out, predicts all: ``doc_id, held_out,
    lang_pred, score, ambiguous``."""
    model = fit_languages(docs.filter(~held_out_column(F.col(doc_id), parts, part) & F.col(doc_id).isNotNull()),
                          rules, text, lang)
    return identify(docs, model, text, doc_id).select(
        F.col(doc_id).alias("doc_id"), held_out_column(F.col(doc_id), parts, part).alias("held_out"),
        "lang_pred", "score", "ambiguous")


def apply_language(docs: DataFrame, rules: LangRules = LangRules(), text: str = "text", lang: str = "lang",
                   doc_id: str = "doc_id", parts: int = 4, part: int = 2) -> DataFrame:
    """The documents with a language (all columns); ``und`` is rejected.  Texts
    that mix languages are flagged by :func:`identify` but stay."""
    model = fit_languages(docs.filter(~held_out_column(F.col(doc_id), parts, part) & F.col(doc_id).isNotNull()),
                          rules, text, lang)
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        for b in batches:
            m = sent.value
            texts = [t.as_py() for t in b.column(at)]
            keep = ([p[0] != UNKNOWN for p in m.predict(texts)] if m.languages
                    else [bool(t) and any(map(str.isalpha, t)) for t in texts])
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
