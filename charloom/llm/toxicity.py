"""Toxicity by a subsequence string-kernel support vector machine.

The kernel of two strings counts their common subsequences of ``order``
characters, each weighted by ``decay`` to the power of its span in both, so
characters put between those of a word lower the value but don't end it.  A few
landmark strings map a token to Nystroem features; a linear support vector
machine is trained on them.  A sentence's value is that of its most toxic token,
a text's that of its most toxic sentence.

The machine is trained on the sentences of a bounded sample of labelled texts
(``sample_per_label`` texts of at most ``sample_chars`` characters for either
label, chosen by hashes of id and text).  A sentence of a clean text is clean; of a
toxic text, the sentences with a token that stands in many places of toxic texts
and in hardly any of clean ones are toxic, the others are left out.

Because the kernel is a sum over subsequences, the trained machine folds into
one weight per subsequence; a token is scored by its own subsequences.  Tokens
are scored once per worker (bounded cache), whole texts are read.

Tokens are blank-separated, lower-cased, without what is neither letter nor
digit (``i-d.i*ot``), look-alike digits and signs read as letters; runs of single
characters (``i d i o t``) are a token too.

Results in the odd cases: null, empty and token-less texts score what a token
without a weighted subsequence scores (far below the threshold); without a
labelled text of both kinds every text scores 0; null labels are not learned
from; an id with several labels gives its text once per distinct label; null ids
and repeated rows are carried through; extra columns are neither read nor
returned.
"""

from __future__ import annotations

import itertools
import re
from array import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from charloom.llm.common import prepare
from charloom.llm.langid import held_out_column


@dataclass(frozen=True)
class ToxicRules:
    order: int = 4
    #: a subsequence's first and last character lie less than so many places apart
    span: int = 7
    decay: float = 0.7
    landmarks: int = 800
    sample_per_label: int = 2000
    sample_chars: int = 20_000
    negatives: int = 12_000
    #: a telling token stands in so many different places of toxic texts at least, and in as many more as
    #: make chance less likely than exp(-evidence)
    min_places: int = 3
    evidence: float = 12.0
    #: longest token; longer ones are read in overlapping pieces
    longest: int = 24
    threshold: float = 0.7
    rounds: int = 30
    decay_weight: float = 1e-5
    cache: int = 500_000


#: 0 opens and 31 closes a token, 1-26 are letters, 27-30 other characters
_ALPHABET = 32
#: digits and signs that stand for letters
_ALIKE = str.maketrans("013457@$", "oieastas")
_JUNK = re.compile(r"[\W_]+")
_ENDS = re.compile(r"^[\W_]+|[\W_]+$")
_SPELT = re.compile(r"(?<!\S)\w(?:[^\S\n]+\w){2,}(?!\S)")
_SENTENCE = re.compile(r"[.!?\n]+\s*")


def tokens_of(text: str) -> set[str]:
    """Distinct tokens, and runs of single characters as one, not yet cleaned."""
    return {*text.split(), *("".join(run.split()) for run in _SPELT.findall(text))}


def _ordered(text: str) -> list[str]:
    """The same tokens in order, runs of single characters joined."""
    return _SPELT.sub(lambda m: "".join(m[0].split()), text).split()


def clean(token: str) -> str:
    return _JUNK.sub("", _ENDS.sub("", token).lower().translate(_ALIKE))


def _codes(tokens: list[str], length: int) -> np.ndarray:
    raw = np.frombuffer("".join(tokens).encode("utf-32-le", "replace"), "<u4").reshape(len(tokens), length).astype(np.int64)
    codes = np.full((len(tokens), length + 2), _ALPHABET - 1)
    codes[:, 0], codes[:, 1:-1] = 0, np.where((raw >= 97) & (raw < 123), raw - 96, 27 + raw % 4)
    return codes


class Subsequences:
    """Span-weighted subsequences of ``order`` characters of equally long tokens."""

    def __init__(self, length: int, order: int, span: int, decay: float):
        self.places = np.array([(i, *rest) for i in range(length) for rest in itertools.combinations(
            range(i + 1, min(length, i + span)), order - 1)], int).reshape(-1, order)
        self.weight = decay ** (self.places[:, -1] - self.places[:, 0] + 1) if len(self.places) else np.zeros(0)

    def ids(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(codes), len(self.places)), np.int64)
        for column in self.places.T:
            out = out * _ALPHABET + codes[:, column]
        return out


def profiles(tokens: list[str], rules: ToxicRules, at_once: int = 4_000_000):
    """Per token: ids of its distinct subsequences and their summed weights,
    scaled to kernel(token, token) = 1.  Yields (index array, ids, weights)."""
    by_length: dict[int, list[int]] = {}
    for i, t in enumerate(tokens):
        by_length.setdefault(len(t), []).append(i)
    for length, index in by_length.items():
        if length + 2 < rules.order or not length:
            continue
        sub = Subsequences(length + 2, rules.order, rules.span, rules.decay)
        step = max(1, at_once // len(sub.weight))
        for at in range(0, len(index), step):
            own = index[at:at + step]
            ids = sub.ids(_codes([tokens[i] for i in own], length))
            order = np.argsort(ids, axis=1, kind="stable")
            ids, weight = np.take_along_axis(ids, order, 1), sub.weight[order]
            new = np.ones(ids.shape, bool)
            new[:, 1:] = ids[:, 1:] != ids[:, :-1]
            flat = np.cumsum(new.ravel()) - 1
            total = np.bincount(flat, weight.ravel())
            row = np.repeat(np.arange(len(own)), new.sum(1))
            norm = np.sqrt(np.bincount(row, total ** 2, minlength=len(own)))
            yield np.array(own), row, ids[new], total / norm[row]


@dataclass
class ToxicModel:
    table: np.ndarray  # weight per subsequence
    slope: float
    shift: float
    rules: ToxicRules

    def token_values(self, tokens: list[str]) -> np.ndarray:
        out = np.zeros(len(tokens))
        for index, row, ids, weight in profiles(tokens, self.rules):
            out[index] = np.bincount(row, self.table[ids] * weight, minlength=len(index))
        return out

    def score(self, value: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * value + self.shift, -30, 30))))


class TextScorer:
    """Scores of texts; values of raw tokens are remembered."""

    def __init__(self, model: ToxicModel):
        self.model, self.values = model, {}

    def _pieces(self, token: str) -> list[str]:
        t, n = clean(token), self.model.rules.longest
        return [t] if len(t) <= n else [t[i:i + n] for i in range(0, len(t) - n // 2, n // 2)]

    def best(self, texts: list[str]) -> list[float]:
        found = [tokens_of(t) for t in texts]
        new = set().union(*found).difference(self.values) if found else set()
        if len(self.values) + len(new) > self.model.rules.cache:
            self.values = {}
            new = set().union(*found)
        new = list(new)
        for at in range(0, len(new), 100_000):
            own = new[at:at + 100_000]
            pieces = [(i, p) for i, t in enumerate(own) for p in self._pieces(t)]
            value = np.zeros(len(own))
            np.maximum.at(value, [i for i, _ in pieces], self.model.token_values([p for _, p in pieces]))
            self.values.update(zip(own, value.tolist()))
        return [max(map(self.values.__getitem__, f), default=0.0) for f in found]


def sampled_ids(labels: DataFrame, rules: ToxicRules, doc_id: str = "doc_id", label: str = "toxic") -> DataFrame:
    """``id, y``: for either label twice ``sample_per_label`` ids, the first by a
    hash.  A bounded table, whatever the labels: it may be broadcast."""
    own = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")).filter(
        F.col("id").isNotNull() & F.col("y").isin(0, 1)).distinct()
    first = [own.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(2 * rules.sample_per_label) for y in (0, 1)]
    return first[0].union(first[1])


def _sample(docs: DataFrame, ids: DataFrame, rules: ToxicRules, text: str, doc_id: str) -> dict[int, list[str]]:
    """Texts of a bounded table of ids, for either label the first ``sample_per_label``
    distinct ones by a hash.  Documents are not shuffled."""
    own = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).filter(
        F.col("text").isNotNull() & (F.length("text") <= rules.sample_chars))
    rows = own.join(F.broadcast(ids), F.col("doc") == F.col("id")).select("y", "text", F.xxhash64("text").alias("u"))
    out: dict[int, dict[str, None]] = {0: {}, 1: {}}
    for r in rows.orderBy("u", "y").toLocalIterator():
        if len(out[r["y"]]) < rules.sample_per_label:
            out[r["y"]][r["text"]] = None
    return {y: list(texts) for y, texts in out.items()}


class Kernel:
    """Kernel values of tokens with a list of landmarks, a few tokens at a time."""

    def __init__(self, landmarks: list[str], rules: ToxicRules):
        self.rules, self.lookup = rules, np.full(_ALPHABET ** rules.order, -1, np.int32)
        found = list(profiles(landmarks, rules))
        self.ids = np.unique(np.concatenate([ids for _, _, ids, _ in found]))
        self.lookup[self.ids] = np.arange(len(self.ids))
        self.by_id = np.zeros((len(self.ids), len(landmarks)), np.float32)
        for index, row, ids, weight in found:
            self.by_id[self.lookup[ids], index[row]] = weight

    def values(self, tokens: list[str]) -> np.ndarray:
        out = np.zeros((len(tokens), self.by_id.shape[1]), np.float32)
        for index, row, ids, weight in profiles(tokens, self.rules, 400_000):
            at = self.lookup[ids]
            row, at, weight = row[at >= 0], at[at >= 0], weight[at >= 0]
            ends = np.searchsorted(row, np.arange(0, len(index) + 64, 64))
            for i, (lo, hi) in enumerate(zip(ends, ends[1:])):
                if lo < hi:
                    starts = np.flatnonzero(np.r_[True, row[lo + 1:hi] != row[lo:hi - 1]])
                    out[index[row[lo:hi][starts]]] = np.add.reduceat(self.by_id[at[lo:hi]] * weight[lo:hi, None], starts)
        return out


class _Places:
    """Tokens of texts as numbers; a token's places count once per neighbours."""

    def __init__(self):
        self.raw: dict[str, int] = {}
        self.ids: dict[str, int] = {"": 0}

    def _id(self, raw: str) -> int:
        if raw not in self.raw:
            self.raw[raw] = self.ids.setdefault(clean(raw), len(self.ids))
        return self.raw[raw]

    def read(self, texts: list[str]) -> tuple[list[array], np.ndarray]:
        """Sentences, and the distinct places of tokens as one number each: 23 bits for
        the token, 40 that tell its neighbours."""
        sentences = [array("q", map(self._id, _ordered(s))) for t in texts for s in _SENTENCE.split(t)]
        flat = np.concatenate([np.zeros(1, np.int64), *(np.r_[np.array(s, np.int64), 0] for s in sentences)])
        keys = (flat[1:-1] << 40) + ((flat[:-2] * 1_000_003 + flat[2:]) & ((1 << 40) - 1))
        return sentences, np.unique(keys[flat[1:-1] > 0])


def fit_toxicity(docs: DataFrame, labels: DataFrame, rules: ToxicRules = ToxicRules(), text: str = "text",
                 doc_id: str = "doc_id", label: str = "toxic") -> ToxicModel | None:
    """Model from ``docs`` and their ``labels`` (1 toxic, 0 not); None without both."""
    return train(_sample(docs, sampled_ids(labels, rules, doc_id, label), rules, text, doc_id), rules)


def train(sample: dict[int, list[str]], rules: ToxicRules = ToxicRules()) -> ToxicModel | None:
    """Model from toxic (1) and clean (0) texts."""
    if not sample[0] or not sample[1]:
        return None
    places = _Places()
    sentences, toxic_places = places.read(sample[1])
    _, clean_places = places.read(sample[0])
    names = list(places.ids)
    in_toxic, in_clean = (np.bincount(k >> 40, minlength=len(names)) for k in (toxic_places, clean_places))
    # by chance a token's places would all be in toxic texts with probability share ** places
    share = len(toxic_places) / max(1, len(toxic_places) + len(clean_places))
    if not 0 < share < 1:
        return None
    enough = max(rules.min_places, rules.evidence / -np.log(share))
    size = np.array([len(w) for w in names])
    telling = ((size >= rules.order) & (size <= rules.longest) & (in_toxic >= enough)
               & (in_clean * 50 < in_toxic * (1 - share) / share))
    # the token that makes a toxic sentence so: the most frequent telling one
    toxic: Counter = Counter()
    for own in sentences:
        if own := [i for i in own if telling[i]]:
            toxic[names[max(own, key=lambda i: (in_toxic[i], names[i]))]] += 1
    if not toxic:
        return None
    negatives = [names[i] for i in np.lexsort((np.arange(len(names)), -in_clean))
                 if in_clean[i] and rules.order <= size[i] <= rules.longest and names[i] not in toxic]
    half = rules.negatives // 2  # the most frequent ones, and an even draw of the others
    negatives = negatives[:half] + negatives[half::max(1, (len(negatives) - half) // max(1, half))][:half]
    # toxic words may come with a character put in, but one that lacks a character is another word
    words = list(toxic)
    gapped = [w[:i] + "xeoinatsr"[i % 9] + w[i:] for w in words if len(w) < rules.longest for i in range(1, len(w))]
    shorter = {w[:i] + w[i + 1:] for w in words for i in range(len(w))} - set(toxic) - set(negatives)
    negatives += sorted(w for w in shorter if len(w) >= rules.order)
    # landmarks: toxic tokens by frequency, then the negatives that are most like one of them
    landmarks = [w for w, _ in toxic.most_common(rules.landmarks // 3)]
    like = Kernel(landmarks, rules).values(negatives).max(1)
    landmarks += [negatives[i] for i in np.argsort(-like, kind="stable")[:rules.landmarks - len(landmarks)]]
    kernel = Kernel(landmarks, rules)
    values, vectors = np.linalg.eigh(kernel.values(landmarks).astype(float))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-4))) @ vectors.T
    x = kernel.values(words + gapped + negatives) @ root.astype(np.float32)  # Nystroem features
    n_toxic = len(words) + len(gapped)
    y = np.r_[np.ones(n_toxic), -np.ones(len(negatives))]
    near = np.r_[np.zeros(n_toxic, bool), like > 0.4]  # half of the clean side's say
    say = np.where(y > 0, 0.5 / n_toxic, np.where(near, 0.25 / max(1, near.sum()), 0.25 / max(1, (y < 0).sum() - near.sum())))
    # squared hinge loss with weight decay, by Newton steps over the rows inside the margin
    x, w = np.c_[x, np.ones((len(x), 1), np.float32)], np.zeros(x.shape[1] + 1)
    for _ in range(rules.rounds):
        gram, pull = rules.decay_weight * np.eye(len(w)), np.zeros(len(w))
        for at in range(0, len(x), 1024):
            own = slice(at, at + 1024)
            rows = x[own].astype(float)
            inside = y[own] * (rows @ w) < 1
            rows = rows[inside]
            weighted = rows * say[own][inside, None]
            gram += weighted.T @ rows
            pull += weighted.T @ y[own][inside]
        new = np.linalg.solve(gram, pull)
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    w = w[:-1]
    table = np.zeros(_ALPHABET ** rules.order, np.float32)
    table[kernel.ids] = kernel.by_id @ (root @ w)
    model = ToxicModel(table, 1.0, 0.0, rules)
    # threshold between what clean sentences reach and what toxic tokens have
    others = [names[i] for i in np.flatnonzero((in_clean > 0) & ~telling & (size > 0) & (size <= rules.longest))]
    low = np.quantile(model.token_values(others), 0.9999) if others else 0.0
    high = np.quantile(model.token_values(words + gapped), 0.1)
    middle = min(high, (low + high) / 2)
    model.slope = 4.0 / max(0.1, high - middle)
    odds = float(np.log(rules.threshold / (1 - rules.threshold)))
    model.shift = odds - model.slope * middle
    return model


def toxicity_scores(docs: DataFrame, model: ToxicModel | None, text: str = "text", doc_id: str = "doc_id",
                    threshold: float | None = None) -> DataFrame:
    """``doc_id, score, predicted`` for every row, from the text alone."""
    prepare(docs.sparkSession)
    limit = (model.rules.threshold if model else 0.7) if threshold is None else threshold
    sent = docs.sparkSession.sparkContext.broadcast(model)  # one weight per subsequence: bounded by the alphabet
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        scorer = TextScorer(sent.value) if sent.value else None
        for b in batches:
            for at in range(0, b.num_rows, 256):
                own = b.slice(at, 256)
                values = scorer.best([t.as_py() or "" for t in own.column(1)]) if scorer else []
                scores = [scorer.model.score(v) for v in values] if scorer else [0.0] * own.num_rows
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= limit) for s in scores], pa.int32())],
                    names=["doc_id", "score", "predicted"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, predicted int")


def held_out_toxicity(docs: DataFrame, labels: DataFrame, rules: ToxicRules = ToxicRules(), parts: int = 3,
                      part: int = 1) -> DataFrame:
    """Fits on the labelled rows that are not held out, scores all:
    ``doc_id, held_out, score, predicted``."""
    learned = labels.filter(~held_out_column(F.col("doc_id"), parts, part))
    model = fit_toxicity(docs, learned, rules)
    return toxicity_scores(docs, model).select(
        "doc_id", held_out_column(F.col("doc_id"), parts, part).alias("held_out"), "score", "predicted")
