"""Harmonic packing of token sequences.

A piece of length l belongs to class k = capacity // l: its length is at most
1/k of the capacity, so any k pieces of a class fill one sequence.  Documents
longer than the capacity are cut into full sequences; a rest that would waste
more than ``1/max_waste`` of itself in its class is cut once more at the next
class's slot, which fills that slot exactly.

Every task tokenises its documents and fills the sequences of each class by
itself, k pieces at a time; which document lies where needs no exchange.  Only
the fewer than k pieces per class that a task has over go through a shuffle:
they are numbered per class over all tasks and fill sequences k at a time
again.  What is over then (fewer than k pieces per class in all: a number that
the capacity bounds, whatever the input) is packed first-fit by length.

Results in the odd cases: a null text counts as empty; an empty text is one
piece that holds the end token; null ids are carried through; repeated rows are
packed once each; extra columns are neither read nor returned.
"""

from __future__ import annotations

import zlib
from array import array
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from charloom.llm.common import Remembered, cut, prepare


@dataclass(frozen=True)
class PackRules:
    capacity: int = 2048
    end_id: int = 1
    max_waste: int = 32
    #: words whose ids a worker remembers
    cache: int = 800_000


def cut_lengths(n: int, capacity: int, max_waste: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if (capacity // k - rest) * max_waste <= rest:
            out.append(rest)
            break
        slot = capacity // (k + 1)
        out.append(slot)
        rest -= slot
    return out


class WordEncoder:
    """Ids of a text by the ``tokenizers`` library, word by word with a cache.

    The tokenizer drops white space and lets no token cross it, so the ids of a
    text are those of its blank-separated parts in order.  Parts of printable
    ASCII and precomposed Latin-1 letters (which no normalisation changes but for
    case) are lower-cased and split here and their pieces go to the library's
    model; any other part goes through the library whole, and so does a text
    that spells a special token."""

    LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"

    def __init__(self, tokenizer_json: str, cache: int):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json
        import re
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # the file's own pattern, for these characters
        rule = json.loads(tokenizer_json)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = re.compile(rule.replace(r"\p{L}", self.LETTERS).replace(r"\p{N}", "0-9")).findall
        self.plain = re.compile(f"[!-~{self.LETTERS}]*").fullmatch
        # the byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self.alphabet = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in shown)}
        self.pieces = Remembered(self._piece, cache)
        self.words = Remembered(self._word, cache)

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        if self.plain(word):
            return b"".join(map(self.pieces.__getitem__, self.split(word.lower())))
        return self._whole(word)

    def encode(self, text: str) -> bytes:
        """Unsigned 32-bit ids (little-endian, as every platform that Spark's Arrow runs on)."""
        if any(s in text for s in self.special):
            return self._whole(text)
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


_ENCODERS: dict = {}


def _pieces(docs: DataFrame, tokenizer_path: str, rules: PackRules, text: str, doc_id: str) -> DataFrame:
    """All pieces; those of sequences that a task filled by itself with
    ``sequence_id`` and ``offset``, the others with their class."""
    prepare(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary: bounded, a few MB
    capacity, end = rules.capacity, rules.end_id.to_bytes(4, "little")
    kind = docs.schema[doc_id].dataType
    schema = (f"doc_id {kind.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long, class int, part int, place long")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "class", "part", "place"]

    def run(batches):
        key = (tokenizer_path, rules)
        if key not in _ENCODERS:
            _ENCODERS[key] = WordEncoder(spec.value, rules.cache)
        encoder = _ENCODERS[key]
        part = TaskContext.get().partitionId()
        filled, waiting, arrow = 0, {}, None

        def rows(values):
            cols = list(zip(*values)) if values else [()] * len(names)
            types = [arrow, *[pa.int64()] * 6, pa.int32(), pa.int32(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

        for b in batches:
            arrow = b.schema.field(0).type
            out = []
            for d, t in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encoder.encode(t.as_py() or "") + end
                n, start = len(ids) // 4, 0
                for length in cut_lengths(n, capacity, rules.max_waste):
                    crc = zlib.crc32(memoryview(ids)[4 * start:4 * (start + length)])
                    k = capacity // length
                    bin_ = waiting.setdefault(k, [])
                    bin_.append((d, start, length, crc, n))
                    start += length
                    if len(bin_) == k:  # this class's sequence is full
                        offset = 0
                        for p in bin_:
                            out.append((*p, (part + 2 << 33) + filled, offset, k, part, None))
                            offset += p[2]
                        filled += 1
                        waiting[k] = []
            yield rows(out)
        if arrow is not None:
            yield rows([(*p, None, None, k, part, i) for k, bin_ in waiting.items() for i, p in enumerate(bin_)])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def _number(over: DataFrame) -> DataFrame:
    """``at``: place of a piece in its class over all tasks; ``in_class``: pieces of the class."""
    counts = over.groupBy(F.col("class").alias("c_class"), F.col("part").alias("c_part")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("c_class").orderBy("c_part")
    counts = counts.select(
        "c_class", "c_part",
        (F.sum("n").over(before) - F.col("n")).alias("first"),
        F.sum("n").over(Window.partitionBy("c_class")).alias("in_class"))
    return (over.join(counts, (F.col("class") == F.col("c_class")) & (F.col("part") == F.col("c_part")))
            .withColumn("at", F.col("first") + F.col("place")).drop("c_class", "c_part", "first"))


def pack_documents(docs: DataFrame, tokenizer_path: str, rules: PackRules = PackRules(), text: str = "text",
                   doc_id: str = "doc_id") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``.  Sequence ids are unique, not dense."""
    capacity = rules.capacity
    pieces = cut(_pieces(docs, tokenizer_path, rules, text, doc_id))
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    done = pieces.filter("sequence_id is not null").select(*cols)
    over = _number(pieces.filter("sequence_id is null").drop("sequence_id", "offset"))
    full = F.col("at") < F.col("in_class") - F.col("in_class") % F.col("class")
    number = F.floor(F.col("at") / F.col("class")).cast("long")
    inside = Window.partitionBy("sequence_id").orderBy("at")
    second = (over.filter(full)
              .withColumn("sequence_id", F.lit(1 << 33) + number * (capacity + 1) + F.col("class"))
              .withColumn("offset", (F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, 0))
                                     - F.col("length"))).select(*cols))

    def first_fit(pdf):
        pdf = pdf.sort_values(["length", "class", "at"], ascending=[False, True, True], kind="stable")
        room, seq, off = [], [], []
        for n in pdf["length"]:
            i = next((i for i, r in enumerate(room) if r >= n), len(room))
            if i == len(room):
                room.append(capacity)
            seq.append(i)
            off.append(capacity - room[i])
            room[i] -= n
        return pdf.assign(sequence_id=seq, offset=off)[cols]

    # fewer than k pieces of each class k <= capacity: bounded by the capacity alone
    rest = over.filter(~full).withColumn("all", F.lit(0))
    kind = docs.schema[doc_id].dataType.simpleString()
    last = rest.groupBy("all").applyInPandas(
        first_fit, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return done.union(second).union(last)
