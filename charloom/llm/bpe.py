"""Byte-level BPE by a sentencepiece model written from a rank file.

The model's pieces are the vocabulary's byte strings with every byte mapped to
one character, scored by negative rank: sentencepiece merges the best-scored
neighbours first, which is the merge order of the ranks.  No normalisation, no
dummy prefix; ids are the ranks.  Pre-tokens are encoded one by one (nothing
merges across them) and remembered per worker; decoding looks up each id's
bytes.

Results in the odd cases: null and empty texts have no ids (digests of the
empty string); null ids and repeated rows are carried through row by row; a
text of any length is encoded whole; extra columns are neither read nor
returned.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from charloom.llm.common import Remembered, prepare

#: one character per byte; outside the characters that sentencepiece treats apart
FIRST_CHAR = 0x4E00
_MAP = {i: chr(FIRST_CHAR + i) for i in range(256)}


def read_ranks(path: str) -> list[bytes]:
    """Byte strings in rank order from a ``tiktoken`` file (base64 and rank per line)."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranks = {int(r): base64.b64decode(b) for b, r in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks are not 0..n-1")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def to_chars(b: bytes) -> str:
    return b.decode("latin-1").translate(_MAP)


def sentencepiece_model(pieces: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model whose id of ``pieces[i]`` is i; the
    unknown piece, which byte-mapped text never needs, comes after them."""
    float_ = lambda x: _varint(2 << 3 | 5) + struct.pack("<f", x)
    out = [_field(1, _field(1, to_chars(p).encode()) + float_(-float(i))) for i, p in enumerate(pieces)]
    out.append(_field(1, _field(1, b"<unk>") + float_(0.0) + _field(3, 2)))
    trainer = _field(3, 2) + _field(4, len(pieces) + 1) + _field(40, len(pieces))
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(out) + _field(2, trainer) + _field(3, normalizer)


class _Crossing(Exception):
    """A blank beside other white space: a pre-token may cross it."""


class ByteBpe:
    """Encoder and decoder of one vocabulary, with caches.

    A single blank between two other characters starts a pre-token under any
    pattern that lets a blank lead a word, so the parts between such blanks are
    split and encoded on their own and remembered; a text where a blank meets
    other white space is split by the pattern as a whole."""

    def __init__(self, model: bytes, pieces: list[bytes], pattern: str, cache: int = 300_000):
        import regex
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces, self.split = pieces, regex.compile(pattern).findall
        self.whole = {p: [i] for i, p in enumerate(pieces)}
        self.tokens = Remembered(self._token, cache)
        self.parts = Remembered(self._part, cache)
        self.leads = " " in "".join(self.split("a b")[1:])  # the pattern joins a blank to the next word

    def _token(self, token: str) -> list[int]:
        raw = token.encode("utf-8", "replace")
        # a pre-token that is a piece is that piece, merges or not
        return self.whole.get(raw) or self.model.encode(to_chars(raw))

    def _part(self, part: str) -> tuple[int, ...]:
        if part == " " or part[1:2].isspace() or part[-1].isspace():
            raise _Crossing
        return tuple(chain.from_iterable(map(self.tokens.__getitem__, self.split(part))))

    def encode(self, text: str) -> list[int]:
        if self.leads and text[:1].strip() and text[-1:].strip():
            first, *rest = text.split(" ")
            try:
                if first[-1].isspace():
                    raise _Crossing
                return list(chain(chain.from_iterable(map(self.tokens.__getitem__, self.split(first))),
                                  chain.from_iterable(map(self.parts.__getitem__, [" " + p for p in rest]))))
            except _Crossing:
                pass
        return list(chain.from_iterable(map(self.tokens.__getitem__, self.split(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


_MODELS: dict = {}


def _codec(spec, pattern: str, cache: int, key) -> ByteBpe:
    if key not in _MODELS:
        model, pieces = spec.value
        _MODELS[key] = ByteBpe(model, pieces, pattern, cache)
    return _MODELS[key]


def _broadcast(docs: DataFrame, path: str):
    prepare(docs.sparkSession)
    pieces = read_ranks(path)  # a vocabulary: bounded, a few MB
    return docs.sparkSession.sparkContext.broadcast((sentencepiece_model(pieces), pieces))


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", doc_id: str = "doc_id",
                     cache: int = 300_000) -> DataFrame:
    """``doc_id, ids`` (array of int) of every row."""
    spec, kind = _broadcast(docs, path), docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        codec = _codec(spec, pattern, cache, (path, pattern, cache))
        for b in batches:
            for at in range(0, b.num_rows, 64):
                own = b.slice(at, 64)
                ids = pa.array([codec.encode(t.as_py() or "") for t in own.column(1)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([own.column(0), ids], names=["doc_id", "ids"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", doc_id: str = "doc_id",
                     cache: int = 300_000) -> DataFrame:
    """``doc_id, text_bytes`` (binary) of every row of ids; null ids give null."""
    spec, kind = _broadcast(encoded, path), encoded.schema[doc_id].dataType.simpleString()

    def run(batches):
        codec = _codec(spec, pattern, cache, (path, pattern, cache))
        for b in batches:
            for at in range(0, b.num_rows, 64):
                own = b.slice(at, 64)
                out = [None if x is None else codec.decode(x) for x in own.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([own.column(0), pa.array(out, pa.binary())],
                                                 names=["doc_id", "text_bytes"])

    return encoded.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(
        run, f"doc_id {kind}, text_bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", doc_id: str = "doc_id",
               cache: int = 300_000) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: each text encoded and its
    ids decoded again in one pass, without shipping the ids."""
    spec, kind = _broadcast(docs, path), docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        codec = _codec(spec, pattern, cache, (path, pattern, cache))
        digits = [str(i) for i in range(len(codec.pieces))]
        for b in batches:
            n, own, back = [], [], []
            for t in b.column(1):
                ids = codec.encode(t.as_py() or "")
                n.append(len(ids))
                own.append(hashlib.sha256(",".join(map(digits.__getitem__, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(own), pa.array(back)],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
