"""Byte-level BPE by a sentencepiece model that is written out from a rank vocabulary.

Each vocabulary entry becomes a piece: its bytes mapped to visible characters, scored
by its negative rank, so the library's best-scored merge is the lowest-ranked one.
The normaliser is the identity.  Texts are cut into pre-tokens by the vocabulary's
pattern, each is mapped and encoded; decoding maps ids back to bytes.

Defined cases: null text is empty (no ids); null ids stay null; every input row gives
a row, repeated or not; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.llm.common import file_bytes, text_of
from ferrule.llm.pieces import MEMO_PARTS, PieceMemo

UNKNOWN = "<unknown>"
#: Piece types and the model type of the library's public file format.
NORMAL, UNKNOWN_TYPE, BPE = 1, 2, 2


def byte_chars() -> list[str]:
    """A visible character for each byte: printable Latin-1 bytes stand for themselves, the
    others, in order, for U+0100 onwards."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def read_ranks(data: bytes) -> dict[bytes, int]:
    lines = (line.split() for line in data.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in lines}


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def _piece(text: str, score: float, kind: int) -> bytes:
    score_field = _varint(2 << 3 | 5) + struct.pack("<f", score)
    return _bytes(1, _bytes(1, text.encode("utf-8")) + score_field + _number(3, kind))


def model_proto(ranks: dict[bytes, int]) -> tuple[bytes, list[bytes], list[int]]:
    """The model's file content, and bytes and rank of the piece at each place."""
    order = sorted(ranks, key=ranks.__getitem__)
    chars = byte_chars()
    pieces = [_piece("".join(chars[b] for b in token), -float(ranks[token]), NORMAL) for token in order]
    pieces.append(_piece(UNKNOWN, 0.0, UNKNOWN_TYPE))
    n = len(pieces)
    trainer = _number(3, BPE) + _number(4, n) + _number(40, n - 1) + b"".join(_number(f, -1) for f in (41, 42, 43))
    normaliser = _bytes(1, b"identity") + b"".join(_number(f, 0) for f in (3, 4, 5))
    return b"".join(pieces) + _bytes(2, trainer) + _bytes(3, normaliser), order, [ranks[t] for t in order]


class Codec:
    """Encodes texts to ids (ranks) and back; built once a task."""

    def __init__(self, vocabulary: bytes, pattern: str):
        import regex
        import sentencepiece

        self.ranks = read_ranks(vocabulary)
        proto, order, ids = model_proto(self.ranks)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.ids = np.array(ids, "<u4")
        self.token = dict(zip(ids, order, strict=True))
        self.find = regex.compile(pattern).findall
        self.table = dict(zip(range(256), byte_chars(), strict=True))
        self.known: dict[str, bytes] = {}
        self.memo = PieceMemo(self._many)

    def _learn(self, found: list[str]) -> None:
        """Put the ids of new pre-tokens into the memo; one that is a vocabulary entry is that entry."""
        open_ = []
        for x in found:
            raw = x.encode("utf-8")
            if raw in self.ranks:
                self.known[x] = struct.pack("<I", self.ranks[raw])
            else:
                open_.append((x, raw.decode("latin-1").translate(self.table)))
        for (x, _), ids in zip(open_, self.library.encode([m for _, m in open_], num_threads=1), strict=True):
            self.known[x] = self.ids[ids].tobytes()

    def _many(self, texts: list[str]) -> list[bytes]:
        cut = [self.find(x) for x in texts]
        known = self.known
        if len(known) > MEMO_PARTS:
            known.clear()
        new = {p for c in cut for p in c if p not in known}
        if new:
            self._learn(list(new))
        return [b"".join([known[p] for p in c]) for c in cut]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(self.memo.values(text))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(spark: SparkSession, docs: DataFrame, vocabulary: str, pattern: str,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)``: ids of every whole text as little-endian unsigned 32-bit integers."""
    data = spark.sparkContext.broadcast(file_bytes(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(data.value, pattern)
        for b in batches:
            ids = [codec.encode(x.as_py()) for x in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs, text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(spark: SparkSession, encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes its ``ids`` stand for (null ids: empty)."""
    data = spark.sparkContext.broadcast(file_bytes(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: t for t, rank in read_ranks(data.value).items()}.__getitem__
        for b in batches:
            out = [b"".join(map(token, np.frombuffer(x.as_py() or b"", "<u4").tolist())) for x in b.column("ids")]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], [*b.schema.names, "decoded"])

    kept = encoded.select(*[c for c in encoded.columns if c != "decoded"])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{schema}, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of an encoded and decoded table."""
    return decoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
