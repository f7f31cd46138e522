"""Byte-level BPE by a sentencepiece model that is written directly from a file of ranks.

The 256 bytes get printable characters of their own, every piece of the vocabulary becomes a string of such
characters with the score ``-rank``, and the normaliser is the identity. The library then merges exactly the pairs
that the ranks ask for. Texts are cut into pre-tokens by the pattern first, and each different pre-token of a block
of texts is encoded once. Decoding maps every id back to its bytes.

Null and empty texts have no ids. Repeated rows stay repeated. An empty table gives an empty result. Very long texts are encoded whole,
each in a step of its own. Columns other than the id and the text are not kept.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Callable
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from featurepipe.llm.common import _parsed, arrow_schema, blocks, documents, gives_back, map_blocks, table_batch

# Bytes of pre-tokens and ids that a task remembers, and what an entry weighs besides them.
KEPT_BYTES = 48 << 20
ENTRY_BYTES = 170


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, filter(bytes.strip, lines))}


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is printable Latin-1, else one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _message(field: int, content: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(content)) + content


def serialised_model(ranks: dict[bytes, int]) -> bytes:
    """The bytes of a sentencepiece BPE model whose piece ids are positions in rank order; the last is unknown."""
    shown = byte_characters()
    pieces = []
    for piece, rank in sorted(ranks.items(), key=lambda entry: entry[1]):
        name = "".join(shown[b] for b in piece).encode()
        pieces.append(_message(1, _message(1, name) + b"\x15" + struct.pack("<f", -float(rank))))
    unknown = _message(1, _message(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _number(3, 2))
    trainer = _number(3, 2) + _number(4, len(pieces) + 1) + _number(40, len(pieces))
    normaliser = _message(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + unknown + _message(2, trainer) + _message(3, normaliser)


class Codec:
    """Encodes texts to ids and ids to bytes in one process."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised_model(ranks))
        self.split = regex.compile(pattern).findall
        self.characters = byte_characters()
        self.ids = np.array(sorted(ranks.values()), dtype="<u4")
        # A pre-token that is a piece itself is that piece, whatever the merges lead to.
        self.whole = {piece: struct.pack("<I", rank) for piece, rank in ranks.items()}
        self.known: dict[str, bytes] = {}
        self.room = KEPT_BYTES

    @cached_property
    def bytes_of(self) -> dict[int, bytes]:
        """Only decoding needs this table."""
        return {struct.unpack("<I", rank)[0]: piece for piece, rank in self.whole.items()}

    def _learn(self, missing: list[str]) -> None:
        rest = []
        for token in missing:
            if found := self.whole.get(token.encode()):
                self.known[token] = found
            else:
                rest.append(token)
        shown = ["".join([self.characters[b] for b in token.encode()]) for token in rest]
        for token, numbers in zip(rest, self.model.encode(shown, out_type=int, num_threads=1), strict=True):
            self.known[token] = self.ids[numbers].tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.split(text) for text in texts]
        if missing := list(set().union(*cut).difference(self.known)):
            self._learn(missing)
            self.room -= sum(ENTRY_BYTES + len(token) + len(self.known[token]) for token in missing)
        packed = [b"".join(map(self.known.__getitem__, tokens)) for tokens in cut]
        if self.room < 0:
            self.known.clear()
            self.room = KEPT_BYTES
        return packed

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


def encode(
    frame: DataFrame, path: str, pattern: str, decoded: bool = False, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id`` and ``ids``: a binary of little-endian unsigned 32-bit integers (4 bytes a token).

    ``decoded=True`` adds what the ids decode to. ``path`` must be readable on every executor.
    """

    def columns(own: Codec, packed: list[bytes]) -> dict:
        return {"ids": packed} | ({"decoded": [own.decode(ids) for ids in packed]} if decoded else {})

    schema = "doc_id bigint, ids binary" + ", decoded binary" * decoded
    return _encoded(documents(frame, id_column, text_column), path, pattern, columns, schema)


def encode_arrays(frame: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``token_ids``, an array of integers: ``id_arrays`` of ``encode`` in one step, as two would hold two workers a task."""
    schema = "doc_id bigint, token_ids array<int>"
    return _encoded(documents(frame, id_column, text_column), path, pattern, lambda _, packed: {"token_ids": _as_arrays(packed)}, schema)


def _encoded(docs: DataFrame, path: str, pattern: str, columns: Callable[[Codec, list[bytes]], dict], schema: str) -> DataFrame:
    """``doc_id`` and what ``columns`` makes of the packed ids of a block of texts."""

    def run(batches):
        # Tables and what is remembered belong to the task, as workers outlive it.
        own = None
        for batch in blocks(batches, limit=1 << 18):
            own = own or Codec(path, pattern)
            yield table_batch({"doc_id": batch.column(0)} | columns(own, own.encode(batch.column(1).to_pylist())), target)

    target = arrow_schema(_parsed(schema))
    return docs.mapInArrow(gives_back(run), schema)


def _as_arrays(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *map(len, packed)], dtype=np.int64) // 4
    flat = np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int32)
    return pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(flat))


def decode(frame: DataFrame, path: str, pattern: str, ids_column: str = "ids") -> DataFrame:
    """``doc_id`` and ``decoded``, the bytes that the ids stand for; null ids are none."""
    from pyspark.sql import functions as F

    held: list[Codec] = []

    def run(batch):
        own = held[0] if held else Codec(path, pattern)
        held[:] = [own]
        return {"doc_id": batch.column(0), "decoded": [own.decode(ids) for ids in batch.column(1).to_pylist()]}

    packed = frame.select("doc_id", F.coalesce(ids_column, F.lit(b"")).alias("text"))
    return map_blocks(packed, run, "doc_id bigint, decoded binary", limit=1 << 20)


def id_arrays(frame: DataFrame, ids_column: str = "ids") -> DataFrame:
    """``doc_id`` and the ids as an array of integers."""

    def run(batch):
        return {"doc_id": batch.column(0), "token_ids": _as_arrays(batch.column(1).to_pylist())}

    return map_blocks(frame.select("doc_id", frame[ids_column].alias("text")), run, "doc_id bigint, token_ids array<int>")
