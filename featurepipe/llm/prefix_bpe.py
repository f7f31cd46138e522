"""Byte-level BPE by dynamic programming over prefixes.

Every prefix of a pre-token has exactly one last token, and the encoding of a prefix is that of what stands before its last token,
plus this token. An automaton of the vocabulary reports, at each byte, the pieces that are suffixes of the prefix there;
the one that is compatible with the last token of the prefix before it is stored. Two tokens are compatible when
encoding their bytes together gives these two again: their merges are undone along the seam, latest first, and no
merge across the seam may come earlier than one that was undone. Following the stored tokens back from
the end gives the ids. Work is linear in the length of a pre-token, whatever its length.

Texts are cut as the tokenizer file says: at the strings of its added tokens first, the rest by its pattern. Which characters
count as letters and numbers is asked of the tokenizer library, whose Unicode tables may be older than those of the pattern
library. Decoding maps every id back to its bytes. The file must hold a byte-level BPE without a normaliser.

Null and empty texts have no ids. Repeated rows stay repeated. An empty table gives an empty result. Very long texts are
encoded whole, in one step of their own. Columns other than the id and the text are not kept, so none can clash.
"""

from __future__ import annotations

import json
import struct
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame

from featurepipe.llm.bpe import byte_characters
from featurepipe.llm.common import _parsed, arrow_schema, blocks, documents, in_pieces, table_batch

# Bytes of pre-tokens and ids that a task remembers, and the number of pairs of tokens.
KEPT_BYTES = 64 << 20
KEPT_PAIRS = 400_000
# Characters of a text whose pre-tokens are listed at once; a longer text is cut step by step.
WHOLE_CHARACTERS = 1 << 20
# What a remembered pre-token weighs besides its characters and ids.
ENTRY_BYTES = 170
# Fixed value: how byte-level tokenizers cut text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Vocabulary:
    """Pieces, merges and automaton of a tokenizer file; one for each Python worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        kinds = (model["type"], content["pre_tokenizer"]["type"], content["normalizer"], content["pre_tokenizer"]["add_prefix_space"])
        if kinds != ("BPE", "ByteLevel", None, False) or model.get("ignore_merges"):
            raise ValueError("Only byte-level BPE without normaliser, added space or ignored merges is supported.")
        ids = model["vocab"]
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        # When a pair merges, and into what; and what a token was merged from, and when.
        self.merged = {(ids[one], ids[other]): when for when, (one, other) in enumerate(merges)}
        self.parts = {ids[one + other]: (when, ids[one], ids[other]) for when, (one, other) in enumerate(merges)}
        characters = byte_characters()
        self.characters = str.maketrans({chr(b): c for b, c in enumerate(characters)})
        byte_of = {c: b for b, c in enumerate(characters)}
        self.bytes_of = {number: bytes(byte_of[c] for c in piece) for piece, number in ids.items()}
        self.automaton = ahocorasick.Automaton()
        for piece, number in ids.items():
            self.automaton.add_word(piece, (number, len(piece)))
        self.automaton.make_automaton()
        added = {token["content"]: token["id"] for token in content["added_tokens"]}
        self.added = added
        self.bytes_of |= {number: text.encode() for text, number in added.items()}
        self.packed = {number: struct.pack("<I", number) for number in self.bytes_of}
        self.lengths = {number: len(piece) for number, piece in self.bytes_of.items()}
        if any(token["single_word"] or token["lstrip"] or token["rstrip"] for token in content["added_tokens"]):
            raise ValueError("Added tokens that take white space or whole words only are not supported.")
        # The longest of several that begin at one place.
        names = sorted(added, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None

    def compatible(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens, encoded together, give these two tokens."""
        parts, merged = self.parts, self.merged
        # Merges from this time on are undone: at the seam, time runs backwards.
        bound = len(merged)
        while True:
            when = merged.get((left, right))
            if when is not None and when < bound:
                return False
            of_left, of_right = parts.get(left), parts.get(right)
            if of_left is None and of_right is None:
                return True
            if of_right is None or (of_left is not None and of_left[0] > of_right[0]):
                # A merge within the left token at the same time comes first: it stands further left.
                bound, left = of_left[0], of_left[2]
            else:
                bound, right = of_right[0] + 1, of_right[1]


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=4)
def strangers(path: str) -> tuple[str, ...]:
    """Characters that the pattern's tables call letters or numbers and the library of the tokenizer file does not."""
    import tokenizers

    cut = tokenizers.Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    every = "".join([chr(c) for c in range(128, 0x110000) if not 0xD800 <= c < 0xE000])
    found = []
    for known, kind in (("a", r"\p{L}"), ("1", r"\p{N}")):
        for some in in_pieces(regex.findall(kind, every), 500):
            # A pre-token that is longer than "a" or "1" holds the character after it too.
            pieces = cut("".join([f"\n{known}{c}" for c in some]))
            joined = {start for _, (start, end) in pieces if end - start == 2}
            found += [c for k, c in enumerate(some) if 3 * k + 1 not in joined]
    return tuple(found)


def _ranges(characters: tuple[str, ...]) -> str:
    points = sorted(map(ord, characters))
    runs: list[list[int]] = []
    for point in points:
        if runs and runs[-1][1] == point - 1:
            runs[-1][1] = point
        else:
            runs.append([point, point])
    return "".join(f"\\U{first:08X}-\\U{last:08X}" for first, last in runs)


class Encoder:
    """Encodes texts in one task; what it remembers is bounded in bytes and goes with it."""

    def __init__(self, path: str, others: tuple[str, ...] = ()):
        self.vocabulary = vocabulary(path)
        self.cut = regex.compile(PATTERN)
        self.other = None
        if others:
            self.other = regex.compile(f"[{_ranges(others)}]").search
            self.careful = regex.compile(_without(PATTERN, others), regex.V1)
        self.known: dict[str, bytes] = {}
        self.weight = 0
        self.pairs: defaultdict[int, dict[int, bool]] = defaultdict(dict)
        self.tested = 0

    def last_tokens(self, shown: str) -> list[int]:
        """For every prefix of each pre-token its last token. Pre-tokens are in printable bytes, each with a line feed before it.

        No piece holds a line feed, so none reaches beyond its pre-token; what stands before a pre-token is -1.
        """
        compatible, pairs = self.vocabulary.compatible, self.pairs
        if self.tested > KEPT_PAIRS:
            pairs.clear()
            self.tested = 0
        last = [-1] * len(shown)
        for end, (token, length) in self.vocabulary.automaton.iter(shown):
            if last[end] >= 0:
                continue
            before = last[end - length]
            if before >= 0:
                tested = pairs[before]
                if token not in tested:
                    tested[token] = compatible(before, token)
                    self.tested += 1
                if not tested[token]:
                    continue
            last[end] = token
        return last

    def _learn(self, pieces: list[str]) -> None:
        """The ids of pre-tokens, by following the last tokens back from the end of each."""
        shown = "".join(["\n" + self._shown(piece) for piece in pieces])
        last = self.last_tokens(shown)
        packed, lengths, known = self.vocabulary.packed, self.vocabulary.lengths, self.known
        place = len(last) - 1
        for piece in reversed(pieces):
            ids = []
            while (token := last[place]) >= 0:
                ids.append(packed[token])
                place -= lengths[token]
            place -= 1
            ids.reverse()
            known[piece] = found = b"".join(ids)
            self.weight += ENTRY_BYTES + len(piece) + len(found)

    def _shown(self, piece: str) -> str:
        return piece.encode().decode("latin-1").translate(self.vocabulary.characters)

    def _pieces(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text without added tokens, many at a time."""
        careful = self.other is not None and not text.isascii() and self.other(text)
        cut = self.careful if careful else self.cut
        if len(text) <= WHOLE_CHARACTERS:
            yield cut.findall(text)
        else:
            yield from in_pieces((match[0] for match in cut.finditer(text)), WHOLE_CHARACTERS)

    def _plain(self, text: str) -> bytes:
        out = []
        for pieces in self._pieces(text):
            if missing := set(pieces).difference(self.known):
                self._learn(list(missing))
            out.append(b"".join(map(self.known.__getitem__, pieces)))
            if self.weight > KEPT_BYTES:
                self.known.clear()
                self.weight = 0
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        special = self.vocabulary.special
        if special is None or not any(name in text for name in self.vocabulary.added):
            return self._plain(text)
        out, place = [], 0
        for match in special.finditer(text):
            out += [self._plain(text[place : match.start()]), self.vocabulary.packed[self.vocabulary.added[match[0]]]]
            place = match.end()
        return b"".join([*out, self._plain(text[place:])])

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


def _without(pattern: str, others: tuple[str, ...]) -> str:
    """The pattern with letters and numbers that leave out some characters."""
    less = f"--[{_ranges(others)}]]"
    letters, numbers = rf"[\p{{L}}{less}", rf"[\p{{N}}{less}"
    marks = {r"[^\s\p{L}\p{N}]": rf"[^\s{letters}{numbers}]", r"\p{L}": letters, r"\p{N}": numbers}
    return regex.sub("|".join(map(regex.escape, marks)), lambda match: marks[match[0]], pattern)


def encode(
    frame: DataFrame, path: str, decoded: bool = False, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id`` and ``ids``: a binary of little-endian unsigned 32-bit integers (4 bytes a token).

    ``decoded=True`` adds the text that the ids stand for, in UTF-8. ``path``, a file of the tokenizers library, must be readable on
    every executor.
    """
    others = strangers(path)

    def run(batches):
        own = Encoder(path, others)
        for batch in blocks(batches, limit=1 << 20):
            packed = [own.encode(text) for text in batch.column(1).to_pylist()]
            out = {"doc_id": batch.column(0), "ids": packed}
            yield table_batch(out | {"decoded": [_text(own.decode(ids)) for ids in packed]} if decoded else out, target)

    schema = "doc_id bigint, ids binary" + ", decoded string" * decoded
    target = arrow_schema(_parsed(schema))
    return documents(frame, id_column, text_column).mapInArrow(run, schema)


def decode(frame: DataFrame, path: str, ids_column: str = "ids") -> DataFrame:
    """``doc_id`` and ``decoded``, the text of the ids; bytes that are no UTF-8 become replacement characters, null ids no text."""
    from pyspark.sql import functions as F

    def run(batches):
        own = Encoder(path)
        for batch in blocks(batches, limit=1 << 20):
            texts = [_text(own.decode(ids)) for ids in batch.column(1).to_pylist()]
            yield table_batch({"doc_id": batch.column(0), "decoded": texts}, target)

    schema = "doc_id bigint, decoded string"
    target = arrow_schema(_parsed(schema))
    packed = frame.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(ids_column, F.lit(b"")).alias("text"))
    return packed.mapInArrow(run, schema)


def _text(content: bytes) -> str:
    return content.decode("utf-8", errors="replace")
