import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from featurepipe.llm import prefix_bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    own = tokenizers.Tokenizer.from_file(PATH)
    own.no_truncation()
    own.no_padding()
    return own


@pytest.fixture(scope="module")
def encoder():
    return prefix_bpe.Encoder(PATH, prefix_bpe.strangers(PATH))


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


def of_library(library, text):
    return packed(library.encode(text, add_special_tokens=False).ids)


def test_whole_table_equals_the_library(spark, sf, library):
    texts = {row.doc_id: row.text or "" for row in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op12_prefix_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(packed(ids)).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_random_texts_equal_the_library(library, encoder):
    chance = random.Random(5)
    parts = [*"abcdefghijk  \n\t'12.!?é日本\x1c\x85\xa0 \U0001f600", "<|endoftext|>", "<|endoftext", "aaaa", "'ll", "'LL", "the", "ing", " un"]
    for _ in range(4000):
        text = "".join(chance.choices(parts, k=chance.randrange(30)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == packed(ids), text
        assert encoder.decode(packed(ids)).decode("utf-8", "replace") == library.decode(ids, skip_special_tokens=False)


def test_characters_are_classed_as_the_library_does(library, encoder):
    others = prefix_bpe.strangers(PATH)
    chosen = [*map(chr, range(0x3000)), *others[::40], *(chr(c) for c in range(0xE000, 0x110000, 997))]
    for k in range(0, len(chosen), 400):
        text = "".join(f"a{c}1{c}! {c}{c}x" for c in chosen[k : k + 400])
        assert encoder.encode(text) == of_library(library, text)


def test_last_token_of_each_prefix_is_that_of_the_prefix_alone(library, encoder):
    chance = random.Random(6)
    for alphabet in ("ab", "ing the", "aA", "0"):
        word = "".join(chance.choices(alphabet.replace(" ", ""), k=40))
        last = encoder.last_tokens("\n" + word)[1:]
        assert last == [library.encode(word[: k + 1], add_special_tokens=False).ids[-1] for k in range(len(word))]


def test_compatible_pairs_are_those_that_encode_to_themselves(library, encoder):
    chance = random.Random(7)
    vocabulary = encoder.vocabulary
    letters = [n for n, piece in vocabulary.bytes_of.items() if piece.isalpha() and piece.isascii() and n not in vocabulary.added.values()]
    seen = set()
    for _ in range(4000):
        one, other = chance.choices(letters, k=2)
        text = (vocabulary.bytes_of[one] + vocabulary.bytes_of[other]).decode()
        together = library.encode(text, add_special_tokens=False).ids
        assert vocabulary.compatible(one, other) == (together == [one, other])
        seen.add(together == [one, other])
    assert seen == {True, False}


def test_caches_do_not_change_ids(monkeypatch, library):
    small = prefix_bpe.Encoder(PATH)
    monkeypatch.setattr(prefix_bpe, "KEPT_BYTES", 2000)
    monkeypatch.setattr(prefix_bpe, "KEPT_PAIRS", 20)
    monkeypatch.setattr(prefix_bpe, "WHOLE_CHARACTERS", 64)
    chance = random.Random(8)
    for _ in range(60):
        text = " ".join("".join(chance.choices("abcdé", k=chance.randrange(1, 9))) for _ in range(40))
        assert small.encode(text) == of_library(library, text)
        assert small.weight <= 2000


def test_nulls_empty_long_repeated_and_clashing(spark, library):
    long = "word, 12 " * 300_000
    texts = [None, "", "same", "same", "a" * 200_000, " " * 50_000, long, "<|endoftext|>" * 3]
    rows = [(k if k else None, text) for k, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"ids": F.lit(1), "decoded": F.lit("x")})
    found = {row.doc_id: row for row in prefix_bpe.encode(docs, PATH, decoded=True).collect()}
    for key, text in rows:
        assert bytes(found[key].ids) == of_library(library, text or "")
        assert found[key].decoded == (text or "")
    empty = prefix_bpe.encode(docs.limit(0), PATH)
    assert empty.columns == ["doc_id", "ids"] and empty.count() == 0


def test_decode_of_broken_bytes_and_null(spark, library):
    half = library.encode("日", add_special_tokens=False).ids[:1]
    frame = spark.createDataFrame([(1, packed(half)), (2, None)], "doc_id bigint, ids binary")
    found = {row.doc_id: row.decoded for row in prefix_bpe.decode(frame, PATH).collect()}
    assert found == {1: library.decode(half, skip_special_tokens=False), 2: ""}
