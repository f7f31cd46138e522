"""The registered queries of the text operators: whole tables in, digests of the operators' real outputs out."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurepipe.llm import (
    bpe,
    chat,
    decontaminate,
    fingerprints,
    jaccard,
    kd_shards,
    passages,
    prefix_bpe,
    secrets,
    suffix_dedup,
    toxicity,
    turn_repair,
    whitening,
)
from featurepipe.llm.oracles import ORACLES  # noqa: F401
from featurepipe.sources.staging import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_components(_table(spark, folder, "documents"), shingle=4, percent=85)


@query
def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = suffix_dedup.remove_repeats(_table(spark, folder, "documents"))
    zero = F.lit(0).cast("bigint")
    return done.select(
        "doc_id",
        "n_bytes",
        F.aggregate("removed", zero, lambda total, s: total + s["end"] - s["start"]).alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode(_table(spark, folder, "documents"), path, public_tokenizers.PATTERN, decoded=True)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    held: list[fingerprints.Sketcher] = []
    known: dict[str, object] = {}

    def compared(doc: int, text: str, following: str) -> dict:
        own = held[0] if held else fingerprints.Sketcher()
        held[:] = [own]
        edited = fingerprints.edited(text, following)
        # The next row of a stream needs what this one computes for its neighbour.
        sketch = known.pop(text, None)
        sketch = own.of(text) if sketch is None else sketch
        known.clear()
        known[following] = own.of(following)
        of_edited = own.of(edited)
        return {
            "doc_id": doc,
            "n_chars": len(text),
            "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
            "fingerprint": fingerprints.packed(sketch),
            "edited_fingerprint": fingerprints.packed(of_edited),
            "near_edited": fingerprints.resemblance(sketch, of_edited),
            "near_next": fingerprints.resemblance(sketch, known[following]),
        }

    return fingerprints.with_next(
        _table(spark, folder, "documents"),
        compared,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


@query
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find_contamination(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = toxicity.fit(docs, _table(spark, folder, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op7_shared_passages(spark: SparkSession, folder: str) -> DataFrame:
    found = passages.shared_passages(_table(spark, folder, "documents"))
    return passages.passage_classes(materialize(found, "passages"))


@query
def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = chat.END + chat.BEGIN + "assistant ok"
    added = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string"
    )
    turns = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    # The template is append-only.
    return chat.digests(chat.format_conversations(turns, chat.marked_turns, context=chat.APPEND_ONLY_CONTEXT))


@query
def op9_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = kd_shards.kd_shards(_table(spark, folder, "documents"), shards=16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op10_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, folder, "documents"))
    kinds = [rule.kind for rule in secrets.BASE_RULES]
    base = F.filter("secrets", lambda s: s["kind"].isin(kinds))

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, kinds),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("secrets")).alias("spans"),
    )


@query
def op11_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    damaged = turn_repair.damage(_table(spark, folder, "conversations"))
    return turn_repair.digests(turn_repair.repair_conversations(damaged, copies="copies"))


@query
def op12_prefix_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return prefix_bpe.encode(_table(spark, folder, "documents"), path, decoded=True).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "embeddings")
    model = whitening.fit(rows)
    white = whitening.whiten(rows, model)
    return whitening.by_component(white, model, whitening.identity_error(white, model))
