"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the ``K`` smallest distinct 64-bit hashes of a text's five-word shingles. The sketch of several parts
is the bottom of their union, so sketches of parts merge. From two sketches follow estimates of resemblance (Jaccard),
containment and the number of distinct shingles; with fewer than ``K`` shingles they are exact.
A fingerprint is the sketch as base64 of little-endian 64-bit numbers in rising order.

Null and empty texts have the empty fingerprint; two empty ones are alike (1), an empty and another one are not (0).
A text with fewer words than a shingle is one shingle. Repeated rows have equal fingerprints. Very long texts are read whole, with 8 bytes a
shingle in memory. An empty table gives an empty result. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.common import WordHashes, blocks, documents, map_blocks, plain_words, shingle_hashes

K = 128
SHINGLE = 5
# Ranges of ids for each shuffle partition, so that hashing them to partitions comes out even.
RANGES_PER_PARTITION = 4


class Sketcher:
    def __init__(self, k: int = K, shingle: int = SHINGLE):
        self.k, self.shingle, self.known = k, shingle, WordHashes()

    def of(self, text: str) -> np.ndarray:
        hashes = shingle_hashes(self.known.of(plain_words(text)), self.shingle)
        if len(hashes) > 4 * self.k:
            # Repeats take places, so the bottom is widened until it holds enough different hashes.
            take = 2 * self.k
            while take < len(hashes):
                least = np.unique(np.partition(hashes, take)[:take])
                if len(least) >= self.k:
                    return least[: self.k]
                take *= 4
        return np.unique(hashes)[: self.k]


def merge(sketches: list[np.ndarray], k: int = K) -> np.ndarray:
    return np.unique(np.concatenate([np.empty(0, np.uint64), *sketches]))[:k]


def resemblance(one: np.ndarray, other: np.ndarray, k: int = K) -> float:
    if not len(one) or not len(other):
        return float(len(one) == len(other))
    union = merge([one, other], k)
    both = np.isin(union, one, assume_unique=True) & np.isin(union, other, assume_unique=True)
    return float(both.sum() / len(union))


def distinct(sketch: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    if len(sketch) < k:
        return float(len(sketch))
    return float((k - 1) / ((float(sketch[k - 1]) + 1) / 2.0**64))


def containment(one: np.ndarray, other: np.ndarray, k: int = K) -> float:
    """Estimated share of the shingles of ``one`` that ``other`` has too."""
    if not len(one):
        return 1.0
    shared = resemblance(one, other, k) * distinct(merge([one, other], k), k)
    return min(1.0, shared / distinct(one, k))


def packed(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u8").tobytes()).decode()


def unpacked(fingerprint: str | None) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint or ""), dtype="<u8")


def fingerprints(
    frame: DataFrame, k: int = K, shingle: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, fingerprint`` of every row."""
    held: list[Sketcher] = []

    def run(batch):
        own = held[0] if held else Sketcher(k, shingle)
        held[:] = [own]
        return {"doc_id": batch.column(0), "fingerprint": [packed(own.of(t)) for t in batch.column(1).to_pylist()]}

    return map_blocks(documents(frame, id_column, text_column), run, "doc_id bigint, fingerprint string")


def merged_fingerprints(frame: DataFrame, key: str, fingerprint: str = "fingerprint", k: int = K) -> DataFrame:
    """``key, fingerprint`` of all parts of a key together; tasks merge what they hold before anything is shuffled."""

    def combine(batches):
        held: dict = {}
        for batch in batches:
            parts: dict = {}
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts.setdefault(name, []).append(unpacked(value))
            for name, own in parts.items():
                held[name] = merge([*own, held.get(name, np.empty(0, np.uint64))], k)
            if len(held) > 20_000:
                yield _out(held)
                held = {}
        if held:
            yield _out(held)

    def finish(batches):
        current, sketch = None, None
        for batch in batches:
            done = {}
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if sketch is None or name != current:
                    if sketch is not None:
                        done[current] = sketch
                    current, sketch = name, np.empty(0, np.uint64)
                sketch = merge([sketch, unpacked(value)], k)
            if done:
                yield _out(done)
        if sketch is not None:
            yield _out({current: sketch})

    def _out(held):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.string()), pa.array([packed(s) for s in held.values()], pa.string())], ["key", "fingerprint"]
        )

    schema = "key string, fingerprint string"
    parts = frame.select(F.col(key).cast("string").alias("key"), F.col(fingerprint).alias("fingerprint")).mapInArrow(combine, schema)
    return parts.repartition("key").sortWithinPartitions("key").mapInArrow(finish, schema)


def with_next(
    frame: DataFrame, function: Callable, schema: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Rows of ``function(doc_id, text, next_text)``, the next document being that of the next id (after the last: the first).

    Rows follow the order (id, null first; text), so a repeated row is next to itself. The ids are cut into ranges at
    sketched quantiles; the first rows of a range are sent to the range before as well, so each range has all its
    neighbours and is read as a stream of sorted rows. Only ids are looked at beforehand.
    """
    docs = documents(frame, id_column, text_column)
    order = F.coalesce("doc_id", F.lit(-(1 << 63)))
    ids = docs.select(order.alias("place"))
    wanted = RANGES_PER_PARTITION * int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = ids.agg(F.percentile_approx("place", [k / wanted for k in range(wanted)], 50 * wanted)).first()[0]
    least = ids.agg(F.min("place")).first()[0]
    starts = np.unique(np.array([least, *(cuts or [])], dtype=np.int64)) if least is not None else np.empty(0, np.int64)

    def deal(batches):
        """Every row with the number of its range; the first of a range also goes to the range before."""
        for batch in batches:
            place = np.asarray(batch.column(0))
            own = np.searchsorted(starts, place, side="right") - 1
            again = np.flatnonzero(place == starts[own])
            rows = np.concatenate((np.arange(len(place)), again))
            bucket = np.concatenate((own, (own[again] - 1) % len(starts)))
            extra = np.repeat([0, 1], [len(place), len(again)])
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int64()), pa.array(extra, pa.int64()), *taken.columns], ["bucket", "extra", "place", "doc_id", "text"]
            )

    def run(batches):
        held = None  # the row whose next one has not come yet
        bucket = None
        for batch in blocks(batches):
            out = []
            for own, extra, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if own != bucket:
                    bucket, held = own, None
                if held is not None:
                    out.append(function(*held, text))
                held = None if extra else (doc, text)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=target)

    from featurepipe.llm.common import _parsed, arrow_schema

    target = arrow_schema(_parsed(schema))
    dealt = docs.select(order.alias("place"), "doc_id", "text").mapInArrow(
        deal, "bucket bigint, extra bigint, place bigint, doc_id bigint, text string"
    )
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket", "extra", "place", "text")
    return dealt.select("bucket", "extra", "doc_id", "text").mapInArrow(run, schema)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]
