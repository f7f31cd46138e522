"""Toxicity by non-negative positive-unlabelled learning.

The classifier learns from confirmed toxic texts and from unlabelled texts only. Its risk estimator corrects for the
share of toxic texts among the unlabelled (the class prior): ``prior * R+(P) + max(0, R-(U) - prior * R-(P))``; where
the second part would turn negative, a step goes against it instead. Features are the different words of the whole
text and their first four to seven bytes, hashed to ``2 ** BITS`` places and weighed by how much commoner they are in toxic than
in unlabelled texts. The model is a numpy vector of fixed size, so it can go to every task.

Fitting takes at most ``positives`` confirmed and ``unlabelled`` other texts (documented bounds; chosen by the hash of
their id, from rows whose id is not held out). Scoring covers all rows and reads the text alone. The prior is a
parameter, or the share of toxic rows among the labels that are not held out.

Null and empty texts have no features and get the score of the intercept. Repeated rows get the same score. Without
any confirmed toxic text every score is 0. An empty table gives an empty result. Very long texts are read whole. Columns other than
the id and the text are not read; ``drop_toxic`` keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.common import as_text, blocks, documents, give_back, gives_back, map_blocks
from featurepipe.llm.decontaminate import words

BITS = 20
POSITIVES = 3_000
UNLABELLED = 12_000
PREFIXES = (4, 5, 7)
# Standard deviations by which the shares of a feature must differ.
SIGNIFICANT = 4.0
# Bytes of words and places that a task remembers, and what an entry weighs besides its word.
KEPT_BYTES = 24 << 20
ENTRY_BYTES = 320


class WordFeatures(dict):
    """Places of the features of a word; what it remembers is bounded in bytes and belongs to one task."""

    def __init__(self, keep_bytes: int = KEPT_BYTES):
        super().__init__()
        self.room = self.keep_bytes = keep_bytes

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        kinds = [b"w" + word, *(b"%d" % n + word[:n] for n in PREFIXES if len(word) >= n)]
        places = tuple(xxhash.xxh32_intdigest(kind) >> (32 - BITS) for kind in kinds)
        self.room -= ENTRY_BYTES + len(word)
        if self.room < 0:
            self.clear()
            self.room = self.keep_bytes
        self[word] = places
        return places


def features(text: str, known: WordFeatures | None = None) -> np.ndarray:
    """Places of the features that occur in a text, each once."""
    known = WordFeatures() if known is None else known
    found: set[int] = set()
    for word in set(words(text)):
        found.update(known[word])
    return np.fromiter(found, dtype=np.int32, count=len(found))


@dataclass
class Model:
    weights: np.ndarray
    intercept: float

    def scores(self, texts: list[str], known: WordFeatures | None = None) -> np.ndarray:
        known = WordFeatures() if known is None else known
        margins = np.array([self.weights[features(t, known)].sum() for t in texts], dtype=np.float64) + self.intercept
        return 1 / (1 + np.exp(-np.clip(margins, -30, 30)))


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum([len(r) for r in rows])
    return (np.concatenate(rows) if rows else np.empty(0, np.int32)), np.concatenate(([0], ends)).astype(np.int64)


def _sums(values: np.ndarray, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values[flat])))
    return total[ends[1:]] - total[ends[:-1]]


def fit_arrays(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, epochs: int = 30, rate: float = 0.1, decay: float = 1e-4
) -> Model:
    """Minimise the non-negative risk with the sigmoid loss by stochastic steps of adaptive length."""
    size = 1 << BITS
    if not positive or not unlabelled:
        return Model(np.zeros(size, np.float32), -30.0)
    share_p = np.bincount(np.concatenate(positive), minlength=size) / len(positive)
    share_u = np.bincount(np.concatenate(unlabelled), minlength=size) / len(unlabelled)
    floor = 1 / len(positive)
    # Log of how much commoner a feature is in toxic texts, where the difference is no chance.
    scale = np.log((share_p + floor) / (share_u + floor)).astype(np.float64)
    spread = np.sqrt((share_u + floor) * (1 - share_u) / len(positive))
    scale[np.abs(share_p - share_u) < SIGNIFICANT * spread] = 0
    used = scale != 0
    positive = [r[used[r]] for r in positive]
    unlabelled = [r[used[r]] for r in unlabelled]
    weight, intercept = np.zeros(size), float(np.log(prior / (1 - prior)))
    weight[used] = 1.0
    squares, own = np.full(size, 1e-6), 1e-6
    chance = np.random.default_rng(7)
    steps = max(1, len(unlabelled) // 500)
    for _ in range(epochs):
        parts_p = np.array_split(chance.permutation(len(positive)), steps)
        parts_u = np.array_split(chance.permutation(len(unlabelled)), steps)
        for part_p, part_u in zip(parts_p, parts_u, strict=True):
            if not len(part_p):
                part_p = chance.integers(0, len(positive), 1)
            fp, ep = _flat([positive[k] for k in part_p])
            fu, eu = _flat([unlabelled[k] for k in part_u])
            effective = weight * scale
            zp, zu = _sums(effective, fp, ep) + intercept, _sums(effective, fu, eu) + intercept
            sp, su = 1 / (1 + np.exp(-np.clip(zp, -30, 30))), 1 / (1 + np.exp(-np.clip(zu, -30, 30)))
            slope_p, slope_u = sp * (1 - sp) / len(sp), su * (1 - su) / len(su)
            # Loss of being called clean: 1 - s; of being called toxic: s.
            negative = su.mean() - prior * sp.mean()
            if negative >= 0:
                gp, gu = -prior * slope_p - prior * slope_p, slope_u
            else:
                gp, gu = prior * slope_p, -slope_u
            grad = np.bincount(fp, np.repeat(gp, np.diff(ep)), size) + np.bincount(fu, np.repeat(gu, np.diff(eu)), size)
            touched = np.flatnonzero(grad)
            change = grad[touched] * scale[touched] + decay * weight[touched] / steps
            squares[touched] += change**2
            weight[touched] -= rate * change / np.sqrt(squares[touched])
            change = gp.sum() + gu.sum()
            own += change**2
            intercept -= rate * change / np.sqrt(own)
    return Model((weight * scale).astype(np.float32), float(intercept))


def held_out(id_column: Column) -> Column:
    """Rows whose labels are never learnt from; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("null"))) % 5 == 0


def fit(
    frame: DataFrame,
    labels: DataFrame,
    prior: float | None = None,
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> Model:
    plain = documents(frame, id_column, text_column).where(~held_out(F.col("doc_id")))
    marked = (
        labels.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(label_column).cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    if prior is None:
        prior = marked.agg(F.avg("toxic")).first()[0] or 0.0
    prior = min(max(prior, 1e-3), 0.999)
    order = F.xxhash64("doc_id")
    sampled = (
        marked.where("toxic = 1").orderBy(order).limit(positives).select("doc_id", F.lit(1).alias("confirmed"))
    ).unionByName(
        plain.where("doc_id IS NOT NULL").select("doc_id").orderBy(order).limit(unlabelled).distinct().withColumn("confirmed", F.lit(0))
    )
    # At most positives + unlabelled ids, so the list may go to every task.
    rows = plain.join(F.broadcast(sampled), "doc_id").dropDuplicates(["doc_id", "confirmed"]).select("confirmed", "text")

    def run(batch):
        known = held[0] if held else WordFeatures()
        held[:] = [known]
        return {
            "confirmed": batch.column(0),
            "places": [features(t, known).tobytes() for t in batch.column(1).to_pylist()],
        }

    held: list[WordFeatures] = []
    model = _fitted(map_blocks(rows, run, "confirmed int, places binary"), prior)
    # The rows that were learnt from are gone; the driver need not hold their memory while it goes on.
    give_back()
    return model


def _fitted(rows: DataFrame, prior: float) -> Model:
    """A model from at most the asked-for number of confirmed and unlabelled rows."""
    found = rows.toArrow()
    places = [np.frombuffer(p, dtype=np.int32) for p in found.column("places").to_pylist()]
    confirmed = found.column("confirmed").to_pylist()
    del found
    return fit_arrays(
        [p for p, c in zip(places, confirmed, strict=True) if c],
        [p for p, c in zip(places, confirmed, strict=True) if not c],
        prior,
    )


def score(frame: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` from 0 to 1 for every row."""
    shared = frame.sparkSession.sparkContext.broadcast(model)
    held: list[WordFeatures] = []

    def run(batch):
        known = held[0] if held else WordFeatures()
        held[:] = [known]
        return {"doc_id": batch.column(0), "score": shared.value.scores(batch.column(1).to_pylist(), known)}

    return map_blocks(documents(frame, id_column, text_column), run, "doc_id bigint, score double")


def drop_toxic(frame: DataFrame, model: Model, threshold: float = 0.5, text_column: str = "text") -> DataFrame:
    """The rows, with all their columns, that score below the threshold. Only texts go to Python, and only scores come back."""
    shared = frame.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from gives_back(scored)(columns)

    def scored(columns):
        known = WordFeatures()
        for column in columns:
            parts = [shared.value.scores(part.column(0).to_pylist(), known) for part in blocks([_as_batch(column)])]
            yield pa.array(np.concatenate([*parts, np.empty(0)]))

    return frame.where(scores(as_text(text_column)) < threshold)


def _as_batch(column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([column], ["text"])
