"""Benchmark passages in training documents, found through suffix arrays of the documents.

A shard is a block of documents. Its suffix array orders the word positions from which a match could start: the
shortest window must fit into words that the benchmark knows, so all other suffixes cannot match and are left out.
Every benchmark suffix is then looked up in each shard by binary search, which gives the range of equal positions;
matches that go on from word to word are put together to the longest verbatim match with its place in both texts.

A window is ``window`` consecutive words of an item; an item with fewer words, but not none, is one window. Words are
runs of letters, digits and non-ASCII characters, A-Z in lower case. Null and empty texts have no words. Items go to
the tasks in blocks of at most ``block_bytes`` of text (one item at least), so the benchmark may be of any size.
Repeated documents stay repeated, a null item is an item without words, and items with a null id are named ``""``.
"""

from __future__ import annotations

from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.common import as_text, documents, map_blocks

WINDOW = 10
ITEM_BLOCK_BYTES = 16 << 20

MATCHES = "array<struct<item_id:string,start:bigint,item_start:bigint,length:bigint>>"

# Bytes that belong to words stay, in lower case; all others become a space.
_WORD_BYTES = bytes(
    b | 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_END_OF_TEXT = b"\x01"


def words(text: str) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split()


class Windows:
    """The windows of a block of items, as fixed-length keys of word numbers."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.window = window
        self.names = [name for name, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        keys, lengths, owners, places = [], [], [], []
        for owner, (_, text) in enumerate(items):
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            size = min(window, len(numbers))
            for k in range(len(numbers) - size + 1 if size else 0):
                keys.append(numbers[k : k + size] + [0] * (window - size))
                lengths.append(size)
                owners.append(owner)
                places.append(k)
        self.lengths = np.array(lengths, dtype=np.int64)
        self.owners = np.array(owners, dtype=np.int64)
        self.places = np.array(places, dtype=np.int64)
        low = np.array(keys, dtype=">u4").reshape(len(keys), window)
        beyond = np.arange(window) >= self.lengths[:, None]
        self.low = _strings(low)
        self.high = _strings(np.where(beyond, 0xFFFFFFFF, low))
        self.shortest = int(self.lengths.min()) if len(keys) else 0


def _strings(numbers: np.ndarray) -> np.ndarray:
    rows, width = numbers.shape
    return np.ascontiguousarray(numbers.astype(">u4")).view(f"S{4 * width}").reshape(rows)


def match_texts(texts: list[str], test: Windows) -> tuple[np.ndarray, dict[int, list[dict]]]:
    """Word count of each text, and for texts with matches the longest ones."""
    flat = b" \x01 ".join([t.encode().translate(_WORD_BYTES) for t in texts] + [b""]).split()
    get = test.vocabulary.get
    numbers = np.fromiter(map(get, flat, repeat(0)), dtype=np.int64, count=len(flat))
    ends = np.array([k for k in np.flatnonzero(numbers == 0).tolist() if flat[k] == _END_OF_TEXT], dtype=np.int64)
    counts = np.diff(np.concatenate(([-1], ends))) - 1
    if not test.shortest:
        return counts, {}
    # Known words in a row from each position on.
    size = len(numbers)
    unknown = np.where(numbers == 0, np.arange(size), size)
    run = np.minimum.accumulate(unknown[::-1])[::-1] - np.arange(size)
    starts = np.flatnonzero(run >= test.shortest)
    if not len(starts):
        return counts, {}
    padded = np.concatenate((numbers, np.zeros(test.window, np.int64)))
    suffixes = _strings(padded[starts[:, None] + np.arange(test.window)])
    order = np.argsort(suffixes, kind="stable")
    sorted_suffixes = suffixes[order]
    first = np.searchsorted(sorted_suffixes, test.low, side="left")
    after = np.searchsorted(sorted_suffixes, test.high, side="right")
    hits = after - first
    if not hits.any():
        return counts, {}
    which = np.repeat(np.arange(len(hits)), hits)
    within = np.arange(len(which)) - np.repeat(np.cumsum(hits) - hits, hits)
    at = starts[order[first[which] + within]]
    text = np.searchsorted(ends, at)
    # Matches of one item on one diagonal that follow each other word by word are one match.
    owner, place, length = test.owners[which], test.places[which], test.lengths[which]
    by = np.lexsort((at, at - place, owner, text))
    text, owner, place, length, at = text[by], owner[by], place[by], length[by], at[by]
    new = np.ones(len(by), dtype=bool)
    new[1:] = (
        (text[1:] != text[:-1])
        | (owner[1:] != owner[:-1])
        | (at[1:] - place[1:] != at[:-1] - place[:-1])
        | (at[1:] != at[:-1] + 1)
    )
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(by)) - 1
    found: dict[int, list[dict]] = {}
    begin = np.concatenate(([0], ends + 1))
    for h, t in zip(heads.tolist(), tails.tolist(), strict=True):
        k = int(text[h])
        found.setdefault(k, []).append(
            {
                "item_id": test.names[owner[h]],
                "start": int(at[h] - begin[k]),
                "item_start": int(place[h]),
                "length": int(at[t] - at[h] + length[t]),
            }
        )
    return counts, found


def covered(matches: Column) -> Column:
    """Number of words inside any match."""
    spans = F.array_sort(
        F.transform(matches, lambda m: F.struct(m["start"].alias("s"), (m["start"] + m["length"]).alias("e")))
    )
    zero = F.struct(F.lit(0).cast("bigint").alias("reach"), F.lit(0).cast("bigint").alias("total"))
    return F.aggregate(
        spans,
        zero,
        lambda a, m: F.struct(
            F.greatest(a["reach"], m["e"]).alias("reach"),
            (a["total"] + F.greatest(F.lit(0), m["e"] - F.greatest(a["reach"], m["s"]))).alias("total"),
        ),
        lambda a: a["total"],
    )


def item_blocks(items: DataFrame, id_column: str, text_column: str, block_bytes: int):
    """The items in lists of at most ``block_bytes``, by the hash of their id; each is collected alone."""
    plain = items.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item_id"), as_text(text_column).alias("text")
    )
    total = plain.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = max(1, -(-2 * total // block_bytes) if total > block_bytes else 1)
    for k in range(count):
        part = plain if count == 1 else plain.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        yield [(row["item_id"], row["text"]) for row in part.collect()]


def find_contamination(
    frame: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    block_bytes: int = ITEM_BLOCK_BYTES,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
) -> DataFrame:
    """One row for each document: ``doc_id, n_words, n_hit, matches`` (item, place in words, longest length)."""
    return _found(frame, items, window, block_bytes, id_column, text_column, item_column).drop("key")


def _found(
    frame: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    block_bytes: int = ITEM_BLOCK_BYTES,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
) -> DataFrame:
    """``find_contamination``, with the hash of the text as ``key``."""
    spark = frame.sparkSession
    plain = documents(frame, id_column, text_column)
    passes = []
    for block in item_blocks(items, item_column, "text", block_bytes):
        shared = spark.sparkContext.broadcast(block)
        passes.append(_one_pass(plain, shared, window))
    if len(passes) == 1:
        found = passes[0]
    else:
        marked = [p.withColumn("copies", F.lit(1 if k == 0 else 0)) for k, p in enumerate(passes)]
        found = (
            reduce(DataFrame.unionByName, marked)
            .groupBy("doc_id", "key")
            .agg(
                F.max("n_words").alias("n_words"),
                F.array_distinct(F.flatten(F.collect_list("matches"))).alias("matches"),
                F.sum("copies").alias("copies"),
            )
            .select("doc_id", "key", "n_words", "matches", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        )
    return found.select("doc_id", "n_words", covered(F.col("matches")).alias("n_hit"), "matches", "key")


def _one_pass(plain: DataFrame, shared, window: int) -> DataFrame:
    held: list[Windows] = []

    def run(batch):
        if not held:
            held.append(Windows(shared.value, window))
        counts, found = match_texts(batch.column(1).to_pylist(), held[0])
        return {
            "doc_id": batch.column(0),
            "n_words": counts,
            "matches": [found.get(k, []) for k in range(batch.num_rows)],
            "key": batch.column(2),
        }

    keyed = plain.withColumn("key", F.xxhash64("text"))
    return map_blocks(keyed, run, f"doc_id bigint, n_words bigint, matches {MATCHES}, key bigint")


def remove_contaminated(frame: DataFrame, items: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """The documents, with all their columns, in which no window of any item occurs.

    Of several rows with one id those leave whose own text is affected; rows with a null id always stay.
    """
    affected = _found(frame, items, window, **options).where("n_hit > 0")
    affected = affected.select(F.col("doc_id").alias("_affected"), F.col("key").alias("_key")).distinct()
    own = F.xxhash64(as_text(options.get("text_column", "text"))) == F.col("_key")
    return frame.join(affected, (F.col(options.get("id_column", "doc_id")) == F.col("_affected")) & own, "left_anti")
