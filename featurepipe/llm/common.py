"""Helpers of the text operators: Arrow batches in tasks, word hashes, spans, blocks of text."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text that one step inside a task works on; a longer text is a step of its own.
BLOCK_BYTES = 4 << 20

U64 = np.uint64


def as_text(column: Column | str) -> Column:
    """A text column in which null is the empty text."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def documents(frame: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text`` of a table, so that no other column can clash; null text is empty."""
    return frame.select(F.col(id_column).cast("bigint").alias("doc_id"), as_text(text_column).alias("text"))


def blocks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices with at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum(np.asarray(pc.binary_length(column).fill_null(0)), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def arrow_schema(frame_schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(frame_schema)


def map_blocks(frame: DataFrame, function: Callable, schema: str, text: str = "text", limit: int = BLOCK_BYTES):
    """Apply ``function(batch) -> dict of columns`` to slices of bounded size, in every task, which gives freed memory back."""

    def run(batches):
        for batch in blocks(batches, text, limit):
            yield table_batch(function(batch), target)

    target = arrow_schema(_parsed(schema))
    return frame.mapInArrow(gives_back(run), schema)


def gives_back(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over the batches of a task that returns freed memory to the system before and after it.

    Workers outlive their tasks, and what a task has freed would stay with the allocators of idle ones.
    """

    def run(batches):
        give_back()
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _parsed(schema: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(schema)


def table_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_array(columns[f.name], f.type) for f in schema], schema=schema)


def _array(values, kind) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def mix(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    values = values ^ (values >> U64(31))
    values = values * U64(0x7FB5D329728EA185)
    values = values ^ (values >> U64(27))
    values = values * U64(0x81DADEF4BC2DD44D)
    return values ^ (values >> U64(33))


class WordHashes(dict):
    """64-bit hash of a word, kept while there is room."""

    def __init__(self, keep: int = 200_000):
        super().__init__()
        self.keep = keep

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.keep:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=U64, count=len(words))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words in order; of the whole sequence where it is shorter, of none where empty."""
    if not len(words):
        return words
    size = min(size, len(words))
    count = len(words) - size + 1
    total = words[:count]
    for k in range(1, size):
        total = mix(total) + words[k : k + count]
    return mix(total + U64(size))


def plain_words(text: str) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case."""
    return text.encode().lower().split()


def merged_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals as maximal runs in order; touching ones join."""
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.flatnonzero(np.concatenate(([True], starts[1:] > reach[:-1])))
    return starts[first], np.concatenate((reach[first[1:] - 1], reach[-1:]))


def in_pieces(items: Iterable, size: int) -> Iterator[list]:
    iterator = iter(items)
    while piece := list(islice(iterator, size)):
        yield piece
