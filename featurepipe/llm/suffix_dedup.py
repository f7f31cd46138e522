"""Exact removal of byte strings that occur earlier, by sorting the suffixes that can repeat.

Every window of ``window`` bytes names one of its ``SEED``-byte strings as its anchor (the one of least hash), so equal
windows have equal anchors. Consecutive windows with one anchor form a chunk.

1. Chunks are listed by the hash of their anchor, a few bytes each. Equal chunks (119 bits of hash agree) are settled
   first inside each block and then among all: all but the earliest are repeats. An anchor with a single different chunk
   is done, and most chunks end here.
2. The bytes of the remaining chunks go to the task of their anchor. Each task orders the suffixes of its windows by
   deep-shallow sorting; equal ones stand together, and all but the earliest are repeats.
3. Repeats come back to their documents, and every byte that one covers is removed.

An anchor with more than ``HEAVY_CHUNKS`` chunks is dealt out by whole windows instead, so that neither a frequent line
nor a third of the table ends in one task; equal windows of a block are one row then. Earlier means a smaller id, or the same document and an earlier start.

Null and empty texts have no bytes. Where ids repeat or are null, rows follow the order (id, null first; text) and count
as different documents. Runs of one letter and very long texts are ordinary input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.common import U64, documents, merged_spans, mix
from featurepipe.llm.suffix_sort import order_suffixes
from featurepipe.sources.staging import materialize

WINDOW = 100
SEED = 24
HEAVY_CHUNKS = 20_000
PIECE_BYTES = 1 << 20
# Windows that a task orders at once.
SORT_WINDOWS = 1_500_000

SPANS = "array<struct<start:bigint,end:bigint>>"


def byte_hashes(data: np.ndarray, lengths: tuple[int, ...]) -> list[np.ndarray]:
    """Hashes of the strings of some lengths (8 times a power of two, or the sum of two such) from each position on, by doubling."""
    values, length, known = mix(data.astype(U64) + U64(1)), 1, {}
    for wanted in sorted({part for n in lengths for part in _parts(n)}):
        while length < wanted:
            values = mix(values[:-length] * U64(0x9E3779B97F4A7C15) + values[length:])
            length *= 2
        known[wanted] = values
    out = []
    for n in lengths:
        first, *second = _parts(n)
        if second:
            end = len(data) - n + 1
            out.append(mix(known[first][:end] * U64(0xD6E8FEB86659FD93) + known[second[0]][first : first + end]))
        else:
            out.append(known[first])
    return out


def _parts(n: int) -> list[int]:
    large = 1 << (n.bit_length() - 1)
    return [large] if n == large else [large, n - large]


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values in a row."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return np.minimum(values[: len(values) - (width - reach)], values[width - reach :]) if reach < width else values


def chunks(data: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Start, number of windows, anchor hash and content hash of each chunk of texts laid end to end; ``ends`` of the texts."""
    if len(data) < window:
        return (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, U64), np.empty(0, U64))
    part = 1 << (window.bit_length() - 1)
    hashes, parts = byte_hashes(data, (SEED, part))
    bits = U64(max(1, int(len(data)).bit_length()))
    keys = (hashes >> bits << bits) | np.arange(len(hashes), dtype=U64)
    anchors = (sliding_least(keys, window - SEED + 1) & ((U64(1) << bits) - U64(1))).astype(np.int64)
    # Windows that cross the end of a text are none.
    marks = np.zeros(len(anchors) + 1, dtype=np.int64)
    np.add.at(marks, np.clip(ends[:-1] - window + 1, 0, len(anchors)), 1)
    np.add.at(marks, np.clip(ends[:-1], 0, len(anchors)), -1)
    valid = np.cumsum(marks)[:-1] <= 0
    new, stop = valid.copy(), valid.copy()
    new[1:] &= (anchors[1:] != anchors[:-1]) | ~valid[:-1]
    stop[:-1] &= (anchors[1:] != anchors[:-1]) | ~valid[1:]
    starts, lasts = np.flatnonzero(new), np.flatnonzero(stop)
    counts = lasts - starts + 1
    # A chunk has less than four such parts, so four that are spread over it cover it.
    room = counts + window - 1 - part
    content = counts.astype(U64)
    for k in range(4):
        content = mix(content * U64(0x9E3779B97F4A7C15) + parts[starts + room * k // 3])
    return starts, counts, hashes[anchors[starts]], content


def _pieces(batches, window: int):
    """(rows, offsets in their texts, ends, bytes) of texts laid end to end; a long text comes in overlapping parts."""
    held, size = [], 0
    for batch in batches:
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            raw = text.encode()
            for base in range(0, max(1, len(raw) - window + 1), PIECE_BYTES):
                held.append((row, base, raw[base : base + PIECE_BYTES + window - 1]))
                size += len(held[-1][2])
                if size >= PIECE_BYTES:
                    yield _laid_out(held)
                    held, size = [], 0
    if held:
        yield _laid_out(held)


def _laid_out(held):
    rows = np.array([h[0] for h in held], dtype=np.int64)
    bases = np.array([h[1] for h in held], dtype=np.int64)
    ends = np.cumsum([len(h[2]) for h in held], dtype=np.int64)
    return rows, bases, ends, b"".join(h[2] for h in held)


def _record(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names.split())


def _listed(docs: DataFrame, window: int) -> DataFrame:
    """(anchor, content, row, start): chunks; ``content`` is 55 bits of hash, 7 bits of count, and whether it is settled.

    Settled are those with an equal earlier chunk in their block. They only pass through, so they are dealt out evenly.
    """

    def run(batches):
        for rows, bases, ends, raw in _pieces(batches, window):
            starts, counts, anchors, contents = chunks(np.frombuffer(raw, np.uint8), ends, window)
            text = np.searchsorted(ends, starts, side="right")
            begin = np.concatenate(([0], ends[:-1]))
            row, start = rows[text], starts - begin[text] + bases[text]
            content = (contents >> U64(9) << U64(9)) | counts.astype(U64) << U64(1)
            order = np.lexsort((start, row, content, anchors))
            settled = np.zeros(len(order), dtype=bool)
            settled[order[1:]] = (anchors[order][1:] == anchors[order][:-1]) & (content[order][1:] == content[order][:-1])
            anchors = np.where(settled, mix(row.astype(U64) * U64(31) + start.astype(U64)), anchors)
            yield _record("anchor content row start", anchors.view(np.int64), (content | settled.astype(U64)).view(np.int64), row, start)

    return docs.mapInArrow(run, "anchor bigint, content bigint, row bigint, start bigint")


COUNT_MASK = 0xFF


def _repeating(listed: DataFrame) -> DataFrame:
    """(row, anchor, code) of chunks that repeat or may: ``code`` is start, count and kind.

    Kind 0 is settled: an equal chunk comes earlier. Kind 1 is the first of several different chunks of an anchor, kind 2 that
    of a heavy anchor. The last group of a batch waits for the next one, as long as it is not heavy.
    """

    def run(batches):
        pending = [np.empty(0, np.int64)] * 4
        last = None  # anchor and content of the last different chunk
        heavy = None  # anchor of a group that is known to be heavy
        for batch in batches:
            anchor, content, row, start = (np.asarray(c) for c in batch.columns)
            if not len(anchor):
                continue
            again = np.zeros(len(anchor), dtype=bool)
            again[1:] = (anchor[1:] == anchor[:-1]) & (content[1:] == content[:-1])
            again[0] = last == (anchor[0], content[0])
            last = (anchor[-1], content[-1])
            settled = again | (content & 1 == 1)
            yield _coded(row[settled], np.zeros(int(settled.sum()), np.int64), start[settled], content[settled], 0)
            columns = [np.concatenate((p, c[~settled])) for p, c in zip(pending, (anchor, content, row, start), strict=True)]
            anchor = columns[0]
            if not len(anchor):
                continue
            heads = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
            sizes = np.diff(np.append(heads, len(anchor)))
            known = np.repeat(sizes > HEAVY_CHUNKS, sizes) | (anchor == heavy if heavy is not None else False)
            done = len(anchor) if known[-1] else heads[-1]
            heavy = anchor[-1] if known[-1] else None
            yield from _kept([c[:done] for c in columns], known[:done], np.repeat(sizes, sizes)[:done])
            pending = [c[done:] for c in columns]
        yield from _kept(pending, np.zeros(len(pending[0]), bool), np.full(len(pending[0]), len(pending[0])))

    def _kept(columns, heavy, sizes):
        anchor, content, row, start = columns
        for keep, kind in ((heavy, 2), (~heavy & (sizes > 1), 1)):
            if keep.any():
                yield _coded(row[keep], anchor[keep], start[keep], content[keep], kind)

    def _coded(row, anchor, start, content, kind):
        return _record("row anchor code", row, anchor, start << 9 | (content >> 1 & COUNT_MASK) << 2 | kind)

    dealt = listed.repartition("anchor").sortWithinPartitions("anchor", "content", "row", "start")
    return dealt.mapInArrow(run, "row bigint, anchor bigint, code bigint")


def _with_bytes(docs: DataFrame, repeating: DataFrame, window: int) -> DataFrame:
    """(anchor, row, start, count, content): chunks with their bytes; runs of settled windows have a count only."""

    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            windows: dict[bytes, tuple] = {}
            for row, text, anchors, codes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode()
                codes, anchors = np.array(codes, np.int64), np.array(anchors, np.int64)
                kind, count, start = codes & 3, codes >> 2 & 0x7F, codes >> 9
                settled = kind == 0
                for a, b in zip(*merged_spans(start[settled], start[settled] + count[settled]), strict=True):
                    out.append((_scattered(row, int(a)), row, int(a), int(b - a), None))
                for k in np.flatnonzero(~settled).tolist():
                    first, number = int(start[k]), int(count[k])
                    if kind[k] == 1:
                        out.append((int(anchors[k]), row, first, number, raw[first : first + number + window - 1]))
                        continue
                    for at in range(first, first + number):
                        own = raw[at : at + window]
                        mine, known = (row, at), windows.get(own)
                        if known is None or mine < known:
                            windows[own], mine = mine, known
                        if mine is not None:
                            out.append((_scattered(*mine), *mine, 1, None))
                if len(out) > 20_000:
                    yield _rows(out)
                    out = []
            for own, (row, at) in windows.items():
                out.append((xxhash.xxh3_64_intdigest(own) - (1 << 63), row, at, 1, own))
            if out:
                yield _rows(out)

    def _scattered(row, at):
        return (row * 0x9E3779B97F4A7C15 + at * 0xD6E8FEB86659FD93) % (1 << 63)

    def _rows(out):
        anchor, row, start, count, content = zip(*out, strict=True)
        return _record("anchor row start count content", list(anchor), list(row), list(start), list(count), pa.array(content, pa.binary()))

    grouped = repeating.groupBy("row").agg(F.collect_list("anchor").alias("anchors"), F.collect_list("code").alias("codes"))
    joined = docs.join(grouped, "row").select("row", "text", "anchors", "codes")
    return joined.mapInArrow(run, "anchor bigint, row bigint, start bigint, count bigint, content binary")


def repeats(
    anchors: np.ndarray, counts: np.ndarray, contents: list[bytes], window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For chunks in order of age, those windows that an earlier one equals: runs as (chunk, first, number)."""
    whole = np.zeros(len(contents), dtype=bool)
    seen: dict[bytes, int] = {}
    last = None
    distinct: list[int] = []
    spans: list[tuple[int, int]] = []
    for k, content in enumerate(contents):
        if anchors[k] != last:
            seen, last = {}, anchors[k]
            spans.append((len(distinct), len(distinct)))
        if content in seen:
            whole[k] = True
        else:
            seen[content] = k
            distinct.append(k)
            spans[-1] = (spans[-1][0], len(distinct))
    several = [k for first, end in spans if end - first > 1 for k in distinct[first:end]]
    found = [(np.flatnonzero(whole), np.zeros(int(whole.sum()), np.int64), counts[whole])]
    begin = 0
    while begin < len(several):
        # Whole groups, of as many windows as are ordered at once.
        end, size = begin, 0
        while end < len(several) and (size < SORT_WINDOWS or anchors[several[end]] == anchors[several[end - 1]]):
            size += int(counts[several[end]])
            end += 1
        found.append(_ordered(np.array(several[begin:end]), anchors, counts, contents, window))
        begin = end
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def _ordered(own: np.ndarray, anchors, counts, contents, window):
    data = np.frombuffer(b"".join([contents[k] for k in own.tolist()]), np.uint8)
    sizes = counts[own]
    begin = np.cumsum(sizes + window - 1) - (sizes + window - 1)
    chunk = np.repeat(np.arange(len(own)), sizes)
    within = np.arange(len(chunk)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    group = np.cumsum(np.concatenate(([0], anchors[own][1:] != anchors[own][:-1])))
    places = order_suffixes(data, begin[chunk] + within, group[chunk], window)
    # Windows are numbered by age, so of equal ones the first number stays.
    first = np.full(int(places.max()) + 1, len(places))
    np.minimum.at(first, places, np.arange(len(places)))
    again = first[places] != np.arange(len(places))
    new, stop = again.copy(), again.copy()
    new[1:] &= ~again[:-1] | (chunk[1:] != chunk[:-1])
    stop[:-1] &= ~again[1:] | (chunk[1:] != chunk[:-1])
    heads, tails = np.flatnonzero(new), np.flatnonzero(stop)
    return own[chunk[heads]], within[heads], tails - heads + 1


def _removed(chunked: DataFrame, window: int) -> DataFrame:
    """(row, start, end) of removed bytes."""

    def run(batches):
        pending = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if pending is None else [pending, batch]).combine_chunks()
            if not table.num_rows:
                continue
            batch = table.to_batches()[0]
            anchor = np.asarray(batch.column(0))
            tail = int(np.searchsorted(anchor, anchor[-1]))
            pending = batch.slice(tail)
            if tail:
                yield _spans(batch.slice(0, tail))
        if pending is not None:
            yield _spans(pending)

    def _spans(batch):
        anchor, row, start, count = (np.asarray(batch.column(k)) for k in range(4))
        open_ = np.asarray(batch.column(4).is_valid())
        contents = batch.column(4).filter(pa.array(open_)).to_pylist()
        own = np.flatnonzero(open_)
        which, first, number = repeats(anchor[own], count[own], contents, window)
        settled = np.flatnonzero(~open_)
        rows = np.concatenate((row[settled], row[own][which]))
        starts = np.concatenate((start[settled], start[own][which] + first))
        ends = starts + np.concatenate((count[settled], number)) + window - 1
        return _record("row start end", rows, starts, ends)

    dealt = chunked.repartition("anchor").sortWithinPartitions("anchor", "row", "start")
    return dealt.mapInArrow(run, "row bigint, start bigint, end bigint")


def _numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(row, text) with a row number in the order of age, and the ids of the numbers where they differ."""
    counted = docs.select(F.count("*").alias("n"), F.count("doc_id").alias("named")).first()
    distinct = docs.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").limit(1).count()
    if counted["named"] == counted["n"] and not distinct:
        return docs.select(F.coalesce("doc_id", F.lit(-1)).alias("row"), "text"), None
    ordered = docs.orderBy(F.asc_nulls_first("doc_id"), "text").withColumn("row", F.monotonically_increasing_id())
    ordered = materialize(ordered, "numbered")
    return ordered.select(F.coalesce("row", F.lit(-1)).alias("row"), "text"), ordered.select("row", "doc_id")


def remove_repeats(
    frame: DataFrame, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, removed`` (maximal byte spans) and ``kept`` (the remaining bytes) for every row."""
    if not SEED < window <= SEED + 126:
        raise ValueError(f"A window must have {SEED + 1} to {SEED + 126} bytes.")
    docs, ids = _numbered(documents(frame, id_column, text_column))
    repeating = _repeating(_listed(docs, window))
    removed = _removed(_with_bytes(docs, repeating, window), window)
    spans = removed.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def run(batches):
        for batch in batches:
            cut, kept, sizes = [], [], []
            for text, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = text.encode()
                starts, ends = merged_spans(
                    np.array([s["start"] for s in own or []], np.int64), np.array([s["end"] for s in own or []], np.int64)
                )
                edges = zip([0, *ends.tolist()], [*starts.tolist(), len(raw)], strict=True)
                kept.append(b"".join(raw[a:b] for a, b in edges))
                cut.append([{"start": a, "end": b} for a, b in zip(starts.tolist(), ends.tolist(), strict=True)])
                sizes.append(len(raw))
            spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield _record(
                "row n_bytes removed kept", batch.column(0), pa.array(sizes, pa.int64()), pa.array(cut, spans_type), pa.array(kept, pa.binary())
            )

    joined = docs.join(spans, "row", "left").select("row", "text", "spans")
    done = joined.mapInArrow(run, f"row bigint, n_bytes bigint, removed {SPANS}, kept binary")
    if ids is None:
        return done.withColumnRenamed("row", "doc_id")
    return done.join(ids, "row").select("doc_id", "n_bytes", "removed", "kept")
