"""Shards of near-equal bytes by a k-d tree over document metadata.

Dimensions are size, bytes per character, lines and checksum of the text. A node is split along its widest dimension (its extent
relative to that of the root) at the median weighted by bytes, until the leaves reach the target. All nodes of a level are
split together: sketched quantiles of each node give edges, the bytes between the edges are summed where the rows are, and the
cut is refined once more inside the chosen interval. Only edges and sums, a fixed number for each node, reach the driver.

A coordinate is the value of the dimension, then a hash of the text, then a hash of the row, so copies of one text stay
together: a cut that would fall inside such a group moves to its nearer side, unless that shifts more bytes than
``GROUP_SLACK`` of a leaf. Larger groups are split, as sizes come first.

Size is the UTF-8 length of the text plus 1; null texts have none. Rows with equal ids are placed by id and text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.sources.staging import materialize

DIMENSIONS = 4
EDGES = 256
ROW_BITS, TEXT_BITS = 15, 28
GROUP_SLACK = 0.01
# A cut is good enough when it misses the half by this share of a leaf.
EXACT_ENOUGH = 0.001

COORDINATES = [f"at{d}" for d in range(DIMENSIONS)]


def metadata(frame: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32`` and the coordinates of every row."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    plain = frame.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.char_length(text).alias("chars"),
        (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit("")))).alias("lines"),
        F.xxhash64(text).alias("text_hash"),
    )
    values = [
        F.log2("size") * (1 << 15),
        (F.col("size") / (F.col("chars") + 1)) * (1 << 17),
        F.log2(F.col("lines") + 1) * (1 << 15),
        F.shiftrightunsigned("text_crc32", 12),
    ]
    group = F.col("text_hash").bitwiseAND((1 << TEXT_BITS) - 1)
    row = F.xxhash64("doc_id", "text_hash").bitwiseAND((1 << ROW_BITS) - 1)
    tail = F.shiftleft(group, ROW_BITS) + row
    return plain.select(
        "doc_id",
        "size",
        "text_crc32",
        "text_hash",
        *(
            (F.shiftleft(F.least(v.cast("bigint"), F.lit((1 << 20) - 1)), TEXT_BITS + ROW_BITS) + tail).alias(name)
            for v, name in zip(values, COORDINATES, strict=True)
        ),
    )


# A tree is a list of levels; a level gives each node its (dimension, cut). It goes to the tasks as it is, so the plans of
# all levels look alike and none grows with the tree.
Tree = list[dict[int, tuple[int, int]]]


def _nodes(batch: pa.RecordBatch, tree: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Node, coordinates and size of the rows of a batch with the columns of ``COORDINATES`` and ``size`` first."""
    places = np.stack([np.asarray(batch.column(d)) for d in range(DIMENSIONS)])
    node = np.zeros(batch.num_rows, dtype=np.int64)
    rows = np.arange(batch.num_rows)
    for level in tree:
        dims, cuts = np.zeros(max(level) + 1, np.int64), np.zeros(max(level) + 1, np.int64)
        for n, (d, cut) in level.items():
            dims[n], cuts[n] = d, cut
        node = 2 * node + (places[dims[node], rows] > cuts[node])
    return node, places, np.asarray(batch.column(DIMENSIONS))


def _plain(points: DataFrame) -> DataFrame:
    return points.select(*COORDINATES, "size")


def _extents(points: DataFrame, tree: Tree) -> dict[int, dict]:
    """Bytes of each node, and its least and greatest place in each dimension."""
    names = [f"{end}_{c}" for c in COORDINATES for end in ("low", "high")]

    def run(batches):
        for batch in batches:
            node, places, size = _nodes(batch, tree)
            for n in np.unique(node).tolist():
                own = places[:, node == n]
                ends = [int(f(d)) for d in own for f in (np.min, np.max)]
                yield pa.RecordBatch.from_pydict(dict(zip(["node", *names, "bytes"], [[v] for v in (n, *ends, int(size[node == n].sum()))], strict=True)))

    parts = _plain(points).mapInArrow(run, ", ".join(f"{c} bigint" for c in ["node", *names, "bytes"]))
    measures = [(F.min if c.startswith("low") else F.max)(c).alias(c) for c in names]
    return {r["node"]: r.asDict() for r in parts.groupBy("node").agg(*measures, F.sum("bytes").alias("bytes")).collect()}


def _edges(
    points: DataFrame, tree: Tree, dims: dict[int, int], inside: dict[int, tuple[int, int]]
) -> dict[int, np.ndarray]:
    """Sketched quantiles of each node along its dimension, of the points inside the interval ``(low, high]``."""

    def run(batches):
        for batch in batches:
            node, places, _ = _nodes(batch, tree)
            for n, d in dims.items():
                low, high = inside[n]
                own = places[d, node == n]
                own = own[(own > low) & (own <= high)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), n)), pa.array(own)], ["node", "place"])

    shares = [k / EDGES for k in range(1, EDGES)]
    found = _plain(points).mapInArrow(run, "node bigint, place bigint").groupBy("node")
    rows = found.agg(F.percentile_approx("place", shares, 20 * EDGES).alias("edges")).collect()
    return {r["node"]: np.unique(np.array(r["edges"], np.int64)) for r in rows}


def _bytes_up_to(
    points: DataFrame, tree: Tree, dims: dict[int, int], edges: dict[int, np.ndarray]
) -> dict[int, np.ndarray]:
    """Bytes of each node at or below each of its edges."""

    def run(batches):
        for batch in batches:
            node, places, size = _nodes(batch, tree)
            for n, own in edges.items():
                mine = node == n
                at = np.searchsorted(own, places[dims[n], mine], side="left")
                held = np.bincount(at, weights=size[mine], minlength=len(own) + 1).astype(np.int64)
                slot = np.flatnonzero(held)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(slot), n)), pa.array(slot), pa.array(held[slot])], ["node", "slot", "bytes"]
                )

    parts = _plain(points).mapInArrow(run, "node bigint, slot bigint, bytes bigint")
    totals = {n: np.zeros(len(e) + 1, np.int64) for n, e in edges.items()}
    for r in parts.groupBy("node", "slot").agg(F.sum("bytes").alias("bytes")).collect():
        totals[r["node"]][r["slot"]] = r["bytes"]
    return {n: np.cumsum(t)[:-1] for n, t in totals.items()}


def _cuts(
    points: DataFrame, tree: Tree, dims: dict[int, int], extents: dict[int, dict], leaf: dict[int, float]
) -> dict[int, int]:
    """The place of each node up to which it holds half of its bytes."""
    half = {n: extents[n]["bytes"] / 2 for n in dims}
    inside = {n: (extents[n][f"low_{COORDINATES[d]}"] - 1, extents[n][f"high_{COORDINATES[d]}"]) for n, d in dims.items()}
    best = {n: (abs(half[n]), inside[n][0]) for n in dims}
    going = dict(dims)
    while going:
        edges = _edges(points, tree, going, {n: inside[n] for n in going})
        below = _bytes_up_to(points, tree, going, edges)
        for n, own in edges.items():
            error = np.abs(below[n] - half[n])
            k = int(error.argmin())
            best[n] = min(best[n], (float(error[k]), int(own[k])))
            right = int(np.searchsorted(below[n], half[n]))
            low = int(own[right - 1]) if right else inside[n][0]
            high = int(own[right]) if right < len(own) else inside[n][1]
            narrower = (low, high) != inside[n] and high - low > 1
            inside[n] = (low, high)
            if best[n][0] <= EXACT_ENOUGH * leaf[n] or not narrower:
                del going[n]
        going = {n: d for n, d in going.items() if n in edges}
    cuts = {n: cut for n, (_, cut) in best.items()}
    # Copies of one text go to one side where that shifts few bytes.
    mask = (1 << ROW_BITS) - 1
    sides = {n: np.unique(np.array([(c & ~mask) - 1, c, c | mask], np.int64)) for n, c in cuts.items()}
    below = _bytes_up_to(points, tree, dims, sides)
    for n, c in cuts.items():
        for error, side in sorted(zip(np.abs(below[n] - half[n]).tolist(), sides[n].tolist(), strict=True)):
            if side != c and error <= GROUP_SLACK * leaf[n]:
                cuts[n] = side
                break
    return cuts


def grow(points: DataFrame, levels: int) -> Tree:
    """The tree of as many levels; an empty table has none."""
    tree: Tree = []
    root: dict = {}
    for level in range(levels):
        extents = _extents(points, tree)
        if not extents:
            return []
        root = root or extents[0]
        dims = {n: _widest(own, root) for n, own in extents.items()}
        leaf = {n: own["bytes"] / 2 ** (levels - level) for n, own in extents.items()}
        cuts = _cuts(points, tree, dims, extents, leaf)
        tree.append({n: (dims[n], cuts[n]) for n in dims})
    return tree


def _widest(own: dict, root: dict) -> int:
    """The dimension in which a node extends furthest, against the extent of the root."""
    shift = TEXT_BITS + ROW_BITS

    def width(name: str) -> float:
        whole = (root[f"high_{name}"] >> shift) - (root[f"low_{name}"] >> shift)
        return ((own[f"high_{name}"] >> shift) - (own[f"low_{name}"] >> shift)) / whole if whole else 0.0

    return max(range(DIMENSIONS), key=lambda d: width(COORDINATES[d]))


def leaves(points: DataFrame, tree: Tree) -> DataFrame:
    """``doc_id, size, text_crc32, text_hash`` and ``shard``, the number of the leaf, of every point."""
    kept = ["doc_id", "size", "text_crc32", "text_hash"]

    def run(batches):
        for batch in batches:
            shard = pa.array(_nodes(batch, tree)[0], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[DIMENSIONS + 1 :], shard], [*kept, "shard"])

    # The size stands both where the tree looks for it and among the results.
    wide = points.select(*COORDINATES, F.col("size").alias("weight"), *kept)
    return wide.mapInArrow(run, "doc_id bigint, size bigint, text_crc32 bigint, text_hash bigint, shard int")


def kd_shards(
    frame: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: slots count from 0 without gaps in each shard.

    ``shards`` is a power of two; with ``target_bytes`` the tree grows until an even leaf is no larger.
    """
    points = materialize(metadata(frame, id_column, text_column), "metadata")
    if shards is None:
        total = points.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        shards = 1
        while total > shards * (target_bytes or total or 1):
            shards *= 2
    if shards & (shards - 1):
        raise ValueError("The number of shards must be a power of two.")
    return _slots(leaves(points, grow(points, shards.bit_length() - 1)))


def _slots(placed: DataFrame) -> DataFrame:
    """Rows are numbered in small buckets of each shard, which take their offset from the buckets before."""
    from pyspark.sql import Window

    spark = placed.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(buckets)))
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("held"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_hash")
    numbered = placed.withColumn("place", F.row_number().over(inside) - 1)
    # At most shards x buckets rows.
    return numbered.join(F.broadcast(offsets), ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("place")).cast("bigint").alias("slot")
    )
