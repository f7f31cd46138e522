"""Whitening of embeddings: float32 eigenvectors of a distributed covariance, refined to double precision.

Entries become integers, ``floor(scale * c) + offset``. One pass adds them per dimension; a second one centres them by the whole
number next to the mean, multiplies each block with itself, and adds the products by row of the matrix. These sums are whole
numbers, exact in a double below 2^53, so neither the number of tasks nor their order changes them; what the whole number
misses of the mean is taken off afterwards. The matrix is decomposed in float32, and Ogita-Aishima steps correct the
vectors: each step is a few matrix products in extended precision and squares the error. Where eigenvalues lie closer than a step
can tell apart, the cluster is decomposed on its own in the span of its vectors, shifted by its mean, and the steps go on.
A last pass measures the covariance of the whitened rows.

Rows whose vector is null, or holds null or non-finite entries, are left out, and so are vectors whose length is not the
most frequent one (of equally frequent lengths the greatest). Entries beyond 2^52 in steps are held at that bound. Null ids and
repeated rows are rows like others. Components without variance (a constant dimension, fewer rows than dimensions) have null
``whitened``; an empty table gives an empty result. Columns other than the id and the vector are not kept, so none can
clash. The driver and each task hold a square of the dimension (128 MB at 4,096), whatever the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 32
# Entries of vectors that one product inside a task takes.
BLOCK_ENTRIES = 1 << 18
LARGEST_STEP = 1 << 52
LARGEST_LONG = 2**63 - 1
REFINEMENTS = 12

High = np.longdouble


@dataclass(frozen=True)
class Whitening:
    """What a fit found: vectors in columns, by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    vectors: np.ndarray
    trace: float
    scale: float
    offset: int

    @property
    def dimension(self) -> int:
        return len(self.sums)


def _vectors(batch: pa.RecordBatch, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of usable rows of a block and their entries."""
    column = batch.column(batch.schema.get_field_index("embedding"))
    lengths = pc.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False)
    places = np.flatnonzero(lengths == dimension)
    flat = pc.list_flatten(column.take(pa.array(places)))
    entries = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(len(places), dimension)
    finite = np.isfinite(entries).all(axis=1)
    return places[finite], entries[finite]


def _steps(entries: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * c)``, without the offset."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * entries), -LARGEST_STEP, LARGEST_STEP)


def _blocks(batches, dimension: int):
    rows = max(1, BLOCK_ENTRIES // max(1, dimension))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _plain(frame: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    return frame.select(
        F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("embedding")
    )


def _dimension(rows: DataFrame) -> int:
    """The most frequent length of usable vectors, 0 where there is none."""
    # NaN is above infinity in Spark, so one comparison finds both; a null makes it null.
    usable = F.forall("embedding", lambda c: (c < float("inf")) & (c > float("-inf")))
    found = (
        rows.where(F.coalesce(usable, F.lit(False)))
        .groupBy(F.size("embedding").alias("length"))
        .count()
        .orderBy(F.desc("count"), F.desc("length"))
        .first()
    )
    return found["length"] if found else 0


def fit(
    frame: DataFrame, scale: float = 64.0, offset: int = 1_000_000, id_column: str = "vec_id", vector_column: str = "embedding"
) -> Whitening:
    """Eigenvalues and eigenvectors of the covariance of all usable rows."""
    rows = _plain(frame, id_column, vector_column)
    dimension = _dimension(rows)
    if not dimension:
        return Whitening(0, (), np.zeros(0), np.zeros((0, 0)), 0.0, scale, offset)
    n, steps = _sums(rows, dimension, scale)
    whole = [(2 * s + n) // (2 * n) for s in steps]
    products = _products(rows, dimension, scale, np.array(whole, dtype=np.float64))
    # What is left of the mean, exactly a fraction of whole numbers.
    left = np.array([High(s - n * w) / High(n) for s, w in zip(steps, whole, strict=True)])
    covariance = products.astype(High) / High(n) - left[:, None] * left[None, :]
    eigenvalues, vectors = refined_eigen(covariance)
    trace = float(np.trace(covariance))
    return Whitening(n, tuple(s + n * offset for s in steps), eigenvalues, vectors, trace, scale, offset)


def _sums(rows: DataFrame, dimension: int, scale: float) -> tuple[int, list[int]]:
    def run(batches):
        n, total = 0, np.zeros(dimension, dtype=object)
        for batch in _blocks(batches, dimension):
            _, entries = _vectors(batch, dimension)
            n += len(entries)
            # Halves of each number keep the sums of a block within 64 bits.
            steps = _steps(entries, scale).astype(np.int64)
            high, low = steps >> 26, steps & ((1 << 26) - 1)
            total += high.sum(axis=0).astype(object) * (1 << 26) + low.sum(axis=0).astype(object)
        if n:
            from decimal import Decimal

            values = [Decimal(int(value)) for value in total]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dimension), pa.int32()), pa.array([n] * dimension, pa.int64()), pa.array(values, pa.decimal128(38, 0))],
                ["place", "n", "total"],
            )

    found = rows.select("embedding").mapInArrow(run, "place int, n bigint, total decimal(38,0)")
    added = found.groupBy("place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("place").collect()
    return added[0]["n"], [int(row["total"]) for row in added]


def _products(rows: DataFrame, dimension: int, scale: float, centre: np.ndarray) -> np.ndarray:
    """Sum of the centred outer products. A task sends one row for each row of the matrix."""

    def run(batches):
        total = np.zeros((dimension, dimension))
        for batch in _blocks(batches, dimension):
            _, entries = _vectors(batch, dimension)
            centred = _steps(entries, scale) - centre
            total += centred.T @ centred
        if total.any():
            yield _matrix_rows(total)

    return _added(rows.select("embedding").mapInArrow(run, MATRIX_ROWS), dimension)


MATRIX_ROWS = "place int, row array<double>"


def _matrix_rows(matrix: np.ndarray) -> pa.RecordBatch:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    row = pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))
    return pa.RecordBatch.from_arrays([pa.array(range(len(matrix)), pa.int32()), row], ["place", "row"])


def _added(found: DataFrame, dimension: int) -> np.ndarray:
    """The sum of matrices that tasks sent row by row; each row of the matrix is added on its own."""
    cells = found.select("place", F.posexplode("row").alias("column", "value"))
    added = cells.groupBy("place", "column").agg(F.sum("value").alias("value"))
    out = np.zeros((dimension, dimension))
    for place, column, value in added.collect():
        out[place, column] = value
    return out


def refined_eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix, to double precision."""
    matrix = matrix.astype(High)
    size = len(matrix)
    scale = np.abs(matrix).max() if size else High(0)
    if not scale:
        return np.zeros(size), np.eye(size)
    # A power of two, so nothing is rounded and float32 neither over- nor underflows.
    shrunk = matrix / High(2) ** np.ceil(np.log2(scale))
    _, rough = np.linalg.eigh(shrunk.astype(np.float32))
    vectors = rough.astype(High)
    before = None
    for _ in range(REFINEMENTS):
        vectors, values, change, width = _refinement(shrunk, vectors)
        groups = _clusters(values, width)
        for places in groups:
            vectors[:, places] = vectors[:, places] @ _within_cluster(shrunk, vectors[:, places], values[places].mean())
        if change < 64 * size * np.finfo(High).eps or (before is not None and change >= before and change < 2.0**-50 and not groups):
            break
        before = change
    # Close vectors may have lost their right angles to rounding over a small gap.
    for _ in range(2):
        vectors = vectors + vectors @ ((np.eye(size, dtype=High) - vectors.T @ vectors) / 2)
    vectors = vectors / np.sqrt((vectors * vectors).sum(axis=0))
    values = (vectors * (matrix @ vectors)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order].astype(np.float64), vectors[:, order].astype(np.float64)


def _refinement(matrix: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One Ogita-Aishima step: better vectors, eigenvalues, the size of the correction and the gap it can tell apart."""
    ones = np.eye(len(matrix), dtype=High)
    lack = ones - vectors.T @ vectors
    turned = vectors.T @ (matrix @ vectors)
    values = np.diag(turned) / (1 - np.diag(lack))
    off = turned - np.diag(values)
    width = 2 * (np.linalg.norm(off.astype(np.float64)) + np.abs(values).max() * np.linalg.norm(lack.astype(np.float64)))
    width = float(max(width, np.abs(values).max() * 16 * np.finfo(High).eps))
    gaps = values[None, :] - values[:, None]
    apart = np.abs(gaps) > width
    # Vectors too close to tell apart are only made orthogonal here.
    correction = np.where(apart, (turned + values[None, :] * lack) / np.where(apart, gaps, 1), lack / 2)
    return vectors + vectors @ correction, values, float(np.abs(correction).max()), width


def _clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Runs of two or more eigenvalues, each within ``width`` of the next."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > width) + 1
    return [run for run in np.split(order, cuts) if len(run) > 1]


def _within_cluster(matrix: np.ndarray, vectors: np.ndarray, middle: float) -> np.ndarray:
    """Directions of a cluster in the span of its vectors: what is left after the shift is decomposed at its own scale."""
    inner = vectors.T @ (matrix @ vectors) - middle * (vectors.T @ vectors)
    inner = (inner + inner.T) / 2
    largest = np.abs(inner).max()
    if not largest:
        return np.eye(len(inner), dtype=High)
    _, turned = np.linalg.eigh((inner / largest).astype(np.float64))
    return turned.astype(High)


WHITE = "vec_id bigint, deviation bigint, whitened array<double>"


def whiten(
    frame: DataFrame, model: Whitening, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """Usable rows: ``vec_id``, ``deviation`` (exact; null beyond 64 bits) and ``whitened``, an array of the first components."""
    dimension, n, scale = model.dimension, model.n, model.scale
    shown = min(components, dimension)
    values, weights = model.eigenvalues[:shown], np.zeros((dimension, shown))
    varied = _varied(model, shown)
    weights[:, varied] = model.vectors[:, :shown][:, varied] / np.sqrt(values[varied])
    steps = [s - n * model.offset for s in model.sums]
    if not n:
        return frame.sparkSession.createDataFrame([], WHITE)
    # The mean is a whole number and a fraction rest / n.
    base = np.array([s // n for s in steps], dtype=np.int64)
    rests = [s % n for s in steps]
    fraction = np.array(rests, dtype=np.float64) / n

    def run(batches):
        for batch in _blocks(batches, dimension):
            places, entries = _vectors(batch, dimension)
            own = _steps(entries, scale).astype(np.int64) - base
            white = np.ascontiguousarray((own - fraction) @ weights)
            white = pa.array(white.ravel(), mask=np.broadcast_to(~varied, white.shape).ravel())
            ends = np.arange(len(places) + 1, dtype=np.int32) * shown
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(places)), pa.array(_deviations(own, n, rests), pa.int64()), pa.ListArray.from_arrays(ends, white)],
                ["vec_id", "deviation", "whitened"],
            )

    return _plain(frame, id_column, vector_column).mapInArrow(run, WHITE)


def _varied(model: Whitening, shown: int) -> np.ndarray:
    least = np.finfo(np.float64).eps * model.dimension * (model.eigenvalues[0] if model.dimension else 0)
    return model.eigenvalues[:shown] > least


def _deviations(own: np.ndarray, n: int, rests: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n * own - rest)^2, in whole numbers."""
    if not len(own):
        return []
    reach = int(np.abs(own).max()) * n + n
    if own.shape[1] * reach * reach <= LARGEST_LONG:
        off = own * n - np.array(rests, dtype=np.int64)
        return (off * off).sum(axis=1).tolist()
    off = own.astype(object) * n - np.array(rests, dtype=object)
    return [total if total <= LARGEST_LONG else None for total in map(int, (off * off).sum(axis=1))]


def identity_error(white: DataFrame, model: Whitening, components: int = COMPONENTS) -> float | None:
    """Largest absolute entry of the covariance of whitened rows minus the identity, over components with variance."""
    shown = min(components, model.dimension)
    varied = _varied(model, shown)
    if not varied.any():
        return None

    def blocks(batches):
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            yield flat.reshape(-1, shown)[:, varied]

    def add(batches):
        total = np.zeros(int(varied.sum()))
        for block in blocks(batches):
            total += block.sum(axis=0)
        yield _matrix_rows(total[None, :])

    count = int(varied.sum())
    rows = white.select("whitened")
    mean = _added(rows.mapInArrow(add, MATRIX_ROWS), count)[0] / model.n

    def multiply(batches):
        total = np.zeros((count, count))
        for block in blocks(batches):
            total += (block - mean).T @ (block - mean)
        yield _matrix_rows(total)

    covariance = _added(rows.mapInArrow(multiply, MATRIX_ROWS), count) / model.n
    return float(np.abs(covariance - np.eye(count)).max())


def by_component(white: DataFrame, model: Whitening, error: float | None, components: int = COMPONENTS) -> DataFrame:
    """A row for each usable row and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    shown = min(components, model.dimension)
    share = [float(e) / model.trace if model.trace else None for e in model.eigenvalues[:shown]]
    explained = F.array(*(F.lit(s).cast("double") for s in share)) if shown else F.array().cast("array<double>")
    each = white.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
