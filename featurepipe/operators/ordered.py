"""Work that needs rows in a total order, without sorting them in one task.

Rows are cut into ordered buckets at split points. A bucket is handled by one task, and
what a bucket must know of the buckets before it (totals, counts, a few last rows) is
small. Split points only decide how even the buckets are, never the result, so a sample
of the keys is enough to choose them.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featurepipe.sources.staging import materialize

# Rows one bucket should hold; callers pass another number where rows are wide or tasks are small.
BUCKET_ROWS = 200_000

# Most buckets of one number column: what a driver and a sketch hold easily.
MOST_BUCKETS = 100_000

# Sizes of the sketches that choose split points; the largest has a rank error of some 0.01 %.
LEAST_SKETCH, SKETCH_PER_PART, LARGEST_SKETCH = 1_000, 16, 65_535

# Spark numbers the rows of a partition from the lowest of so many bits.
PLACE_BITS = 33


def small_table(spark: SparkSession, columns: dict[str, list], schema: str) -> DataFrame:
    """A table from values the driver holds. Arrow input becomes a local relation, so its size is known to the planner."""
    return spark.createDataFrame(pa.table(columns), schema=schema)


def bucket_count(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    return max(1, math.ceil(rows / bucket_rows))


def counts_and_points(frame: DataFrame, columns: list[str], side: str, bucket_rows: int) -> dict[str, tuple]:
    """For each number column the values with ``side`` 0, those with 1, and split points.

    One aggregate counts all columns, and where some need more than one bucket another sketches their quantiles.
    """
    measures = []
    for i, c in enumerate(columns):
        value = F.col(c)
        measures += [
            F.count_if(value.isNotNull() & (F.col(side).cast("int") == 0)).alias(f"a{i}"),
            F.count_if(value.isNotNull() & (F.col(side).cast("int") == 1)).alias(f"b{i}"),
        ]
    counted = frame.agg(*measures).first()
    found = {c: (counted[f"a{i}"], counted[f"b{i}"]) for i, c in enumerate(columns)}
    cut = {c: bucket_count(a + b, bucket_rows) for c, (a, b) in found.items()}
    cut = {c: min(n, MOST_BUCKETS) for c, n in cut.items() if n > 1}
    points: dict[str, list] = {c: [] for c in columns}
    if cut:
        points |= spread_points(frame, {c: (F.col(c), n) for c, n in cut.items()})
    return {c: (*found[c], points[c]) for c in columns}


def spread_points(frame: DataFrame, wanted: dict[str, tuple[Column, int]]) -> dict[str, list[float]]:
    """For each (number column, parts) the distinct values at about each 1/parts of the ranks; NULL and NaN are skipped.

    Where to look, never what is found: a point may lie some 0.01 % of the rows beside its rank, and differs between runs.
    """
    names = {c: f"__sketch{i}" for i, c in enumerate(wanted)}
    sketches = merged_sketches(frame, {names[c]: entry for c, entry in wanted.items()})
    chosen = []
    for c, (_, parts) in wanted.items():
        shares = _shares(parts)
        # An empty sketch has no quantiles.
        filled = F.kll_sketch_get_n_double(names[c]) > 0
        chosen.append(F.when(filled, F.kll_sketch_get_quantile_double(F.col(names[c]), shares)).alias(names[c]))
    found = sketches.select(*chosen).first()
    return {c: sorted(set(found[names[c]] or [])) for c in wanted}


def _shares(parts: int) -> Column:
    return F.array(*[F.lit(k / parts) for k in range(1, parts)])


def merged_sketches(frame: DataFrame, wanted: dict[str, tuple[Column, int]]) -> DataFrame:
    """One row with a quantile sketch of each (number column, parts).

    Sketches are merged in two levels, so no task receives those of more than about sqrt(splits) others, and the size of a sketch
    depends neither on the rows nor on the number of points.
    """
    groups = max(1, math.isqrt(frame.rdd.getNumPartitions()))
    size = {c: min(LARGEST_SKETCH, max(LEAST_SKETCH, SKETCH_PER_PART * parts)) for c, (_, parts) in wanted.items()}
    numbers = {c: F.when(~F.isnan(value), value.cast("double")) for c, (value, _) in wanted.items()}
    partial = frame.groupBy((F.spark_partition_id() % groups).alias("__group")).agg(
        *[F.kll_sketch_agg_double(numbers[c], size[c]).alias(c) for c in wanted]
    )
    return partial.agg(*[F.kll_merge_agg_double(c, size[c]).alias(c) for c in wanted])


def blocks_of(points: Column) -> Column:
    """Split points as blocks of about sqrt(n), so that a lookup compares 2 * sqrt(n) keys and not n."""
    width = F.greatest(F.ceil(F.sqrt(F.size(points))).cast("int"), F.lit(1))
    starts = F.when(F.size(points) > 0, F.sequence(F.lit(1), F.size(points), width)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda at: F.slice(points, at, width))


def with_number_buckets(frame: DataFrame, names: dict[str, str], points: dict[str, list[float]]) -> DataFrame:
    """For each number column add, under the given name, how many of its split points are at or below the value.

    Numbers have a compiled binary search in Spark ML. NaN gets the last bucket, NULL gets none.
    """
    cut = {c: sorted({p + 0.0 for p in points[c]}) for c in names}
    columns = [c for c in names if cut[c]]
    if columns:
        frame = Bucketizer(
            splitsArray=[[-math.inf, *[p for p in cut[c] if math.isfinite(p)], math.inf] for c in columns],
            inputCols=columns,
            outputCols=[names[c] for c in columns],
            handleInvalid="keep",
        ).transform(frame)
    return frame.withColumns(
        {name: F.col(name).cast("int") if cut[c] else F.lit(0) for c, name in names.items()}
    )


def with_bucket(frame: DataFrame, name: str, key: Column, blocks: Column) -> DataFrame:
    """Add how many split points (as blocks, from a column) are at or below the key: 0 for the first bucket.

    The count of passed blocks is a projection of its own, so that it is computed once per row.
    """
    passed = "__passed_blocks"
    counted = frame.withColumn(passed, F.size(F.filter(blocks, lambda block: F.get(block, F.lit(0)) <= key)))
    at = F.col(passed) - 1
    inside = F.size(F.filter(F.get(blocks, at), lambda point: point <= key))
    bucket = F.when(at < 0, F.lit(0)).otherwise(at * F.size(F.get(blocks, F.lit(0))) + inside)
    return counted.withColumn(name, bucket).drop(passed)


def with_global_rank(
    frame: DataFrame, order: dict[str, Column], rank: str, rows: int, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Add the 0-based position of each row in the order of the given unique key.

    Spark cuts the rows by ranges of the key and sorts each range; the table is staged with the range and place of each row.
    What a range must know is how many rows the ranges before it hold: one small row for each. The plan has the same size for any
    number of rows, and no key is written into it.
    """
    place, bucket, start = "__place", "__bucket", "__start"
    keys = {f"__key{i}": column for i, column in enumerate(order.values())}
    cut = frame.withColumns(keys).repartitionByRange(bucket_count(rows, bucket_rows), *keys).sortWithinPartitions(*keys)
    # The upper bits of this number are the partition, the lower ones the place in it.
    placed = materialize(cut.drop(*keys).withColumn(place, F.monotonically_increasing_id()), "ranked")
    within, of_range = F.col(place).bitwiseAND((1 << PLACE_BITS) - 1), F.shiftright(F.col(place), PLACE_BITS)
    sizes = placed.groupBy(of_range.alias(bucket)).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(bucket, F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias(start))
    return (
        placed.withColumn(bucket, of_range)
        .join(F.broadcast(starts), bucket)
        .withColumn(rank, within + F.col(start))
        .drop(bucket, start, place)
    )
