"""Column statistics. Each function reads the frame once for all columns, unless it says otherwise."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurepipe.functions.numeric import as_double
from featurepipe.operators.ordered import spread_points, with_number_buckets

# Default rank error of quantiles, as a share of the rows.
RELATIVE_ERROR = 0.001

# Exact quantiles: sketched points that cut a value range into cells, and the rows below which a cell's values are
# listed one by one. Neither influences a result.
CELLS = 200
LISTED_ROWS = 20_000

# Columns handled in one job: small enough that the aggregate compiles to one method, where a very wide
# one falls back to interpretation. Parquet reads only those columns, so more jobs do not read more bytes.
COLUMN_BATCH = 16


def batches(items: list, size: int = COLUMN_BATCH) -> Iterable[list]:
    return (items[i : i + size] for i in range(0, len(items), size))


def row_count(frame: DataFrame) -> int:
    return frame.count()


def null_counts(frame: DataFrame) -> tuple[int, dict[str, int]]:
    """Number of rows, and of NULLs per column."""
    columns = frame.columns
    row = frame.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(columns)],
    ).first()
    return row["rows"], {c: row["rows"] - row[f"n{i}"] for i, c in enumerate(columns)}


def null_profile(frame: DataFrame) -> DataFrame:
    """One row per column: rows, NULLs, non-NULLs and the NULL share."""
    counts = [F.count(F.col(f"`{c}`")) for c in frame.columns]
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), n.alias("non_null_count")) for c, n in zip(frame.columns, counts)]
    )
    totals = frame.agg(F.count(F.lit(1)).alias("row_count"), entries.alias("entries"))
    return totals.select("row_count", F.inline("entries")).select(
        "column",
        "row_count",
        "non_null_count",
        (F.col("row_count") - F.col("non_null_count")).alias("null_count"),
        F.coalesce(F.try_divide(F.col("row_count") - F.col("non_null_count"), F.col("row_count")), F.lit(0.0)).alias(
            "null_ratio"
        ),
    )


@dataclass
class StringStats:
    rows: int
    average_length: float
    distinct: int


def string_stats(frame: DataFrame, columns: list[str], exact: bool = False) -> dict[str, StringStats]:
    """Average length and number of distinct values; the latter is a sketch unless ``exact``."""
    distinct = F.count_distinct if exact else F.approx_count_distinct
    result = {}
    for group in batches(columns):
        measures = [F.count(F.lit(1)).alias("rows")]
        for i, c in enumerate(group):
            measures.append(F.avg(F.length(F.col(c))).alias(f"len{i}"))
            measures.append(distinct(F.col(c)).alias(f"distinct{i}"))
        row = frame.agg(*measures).first()
        for i, c in enumerate(group):
            result[c] = StringStats(row["rows"], float(row[f"len{i}"] or 0.0), int(row[f"distinct{i}"] or 0))
    return result


@dataclass
class NumericStats:
    rows: int
    non_null: int
    mean: float | None
    std_population: float | None
    numbers: int
    least: float | None
    greatest: float | None
    quantiles: list[float] | None = None
    median: float | None = None

    @property
    def std_sample(self) -> float | None:
        """NULL for fewer than two values, like the SQL function."""
        n = self.non_null
        return self.std_population * math.sqrt(n / (n - 1)) if n > 1 else None


def numeric_stats(
    frame: DataFrame,
    columns: list[str],
    probabilities: list[float] | None = None,
    exact: bool = False,
    nan_as_null: bool = False,
    median: bool = False,
) -> dict[str, NumericStats]:
    """Count, mean, both standard deviations, extremes and quantiles.

    Quantiles and extremes skip NULL and NaN; the moments skip only NULL unless ``nan_as_null``.
    Quantiles are off by at most RELATIVE_ERROR of the ranks, at every size, and are sketched in the pass of the
    moments; with ``exact`` they are not off at all, and the sketch only tells the passes after it where to look.
    ``median`` adds the median: interpolated if ``exact``, else a sketched quantile.
    """
    asked = [*(probabilities or []), *([0.5] if median else [])]
    steps = [k / CELLS for k in range(CELLS + 1)] if exact else asked
    edges: dict[str, list[float]] = {}
    result = {}
    for group in batches(columns):
        measures = [F.count(F.lit(1)).alias("rows")]
        for i, c in enumerate(group):
            value, number = as_double(c, nan_as_null), as_double(c, True)
            measures += [
                F.count(value).alias(f"n{i}"),
                F.avg(value).alias(f"mean{i}"),
                F.stddev_pop(value).alias(f"std{i}"),
                F.count(number).alias(f"numbers{i}"),
                F.min(number).alias(f"min{i}"),
                F.max(number).alias(f"max{i}"),
            ]
            if asked:
                measures.append(F.percentile_approx(number, steps, round(1 / RELATIVE_ERROR)).alias(f"sketch{i}"))
        row = frame.agg(*measures).first()
        for i, c in enumerate(group):
            names = ("n", "mean", "std", "numbers", "min", "max")
            result[c] = NumericStats(row["rows"], *[row[f"{name}{i}"] for name in names])
            if asked and row[f"sketch{i}"] is not None:
                edges[c] = list(row[f"sketch{i}"])
    if not asked:
        return result
    found: dict[str, list[float] | None] = dict(edges)
    if exact:
        wanted = [(p, False) for p in probabilities or []] + ([(0.5, True)] if median else [])
        found = _find_quantiles(frame, columns, wanted, result, edges)
    for c, values in found.items():
        if values:
            result[c].median = values.pop() if median else None
            result[c].quantiles = values
    return result


@dataclass
class _Search:
    """The hunt for the value of one rank of one column.

    ``below`` rows lie under ``low``, ``inside`` rows lie in [low, high], and the value is one of the latter.
    """

    column: str
    rank: int
    low: float
    high: float
    below: int
    inside: int
    edges: tuple[float, ...] = ()
    answer: float | None = None

    @property
    def range(self) -> tuple:
        return self.column, self.low, self.high, self.edges

    def enter(self, cell_rows: int, skipped: int, low: float, high: float) -> None:
        self.below += skipped
        self.inside, self.low, self.high, self.edges = cell_rows, low, high, ()
        self.answer = low if low == high else None


def quantiles(
    frame: DataFrame,
    columns: list[str],
    probabilities: list[float],
    interpolate: bool = False,
    known: dict[str, NumericStats] | None = None,
) -> dict[str, list[float] | None]:
    """Exact quantiles of numeric columns; NULL and NaN are skipped, a column without values gives None.

    ``interpolate=False`` gives the smallest value whose cumulative share reaches the
    probability; ``True`` interpolates between the two neighbouring values.

    Spark's exact percentile keeps every distinct value of a column in one buffer. Here each
    pass counts the rows between sketched points of a value range and moves on to the one cell that
    holds the wanted rank, until that cell has one value or few enough rows to list. A pass is a
    grouped count that each task reduces to a few thousand rows: the data is not shuffled.
    """
    known = known or numeric_stats(frame, columns)
    return _find_quantiles(frame, columns, [(p, interpolate) for p in probabilities], known, {})


def _find_quantiles(
    frame: DataFrame,
    columns: list[str],
    points: list[tuple[float, bool]],
    known: dict[str, NumericStats],
    edges: dict[str, list[float]],
) -> dict[str, list[float] | None]:
    """Quantiles for (probability, interpolate) pairs, given the counts, extremes and perhaps sketched points of the columns."""
    wanted: dict[str, list[tuple[int, int, float]]] = {}
    searches: dict[tuple[str, int], _Search] = {}
    for c in columns:
        n = known[c].numbers
        if not n:
            continue
        wanted[c] = [_ranks(n, p, interpolate) for p, interpolate in points]
        for rank in {r for low, high, _ in wanted[c] for r in (low, high)}:
            search = searches[c, rank] = _Search(c, rank, known[c].least, known[c].greatest, 0, n)
            search.edges = _around(edges.get(c, []))
            search.answer = search.low if search.low == search.high else None
    while pending := [s for s in searches.values() if s.answer is None]:
        _sketch_edges(frame, [s for s in pending if not s.edges and s.inside > LISTED_ROWS])
        for group in batches(_by_range(pending), 16):
            _count_cells(frame, group)
    result: dict[str, list[float] | None] = {c: None for c in columns}
    for c, entries in wanted.items():
        pairs = [(searches[c, low].answer, searches[c, high].answer, weight) for low, high, weight in entries]
        result[c] = [low if weight == 0 else low + (high - low) * weight for low, high, weight in pairs]
    return result


def _around(points: list[float]) -> tuple[float, ...]:
    """Each point also starts a cell of its own, so a value that most rows share gets isolated."""
    return tuple(sorted({*points, *(math.nextafter(p, math.inf) for p in points)}))


def _ranks(n: int, p: float, interpolate: bool) -> tuple[int, int, float]:
    """1-based ranks around a probability and the weight of the upper one."""
    if not interpolate:
        rank = max(n - math.floor(n - p * n), 1)
        return rank, rank, 0.0
    position = p * (n - 1)
    base = math.floor(position)
    return base + 1, min(base + 2, n), position - base


def _by_range(searches: list[_Search]) -> list[list[_Search]]:
    """Searches that look at the same range share its counts."""
    shared: dict[tuple, list[_Search]] = {}
    for s in searches:
        shared.setdefault(s.range, []).append(s)
    return list(shared.values())


def _sketch_edges(frame: DataFrame, searches: list[_Search]) -> None:
    """Cut the ranges at their sketched quantiles."""
    for group in batches(_by_range(searches), 16):
        values = [as_double(s.column, True) for s, *_ in group]
        wanted = {f"q{i}": (F.when(values[i].between(s.low, s.high), values[i]), CELLS) for i, (s, *_) in enumerate(group)}
        points = spread_points(frame, wanted)
        for i, same in enumerate(group):
            for s in same:
                s.edges = _around([s.low, *points[f"q{i}"], s.high])


def _count_cells(frame: DataFrame, group: list[list[_Search]]) -> None:
    """Count rows per cell of each range and let every search enter the cell with its rank."""
    values, wanted, edges = [], [], {}
    for i, (s, *_) in enumerate(group):
        # A plain comparison (NaN is above any number), so that it can be pushed into the scan.
        wanted.append(as_double(s.column).between(s.low, s.high))
        values.append(F.when(wanted[i], as_double(s.column, True)).alias(f"value{i}"))
        if s.edges and s.inside > LISTED_ROWS:
            edges[f"value{i}"] = list(s.edges)
    # Rows outside all ranges are skipped at once; late passes look at few rows.
    rows = frame.where(reduce(or_, wanted)).select(*values)
    names = {name: f"{name}__cell" for name in edges}
    # Points are looked up by compiled binary search; few enough values are cells of their own.
    rows = with_number_buckets(rows, names, edges) if names else rows
    entries = []
    for i in range(len(group)):
        name = f"value{i}"
        cell = F.col(names[name]).cast("double") if name in names else F.col(name)
        entries.append(F.struct(F.lit(i).alias("range"), cell.alias("cell"), F.col(name).alias("value")))
    cells = (
        rows.select(F.inline(F.array(*entries)))
        .where(F.col("value").isNotNull())
        .groupBy("range", "cell")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("value").alias("low"), F.max("value").alias("high"))
        .collect()
    )
    by_range: dict[int, list] = {}
    for row in sorted(cells, key=lambda r: (r["range"], r["low"])):
        by_range.setdefault(row["range"], []).append(row)
    for i, same in enumerate(group):
        for s in same:
            skipped = 0
            for row in by_range[i]:
                if s.rank <= s.below + skipped + row["rows"]:
                    s.enter(row["rows"], skipped, row["low"], row["high"])
                    break
                skipped += row["rows"]


def medians(
    frame: DataFrame, columns: list[str], known: dict[str, NumericStats] | None = None
) -> dict[str, float | None]:
    """Exact medians; the mean of the two middle values when the count is even."""
    found = quantiles(frame, columns, [0.5], interpolate=True, known=known)
    return {c: v[0] if v else None for c, v in found.items()}


def constant_columns(frame: DataFrame, columns: list[str]) -> list[str]:
    """Columns with at most one distinct value, NULLs aside. Least and greatest value settle it exactly."""
    constant = []
    for group in batches(columns, 3 * COLUMN_BATCH):
        row = frame.agg(
            *[
                F.coalesce(F.min(F.col(f"`{c}`")) == F.max(F.col(f"`{c}`")), F.lit(True)).alias(f"c{i}")
                for i, c in enumerate(group)
            ]
        ).first()
        constant += [c for i, c in enumerate(group) if row[f"c{i}"]]
    return constant


def numeric_columns(frame: DataFrame, exclude: Iterable[str] = (), decimals: bool = True) -> list[str]:
    """Names of the numeric columns, in schema order, without the excluded ones."""
    exclude = set(exclude)
    return [
        f.name
        for f in frame.schema.fields
        if f.name not in exclude
        and isinstance(f.dataType, T.NumericType)
        and (decimals or not isinstance(f.dataType, T.DecimalType))
    ]
