import math
import random

import pytest
from pyspark.sql import functions as F

from featurepipe.operators import ordered, profile


def brute(values, p):
    ordered = sorted(values)
    return ordered[max(len(ordered) - math.floor(len(ordered) - p * len(ordered)), 1) - 1]


@pytest.fixture
def tiny_cells(monkeypatch):
    """Limits so low that small data takes every path."""
    monkeypatch.setattr(profile, "CELLS", 8)
    monkeypatch.setattr(profile, "LISTED_ROWS", 5)


SHAPES = {
    "uniform": lambda r, i: r.random(),
    "heavy_value": lambda r, i: 7.0 if i % 3 else r.gauss(0, 1e6),
    "wide": lambda r, i: math.exp(r.uniform(-300, 300)),
    "negative": lambda r, i: -math.exp(r.uniform(0, 20)),
    "few": lambda r, i: float(i % 4),
    "one": lambda r, i: 3.5,
}


@pytest.mark.parametrize("shape", SHAPES)
def test_exact_quantiles(spark, tiny_cells, shape):
    r = random.Random(5)
    values = [SHAPES[shape](r, i) for i in range(1_501)]
    frame = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double").repartition(4)
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    found = profile.quantiles(frame, ["x"], probabilities)["x"]
    assert found == [brute(values, p) for p in probabilities]
    assert profile.medians(frame, ["x"])["x"] == sorted(values)[750]


@pytest.mark.parametrize("shape", SHAPES)
def test_approximate_quantiles_keep_the_error(spark, tiny_cells, shape):
    r = random.Random(6)
    values = [SHAPES[shape](r, i) for i in range(2_000)]
    frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    ordered = sorted(values)
    stats = profile.numeric_stats(frame, ["x"], [0.01, 0.5, 0.99], median=True)["x"]
    assert stats.median == stats.quantiles[1]
    for p, v in zip([0.01, 0.5, 0.99], stats.quantiles):
        rank = p * len(ordered)
        least = sum(o < v for o in ordered) + 1
        most = sum(o <= v for o in ordered)
        assert least - 0.01 * len(ordered) - 1 <= rank <= most + 0.01 * len(ordered) + 1


def test_infinite_values(spark, tiny_cells):
    values = [float("inf"), float("-inf"), *map(float, range(50))]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    assert profile.quantiles(frame, ["x"], [0.0, 0.5, 1.0])["x"] == [float("-inf"), 24.0, float("inf")]


def test_even_median_and_empty(spark):
    frame = spark.createDataFrame([(1.0, None), (4.0, None)], "x double, y double")
    assert profile.medians(frame, ["x", "y"]) == {"x": 2.5, "y": None}
    stats = profile.numeric_stats(frame, ["x", "y"], [0.5])
    assert stats["y"].quantiles is None and stats["y"].mean is None and stats["x"].quantiles == [1.0]


def test_moments(spark):
    frame = spark.createDataFrame([(1,), (3,), (None,)], "x int")
    stats = profile.numeric_stats(frame, ["x"])["x"]
    assert (stats.rows, stats.non_null, stats.mean) == (3, 2, 2.0)
    assert stats.std_sample == pytest.approx(math.sqrt(2)) and stats.std_population == 1.0
    single = profile.numeric_stats(frame.limit(1), ["x"])["x"]
    assert single.std_sample is None


def test_nan_counts_in_moments_unless_told_otherwise(spark):
    frame = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    assert math.isnan(profile.numeric_stats(frame, ["x"], [0.5])["x"].mean)
    assert profile.numeric_stats(frame, ["x"], [0.5], nan_as_null=True)["x"].mean == 1.0
    assert profile.numeric_stats(frame, ["x"], [0.5])["x"].quantiles == [1.0]


def test_null_profile(spark):
    frame = spark.createDataFrame([(1, None), (2, "a")], "x int, s string")
    rows = {r["column"]: r for r in profile.null_profile(frame).collect()}
    assert rows["s"]["null_count"] == 1 and rows["s"]["null_ratio"] == 0.5 and rows["x"]["null_ratio"] == 0.0
    empty = profile.null_profile(frame.limit(0)).collect()
    assert [r["null_ratio"] for r in empty] == [0.0, 0.0]


def test_string_stats(spark):
    frame = spark.createDataFrame([("ab",), ("abcd",), (None,), ("ab",)], "s string")
    stats = profile.string_stats(frame, ["s"], exact=True)["s"]
    assert (stats.rows, stats.distinct) == (4, 2) and stats.average_length == pytest.approx(8 / 3)


def test_constant_columns(spark):
    frame = spark.createDataFrame([(1, None, 1.0), (1, None, 2.0), (None, None, 1.0)], "a int, b int, c double")
    assert profile.constant_columns(frame, ["a", "b", "c"]) == ["a", "b"]


def test_jobs_do_not_grow_with_columns(spark):
    """The passes over a frame are per batch of columns, not per column."""
    tracker = spark.sparkContext.statusTracker()

    def jobs(columns):
        spark.sparkContext.setJobGroup(f"jobs-{columns}", "count")
        frame = spark.range(100).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(columns)])
        profile.numeric_stats(frame, frame.columns, [0.5])
        found = len(tracker.getJobIdsForGroup(f"jobs-{columns}"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return found

    assert jobs(2) == jobs(12)


def test_passes_push_their_range_into_the_scan(spark, sf, monkeypatch):
    """Late quantile passes read only the column they need and skip what lies outside the range."""
    plans = []
    original = type(spark.range(1)).collect

    def spy(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return original(frame)

    monkeypatch.setattr(type(spark.range(1)), "collect", spy)
    frame = spark.read.parquet(f"{sf}/lineitem.parquet")
    profile.quantiles(frame, ["l_extendedprice"], [0.5])
    passes = [p for p in plans if "cell" in p]
    assert passes and all("ReadSchema: struct<l_extendedprice:double>" in p for p in passes)
    assert "GreaterThanOrEqual(l_extendedprice" in passes[-1] and "Python" not in passes[-1]


@pytest.mark.parametrize("parts", [1, 40])
def test_split_points_are_even_and_merged_in_two_levels(spark, parts):
    frame = spark.range(200_000, numPartitions=parts).select(
        (F.col("id") * 7919 % 200_000).cast("double").alias("x"), F.when(F.col("id") < 0, 1.0).alias("none"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.lit(float("nan"))).alias("same"),
    )
    points = ordered.spread_points(frame, {c: (F.col(c), 50) for c in frame.columns})
    assert len(points["x"]) == 49 and points["none"] == [] and points["same"] == [5.0]
    plan = ordered.merged_sketches(frame, {"x": (F.col("x"), 50)})._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("kll_merge_agg_double") == plan.count("kll_sketch_agg_double") == 2
    edges = [0, *points["x"], 200_000]
    assert all(0.5 < (b - a) / 4_000 < 1.5 for a, b in zip(edges, edges[1:]))
