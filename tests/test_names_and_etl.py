import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from featurepipe.functions.names import normalize_name, unique_names
from featurepipe.operators import etl


def test_normalize_name():
    assert normalize_name("\tUnit price [EUR]!") == "unit_price_eur"
    assert normalize_name("__A--b__") == "a_b"
    assert normalize_name("%%") == "unnamed_column"


def test_unique_names():
    assert unique_names(["Net-Sum", "net sum", "qty", "NET_SUM?"]) == ["net_sum", "net_sum_2", "qty", "net_sum_3"]
    assert unique_names(["a", "a", "a_2"]) == ["a", "a_3", "a_2"]
    assert unique_names(["", "%"]) == ["unnamed_column", "unnamed_column_2"]


@given(st.lists(st.text(alphabet="aA_2 !", max_size=4), max_size=8))
@settings(max_examples=200, deadline=None)
def test_unique_names_never_repeat(columns):
    names = unique_names(columns)
    assert len(set(names)) == len(names) == len(columns)


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(i, f"  n{i} ", "\tx ", None, 1.0 if i < 5 else None) for i in range(100)]
    rows += [rows[0], rows[0]]
    return spark.createDataFrame(
        rows, "` Id ` long, `Name!` string, `name` string, `empty` double, `mostly` double"
    )


def test_clean(spark, raw):
    frame, report = etl.clean(raw, etl.CleanConfig(drop_duplicates=True, max_null_ratio=0.94))
    assert report.renamed == {" Id ": "id", "Name!": "name", "name": "name_2", "empty": "empty", "mostly": "mostly"}
    assert [d["column"] for d in report.dropped] == ["empty", "mostly"]
    assert report.dropped[1]["null_ratio"] == pytest.approx(0.95)
    assert frame.count() == 100
    assert frame.where("id = 3").first().asDict() == {"id": 3, "name": "n3", "name_2": "\tx"}


def test_null_ratio_at_the_limit_is_kept(raw):
    frame, report = etl.clean(raw, etl.CleanConfig(drop_duplicates=True, max_null_ratio=0.95))
    assert "mostly" in frame.columns and [d["column"] for d in report.dropped] == ["empty"]


def test_clean_is_idempotent(raw):
    config = etl.CleanConfig(drop_duplicates=True)
    once, _ = etl.clean(raw, config)
    twice, _ = etl.clean(once, config)
    assert once.columns == twice.columns and once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_required_columns_drop_null_and_nan(spark):
    frame = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan")), (None, 2.0)], "a int, b double")
    assert [r["a"] for r in etl.drop_missing_required(frame, ["a", "b"]).collect()] == [1]
    assert etl.drop_missing_required(frame, []).count() == 4


def test_empty_frame(spark):
    frame = spark.createDataFrame([], "a int, b string")
    cleaned, report = etl.clean(frame, etl.CleanConfig(drop_duplicates=True))
    assert cleaned.columns == ["a", "b"] and report.dropped == []


def test_dedupe_by_key_is_deterministic_and_limits_before_the_shuffle(spark):
    # One key holds most of the rows.
    frame = spark.range(20_000).select(
        F.when(F.col("id") % 3 != 0, 7).otherwise(F.col("id")).alias("k"), (F.col("id") * 7919 % 20_000).alias("v")
    )
    expected = {r["k"]: r["v"] for r in frame.groupBy("k").agg(F.min("v").alias("v")).collect()}
    for parts in (1, 13):
        kept = etl.drop_duplicates_by_key(frame.repartition(parts), ["k"])
        assert {r["k"]: r["v"] for r in kept.collect()} == expected
    plan = etl.drop_duplicates_by_key(frame, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_hash_sample_does_not_depend_on_layout(spark):
    frame = spark.range(5_000)
    first = {r["id"] for r in etl.hash_sample(frame.repartition(3), ["id"], 0.3).collect()}
    second = {r["id"] for r in etl.hash_sample(frame.repartition(11), ["id"], 0.3).collect()}
    assert first == second and 0.27 < len(first) / 5_000 < 0.33
    assert etl.hash_sample(frame, ["id"], 1.0).count() == 5_000 and etl.hash_sample(frame, ["id"], 0.0).count() == 0


def test_bernoulli_sample(spark):
    assert 0.15 < etl.bernoulli_sample(spark.range(5_000), 0.2).count() / 5_000 < 0.25


def test_feature_resolution():
    assert etl.resolve_features(["a"], {"selected_features": ["b"]}) == ["a"]
    assert etl.resolve_features([], {"selected_features": ["b"]}) == ["b"]
    with pytest.raises(ValueError):
        etl.resolve_features([], None)
    with pytest.raises(ValueError):
        etl.resolve_features([], {"selected_features": []})


def test_project_features(spark):
    frame = spark.createDataFrame([(1, 1.0, 0), (2, float("nan"), 1), (3, 2.0, None)], "id int, x double, y int")
    assert etl.project_features(frame, ["x"], "y").columns == ["x", "y"]
    kept = etl.project_features(frame, ["x"], "y", keep_columns=["id"], drop_null=True)
    assert kept.columns == ["id", "x", "y"] and [r["id"] for r in kept.collect()] == [1]
    with pytest.raises(ValueError):
        etl.project_features(frame, [], "y")
