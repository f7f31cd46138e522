"""Queries on column statistics, classes and data checks."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from featurepipe.operators import classify, drift, profile, quality
from featurepipe.plans.clean_queries import EVENTS_WITH_NULLS, events_with_nulls
from featurepipe.plans.registry import ORACLES, query, rounded, table

PRICES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _union(parts):
    return "\nUNION ALL\n".join(parts)


def _null_row(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count(*) AS row_count, count({column}) AS non_null_count,
  count(*) - count({column}) AS null_count, (count(*) - count({column})) / count(*) AS null_ratio FROM e"""


@query(
    f"WITH e AS ({EVENTS_WITH_NULLS})\n"
    + _union(_null_row(c) for c in ("event_id", "user_id", "event_type", "value"))
)
def null_profile(spark, folder):
    return profile.null_profile(events_with_nulls(spark, folder))


def _numeric_row(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS non_null,
  {rounded(f"avg({column})")} AS mean, {rounded(f"stddev_samp({column})")} AS std_sample,
  {rounded(f"stddev_pop({column})")} AS std_population,
  quantile_disc({column}, 0.01) AS p01, quantile_disc({column}, 0.5) AS p50, quantile_disc({column}, 0.99) AS p99,
  median({column}) AS median FROM lineitem"""


@query(_union(_numeric_row(c) for c in PRICES))
def numeric_profile(spark, folder):
    frame = table(spark, folder, "lineitem")
    stats = profile.numeric_stats(frame, list(PRICES), [0.01, 0.5, 0.99], exact=True, median=True)
    rows = [(c, s.non_null, s.mean, s.std_sample, s.std_population, *s.quantiles, s.median) for c, s in stats.items()]
    wide = spark.createDataFrame(
        rows,
        "column string, non_null long, mean double, std_sample double, std_population double, "
        "p01 double, p50 double, p99 double, median double",
    )
    return wide.withColumns({c: F.round(c, 6) for c in ("mean", "std_sample", "std_population")})


def _string_row(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count(*) AS row_count,
  {rounded(f"avg(length({column}))")} AS average_length, count(DISTINCT {column}) AS distinct_count FROM part"""


@query(_union(_string_row(c) for c in ("p_name", "p_brand", "p_type")))
def string_profile(spark, folder):
    stats = profile.string_stats(table(spark, folder, "part"), ["p_name", "p_brand", "p_type"], exact=True)
    rows = [(c, s.rows, s.average_length, s.distinct) for c, s in stats.items()]
    wide = spark.createDataFrame(rows, "column string, row_count long, average_length double, distinct_count long")
    return wide.withColumn("average_length", F.round("average_length", 6))


def _string_class(name: str, column: str) -> str:
    return f"""SELECT '{name}' AS table_name, '{column}' AS "column",
  CASE WHEN avg(length({column})) >= 40 OR count(DISTINCT {column}) / count(*) > 0.5 THEN 'text'
       WHEN count(DISTINCT {column}) <= 100 THEN 'categorical' ELSE 'text' END AS class FROM {name}"""


def _settled_class(name: str, column: str, class_name: str) -> str:
    # Columns whose class follows from type or name alone; read from the table so that it must have the column.
    return f"""SELECT '{name}' AS table_name, '{column}' AS "column", '{class_name}' AS class
  FROM {name} HAVING count({column}) >= 0"""


@query(
    _union(
        [
            _settled_class("events", "event_id", "numerical"),
            _settled_class("events", "ts", "datetime"),
            _settled_class("events", "user_id", "numerical"),
            _string_class("events", "event_type"),
            _settled_class("events", "value", "numerical"),
            _string_class("events", "props"),
            _settled_class("part", "p_partkey", "numerical"),
            _string_class("part", "p_name"),
            _string_class("part", "p_brand"),
            _string_class("part", "p_type"),
            _settled_class("part", "p_size", "numerical"),
            _settled_class("part", "p_retailprice", "numerical"),
            _settled_class("documents", "doc_id", "numerical"),
            _string_class("documents", "text"),
            _string_class("documents", "lang"),
            _string_class("documents", "source"),
            _settled_class("documents", "n_chars", "numerical"),
            _settled_class("embeddings", "vec_id", "numerical"),
            _settled_class("embeddings", "embedding", "ignored"),
        ]
    )
)
def classify_columns(spark, folder):
    rows = []
    for name, label in (("events", None), ("part", None), ("documents", None), ("embeddings", "label")):
        classes = classify.classify_columns(table(spark, folder, name), label, exact=True)
        rows += [(name, c, class_name) for c, class_name in classes.rows()]
    return spark.createDataFrame(rows, "table_name string, column string, class string")


def _check(check: str, column: str, observed: str, threshold: str, passed: str, source: str, severity="error") -> str:
    return f"""SELECT '{check}' AS "check", '{column}' AS "column", CAST({observed} AS DOUBLE) AS observed,
  CAST({threshold} AS DOUBLE) AS threshold, {passed} AS passed, '{severity}' AS severity FROM {source}"""


@query(
    _union(
        [
            _check("expected_column", c, "1.0", "1.0", "count(*) >= 0", "orders")
            for c in ("o_orderkey", "o_totalprice")
        ]
        + [
            _check("expected_column", "o_label", "0.0", "1.0", "count(*) < 0", "orders"),
            _check("minimum_rows", "*", "count(*)", "1000", "count(*) > 1000", "orders"),
        ]
    )
)
def schema_check(spark, folder):
    checks = quality.schema_checks(["o_orderkey", "o_totalprice", "o_label"], 1000)
    return quality.run_checks(table(spark, folder, "orders"), checks)


_AGE = "date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2002-01-01')"


@query(_check("freshness_days", "o_orderdate", _AGE, "7", f"{_AGE} <= 7", "orders"))
def freshness_check(spark, folder):
    check = quality.Fresh("o_orderdate", as_of=datetime.date(2002, 1, 1), threshold=7)
    return quality.run_checks(table(spark, folder, "orders"), [check])


def _violations(check: str, column: str, condition: str, severity: str = "error") -> str:
    count = f"count(*) FILTER (WHERE {condition})"
    return _check(check, column, count, "0", f"{count} <= 0", "e", severity)


def _mostly(column: str, share: str, severity: str = "error") -> str:
    ratio = f"count({column}) / count(*)"
    return _check("non_null_ratio", column, ratio, share, f"{ratio} >= {share}", "e", severity)


@query(
    f"WITH e AS ({EVENTS_WITH_NULLS})\n"
    + _union(
        [
            _violations("null_count", "event_id", "event_id IS NULL"),
            _violations("null_count", "value", "value IS NULL"),
            _mostly("value", "0.95"),
            _mostly("user_id", "0.9"),
            _violations("out_of_range", "value", "value < 0 OR value > 100"),
            _violations("not_in_set", "event_type", "event_type NOT IN ('click', 'view')"),
            _violations("not_in_set", "user_id", "user_id NOT IN (1, 2, 3)"),
        ]
    )
)
def quality_rules(spark, folder):
    checks = [
        quality.NotNull("event_id"),
        quality.NotNull("value"),
        quality.MostlyNotNull("value", threshold=0.95),
        quality.MostlyNotNull("user_id", threshold=0.9),
        quality.InRange("value", minimum=0.0, maximum=100.0),
        quality.InSet("event_type", allowed=("click", "view")),
        quality.InSet("user_id", allowed=("1", "2", "3")),
    ]
    return quality.run_checks(events_with_nulls(spark, folder), checks)


@query(
    f"WITH e AS ({EVENTS_WITH_NULLS})\n"
    + _union(
        [
            _violations("null_count", "event_type", "event_type IS NULL", "warn"),
            _mostly("value", "0.95", "warn"),
            _violations("out_of_range", "value", "value < 1 OR value > 50", "warn"),
        ]
    )
)
def expectation_suite(spark, folder):
    suite = quality.expectation_suite("event_type", ["value"], [quality.InRange("value", minimum=1.0, maximum=50.0)])
    return quality.run_checks(events_with_nulls(spark, folder), suite)


@query("SELECT CAST(quality AS VARCHAR) AS label, count(*) AS rows FROM labels GROUP BY quality")
def label_distribution(spark, folder):
    return quality.label_distribution(table(spark, folder, "labels"), "quality")


@query(
    """
WITH g AS (SELECT count(*) AS n FROM labels GROUP BY quality),
     s AS (SELECT min(n) / sum(n) AS minority, CAST(count(*) AS DOUBLE) AS classes FROM g)
SELECT 'minority_ratio' AS "check", 'quality' AS "column", minority AS observed, CAST(0.05 AS DOUBLE) AS threshold,
       minority > 0.05 AS passed, 'error' AS severity FROM s
UNION ALL
SELECT 'class_count', 'quality', classes, CAST(2 AS DOUBLE), classes >= 2, 'error' FROM s"""
)
def class_balance(spark, folder):
    return quality.class_balance(table(spark, folder, "labels"), "quality", 0.05)


def _ks_rows(column: str) -> str:
    return f"""
  SELECT '{column}' AS "column", CAST({column} AS DOUBLE) AS v, ts >= TIMESTAMP '2024-01-16' AS current FROM events"""


@query(
    f"""
WITH r AS ({_union(_ks_rows(c) for c in ("value", "user_id"))}),
g AS (SELECT "column", v, count(*) FILTER (WHERE current) AS a, count(*) FILTER (WHERE NOT current) AS b
      FROM r WHERE v IS NOT NULL GROUP BY ALL),
c AS (SELECT "column", sum(a) OVER w AS ca, sum(b) OVER w AS cb,
             sum(a) OVER (PARTITION BY "column") AS n, sum(b) OVER (PARTITION BY "column") AS m
      FROM g WINDOW w AS (PARTITION BY "column" ORDER BY v)),
d AS (SELECT "column", CAST(max(n) AS BIGINT) AS current_rows, CAST(max(m) AS BIGINT) AS previous_rows,
             max(abs(ca / n - cb / m)) AS d FROM c GROUP BY "column"),
p AS (SELECT *, d * sqrt(current_rows * previous_rows / (current_rows + previous_rows)) AS x FROM d),
q AS (SELECT *, CASE WHEN x < 0.2 THEN 1.0 ELSE greatest(least(list_sum(list_transform(range(1, 101),
             lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * x * x))), 1.0), 0.0) END AS p FROM p)
SELECT "column", current_rows, previous_rows, round(d, 9) AS ks_statistic, round(p, 9) AS p_value, p > 0.05 AS passed
FROM q"""
)
def ks_drift(spark, folder):
    events = table(spark, folder, "events")
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    tested = drift.ks_drift(events.where(late), events.where(~late), ["value", "user_id"], 0.05, "asymptotic")
    return tested.withColumns({c: F.round(c, 9) for c in ("ks_statistic", "p_value")})


@query(ORACLES["ks_drift"])
def ks_drift_bucketed(spark, folder):
    """The same test over many ordered buckets of values."""
    events = table(spark, folder, "events")
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    tested = drift.ks_drift(events.where(late), events.where(~late), ["value", "user_id"], bucket_rows=500)
    return tested.withColumns({c: F.round(c, 9) for c in ("ks_statistic", "p_value")})
