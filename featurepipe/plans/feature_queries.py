"""Queries on feature generation and selection."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from featurepipe.functions.text import NEGATIVE_WORDS, POSITIVE_WORDS
from featurepipe.operators import categorical, dates, lag, numeric, select, text
from featurepipe.plans.profile_queries import PRICES
from featurepipe.plans.registry import ORACLES, query, rounded, table

# --- numeric -----------------------------------------------------------------------------------------------------

LINES_SQL = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
       l_extendedprice, l_discount, CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE l_tax END AS l_tax,
       CAST(l_returnflag = 'R' AS DOUBLE) AS returned
FROM lineitem"""


def lines(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity")).alias("l_quantity"),
        "l_extendedprice",
        "l_discount",
        F.when(F.col("l_partkey") % 9 != 0, F.col("l_tax")).alias("l_tax"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("returned"),
    )


def _bounds_sql(c: str) -> str:
    return f"""quantile_disc({c}, 0.01) AS {c}_low, quantile_disc({c}, 0.5) AS {c}_mid,
    quantile_disc({c}, 0.99) AS {c}_high, avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_std"""


def _capped_sql(c: str) -> str:
    return f"""CASE WHEN {c} IS NULL THEN {c}_mid WHEN {c} < {c}_low THEN {c}_low
    WHEN {c} > {c}_high THEN {c}_high ELSE {c} END AS {c}__capped"""


_SCALED_LINES = f"""
WITH lines AS ({LINES_SQL}),
stats AS (SELECT {", ".join(_bounds_sql(c) for c in PRICES)} FROM lines),
capped AS (SELECT lines.*, stats.*, {", ".join(_capped_sql(c) for c in PRICES)} FROM lines, stats)"""


def _numeric_sql(c: str) -> str:
    return f"""CAST({c} IS NULL AS DOUBLE) AS {c}__is_missing, {c}__capped,
  {rounded(f"({c}__capped - {c}_mean) / {c}_std")} AS {c}__scaled,
  CAST(CASE WHEN {c}__capped <= {c}_low THEN 0 WHEN {c}__capped <= {c}_mid THEN 1
       WHEN {c}__capped <= {c}_high THEN 2 ELSE 3 END AS DOUBLE) AS {c}__bin"""


@query(f"{_SCALED_LINES}\nSELECT l_orderkey, {', '.join(_numeric_sql(c) for c in PRICES)}, returned FROM capped")
def numeric_features(spark, folder):
    frame = lines(spark, folder)
    fitted = numeric.fit_numeric(frame, list(PRICES), max_interactions=0, exact=True, keep_capped=True)
    features = [f"{c}__{s}" for c in PRICES for s in ("is_missing", "capped", "scaled", "bin")]
    return fitted.transform(frame).select(
        "l_orderkey",
        *[F.round(f, 6).alias(f) if f.endswith("__scaled") else F.col(f) for f in features],
        "returned",
    )


def _product_sql(a: str, b: str) -> str:
    product = " * ".join(f"(({c}__capped - {c}_mean) / {c}_std)" for c in (a, b))
    return f"{rounded(product)} AS {a}__x__{b}"


_PAIRS = list(itertools.combinations(PRICES, 2))[:5]


@query(f"{_SCALED_LINES}\nSELECT l_orderkey, {', '.join(_product_sql(a, b) for a, b in _PAIRS)} FROM capped")
def numeric_interactions(spark, folder):
    frame = lines(spark, folder)
    fitted = numeric.fit_numeric(frame, list(PRICES), max_interactions=5, exact=True)
    return fitted.transform(frame).select(
        "l_orderkey", *[F.round(f"{a}__x__{b}", 6).alias(f"{a}__x__{b}") for a, b in _PAIRS]
    )


_SUPPLIERS_SQL = """
SELECT s_suppkey, CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE s_acctbal END AS s_acctbal,
       CAST(s_nationkey AS DOUBLE) AS s_nationkey FROM supplier"""


@query(
    f"""
WITH s AS ({_SUPPLIERS_SQL}),
m AS (SELECT median(s_acctbal) AS a, median(s_nationkey) AS n FROM s),
f AS (SELECT s_suppkey, coalesce(s_acctbal, a) AS s_acctbal, coalesce(s_nationkey, n) AS s_nationkey FROM s, m),
t AS (SELECT avg(s_acctbal) AS am, stddev_pop(s_acctbal) AS asd, avg(s_nationkey) AS nm, stddev_pop(s_nationkey) AS nsd
      FROM f)
SELECT s_suppkey, {rounded("(s_acctbal - am) / asd")} AS s_acctbal, {rounded("(s_nationkey - nm) / nsd")} AS s_nationkey
FROM f, t"""
)
def standardize_population(spark, folder):
    frame = table(spark, folder, "supplier").select(
        "s_suppkey",
        F.when(F.col("s_suppkey") % 6 != 0, F.col("s_acctbal")).alias("s_acctbal"),
        F.col("s_nationkey").cast("double").alias("s_nationkey"),
    )
    columns = ["s_acctbal", "s_nationkey"]
    fitted = numeric.fit_standardizer(frame, columns)
    return fitted.transform(frame).withColumns({c: F.round(c, 6) for c in columns})


# --- categorical -------------------------------------------------------------------------------------------------

_SEGMENTS_SQL = """
SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_nationkey
FROM customer"""


def _segments(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 9 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
        "c_nationkey",
    )


def _index_sql(c: str) -> str:
    return f"""SELECT coalesce(CAST({c} AS VARCHAR), '__missing__') AS v, count(*) AS n,
  row_number() OVER (ORDER BY count(*) DESC, coalesce(CAST({c} AS VARCHAR), '__missing__')) - 1 AS i
  FROM s GROUP BY 1"""


@query(
    f"""
WITH s AS ({_SEGMENTS_SQL}), a AS ({_index_sql("c_mktsegment")}), b AS ({_index_sql("c_nationkey")})
SELECT c_custkey, CAST(a.i AS DOUBLE) AS c_mktsegment__index, CAST(b.i AS DOUBLE) AS c_nationkey__index
FROM s JOIN a ON coalesce(c_mktsegment, '__missing__') = a.v JOIN b ON CAST(c_nationkey AS VARCHAR) = b.v"""
)
def category_index(spark, folder):
    frame = _segments(spark, folder)
    fitted = categorical.fit_categories(frame, ["c_mktsegment", "c_nationkey"])
    return fitted.transform(frame).select("c_custkey", "c_mktsegment__index", "c_nationkey__index")


@query(
    f"""
WITH s AS ({_SEGMENTS_SQL})
SELECT c_custkey, count(*) OVER (PARTITION BY coalesce(c_mktsegment, '__missing__')) / count(*) OVER ()
  AS c_mktsegment__frequency
FROM s"""
)
def category_frequency(spark, folder):
    frame = _segments(spark, folder)
    fitted = categorical.fit_categories(frame, ["c_mktsegment"])
    return fitted.transform(frame).select("c_custkey", "c_mktsegment__frequency")


@query(
    """
WITH n AS (SELECT l_partkey AS v, count(*) AS n FROM lineitem GROUP BY 1),
     r AS (SELECT v, n, row_number() OVER (ORDER BY n DESC, CAST(v AS VARCHAR)) - 1 AS i FROM n)
SELECT l_orderkey, l_partkey, CAST(i AS DOUBLE) AS l_partkey__index,
       n / (SELECT count(*) FROM lineitem) AS l_partkey__frequency
FROM lineitem JOIN r ON l_partkey = v"""
)
def many_categories(spark, folder):
    """A column with so many categories that, from some size on, they are not broadcast."""
    frame = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    return categorical.fit_categories(frame, ["l_partkey"]).transform(frame)


@query(ORACLES["many_categories"])
def many_categories_shuffled(spark, folder):
    """The same with a limit so low that the lookup is a shuffle and the ranks come from ordered buckets."""
    frame = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    fitted = categorical.fit_categories(frame, ["l_partkey"], broadcast_categories=100, bucket_rows=300)
    return fitted.transform(frame)


@query(
    """
SELECT l_orderkey, l_linenumber,
  avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY l_linestatus) AS l_linestatus__target_mean,
  avg(CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY l_linenumber) AS l_linenumber__target_mean
FROM lineitem"""
)
def target_mean(spark, folder):
    frame = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_linestatus",
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0).alias("returned"),
    )
    fitted = categorical.fit_categories(frame, ["l_linestatus", "l_linenumber"], "returned", target_encoding=True)
    return fitted.transform(frame).select(
        "l_orderkey", "l_linenumber", "l_linestatus__target_mean", "l_linenumber__target_mean"
    )


# --- dates -------------------------------------------------------------------------------------------------------

_DATES_SQL = """
SELECT o_orderkey, o_orderdate, TRY_CAST(CASE WHEN o_orderkey % 5 = 0 THEN 'not a date'
  ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP) AS text_date FROM orders"""


def _date_sql(c: str) -> str:
    parts = {
        "year": f"CAST(year({c}) AS DOUBLE)",
        "month": f"CAST(month({c}) AS DOUBLE)",
        "dayofweek": f"CAST(dayofweek({c}) + 1 AS DOUBLE)",
        "hour": f"CAST(hour({c}) AS DOUBLE)",
    }
    columns = [f"{sql} AS {c}__{part}" for part, sql in parts.items()]
    for part, period in (("month", 12), ("dayofweek", 7)):
        for wave in ("sin", "cos"):
            value = f"{wave}(2 * pi() * ({parts[part]}) / {period})"
            columns.append(f"{rounded(value)} AS {c}__{part}_{wave}")
    return ", ".join(columns)


@query(f"WITH d AS ({_DATES_SQL})\nSELECT o_orderkey, {_date_sql('o_orderdate')}, {_date_sql('text_date')} FROM d")
def datetime_features(spark, folder):
    as_text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    frame = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderdate",
        F.when(F.col("o_orderkey") % 5 == 0, "not a date").otherwise(as_text).alias("text_date"),
    )
    fitted = dates.fit_dates(["o_orderdate", "text_date"])
    names = [n for rule in fitted.rules for n in rule.features]
    waves = ("_sin", "_cos")
    return fitted.transform(frame).select(
        "o_orderkey", *[F.round(n, 6).alias(n) if n.endswith(waves) else F.col(n) for n in names]
    )


# --- text --------------------------------------------------------------------------------------------------------

BUCKETS = 16


def _documents(spark, folder):
    return table(spark, folder, "documents", spread=True).select("doc_id", "text")


@query(
    r"""
SELECT doc_id, CAST(length(text) AS DOUBLE) AS text__char_len,
       CAST(len(regexp_split_to_array(text, '\s+')) AS DOUBLE) AS text__word_count
FROM documents"""
)
def text_basic_features(spark, folder):
    added = text.basic_features("text")
    names = ["text__char_len", "text__word_count"]
    return _documents(spark, folder).select("doc_id", *[added[n].alias(n) for n in names])


def _presence_sql(words) -> str:
    return " + ".join(f"CASE WHEN contains(lower(text), '{w}') THEN 1.0 ELSE 0.0 END" for w in words)


@query(
    f"""
SELECT doc_id, CAST(({_presence_sql(POSITIVE_WORDS)}) - ({_presence_sql(NEGATIVE_WORDS)}) AS DOUBLE)
  AS text__sentiment_score FROM documents"""
)
def text_sentiment(spark, folder):
    name = "text__sentiment_score"
    return _documents(spark, folder).select("doc_id", text.basic_features("text")[name].alias(name))


_HASHED_SQL = """
SELECT doc_id, list_transform(regexp_extract_all(lower(text), '[a-z0-9_]+'), lambda w: right(md5(w), 1)) AS h
FROM documents"""


def _tf_sql(i: int) -> str:
    return f"len(list_filter(h, lambda x: x = '{i:x}')) / greatest(len(h), 1)"


@query(
    f"""
WITH d AS ({_HASHED_SQL})
SELECT doc_id, {", ".join(f"{rounded(_tf_sql(i))} AS text__tf_hash_{i}" for i in range(BUCKETS))} FROM d"""
)
def text_hash_tf(spark, folder):
    result = text.term_frequencies(_documents(spark, folder), ["text"], BUCKETS).drop("text")
    return result.withColumns({f"text__tf_hash_{i}": F.round(f"text__tf_hash_{i}", 6) for i in range(BUCKETS)})


@query(
    f"""
WITH d AS ({_HASHED_SQL}),
t AS (SELECT doc_id, {", ".join(f"{_tf_sql(i)} AS t{i}" for i in range(BUCKETS))} FROM d),
w AS (SELECT {", ".join(f"ln((count(*) + 1) / (count(*) FILTER (WHERE t{i} > 0) + 1)) + 1 AS w{i}" for i in range(BUCKETS))}
      FROM t)
SELECT doc_id, {", ".join(f"{rounded(f't{i} * w{i}')} AS text__tfidf_hash_{i}" for i in range(BUCKETS))} FROM t, w"""
)
def text_hash_tfidf(spark, folder):
    weighted, _ = text.fit_transform_text(_documents(spark, folder), ["text"], BUCKETS, keep=["doc_id"])
    names = [f"text__tfidf_hash_{i}" for i in range(BUCKETS)]
    return weighted.select("doc_id", *[F.round(n, 6).alias(n) for n in names])


# --- series ------------------------------------------------------------------------------------------------------

_ROLLING = "avg(value) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"


@query(
    f"""
SELECT event_id, user_id, lag(value, 1) OVER w AS value__lag_1, lag(value, 3) OVER w AS value__lag_3,
       {rounded(_ROLLING)} AS value__rolling_mean_3
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id)"""
)
def lag_rolling(spark, folder):
    frame = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    fitted = lag.fit_lags(["value"], "ts", "user_id", ["event_id"])
    return fitted.transform(frame).select(
        "event_id",
        "user_id",
        "value__lag_1",
        "value__lag_3",
        F.round("value__rolling_mean_3", 6).alias("value__rolling_mean_3"),
    )


@query(
    f"""
SELECT event_id, lag(value, 1) OVER w AS value__lag_1, lag(value, 3) OVER w AS value__lag_3,
       {rounded(_ROLLING)} AS value__rolling_mean_3
FROM events WINDOW w AS (ORDER BY ts NULLS FIRST, event_id)"""
)
def lag_whole_table(spark, folder):
    """One series without entities: cut into ordered pieces once it is longer than a task should handle."""
    frame = table(spark, folder, "events").select("event_id", "ts", "value")
    fitted = lag.fit_lags(["value"], "ts", None, ["event_id"])
    return fitted.transform(frame).select(
        "event_id",
        "value__lag_1",
        "value__lag_3",
        F.round("value__rolling_mean_3", 6).alias("value__rolling_mean_3"),
    )


@query(ORACLES["lag_whole_table"])
def lag_in_pieces(spark, folder):
    """The same series, cut into pieces of a few hundred rows."""
    frame = table(spark, folder, "events").select("event_id", "ts", "value")
    fitted = lag.fit_lags(["value"], "ts", None, ["event_id"], series_rows=400)
    return fitted.transform(frame).select(
        "event_id",
        "value__lag_1",
        "value__lag_3",
        F.round("value__rolling_mean_3", 6).alias("value__rolling_mean_3"),
    )


# --- selection ---------------------------------------------------------------------------------------------------


@query("SELECT event_id, value, value * 2 AS doubled FROM events")
def leakage_filter(spark, folder):
    frame = table(spark, folder, "events").select(
        "event_id",
        "value",
        (F.col("value") * 2).alias("doubled"),
        F.col("value").alias("value_Leaked"),
        F.col("value").alias("future_value"),
        F.col("event_type").alias("label"),
    )
    return frame.select(*select.drop_leaks(frame.columns, label="label").selected)


_CANDIDATES_SQL = f"""
SELECT l_quantity, l_tax, l_discount, 1.0 AS constant, CASE WHEN l_linenumber = 1 THEN l_tax END AS sparse
FROM ({LINES_SQL})"""
_CANDIDATES = ("l_quantity", "l_tax", "l_discount", "constant", "sparse")


def _selection_row(c: str) -> str:
    ratio = f"1 - count({c}) / count(*)"
    return f"""SELECT '{c}' AS feature, {rounded(ratio)} AS null_ratio,
  CASE WHEN {ratio} > 0.4 THEN 'high_null_ratio' WHEN count(DISTINCT {c}) <= 1 THEN 'constant_or_no_variance'
       ELSE 'selected' END AS outcome FROM c"""


@query(f"WITH c AS ({_CANDIDATES_SQL})\n" + "\nUNION ALL\n".join(_selection_row(c) for c in _CANDIDATES))
def select_null_constant(spark, folder):
    frame = lines(spark, folder).select(
        "l_quantity",
        "l_tax",
        "l_discount",
        F.lit(1.0).alias("constant"),
        F.when(F.col("l_linenumber") == 1, F.col("l_tax")).alias("sparse"),
    )
    features = list(_CANDIDATES)
    stats = select.feature_profile(frame, features)
    selection = select.drop_uninformative(frame, features, 0.4, stats)
    outcome = {d["feature"]: d["reason"] for d in selection.dropped}
    rows = [(f, round(stats[f].null_ratio, 6), outcome.get(f, "selected")) for f in features]
    return spark.createDataFrame(rows, "feature string, null_ratio double, outcome string")


def _corr_row(a: str, b: str) -> str:
    value = f"corr(coalesce({a}, 0.0), coalesce({b}, 0.0))"
    return f"SELECT '{a}' AS left_feature, '{b}' AS right_feature, {rounded(value)} AS correlation FROM l"


@query(
    f"WITH l AS ({LINES_SQL})\n"
    + "\nUNION ALL\n".join(_corr_row(a, b) for a, b in itertools.combinations(PRICES, 2))
)
def pairwise_correlation(spark, folder):
    return select.pairwise_correlation(lines(spark, folder), list(PRICES)).withColumn(
        "correlation", F.round("correlation", 6)
    )


_TWINS = ("l_quantity", "with_tax", "l_extendedprice", "negated", "l_discount", "twice")
_TWINS_SQL = """
SELECT l_quantity, l_extendedprice * (1 + l_tax) AS with_tax, l_extendedprice, -l_quantity AS negated, l_discount,
       2 * l_discount + 1 AS twice FROM lineitem"""


def _twin_row(i: int, j: int) -> str:
    a, b = _TWINS[i], _TWINS[j]
    return f"SELECT {i} AS i, {j} AS j, abs(corr({a}, {b})) >= 0.98 AS twins FROM t"


@query(
    f"""
WITH RECURSIVE t AS ({_TWINS_SQL}),
p AS ({" UNION ALL ".join(_twin_row(i, j) for j, i in itertools.combinations(range(len(_TWINS)), 2))}),
g AS (
  SELECT 0 AS i, [0] AS kept, CAST(NULL AS INTEGER) AS twin
  UNION ALL
  SELECT g.i + 1,
    CASE WHEN len(x.found) = 0 THEN list_append(g.kept, g.i + 1) ELSE g.kept END,
    CASE WHEN len(x.found) = 0 THEN NULL ELSE list_min(x.found) END
  FROM g JOIN (SELECT i, list(j) FILTER (WHERE twins) AS js FROM p GROUP BY i) q ON q.i = g.i + 1,
  LATERAL (SELECT list_filter(g.kept, lambda k: list_contains(coalesce(q.js, []), k)) AS found) x
),
n AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate(_TWINS))}) v(i, feature))
SELECT a.feature, g.twin IS NULL AS kept, b.feature AS correlated_with
FROM g JOIN n a ON a.i = g.i LEFT JOIN n b ON b.i = g.twin"""
)
def greedy_correlation_select(spark, folder):
    frame = table(spark, folder, "lineitem").select(
        "l_quantity",
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("with_tax"),
        "l_extendedprice",
        (-F.col("l_quantity")).alias("negated"),
        "l_discount",
        (2 * F.col("l_discount") + 1).alias("twice"),
    )
    selection = select.drop_correlated(frame, list(_TWINS), 0.98)
    twins = {d["feature"]: d["correlated_with"] for d in selection.dropped}
    rows = [(f, f not in twins, twins.get(f)) for f in _TWINS]
    return spark.createDataFrame(rows, "feature string, kept boolean, correlated_with string")


@query(
    f"""
WITH p AS (SELECT CAST(p_partkey AS DOUBLE) AS p_partkey, CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE p_retailprice END
             AS p_retailprice, p_size FROM part),
m AS (SELECT median(p_retailprice) AS r FROM p),
f AS (SELECT p_partkey, coalesce(p_retailprice, r) AS p_retailprice, p_size FROM p, m),
t AS (SELECT avg(p_partkey) AS km, stddev_pop(p_partkey) AS ks, avg(p_retailprice) AS rm, stddev_pop(p_retailprice) AS rs
      FROM f)
SELECT {rounded("(p_partkey - km) / ks")} AS p_partkey, {rounded("(p_retailprice - rm) / rs")} AS p_retailprice, p_size
FROM f, t"""
)
def numeric_passthrough_select(spark, folder):
    frame = table(spark, folder, "part").withColumns(
        {
            "p_retailprice": F.when(F.col("p_partkey") % 8 != 0, F.col("p_retailprice")),
            "same": F.lit(3),
            "row_id": F.col("p_partkey"),
        }
    )
    selected, _, fitted = select.numeric_passthrough(frame, "p_size", exclude=["row_id"])
    matrix = fitted.transform(frame).select(*selected, "p_size").dropna(subset=["p_size"])
    return matrix.withColumns({c: F.round(c, 6) for c in selected})
