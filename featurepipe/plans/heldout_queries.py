"""Queries on what a run learns from one side of a split and shows on the other, and on what it stores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.operators import categorical, model, quality
from featurepipe.operators.features import FeatureConfig, fit_features
from featurepipe.plans.flow import Flow, FlowConfig
from featurepipe.plans.model_queries import _auc_sql
from featurepipe.plans.registry import query, rounded, table
from featurepipe.sources.manifest import StaleStage
from featurepipe.sources.readers import PullRequest
from featurepipe.sources.staging import staging_uri
from featurepipe.sources.stored import load_generators, save_generators

SHARE, HELD_BELOW = 0.25, 1 << 30


def _position_sql(column: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({column} AS VARCHAR)), 1, 8) AS BIGINT)"


# --- out-of-fold means -------------------------------------------------------------------------------------------

FOLDS = 5
_RICH_SQL = f"""
SELECT c_custkey, coalesce(CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END, '__missing__') AS c_mktsegment,
       c_nationkey, CAST(c_acctbal > 5000 AS DOUBLE) AS rich, {_position_sql("c_custkey")} % {FOLDS} AS fold FROM customer"""


def _outside_sql(c: str) -> str:
    of = f"PARTITION BY {c}"
    rows = f"count(*) OVER ({of}) - count(*) OVER ({of}, fold)"
    own = f"(sum(rich) OVER ({of}) - sum(rich) OVER ({of}, fold)) / nullif({rows}, 0)"
    others = "(sum(rich) OVER () - sum(rich) OVER (PARTITION BY fold)) / (count(*) OVER () - count(*) OVER (PARTITION BY fold))"
    return f"{rounded(f'coalesce({own}, {others})')} AS {c}__target_mean"


def _rich_customers(spark, folder) -> DataFrame:
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 9 != 0, F.col("c_mktsegment")).alias("c_mktsegment"),
        "c_nationkey",
        F.when(F.col("c_acctbal") > 5000, 1.0).otherwise(0.0).alias("rich"),
    )


_OUT_OF_FOLD = f"SELECT c_custkey, {_outside_sql('c_mktsegment')}, {_outside_sql('c_nationkey')} FROM ({_RICH_SQL})"


def _out_of_fold(spark, folder, **limits) -> DataFrame:
    frame, columns = _rich_customers(spark, folder), ["c_mktsegment", "c_nationkey"]
    fitted = categorical.fit_categories(frame, columns, "rich", True, folds=FOLDS, fold_keys=["c_custkey"], **limits)
    return fitted.transform_training(frame).select(
        "c_custkey", *[F.round(f"{c}__target_mean", 6).alias(f"{c}__target_mean") for c in columns]
    )


@query(_OUT_OF_FOLD)
def target_mean_out_of_fold(spark, folder):
    """Label means of each customer's categories, learned from the other folds only."""
    return _out_of_fold(spark, folder)


@query(_OUT_OF_FOLD)
def target_mean_out_of_fold_shuffled(spark, folder):
    """The same with tables that are too large to broadcast."""
    return _out_of_fold(spark, folder, broadcast_categories=0, bucket_rows=7)


# --- held-out measures -------------------------------------------------------------------------------------------


def _side_sql(x: str, y: str) -> str:
    """Distinct line items, with the side of each and its feature, capped and scaled by what the training side shows."""
    return f"""
p AS (SELECT *, {_position_sql("l_orderkey")} < {HELD_BELOW} AS held, {y} AS y FROM (SELECT DISTINCT * FROM lineitem)),
q AS (SELECT quantile_disc({x}, 0.01) AS low, quantile_disc({x}, 0.5) AS mid, quantile_disc({x}, 0.99) AS high,
             avg({x}) AS mean, stddev_samp({x}) AS std FROM p WHERE NOT held),
c AS (SELECT p.*, (least(greatest({x}, low), high) - mean) / std AS x FROM p, q)"""


def _line_flow(spark, folder, label: str, features: list[str], **settings) -> Flow:
    lines = table(spark, folder, "lineitem")
    returned = "CASE WHEN l_returnflag = 'R' THEN 1D ELSE 0D END AS returned"
    used = [f.removesuffix("__scaled") for f in features]
    keep = settings.pop("keep", [])
    unused = [c for c in [*lines.columns, "returned"] if c not in {*used, label}]
    return Flow(
        spark,
        FlowConfig(
            PullRequest("parquet", f"{folder}/lineitem.parquet", added_columns=[returned]),
            FeatureConfig(label, exclude=unused, keep_columns=keep, exact=True),
            holdout_share=SHARE,
            holdout_keys=["l_orderkey"],
            feature_override=features,
            min_rows=100,
            **settings,
        ),
    )


@query(
    f"""
WITH {_side_sql("l_quantity", "l_extendedprice")},
m AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM c WHERE NOT held)
SELECT 'heldout' AS measured_on, count(*) FILTER (WHERE NOT held) AS training_rows, count(*) FILTER (WHERE held) AS measured_rows,
       {rounded("avg((a * x + b - y) * (a * x + b - y)) FILTER (WHERE held) / 1000000")} AS loss
FROM c, m"""
)
def heldout_report(spark, folder):
    """A whole run that learns prices from quantities on three quarters of the orders and is measured on the others."""
    flow = _line_flow(
        spark,
        folder,
        "l_extendedprice",
        ["l_quantity__scaled"],
        stages=("pull", "validate_schema", "etl", "feature_engineer", "feature_select", "preprocess", "train", "evaluate"),
        training=model.TrainConfig(task="regression", algorithm="linear_regression", params={"solver": "normal"}),
    ).run()
    report = flow.report("evaluation")
    return flow.table("matrix").agg(
        F.lit(report["measured_on"]).alias("measured_on"),
        F.count(F.lit(1)).alias("training_rows"),
        F.lit(report["rows"]).cast("bigint").alias("measured_rows"),
        F.round(F.lit(report["loss"] / 1e6), 6).alias("loss"),
    )


def _held_auc_sql(group: str, score: str) -> str:
    return _auc_sql(f"SELECT {group} AS g, {score} AS s, CAST(y AS INT) AS y FROM c, k WHERE held")


MIN_AUC, CHAMPION_TOLERANCE, MIN_GROUP_AUC = 0.5, 0.02, 0.49


@query(
    f"""
WITH {_side_sql("l_extendedprice", "CAST(l_returnflag = 'R' AS DOUBLE)")},
k AS (SELECT sign(covar_pop(x, y) FILTER (WHERE NOT held)) AS way, (SELECT sign(covar_pop(l_quantity, CAST(l_returnflag = 'R' AS DOUBLE)))
      FROM lineitem) AS champion_way FROM c),
a AS ({_held_auc_sql("'*'", "x * way")}), b AS ({_held_auc_sql("'*'", "l_quantity * champion_way")}),
d AS ({_held_auc_sql("l_linestatus", "x * way")})
SELECT 'auc_floor' AS "check", '*' AS "column", a.auc AS observed, CAST({MIN_AUC} AS DOUBLE) AS threshold, a.auc >= {MIN_AUC} AS passed FROM a
UNION ALL SELECT 'champion_auc', '*', a.auc, round(b.auc - {CHAMPION_TOLERANCE}, 6), a.auc >= b.auc - {CHAMPION_TOLERANCE} FROM a, b
UNION ALL SELECT 'group_auc', "group", auc, CAST({MIN_GROUP_AUC} AS DOUBLE), auc >= {MIN_GROUP_AUC} FROM d"""
)
def heldout_gates(spark, folder):
    """The model gates of a whole run, on orders that nothing was learned from; the stored model in use is scored on them too."""
    lines = table(spark, folder, "lineitem").withColumn("returned", F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0))
    logistic = model.TrainConfig(algorithm="logistic_regression")
    in_use = staging_uri(spark, "model-in-use")
    model.train(lines, ["l_quantity"], "returned", logistic).save(in_use)
    flow = _line_flow(
        spark,
        folder,
        "returned",
        ["l_extendedprice__scaled"],
        keep=["l_quantity", "l_linestatus"],
        training=logistic,
        min_auc=MIN_AUC,
        champion_model_uri=in_use,
        champion_tolerance=CHAMPION_TOLERANCE,
        fairness_column="l_linestatus",
        fairness_groups=[r[0] for r in lines.select("l_linestatus").distinct().collect()],
        min_group_auc=MIN_GROUP_AUC,
        max_latency_ms=1e6,
    )
    try:
        flow.run()
    except quality.GateFailed:
        # The report is stored before a failed gate stops the run.
        pass
    rows = [(r["check"], r["column"], r["observed"], r["threshold"], r["passed"]) for r in flow.report("model")["checks"]]
    report = spark.createDataFrame(rows, "check string, column string, observed double, threshold double, passed boolean")
    return report.where("check <> 'latency_ms'").withColumns({c: F.round(c, 6) for c in ("observed", "threshold")})


# --- stored artefacts --------------------------------------------------------------------------------------------

_ACCOUNTS_SQL = """
SELECT s_suppkey, s_acctbal AS c_acctbal,
       CASE s_suppkey % 4 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'nowhere' WHEN 2 THEN 'MACHINERY' END AS c_mktsegment FROM supplier"""


@query(
    f"""
WITH f AS (SELECT c_acctbal AS v, c_mktsegment AS k FROM customer),
q AS (SELECT quantile_disc(v, 0.01) AS low, quantile_disc(v, 0.5) AS mid, quantile_disc(v, 0.99) AS high, avg(v) AS mean,
             stddev_samp(v) AS std, count(DISTINCT k) AS kinds, count(*) AS n FROM f),
i AS (SELECT k, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, k) - 1 AS idx FROM f GROUP BY k),
s AS ({_ACCOUNTS_SQL}),
c AS (SELECT s.*, q.*, CASE WHEN c_acctbal IS NULL THEN mid ELSE least(greatest(c_acctbal, low), high) END AS capped FROM s, q)
SELECT s_suppkey, {rounded("(capped - mean) / std")} AS c_acctbal__scaled,
       CAST(CASE WHEN capped <= low THEN 0 WHEN capped <= mid THEN 1 WHEN capped <= high THEN 2 ELSE 3 END AS DOUBLE) AS c_acctbal__bin,
       CAST(coalesce(i.idx, kinds) AS DOUBLE) AS c_mktsegment__index, {rounded("coalesce(i.n, 0) / c.n")} AS c_mktsegment__frequency
FROM c LEFT JOIN i ON coalesce(c_mktsegment, '__missing__') = i.k"""
)
def stored_generators(spark, folder):
    """Fit on customers, store, load into fresh objects, and transform suppliers with them."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    config = FeatureConfig("label", exclude=["c_custkey"], exact=True)
    uri = staging_uri(spark, "generators")
    frame = customers.withColumn("label", F.lit(0.0))
    save_generators(spark, fit_features(frame, config), uri, frame.schema)
    fitted, _ = load_generators(spark, uri)
    key = F.col("s_suppkey") % 4
    kind = F.when(key == 0, "BUILDING").when(key == 1, "nowhere").when(key == 2, "MACHINERY")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", F.col("s_acctbal").alias("c_acctbal"), kind.alias("c_mktsegment"))
    return fitted.transform(suppliers).select(
        "s_suppkey",
        F.round("c_acctbal__scaled", 6).alias("c_acctbal__scaled"),
        "c_acctbal__bin",
        "c_mktsegment__index",
        F.round("c_mktsegment__frequency", 6).alias("c_mktsegment__frequency"),
    )


@query(
    f"""
WITH d AS (SELECT DISTINCT * FROM lineitem), s AS (SELECT {_position_sql("l_orderkey")} < {HELD_BELOW} AS held FROM d),
t AS (SELECT 'pull' AS stage, 'raw' AS table_name, count(*) AS row_count, true AS resumed_as_it_was FROM lineitem
UNION ALL SELECT 'etl', 'clean', count(*), true FROM d
UNION ALL SELECT 'feature_engineer', 'features', count(*) FILTER (WHERE NOT held), true FROM s
UNION ALL SELECT 'feature_engineer', 'heldout_features', count(*) FILTER (WHERE held), true FROM s
UNION ALL SELECT 'preprocess', 'matrix', count(*) FILTER (WHERE NOT held), true FROM s
UNION ALL SELECT 'preprocess', 'heldout', count(*) FILTER (WHERE held), true FROM s)
SELECT t.*, stage IN ('pull', 'etl') AS resumed_with_more_held_out FROM t"""
)
def stage_manifests(spark, folder):
    """What each stage's manifest says of its tables, and whether a run with these or other settings may resume from it."""
    stages = ("pull", "etl", "feature_engineer", "preprocess")
    flow = _line_flow(spark, folder, "returned", ["l_quantity__scaled"], stages=stages).run()
    rows = []
    for stage in stages:
        changed = FlowConfig(**{**vars(flow.config), "work_uri": flow.work_uri, "stages": (), "holdout_share": 0.5})
        same = FlowConfig(**{**vars(changed), "holdout_share": flow.config.holdout_share})
        allowed = [_resumes(Flow(spark, config), stage) for config in (same, changed)]
        rows += [(stage, name, entry["rows"], *allowed) for name, entry in flow.manifest(stage)["tables"].items()]
    schema = "stage string, table_name string, row_count bigint, resumed_as_it_was boolean, resumed_with_more_held_out boolean"
    return spark.createDataFrame(rows, schema)


def _resumes(flow: Flow, stage: str) -> bool:
    try:
        flow.require(stage)
    except StaleStage:
        return False
    return True
