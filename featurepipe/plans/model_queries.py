"""Queries on scoring, model quality, gates and whole runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.operators import etl, gates, model, model_metrics, quality
from featurepipe.operators.features import FeatureConfig, engineer_features
from featurepipe.plans.flow import FlowConfig, run_flow
from featurepipe.plans.registry import ORACLES, query, rounded, table
from featurepipe.sources.readers import PullRequest, read_report
from featurepipe.sources.staging import staging_uri
from featurepipe.sources.writers import RunMetrics, write_report

# A linear model with given coefficients.
WEIGHTS = {"l_quantity": 0.02, "l_discount": -4.0, "l_tax": 3.0}
INTERCEPT = -0.6

_LOGIT = f"{INTERCEPT} + " + " + ".join(f"{c} * ({w})" for c, w in WEIGHTS.items())
SCORED_LINES_SQL = f"""
SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS DOUBLE) AS label,
       1 / (1 + exp(-({_LOGIT}))) AS score FROM lineitem"""


def scored_lines(spark, folder):
    frame = table(spark, folder, "lineitem").withColumn(
        "label", F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)
    )
    scored = model.linear_score(frame, WEIGHTS, INTERCEPT)
    return scored.select("l_orderkey", "l_linenumber", "label", "score")


@query(f"SELECT l_orderkey, l_linenumber, label, {rounded('score')} AS score FROM ({SCORED_LINES_SQL})")
def model_score(spark, folder):
    return scored_lines(spark, folder).withColumn("score", F.round("score", 6))


@query(
    f"""
SELECT {rounded("avg(-(label * ln(score) + (1 - label) * ln(1 - score)))")} AS loss,
       {rounded("avg(CASE WHEN (score >= 0.5) = (label = 1) THEN 1.0 ELSE 0.0 END)")} AS accuracy
FROM ({SCORED_LINES_SQL})"""
)
def loss_accuracy(spark, folder):
    result = model_metrics.loss_and_accuracy(scored_lines(spark, folder))
    return result.withColumns({c: F.round(c, 6) for c in result.columns})


@query(
    """
SELECT round(avg((l_extendedprice / 1000 - l_quantity) * (l_extendedprice / 1000 - l_quantity)), 6) AS loss
FROM lineitem"""
)
def regression_loss(spark, folder):
    scored = table(spark, folder, "lineitem").select(
        (F.col("l_extendedprice") / 1000).alias("score"), F.col("l_quantity").alias("label")
    )
    return model_metrics.loss_and_accuracy(scored, task="regression").withColumn("loss", F.round("loss", 6))


@query(
    f"""
WITH s AS (SELECT score >= 0.5 AS p, label = 1 AS y FROM ({SCORED_LINES_SQL})),
c AS (SELECT count(*) FILTER (WHERE p AND y) AS tp, count(*) FILTER (WHERE p AND NOT y) AS fp,
             count(*) FILTER (WHERE NOT p AND y) AS fn, count(*) FILTER (WHERE NOT p AND NOT y) AS tn FROM s)
SELECT tp AS true_positive, fp AS false_positive, fn AS false_negative, tn AS true_negative,
       {rounded("tp / (tp + fp)")} AS precision, {rounded("tp / (tp + fn)")} AS recall,
       {rounded("2 * tp / (2 * tp + fp + fn)")} AS f1
FROM c"""
)
def confusion_metrics(spark, folder):
    result = model_metrics.confusion_metrics(scored_lines(spark, folder))
    return result.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


def _auc_sql(rows: str) -> str:
    """SQL for the area: rows have g, s (score) and y (label)."""
    return f"""
WITH r AS ({rows}),
v AS (SELECT g, s, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg FROM r GROUP BY g, s),
w AS (SELECT g, pos, neg, coalesce(sum(neg) OVER (PARTITION BY g ORDER BY s
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower FROM v)
SELECT g AS "group", CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
       {rounded("sum(pos * (lower + neg / 2)) / nullif(sum(pos) * sum(neg), 0)")} AS auc
FROM w GROUP BY g"""


_LENGTHS_SQL = """
SELECT lang, CAST(n_chars AS DOUBLE) AS score, quality AS label
FROM documents JOIN labels USING (doc_id)"""


def _scored_documents(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang", F.col("n_chars").cast("double").alias("score"))
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return documents.join(labels, "doc_id").select("lang", "score", "label")


@query(_auc_sql(f"SELECT 'all' AS g, score AS s, label AS y FROM ({_LENGTHS_SQL})"))
def roc_auc(spark, folder):
    result = model_metrics.roc_auc(_scored_documents(spark, folder))
    return result.withColumn("auc", F.round("auc", 6))


@query(_auc_sql(f"SELECT lang AS g, score AS s, label AS y FROM ({_LENGTHS_SQL})"))
def group_auc(spark, folder):
    result = model_metrics.roc_auc(_scored_documents(spark, folder), group="lang")
    return result.withColumn("auc", F.round("auc", 6))


@query(_auc_sql(f"SELECT 'all' AS g, l_extendedprice AS s, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem"))
def price_auc(spark, folder):
    """The same on a fact table whose scores are nearly all distinct."""
    scored = table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").alias("score"), (F.col("l_returnflag") == "R").cast("int").alias("label")
    )
    return model_metrics.roc_auc(scored).withColumn("auc", F.round("auc", 6))


@query(ORACLES["price_auc"])
def price_auc_bucketed(spark, folder):
    """The same over many ordered buckets of scores."""
    scored = table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").alias("score"), (F.col("l_returnflag") == "R").cast("int").alias("label")
    )
    return model_metrics.roc_auc(scored, bucket_rows=2_000).withColumn("auc", F.round("auc", 6))


_ALL_AUC = _auc_sql(f"SELECT 'all' AS g, score AS s, label AS y FROM ({_LENGTHS_SQL})")
_LANG_AUC = _auc_sql(f"SELECT lang AS g, score AS s, label AS y FROM ({_LENGTHS_SQL})")


@query(
    f"""
WITH a AS ({_ALL_AUC}), b AS ({_LANG_AUC})
SELECT 'auc_floor' AS "check", '*' AS "column", auc AS observed, CAST(0.6 AS DOUBLE) AS threshold, auc >= 0.6 AS passed,
       'error' AS severity FROM a
UNION ALL SELECT 'champion_auc', '*', auc, CAST(0.49 AS DOUBLE), auc >= 0.49, 'error' FROM a
UNION ALL SELECT 'group_auc', "group", auc, CAST(0.5 AS DOUBLE), coalesce(auc >= 0.5, false), 'error' FROM b"""
)
def gate_report(spark, folder):
    scored = _scored_documents(spark, folder)
    overall = gates.auc_gates(model_metrics.roc_auc(scored), floor=0.6, champion=0.5)
    report = overall.union(gates.group_auc_gates(model_metrics.roc_auc(scored, group="lang"), 0.5))
    return report.withColumn("observed", F.round("observed", 6))


@query(
    f"""
WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem)
SELECT l_orderkey, l_linenumber, {rounded("(a * l_quantity + b) / 1000")} AS score FROM lineitem, m"""
)
def train_linear(spark, folder):
    """Train on all lines, store, load again and score all lines with the loaded model; in thousands."""
    frame = table(spark, folder, "lineitem")
    config = model.TrainConfig(task="regression", algorithm="linear_regression", params={"solver": "normal"})
    uri = staging_uri(spark, "model")
    model.train(frame, ["l_quantity"], "l_extendedprice", config).save(uri)
    scored = model.load_model(spark, uri).score(frame)
    return scored.select("l_orderkey", "l_linenumber", F.round(F.col("score") / 1000, 6).alias("score"))


_RETURNED_AUC = _auc_sql("SELECT 'all' AS g, l_extendedprice AS s, CAST(l_returnflag = 'R' AS INT) AS y FROM lineitem")


@query(
    f"""
WITH a AS ({_RETURNED_AUC}), s AS (SELECT count(DISTINCT l_returnflag) AS n FROM lineitem)
SELECT 'selected_features' AS "check", '*' AS "column", CAST(n AS DOUBLE) AS observed, CAST(2 AS DOUBLE) AS threshold,
       n >= 2 AS passed, 'error' AS severity FROM s
UNION ALL SELECT 'report_status', 'lines', CAST(1 AS DOUBLE), CAST(1 AS DOUBLE), true, 'error'
UNION ALL SELECT 'report_status', 'empty', CAST(0 AS DOUBLE), CAST(1 AS DOUBLE), false, 'error'
UNION ALL SELECT 'champion_auc', '*', round(auc, 6), round(auc - 0.01, 6), true, 'error' FROM a"""
)
def stored_gates(spark, folder):
    """Gates on a selection, on stored reports and on the metrics of the model in use, all taken from the line items."""
    lines = table(spark, folder, "lineitem")
    flags = [r["label"] for r in quality.label_distribution(lines, "l_returnflag").collect()]
    rows = [gates.selection_gate(flags, 2)]
    for name, frame in (("lines", lines), ("empty", lines.where(F.lit(False)))):
        uri = staging_uri(spark, "report")
        passed = quality.run_checks(frame, [quality.MinimumRows(threshold=1)]).first()["passed"]
        write_report(spark, uri, {"status": "passed" if passed else "failed"})
        rows.append(gates.report_gate(name, read_report(spark, uri).first().asDict()))
    scored = lines.select(F.col("l_extendedprice").alias("score"), (F.col("l_returnflag") == "R").cast("int").alias("label"))
    auc = model_metrics.overall_auc(scored)
    rows.append(gates.champion_gate(auc, model.champion_auc(metrics={"candidate_auc": auc})))
    report = gates.gate_rows(spark, rows)
    return report.withColumns({c: F.round(c, 6) for c in ("observed", "threshold")})


@query()
def train_logistic(spark, folder):
    """Train on all lines, store, load again, score all lines and measure."""
    frame = table(spark, folder, "lineitem").withColumn(
        "returned", F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)
    )
    config = model.TrainConfig(algorithm="logistic_regression")
    uri = staging_uri(spark, "model")
    model.train(frame, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "returned", config).save(uri)
    scored = model.load_model(spark, uri).score(frame)
    return model_metrics.loss_and_accuracy(scored, label="returned")


@query(
    """
SELECT 'etl' AS stage, 'StageSucceeded' AS metric, CAST(1 AS DOUBLE) AS value
UNION ALL
SELECT 'etl', 'OutputRows', CAST(count(*) AS DOUBLE) FROM (SELECT DISTINCT * FROM events)"""
)
def stage_metrics(spark, folder):
    """Metrics a clean-up stage leaves behind, without its duration, which differs between runs."""
    uri = staging_uri(spark, "run-metrics")
    metrics = RunMetrics(spark, "run", uri)
    with metrics.stage("etl"):
        frame, _ = etl.clean(table(spark, folder, "events"), etl.CleanConfig(drop_duplicates=True))
        metrics.record("etl", "OutputRows", frame.count())
    return spark.read.parquet(uri).where("metric <> 'StageDurationSeconds'").select("stage", "metric", "value")


@query()
def feature_matrix(spark, folder):
    """Classify, generate and select over the line items; the matrix keeps the order key."""
    frame = table(spark, folder, "lineitem").withColumn(
        "returned", F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)
    )
    config = FeatureConfig("returned", exclude=["l_orderkey", "l_returnflag"], keep_columns=["l_orderkey"])
    return engineer_features(frame, config)[0]


_DISTINCT_LINES = "(SELECT DISTINCT * FROM lineitem)"


@query(
    f"""
SELECT 'raw' AS table_name, count(*) AS row_count FROM lineitem
UNION ALL SELECT 'clean', count(*) FROM {_DISTINCT_LINES}
UNION ALL SELECT 'features', count(*) FROM {_DISTINCT_LINES}
UNION ALL SELECT 'matrix', count(*) FROM {_DISTINCT_LINES}"""
)
def staged_run(spark, folder):
    """All ten stages from the pull to the model gates, over the line items; returns the size of each table."""
    returned = "CASE WHEN l_returnflag = 'R' THEN 1D ELSE 0D END AS returned"
    config = FlowConfig(
        PullRequest("parquet", f"{folder}/lineitem.parquet", added_columns=[returned]),
        FeatureConfig("returned", exclude=["l_orderkey", "l_returnflag"]),
        expected_columns=["l_orderkey", "returned"],
        min_rows=100,
        training=model.TrainConfig(algorithm="logistic_regression", params={"maxIter": 10}),
        min_auc=0.5,
        max_latency_ms=60_000.0,
    )
    flow = run_flow(spark, config)
    sizes = [
        flow.table(name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
        for name in ("raw", "clean", "features", "matrix")
    ]
    return reduce(DataFrame.union, sizes)
