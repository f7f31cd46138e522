import datetime
import random
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from featurepipe.operators import quality
from featurepipe.operators.features import FeatureConfig, fit_features
from featurepipe.operators.model import TrainConfig, train
from featurepipe.plans.flow import STAGES, Flow, FlowConfig, run_flow
from featurepipe.sources import readers, staging, writers
from featurepipe.streaming.scoring import score_stream, start_scoring


def test_csv(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("a,b\n1,x\n2,\n")
    frame = readers.read_csv(spark, str(path))
    assert [r.asDict() for r in frame.collect()] == [{"a": 1, "b": "x"}, {"a": 2, "b": None}]
    assert dict(readers.read_csv(spark, str(path), infer_schema=False).dtypes)["a"] == "string"
    assert readers.read_csv(spark, str(path), header=False).columns == ["_c0", "_c1"]
    assert dict(readers.read_csv(spark, str(path), schema="a long, b string").dtypes)["a"] == "bigint"
    with pytest.raises(ValueError):
        readers.read_csv(spark, "")
    pulled = readers.pull(spark, readers.PullRequest("s3_csv", str(path), sql_file="ignored.sql"))
    assert pulled.count() == 2


def test_pull_adds_columns(spark, tmp_path):
    spark.createDataFrame([(1, "R"), (2, None)], "a long, flag string").write.parquet(str(tmp_path / "t"))
    request = readers.PullRequest("parquet", str(tmp_path / "t"), added_columns=["CASE WHEN flag = 'R' THEN 1D ELSE 0D END AS y"])
    pulled = readers.pull(spark, request)
    assert pulled.columns == ["a", "flag", "y"] and {(r["a"], r["y"]) for r in pulled.collect()} == {(1, 1.0), (2, 0.0)}


@pytest.mark.parametrize("name", ["staged_run", "stage_manifests"])
def test_whole_runs_read_the_given_table(spark, monkeypatch, name):
    """The first table that a run writes is its own raw one, made from the given files."""
    from featurepipe.plans import catalog, flow

    sources = []
    monkeypatch.setattr(flow, "pull", lambda s, request: sources.append(request.input_uri) or readers.pull(s, request))
    catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert sources == ["/root/testdata/sf0.001/lineitem.parquet"]


def test_pull_dispatch(spark):
    with pytest.raises(ValueError, match="Unsupported"):
        readers.pull(spark, readers.PullRequest("magic"))
    with pytest.raises(ValueError, match="input URI"):
        readers.pull(spark, readers.PullRequest("csv"))
    with pytest.raises(ValueError, match="exactly one"):
        readers.pull(spark, readers.PullRequest("jdbc", options={"url": "jdbc:x"}))


class FakeReader:
    """Stands in for spark.read: records the format and options of a load."""

    @property
    def read(self):
        return self

    def format(self, name):
        self.name = name
        return self

    def options(self, **options):
        self.given = options
        return self

    def load(self):
        return self


def test_jdbc_and_connector_options():
    plain = readers.jdbc_options("jdbc:x", "select 1", driver="d", user="token", password="p")
    assert plain == {
        "url": "jdbc:x",
        "fetchsize": "10000",
        "query": "select 1",
        "driver": "d",
        "user": "token",
        "password": "p",
    }
    cut = readers.jdbc_options("jdbc:x", "select id from t;", partitioning=readers.JdbcPartitioning("id", "0", "99", 8))
    assert cut["dbtable"] == "(select id from t) source_query" and cut["numPartitions"] == "8" and "query" not in cut
    request = readers.PullRequest("databricks_sql", query="q", options={"url": "u", "user": "token", "extra": "1"})
    read = readers.pull(FakeReader(), request)
    assert read.name == "jdbc" and read.given["query"] == "q" and read.given["extra"] == "1" and read.given["url"] == "u"
    named = readers.pull(FakeReader(), readers.PullRequest("snowflake_sql", query="q", options={"sfDatabase": "d"}))
    assert named.name == "snowflake" and named.given == {"query": "q", "sfDatabase": "d"}


def test_query_text(spark, tmp_path):
    file = tmp_path / "q.sql"
    file.write_text("select count(*) as n from t")
    assert readers.run_query(spark, {"t": spark.range(3)}, sql_file=str(file)).first()["n"] == 3
    with pytest.raises(ValueError):
        readers.resolve_query("a", "b")
    with pytest.raises(ValueError):
        readers.resolve_query()


def test_parquet_pruning_and_partitions(spark, tmp_path):
    uri = str(tmp_path / "t")
    writers.write_parquet(spark.range(100).withColumn("p", F.col("id") % 3), uri, partition_columns=["p"], compact=True)
    frame = readers.read_parquet(spark, uri, ["id"], "p = 1")
    assert frame.count() == 33
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan and "ReadSchema: struct<id:bigint>" in plan
    matrix = readers.read_training_matrix(spark, uri, ["id"], "p", where="id > 50")
    plan = matrix._jdf.queryExecution().executedPlan().toString()
    assert matrix.dtypes == [("id", "float"), ("p", "int")] and "GreaterThan(id,50)" in plan
    assert readers.preview(frame).count() == 5


def test_report_round_trip(spark, tmp_path):
    uri = writers.write_report(spark, str(tmp_path / "r"), {"status": "passed", "auc": 0.8, "names": ["a", "b"]})
    row = readers.read_report(spark, uri).first()
    assert (row["status"], row["auc"], row["names"]) == ("passed", 0.8, ["a", "b"])


def test_run_metrics(spark, tmp_path):
    metrics = writers.RunMetrics(spark, "r1", str(tmp_path / "m"))
    with metrics.stage("good"):
        metrics.record("good", "Rows", 3, {"table": "t"})
    with pytest.raises(RuntimeError), metrics.stage("bad"):
        raise RuntimeError("stop")
    rows = spark.read.parquet(str(tmp_path / "m")).collect()
    found = {(r["stage"], r["metric"]): r for r in rows}
    assert len(rows) == 5 and found["good", "Rows"]["dims"] == {"table": "t"}
    assert found["good", "StageSucceeded"]["value"] == 1.0 and found["bad", "StageSucceeded"]["value"] == 0.0
    assert found["bad", "StageDurationSeconds"]["value"] >= 0
    unwritable = writers.RunMetrics(spark, "r2", "nosuchscheme://x")
    with unwritable.stage("s"):
        pass
    assert unwritable.frame().count() == 2


def test_staging_uses_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = staging.shared_folder(spark)
    assert folder == (configured or folder)
    frame = staging.materialize(spark.range(5).withColumn("x", F.rand(1)), "t")
    assert frame.count() == 5 and all(folder in f for f in frame.inputFiles())
    assert staging.staging_uri(spark, "t") != staging.staging_uri(spark, "t")


def test_temporary_tables(spark):
    def exists(frame):
        return all(Path(f.removeprefix("file:")).exists() for f in files[frame])

    kept = staging.materialize(spark.range(5), "kept")
    with staging.temporary_tables(spark):
        outer = staging.materialize(spark.range(5), "outer")
        with staging.temporary_tables(spark):
            inner = staging.materialize(spark.range(5), "inner")
            files = {f: f.inputFiles() for f in (kept, outer, inner)}
            assert exists(inner)
        assert exists(outer) and not exists(inner)
    assert exists(kept) and not exists(outer)


def test_blocks_of_two_threads_keep_apart(spark):
    opened, ended, seen = threading.Event(), threading.Event(), []

    def other():
        with staging.temporary_tables(spark):
            frame = staging.materialize(spark.range(5), "other")
            opened.set()
            ended.wait(60)
            seen.append(frame.count())

    thread = threading.Thread(target=other)
    thread.start()
    with staging.temporary_tables(spark):
        opened.wait(60)
        staging.materialize(spark.range(3), "own")
    ended.set()
    thread.join(60)
    assert seen == [5]


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    r = random.Random(11)
    rows = []
    for i in range(1_500):
        x = r.gauss(0, 1)
        rows.append((i, x, r.gauss(10, 2) if i % 9 else None, "abc"[i % 3], f"2024-01-{1 + i % 28:02d}", int(x + r.gauss(0, 0.5) > 0)))
    uri = str(tmp_path_factory.mktemp("flow") / "source")
    frame = spark.createDataFrame(rows, "`Id` long, `X 1` double, `x2` double, `Kind` string, `Event Date` string, `Label` int")
    frame.union(frame.limit(50)).write.parquet(uri)
    return uri


def config_for(source, tmp_path, **changes):
    base = dict(
        source=readers.PullRequest("parquet", source),
        features=FeatureConfig("label", exclude=["id"], keep_columns=["id", "kind"]),
        work_uri=str(tmp_path / "work"),
        expected_columns=["Id", "Label"],
        freshness_column="Event Date",
        as_of=datetime.date(2024, 1, 30),
        checks=[quality.InSet("kind", allowed=("a", "b", "c"))],
        training=TrainConfig(algorithm="logistic_regression"),
        fairness_column="kind",
        fairness_groups=["a", "b"],
        champion_auc=0.8,
        max_latency_ms=1e6,
        metrics_uri=str(tmp_path / "metrics"),
    )
    return FlowConfig(**(base | changes))


def test_whole_flow_and_resume(spark, source, tmp_path):
    flow = run_flow(spark, config_for(source, tmp_path))
    assert flow.table("raw").count() == 1_550 and flow.table("clean").count() == 1_500
    log = flow.report("feature_log")
    matrix = flow.table("matrix")
    assert matrix.columns == ["id", "kind", *log["selected_features"], "label"] and matrix.count() == 1_500
    assert all(flow.report(r)["status"] == "passed" for r in ("schema", "data", "selection", "model"))
    assert flow.report("evaluation")["auc"] > 0.85
    metrics = spark.read.parquet(str(tmp_path / "metrics")).orderBy("ts").collect()
    names = {r["metric"] for r in metrics}
    assert {"StageDurationSeconds", "MinorityClassRatio", "CandidateAUC", "ChampionAUC", "FairnessGroupAUC"} <= names
    assert [r["stage"] for r in metrics if r["metric"] == "StageSucceeded"] == list(STAGES)

    # Resume: only the last stages run, on the tables already written, with another limit.
    strict = config_for(source, tmp_path, stages=("evaluate", "validate_model"), champion_auc=1.2)
    with pytest.raises(quality.GateFailed, match="champion_auc"):
        run_flow(spark, strict)
    assert Flow(spark, strict).report("model")["status"] == "failed"

    # Drift against the run's own clean table passes; against a shifted one it stops the run.
    clean = flow.uri("clean")
    run_flow(spark, config_for(source, tmp_path, stages=("validate_data",), previous_uri=clean, drift_columns=["x_1"]))
    shifted = str(tmp_path / "shifted")
    spark.read.parquet(clean).withColumn("x_1", F.col("x_1") + 1).write.parquet(shifted)
    drifted = config_for(source, tmp_path, stages=("validate_data",), previous_uri=shifted, drift_columns=["x_1"])
    with pytest.raises(quality.GateFailed, match="drift_p_value"):
        run_flow(spark, drifted)


def test_first_failure_stops_the_flow(spark, source, tmp_path):
    config = config_for(source, tmp_path, expected_columns=["Nope"])
    with pytest.raises(quality.GateFailed, match="expected_column"):
        run_flow(spark, config)
    rows = spark.read.parquet(str(tmp_path / "metrics")).where("metric = 'StageSucceeded'").orderBy("ts").collect()
    assert [(r["stage"], r["value"]) for r in rows] == [("pull", 1.0), ("validate_schema", 0.0)]
    assert Flow(spark, config).report("schema")["status"] == "failed"


def test_unknown_stage(spark, source, tmp_path):
    with pytest.raises(ValueError):
        Flow(spark, config_for(source, tmp_path, stages=("magic",)))


def test_stream_scoring_equals_batch_scoring(spark, source, tmp_path):
    frame = spark.read.parquet(source).toDF("id", "x", "x2", "kind", "event_date", "label")
    uri = str(tmp_path / "in")
    frame.write.parquet(uri)
    config = FeatureConfig("label", exclude=["id"], exact=True)
    fitted = fit_features(frame, config)
    features = [f for f in fitted.features if not f.endswith("is_missing")]
    trained = train(fitted.transform(frame), features, "label", TrainConfig(algorithm="logistic_regression"))
    stream = spark.readStream.schema(frame.schema).parquet(uri)
    query = start_scoring(stream, fitted, trained, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True)
    query.awaitTermination(120)
    streamed = sorted((r["id"], r["score"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    batch = sorted((r["id"], r["score"]) for r in score_stream(frame, fitted, trained).collect())
    assert [s[0] for s in streamed] == [b[0] for b in batch]
    assert [s[1] for s in streamed] == pytest.approx([b[1] for b in batch])
    lagged = fit_features(frame, FeatureConfig("label", lag_columns=["x"], time_column="id", exact=True))
    with pytest.raises(ValueError):
        score_stream(stream, lagged, trained)


def test_tables_are_written_in_few_bytes(spark, tmp_path):
    """Doubles that few others equal take less than with the default codec, and read back the same."""
    import pyarrow.parquet as pq

    from featurepipe.sources.writers import write_parquet

    frame = spark.range(0, 40_000, 1, 2).selectExpr("id", "(hash(id) % 20000 - 7) / 3.0D * (id % 11 - 4.5D) AS product")
    frame.write.parquet(str(tmp_path / "plain"))
    write_parquet(frame, str(tmp_path / "table"))
    sizes = {}
    for name in ("plain", "table"):
        parts = [pq.read_metadata(p).row_group(0) for p in (tmp_path / name).glob("*.parquet")]
        sizes[name] = sum(g.column(k).total_compressed_size for g in parts for k in range(2))
    assert sizes["table"] < 0.95 * sizes["plain"]
    written = spark.read.parquet(str(tmp_path / "table"))
    assert written.exceptAll(frame).isEmpty() and written.count() == 40_000
