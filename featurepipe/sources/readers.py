"""Where tables come from: files, JDBC queries, named connectors, SQL text and JSON reports."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

# Source names a pull may ask for, and the Spark reader each one uses.
CONNECTOR_FORMATS = {
    "csv": "csv",
    "s3_csv": "csv",
    "parquet": "parquet",
    "jdbc": "jdbc",
    "databricks_sql": "jdbc",
    "snowflake_sql": "snowflake",
}


def read_csv(
    spark: SparkSession,
    uri: str,
    header: bool = True,
    infer_schema: bool = True,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Read CSV. A given schema saves the extra full pass that inference costs."""
    if not uri:
        raise ValueError("A CSV source needs an input URI.")
    reader = spark.read.option("header", header)
    if schema is not None:
        return reader.schema(schema).csv(uri)
    return reader.option("inferSchema", infer_schema).csv(uri)


def read_parquet(
    spark: SparkSession,
    uri: str,
    columns: list[str] | None = None,
    where: Column | str | None = None,
    spread: bool = False,
) -> DataFrame:
    """Read Parquet; the projection and the filter both reach the scan.

    ``spread`` deals the rows out over all cores if the scan has fewer splits than there are
    cores. That is for costly work on a table in few files. A table that spans fewer splits
    than cores is small, so the shuffle is bounded; any larger table is read as it lies.
    """
    frame = spark.read.parquet(uri)
    if where is not None:
        frame = frame.where(where)
    if columns:
        frame = frame.select(*columns)
    cores = spark.sparkContext.defaultParallelism
    if spread and frame.rdd.getNumPartitions() < cores:
        frame = frame.repartition(cores)
    return frame


def read_training_matrix(
    spark: SparkSession,
    uri: str,
    feature_columns: list[str],
    label_column: str,
    where: Column | str | None = None,
) -> DataFrame:
    """Features in contract order as float, then the label, from a pruned and filtered scan."""
    from pyspark.sql import functions as F

    frame = spark.read.parquet(uri)
    if where is not None:
        frame = frame.where(where)
    return frame.select(*[F.col(c).cast("float").alias(c) for c in feature_columns], F.col(label_column))


@dataclass(frozen=True)
class JdbcPartitioning:
    """How to split a JDBC read. Without it the whole result comes through one connection and one task."""

    column: str
    lower: str
    upper: str
    partitions: int


def jdbc_options(
    url: str,
    query: str,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    partitioning: JdbcPartitioning | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options for a pushed-down query. Spark allows partition bounds only with a table, so the query becomes one."""
    options = {"url": url, "fetchsize": str(fetch_size)}
    if partitioning is None:
        options["query"] = query
    else:
        options |= {
            "dbtable": f"({query.strip().rstrip(';')}) source_query",
            "partitionColumn": partitioning.column,
            "lowerBound": partitioning.lower,
            "upperBound": partitioning.upper,
            "numPartitions": str(partitioning.partitions),
        }
    for key, value in (("driver", driver), ("user", user), ("password", password)):
        if value is not None:
            options[key] = value
    return options


def read_jdbc(spark: SparkSession, **arguments) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**arguments)).load()


@dataclass
class PullRequest:
    """One data pull: what kind of source, and the text or place it needs."""

    source_type: str
    input_uri: str | None = None
    query: str | None = None
    sql_file: str | None = None
    csv_header: bool = True
    csv_infer_schema: bool = True
    csv_schema: T.StructType | str | None = None
    options: dict[str, str] = field(default_factory=dict)
    partitioning: JdbcPartitioning | None = None
    # Columns to add to those of the source: SQL expressions with their names (``... AS name``).
    added_columns: list[str] = field(default_factory=list)


def pull(spark: SparkSession, request: PullRequest) -> DataFrame:
    """Read the source a request names, with the columns it adds. A query is ignored by file sources."""
    frame = _source(spark, request)
    return frame.selectExpr("*", *request.added_columns) if request.added_columns else frame


def _source(spark: SparkSession, request: PullRequest) -> DataFrame:
    if request.source_type not in CONNECTOR_FORMATS:
        raise ValueError(f"Unsupported source type: {request.source_type}")
    reader_format = CONNECTOR_FORMATS[request.source_type]
    if reader_format in ("csv", "parquet") and not request.input_uri:
        raise ValueError(f"Source type {request.source_type} needs an input URI.")
    if reader_format == "csv":
        return read_csv(
            spark, request.input_uri, request.csv_header, request.csv_infer_schema, request.csv_schema
        )
    if reader_format == "parquet":
        return read_parquet(spark, request.input_uri)

    query = resolve_query(request.query, request.sql_file)
    if reader_format == "jdbc":
        options = dict(request.options)
        known = {k: options.pop(k) for k in ("url", "driver", "user", "password") if k in options}
        options = jdbc_options(query=query, partitioning=request.partitioning, **known) | options
    else:
        options = {"query": query} | request.options
    return spark.read.format(reader_format).options(**options).load()


def resolve_query(query: str | None = None, sql_file: str | None = None) -> str:
    """SQL text from exactly one of a string and a file."""
    if bool(query) == bool(sql_file):
        raise ValueError("Give exactly one of query and sql_file.")
    return query or Path(sql_file).read_text(encoding="utf-8")


def run_query(
    spark: SparkSession,
    tables: dict[str, DataFrame],
    query: str | None = None,
    sql_file: str | None = None,
) -> DataFrame:
    """Run SQL text with the given tables bound by name."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
    return spark.sql(resolve_query(query, sql_file))


def read_report(spark: SparkSession, uri: str) -> DataFrame:
    """Read a report that ``write_report`` or another tool stored as JSON."""
    return spark.read.option("multiLine", True).json(uri)


def preview(frame: DataFrame, rows: int = 5) -> DataFrame:
    return frame.limit(rows)
