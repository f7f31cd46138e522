"""Queries on sources, sinks and clean-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from featurepipe.operators import etl
from featurepipe.plans.registry import query, table
from featurepipe.sources.readers import read_csv, read_parquet, read_training_matrix, run_query
from featurepipe.sources.staging import staging_uri
from featurepipe.sources.writers import write_parquet

EVENTS_WITH_NULLS = """
SELECT event_id,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE user_id END AS user_id,
       event_type,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value
FROM events"""


def events_with_nulls(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_id") % 11 != 0, F.col("user_id")).alias("user_id"),
        "event_type",
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
    )


@query("SELECT * FROM customer")
def csv_roundtrip(spark, folder):
    customers = table(spark, folder, "customer")
    uri = staging_uri(spark, "csv")
    customers.write.option("header", True).csv(uri)
    return read_csv(spark, uri, schema=customers.schema)


@query("SELECT o_orderkey, o_orderdate, o_totalprice, o_orderstatus FROM orders")
def parquet_partitioned_roundtrip(spark, folder):
    uri = staging_uri(spark, "orders-by-status")
    write_parquet(table(spark, folder, "orders"), uri, partition_columns=["o_orderstatus"], compact=True)
    return read_parquet(spark, uri, ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"])


@query(
    """
SELECT CAST(l_quantity AS FLOAT) AS l_quantity, CAST(l_extendedprice AS FLOAT) AS l_extendedprice,
       CAST(l_discount AS FLOAT) AS l_discount, l_linenumber
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'"""
)
def training_matrix_scan(spark, folder):
    return read_training_matrix(
        spark,
        f"{folder}/lineitem.parquet",
        ["l_quantity", "l_extendedprice", "l_discount"],
        "l_linenumber",
        where="l_shipdate >= TIMESTAMP_NTZ '1998-01-01'",
    )


SEGMENT_ORDERS = """
SELECT c_mktsegment, o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS total_price
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY c_mktsegment, o_orderpriority"""


@query(SEGMENT_ORDERS)
def sql_text_query(spark, folder):
    tables = {name: table(spark, folder, name) for name in ("orders", "customer")}
    return run_query(spark, tables, query=SEGMENT_ORDERS)


@query(
    """
SELECT c_custkey AS c_cust_key, c_name AS name, c_nationkey AS name_2, c_acctbal AS acct_bal,
       c_mktsegment AS segment
FROM customer"""
)
def normalize_columns(spark, folder):
    messy = table(spark, folder, "customer").toDF(" C Cust-Key ", "Name (%)", "name", "Acct.Bal!", "__Segment__")
    return etl.rename_columns(messy)[0]


@query(
    """
SELECT p_partkey, trim('  ' || p_name || ' ', ' ') AS p_name, trim(p_brand || '   ', ' ') AS p_brand,
       trim(' ' || chr(9) || p_type || ' ', ' ') AS p_type
FROM part"""
)
def trim_strings(spark, folder):
    padded = table(spark, folder, "part").select(
        "p_partkey",
        F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("p_name"),
        F.concat("p_brand", F.lit("   ")).alias("p_brand"),
        F.concat(F.lit(" \t"), "p_type", F.lit(" ")).alias("p_type"),
    )
    return etl.trim_strings(padded)


@query(f"SELECT * FROM ({EVENTS_WITH_NULLS}) WHERE user_id IS NOT NULL AND value IS NOT NULL")
def drop_required_nulls(spark, folder):
    return etl.drop_missing_required(events_with_nulls(spark, folder), ["user_id", "value"])


@query(
    """
SELECT event_id, ts, user_id, event_type, value, props,
       CASE WHEN event_id % 2 = 0 THEN value END AS half
FROM events"""
)
def drop_high_null_columns(spark, folder):
    frame = table(spark, folder, "events").select(
        "*",
        F.when(F.col("event_id") % 2 == 0, F.col("value")).alias("half"),
        F.when(F.col("event_id") % 33 == 0, F.col("value")).alias("mostly_empty"),
        F.lit(None).cast("double").alias("empty"),
    )
    return etl.drop_columns(frame, etl.high_null_columns(frame, 0.95))


@query("SELECT DISTINCT * FROM (SELECT * FROM documents UNION ALL SELECT * FROM documents)")
def dedupe_all(spark, folder):
    documents = table(spark, folder, "documents")
    return etl.drop_duplicate_rows(documents.union(documents))


@query(
    """
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
             l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST,
             l_linestatus NULLS FIRST) AS place
  FROM lineitem)
WHERE place = 1"""
)
def dedupe_by_key(spark, folder):
    return etl.drop_duplicates_by_key(
        table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], order_by=["l_shipdate"]
    )


@query(
    """
SELECT * FROM orders
WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) < 1073741824"""
)
def hash_sample(spark, folder):
    return etl.hash_sample(table(spark, folder, "orders"), ["o_orderkey"], 0.25)


@query()
def bernoulli_sample(spark, folder):
    return etl.bernoulli_sample(table(spark, folder, "orders"), 0.25, seed=42)


@query(
    """
SELECT true AS only_given_rows, true AS no_repeats, true AS about_a_quarter, count(*) AS row_count FROM orders"""
)
def bernoulli_sample_laws(spark, folder):
    """What holds for every such sample: rows of the table, none twice, and a share within six standard deviations."""
    orders = table(spark, folder, "orders")
    sample = etl.bernoulli_sample(orders, 0.25, seed=42)
    drawn = sample.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("times"))
    counted = orders.join(drawn, "o_orderkey", "left").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("times").alias("found"), F.max("times").alias("most")
    )
    drawn_rows = sample.count()
    return counted.withColumn("drawn", F.lit(drawn_rows)).select(
        (F.col("found") == F.col("drawn")).alias("only_given_rows"),
        (F.col("most") == 1).alias("no_repeats"),
        (F.abs(F.col("drawn") - 0.25 * F.col("row_count")) <= 6 * F.sqrt(0.1875 * F.col("row_count"))).alias("about_a_quarter"),
        "row_count",
    )


@query(
    f"""
WITH e AS ({EVENTS_WITH_NULLS})
SELECT event_id, event_type, value, user_id FROM e
WHERE event_type IS NOT NULL AND value IS NOT NULL AND user_id IS NOT NULL"""
)
def project_matrix(spark, folder):
    return etl.project_features(
        events_with_nulls(spark, folder), ["event_type", "value"], "user_id", ["event_id"], drop_null=True
    )
