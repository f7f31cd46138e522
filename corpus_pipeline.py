"""The corpus pipeline: five stages, each of which works on what the one before has kept.

Each stage is written as Parquet under the shared folder and read again. ``run`` gives the rows of the last stage. What a stage
staged for itself, and the table it read, are deleted once its own table is written.

Null and empty texts are kept by every stage and have no tokens. Rows with equal id and text are one document from the second
stage on, which keeps one row of each group; rows with a null id stay. Texts of any length are handled whole. Columns besides
those of documents pass through all stages but the last. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from featurepipe.llm import bpe, decontaminate, jaccard, secrets, toxicity
from featurepipe.sources.staging import delete, staging_uri, temporary_tables


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents that the classifier, learnt from the labelled rows among them, calls toxic."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.drop_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that of the smallest id, of each group linked by five-word shingles at 0.8."""
    return jaccard.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents in which a window of a benchmark item occurs."""
    return decontaminate.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep all documents; every secret is replaced by its kind, and ``n_chars`` is counted anew."""
    from pyspark.sql import functions as F

    masked = secrets.mask_secrets(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast("bigint"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every remaining document."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_arrays(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("byte_bpe", tokenize),
]

# Learning a classifier and grouping near copies cannot be expressed in SQL; a test compares with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        uri = staging_uri(spark, name)
        with temporary_tables(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(uri)
        docs = spark.read.schema(kept.schema).parquet(uri)
        if before:
            delete(spark, before)
        before = uri
    return STAGES[-1][1](spark, docs, sf_dir)
