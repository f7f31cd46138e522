"""Positive-unlabelled learning: quality on rows it never saw, and edge cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurepipe.llm import toxicity
from featurepipe.llm.queries import QUERIES


def test_held_out_quality(spark):
    """Held-out rows of the middle table; a fifth of the labels is never learnt from."""
    folder = "/root/testdata/sf0.1"
    rows = QUERIES["op6_toxicity"](spark, folder).collect()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.5)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    caught = sum(p for p, t in held if t) / sum(t for _, t in held)
    wrong = sum(p for p, t in held if not t) / sum(1 - t for _, t in held)
    assert caught >= 0.8 and wrong <= 0.01


def test_edge_rows(spark):
    texts = ["bad nasty word"] * 30 + ["good plain words"] * 200 + ["", None, "bad " * 50000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("score", F.lit("x"))
    labels = spark.createDataFrame([(k, 1) for k in range(30)] + [(40, 0), (41, None), (None, 1)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels, prior=0.15)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs.union(docs.where("doc_id = 0")), model).collect()}
    assert scores[0] > 0.5 > scores[100] and scores[230] == scores[231]
    assert toxicity.score(docs.limit(0), model).count() == 0
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.where("doc_id = 0").count() == 0 and kept.where("doc_id = 100").count() == 1
    empty = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score(docs, empty).agg(F.max("score")).first()[0] < 0.01


def test_risk_needs_no_negatives():
    chance = np.random.default_rng(1)
    clean = [np.unique(chance.integers(0, 500, 40)).astype(np.int32) for _ in range(2000)]
    bad = [np.append(r, chance.integers(600, 603)).astype(np.int32) for r in clean[:400]]
    model = toxicity.fit_arrays(bad[:200], bad[200:] + clean[400:], prior=0.1)
    margin = [model.weights[r].sum() + model.intercept for r in bad[200:]]
    assert np.mean(np.array(margin) > 0) > 0.95
    assert np.mean([model.weights[r].sum() + model.intercept > 0 for r in clean[400:]]) < 0.02


@pytest.mark.parametrize("text", ["", "a", "é ü", "word " * 10])
def test_features_are_distinct(text):
    found = toxicity.features(text)
    assert len(found) == len(set(found.tolist()))
