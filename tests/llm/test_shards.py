"""The law of the shards: near-equal bytes, gapless slots, copies together."""

import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from featurepipe.llm import kd_shards
from featurepipe.llm.queries import QUERIES


def check(rows, texts, shards, slack):
    assert len(rows) == len(texts)
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert set(slots) <= set(range(shards))
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    even = sum(sizes.values()) / shards
    assert max(sizes.values()) - min(sizes.get(k, 0) for k in range(shards)) <= slack * even
    return sizes


def test_query(spark):
    folder = "/root/testdata/sf0.1"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op9_kd_shards"](spark, folder).collect()
    homes = defaultdict(set)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        homes[raw].add(r["shard"])
    check(rows, texts, 16, 0.1)
    assert max(map(len, homes.values())) == 1


@pytest.mark.parametrize("kind", ["ties", "hot", "lengths"])
def test_skewed_tables(spark, kind):
    chance = random.Random(4)
    texts = {
        "ties": ["same text"] * 640,
        "hot": ["hot text " * 20] * 1000 + [chance.choice("abc") * chance.randrange(400) for _ in range(1000)],
        "lengths": ["x" * int(chance.paretovariate(1.2) * 10) for _ in range(3000)],
    }[kind]
    texts = [t[:5000] for t in texts]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4).withColumn("node", F.lit("x"))
    check(kd_shards.kd_shards(frame, shards=8).collect(), texts, 8, 0.15)


def test_edges(spark):
    rows = [(1, ""), (1, None), (None, "x"), (None, "x"), (5, "y" * 300_000)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = kd_shards.kd_shards(frame, shards=4).collect()
    assert sorted(r["size"] for r in got) == [1, 1, 2, 2, 300_001]
    check(got, rows, 4, 8)
    assert kd_shards.kd_shards(frame.limit(0), shards=4).count() == 0
    small = spark.createDataFrame([(k, "z" * 99) for k in range(80)], "doc_id bigint, text string")
    by_size = kd_shards.kd_shards(small, target_bytes=1000).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    assert len(by_size) == 8 and max(r["s"] for r in by_size) <= 1200
