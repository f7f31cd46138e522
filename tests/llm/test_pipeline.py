"""The pipeline against plain Python on the smallest table, and on rows with nulls, ties and other columns."""

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from featurepipe.llm import bpe, secrets, toxicity
from test_jaccard import brute as brute_components
from test_maps import brute_contamination


def test_stages_equal_plain_python(spark):
    sf = "/root/testdata/sf0.01"
    source = spark.read.parquet(f"{sf}/documents.parquet")
    model = toxicity.fit(source, spark.read.parquet(f"{sf}/labels.parquet"))
    docs = sorted((r["doc_id"], r["text"]) for r in source.collect())
    scores = model.scores([t for _, t in docs])
    kept = [row for row, s in zip(docs, scores, strict=True) if s < 0.5]
    assert 0 < len(kept) < len(docs)
    kept = [row for row, (_, root) in zip(kept, brute_components(kept, 5, 80), strict=True) if root == row[0]]
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    kept = [(doc, text) for doc, text in kept if not brute_contamination(text, items)[1]]
    scanner = secrets.Scanner(secrets.RULES)
    kinds = [rule.kind for rule in secrets.RULES]
    clean = {doc: secrets._masked(text, scanner.scan([text])[0], kinds) for doc, text in kept}
    assert any(clean[doc] != text for doc, text in kept)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: list(r["token_ids"]) for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == {doc: library.encode_ordinary(text) for doc, text in clean.items()}


def test_odd_rows_and_columns(spark, tmp_path):
    base = " ".join(f"word{k}" for k in range(40))
    rows = [(1, base, "en", 1), (2, base, None, 2), (2, base, None, 2), (None, base, "x", 3), (4, None, None, None), (5, "", "de", 0)]
    rows += [(6, "my token=abcdefgh12 here", "en", 5), (7, "word " * 30000, "en", 7), (8, "b a n k " * 3, "en", 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_chars bigint").withColumns(
        {"sig": F.lit(1), "score": F.lit("s"), "ids": F.lit("i"), "item_id": F.lit(0)}
    )
    spark.createDataFrame([(1, 0)], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "b a n k"), (2, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    own, empty = docs, docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        own, empty = stage(spark, own, str(tmp_path)), stage(spark, empty, str(tmp_path))
        assert empty.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert own.columns == docs.columns
        if name == "secrets":
            assert {r["doc_id"]: r["text"] for r in own.collect()}[6] == "my <assign> here"
    assert sorted((r["doc_id"] or 0) for r in own.collect()) == [0, 1, 4, 5, 6, 7]


def test_a_task_of_the_last_stage_holds_one_worker(spark):
    rows = [(1, "one two"), (2, None), (None, ""), (3, "a" * 3000), (3, "\u00e9 \U0001f600 x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    tokens = corpus_pipeline.tokenize(spark, docs, "")
    assert tokens._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    two_steps = bpe.id_arrays(bpe.encode(docs, path, public_tokenizers.PATTERN))
    assert tokens.schema == two_steps.schema and sorted(map(str, tokens.collect())) == sorted(map(str, two_steps.collect()))


def test_registered():
    names = set(__spark_entry__.LLM_QUERIES)
    assert names >= {"pipeline"} and {n.split("_")[0] for n in names - {"pipeline"}} == {f"op{k}" for k in range(1, 14)}
    assert set(__spark_entry__.queries()) >= names
