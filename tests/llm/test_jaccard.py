"""The Jaccard join against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from featurepipe.llm import jaccard
from featurepipe.llm.components import connected_components
from featurepipe.llm.queries import QUERIES


def brute(rows, size, percent):
    """{(id, text): (shingles, component)} by comparing all sets that share a shingle."""
    sets = []
    for _, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for space in "\t\n\v\f\r":
            lowered = lowered.replace(space, " ")
        words = [w for w in lowered.split(" ") if w]
        k = min(size, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if k else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    where = {}
    for i, s in enumerate(sets):
        for t in s:
            where.setdefault(t, []).append(i)
    pairs = {(a, b) for own in where.values() for k, a in enumerate(own) for b in own[k + 1 :]}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(len(s), least.get(find(i))) for i, s in enumerate(sets)]


def made_up():
    chance = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    texts = ["", None, "one", "One", "two words", "a b c d", "A\tb  c\nd", "a b c d e", " \t\n", "é É x y z"]
    line = [chance.choice(words) for _ in range(30)]
    for _ in range(25):
        base = [chance.choice(words) for _ in range(chance.choice([5, 8, 20, 40, 120]))]
        if chance.random() < 0.5:
            base = line + base
        texts += [" ".join(base)] * chance.choice([1, 1, 3])
        for _ in range(chance.randrange(8)):
            own = list(base)
            for _ in range(chance.randrange(1, 5)):
                own[chance.randrange(len(own))] = chance.choice(words)
            texts.append(" ".join(own))
            base = chance.choice([base, own])  # chains of copies
    texts.append(" ".join(chance.choice(words) for _ in range(60000)))
    return texts


@pytest.mark.parametrize(("size", "percent", "group"), [(4, 85, 256), (5, 80, 256), (2, 60, 3)])
def test_equals_all_pairs(spark, docs_of, monkeypatch, size, percent, group):
    monkeypatch.setattr(jaccard, "GROUP_SETS", group)
    rows = list(enumerate(made_up()))
    rows += [rows[20], (None, rows[30][1]), (None, "only here without an id"), (7, "second text of one id")]
    frame = docs_of(rows, parts=3).withColumns({"sig": F.lit("clash"), "n": F.lit(0)})
    got = sorted(
        ((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.similar_components(frame, size, percent).collect()),
        key=str,
    )
    expected = brute(rows, size, percent)
    wanted = sorted(((doc, n, doc if n == 0 else c) for (doc, _), (n, c) in zip(rows, expected, strict=True)), key=str)
    assert got == wanted


@pytest.mark.parametrize("group", [256, 12])
def test_near_misses_of_one_origin(docs_of, monkeypatch, group):
    """Many near misses of one text, of which some are linked with each other, in one loose group or several."""
    monkeypatch.setattr(jaccard, "GROUP_SETS", group)
    chance = random.Random(9)
    origin = [f"o{k}" for k in range(60)]
    edits = [[(chance.randrange(60), f"e{e}_{k}") for k in range(chance.choice([2, 3, 4]))] for e in range(25)]
    docs = [" ".join(origin)]
    for _ in range(150):
        own = list(origin)
        for place, word in sum(chance.sample(edits, 2), []):
            own[place] = word
        if chance.random() < 0.5:
            own[chance.randrange(60)] = f"x{len(docs)}"
        docs.append(" ".join(own[: chance.choice([60, 60, 50])]))
    rows = list(enumerate(docs))
    sizes, loose_links = [], jaccard._loose_links
    monkeypatch.setattr(jaccard, "_loose_links", lambda loose, *more: sizes.append(loose.count()) or loose_links(loose, *more))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_components(docs_of(rows, parts=3), 4, 85).collect()}
    assert got == dict(enumerate(brute(rows, 4, 85)))
    assert sizes[0] > 20 and len({c for _, c in got.values()}) < len(got)


def test_empty_table_and_drop(docs_of):
    frame = docs_of(["a b c d e f g h i j k l", "a b c d e f g h i j k l", "", "", None, "x"]).withColumn("token", F.lit(1))
    assert jaccard.similar_components(frame.limit(0)).count() == 0
    kept = jaccard.drop_near_duplicates(frame)
    assert kept.columns == frame.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3, 4, 5]


def test_drop_decides_for_each_text_of_an_id(docs_of):
    one, two = (" ".join(f"{c}{k}" for k in range(30)) for c in "ab")
    rows = [(3, two), (5, one), (5, two + " more"), (9, one), (9, one), (12, "c d e f g h i"), (12, "k l m n o p"), (None, one)]
    kept = jaccard.drop_near_duplicates(docs_of(rows)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == [(0, one), (3, two), (5, one), (12, "c d e f g h i"), (12, "k l m n o p")]


def test_components(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (7, 7), (102, 100)], "a int, b int")
    got = {r["node"]: r["root"] for r in connected_components(links).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102), 100)}


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op1_ngram_jaccard"](spark, folder).collect()}
    assert got == {doc: own for (doc, _), own in zip(docs, brute(docs, 4, 85), strict=True)}
    assert len({c for _, c in got.values()}) < len(got)
