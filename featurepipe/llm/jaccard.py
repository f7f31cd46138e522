"""Exact Jaccard self-join on word shingles by a token-group matrix.

1. Every text becomes the set of its distinct shingle hashes. Equal sets are one from here on: a set is known by a
   64-bit signature together with its size.
2. Tokens are ordered from rare to frequent. Two sets that reach the threshold must share ``k`` of their first
   ``n - ceil(t * n) + k`` tokens in any common order, so only those enter the matrix (token, set); ``k`` grows with
   the set (one in ``SHARED_PART`` of its tokens), so a passage that two texts share does not make them candidates.
3. Grouping: sets that share tokens are compared with one leader each, and what is linked forms a group. Large groups
   are blocks of at most ``GROUP_SETS`` sets, so no task holds more. Near misses, which no link joins to a group, are grouped with
   the others of their leader too, in loose groups of about half as many; sets of a loose group are compared with each other.
4. Query-group overlap: the matrix, now by token and group, says which sets share enough tokens with a *foreign* group;
   sets whose sizes cannot fit are left out. Only those (set, group) pairs go on. Sets in no group ask first, and join the
   group that they find, so that many near misses of one origin do not have to ask each other.
5. A group is opened in one task: the union of its sets bounds the overlap of each query, and only where the bound
   reaches the threshold is the query compared with the members. All members of a group that links have formed are
   connected already, so the first link decides and pairs inside it need no comparison. A loose group gives all its links.
6. Components of all links, labelled with the smallest document id.

The order of tokens only matters for cost: tokens that occur ``FREQUENT`` times or more in some block of sets come
last, the most frequent at the very end (at most ``FREQUENT_TOKENS`` are told apart, others follow the hash). No
result depends on it. Nothing is capped: every candidate pair of sets in different groups is decided by its sets.

Null and empty texts have no shingles and are linked with nothing; a text with fewer words than a shingle is one
shingle. Repeated rows are members of their set. Rows with a null id get the id of their component, if any.
Two different sets of one size share a signature with probability 2**-64 for each pair of them. An empty table gives an empty result.
Very long texts are one set like others, held by one task at a time as 8 bytes a shingle. Columns other than the id and the text are
not read, so none can clash; ``drop_near_duplicates`` keeps them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.common import U64, WordHashes, as_text, blocks, documents, gives_back, map_blocks, plain_words, shingle_hashes
from featurepipe.llm.components import connected_components
from featurepipe.sources.staging import materialize

SHINGLE = 5
PERCENT = 80
GROUP_SETS = 256
FREQUENT = 3
FREQUENT_TOKENS = 200_000
SHARED_PART = 16
# Tokens of a task that are counted or compared together.
CHUNK_TOKENS = 1_500_000

SET = ["sig", "n"]


def token_set(text: str, size: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    return np.unique(shingle_hashes(known.of(plain_words(text)), size))


def signature(tokens: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def prefix_length(n: int, percent: int) -> int:
    return min(n, n - -(-percent * n // 100) + 1 + n // SHARED_PART)


def _least_shared(percent: int, n: str = "n"):
    """Tokens that the prefix of a set of ``n`` tokens shares at least with that of any set it is linked with."""
    return F.lit(1) + F.floor(F.ceil(F.col(n) * percent / 100) / SHARED_PART)


def _least_shared_by(percent: int, n: str, m: str):
    """The same for two sets of known sizes: the overlap that they need, less what may lie beyond the prefixes."""

    def beyond(size: str):
        size = F.col(size)
        prefix = size - F.ceil(size * percent / 100) + 1 + F.floor(size / SHARED_PART)
        return size - F.least(size, prefix)

    needed = F.ceil((F.col(n) + F.col(m)) * percent / (100 + percent))
    return needed - F.greatest(beyond(n), beyond(m))


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def _chunks(batches, shingle: int):
    """(ids, texts as token sets) in chunks of bounded size."""
    known = WordHashes()
    ids, sets, held = [], [], 0
    for batch in blocks(batches):
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            tokens = token_set(text, shingle, known)
            ids.append(doc)
            sets.append(tokens)
            held += len(tokens)
        if held >= CHUNK_TOKENS:
            yield ids, sets
            ids, sets, held = [], [], 0
    if ids:
        yield ids, sets


def _profile(docs: DataFrame, shingle: int) -> DataFrame:
    """A row (doc_id, sig, n) for each document, and rows (token, frequency) for frequent tokens of a chunk."""

    def run(batches):
        for ids, sets in _chunks(batches, shingle):
            sigs = [signature(s) for s in sets]
            nothing = [None] * len(ids)
            yield _typed(ids, sigs, [len(s) for s in sets], nothing, nothing)
            distinct = dict(zip(sigs, sets, strict=True)).values()
            tokens, counts = np.unique(np.concatenate(list(distinct)), return_counts=True)
            often = counts >= FREQUENT
            none = [None] * int(often.sum())
            yield _typed(none, none, none, tokens[often].astype(np.int64), counts[often])

    def _typed(*columns):
        names = ("doc_id", "sig", "n", "token", "frequency")
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    schema = "doc_id bigint, sig bigint, n bigint, token bigint, frequency bigint"
    return docs.mapInArrow(gives_back(run), schema)


def _frequent(profile: DataFrame) -> np.ndarray:
    """Frequent tokens, the most frequent last; at most FREQUENT_TOKENS of them."""
    counted = profile.where("token IS NOT NULL").groupBy("token").agg(F.sum("frequency").alias("f"))
    rows = counted.orderBy(F.desc("f"), "token").limit(FREQUENT_TOKENS).select("token").toArrow()
    return np.asarray(rows.column(0))[::-1].astype(U64)


def _prefixes(docs: DataFrame, frequent: np.ndarray, shingle: int, percent: int) -> DataFrame:
    """The matrix of rare tokens: (token, sig, n), each set once for a chunk."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        order = np.argsort(shared.value)
        values, places = shared.value[order], order
        for _, sets in _chunks(batches, shingle):
            distinct = {signature(s): s for s in sets if len(s)}
            flat = np.concatenate([*distinct.values(), np.empty(0, U64)])
            rank = np.zeros(len(flat), np.int32)
            if len(values):
                at = np.searchsorted(values, flat).astype(np.int32)
                at[at == len(values)] = 0
                known = values[at] == flat
                rank[known] = places[at[known]] + 1
            begin, tokens, sizes = 0, [], []
            for own in distinct.values():
                r = rank[begin : begin + len(own)]
                begin += len(own)
                take = prefix_length(len(own), percent)
                rare = own[r == 0][:take]
                if len(rare) < take:
                    often = np.flatnonzero(r)
                    rare = np.concatenate((rare, own[often[np.argsort(r[often])]][: take - len(rare)]))
                tokens.append(rare)
                sizes.append(len(rare))
            if tokens:
                yield _batch(
                    token=np.concatenate(tokens).astype(np.int64),
                    sig=np.repeat(np.fromiter(distinct, np.int64, len(distinct)), sizes),
                    n=np.repeat([len(s) for s in distinct.values()], sizes),
                )

    return docs.mapInArrow(gives_back(run), "token bigint, sig bigint, n bigint")


def _shared_tokens(prefixes: DataFrame) -> DataFrame:
    """The rows (token, sig, n) of tokens that several sets have."""

    def run(batches):
        held = None  # the last row, and whether an earlier set has its token too
        for batch in batches:
            token, sig, n = (np.asarray(c) for c in batch.columns)
            if held is not None:
                token, sig, n = (np.concatenate((p, c)) for p, c in zip(held[0], (token, sig, n), strict=True))
            if not len(token):
                continue
            same = (token[1:] == token[:-1]) & (sig[1:] == sig[:-1]) & (n[1:] == n[:-1])
            keep = np.concatenate(([True], ~same))
            token, sig, n = token[keep], sig[keep], n[keep]
            goes_on = np.concatenate(([held is not None and held[1]], token[1:] == token[:-1]))
            several = goes_on.copy()
            several[:-1] |= goes_on[1:]
            # The last row waits for the next batch: whether its token goes on is not known yet.
            several[-1] = False
            held = ((token[-1:], sig[-1:], n[-1:]), bool(goes_on[-1]))
            yield _batch(token=token[several], sig=sig[several], n=n[several])
        if held is not None and held[1]:
            yield _batch(**dict(zip(("token", *SET), held[0], strict=True)))

    dealt = prefixes.repartition("token").sortWithinPartitions("token", "sig", "n")
    return dealt.mapInArrow(gives_back(run), "token bigint, sig bigint, n bigint")


def _texts(docs: DataFrame, reps: DataFrame, shingle: int) -> DataFrame:
    """(sig, n, text) of the given sets, from one document each."""

    def run(batch):
        known = held[0] if held else WordHashes()
        held[:] = [known]
        texts = batch.column(3).to_pylist()
        sets = [token_set(t, shingle, known) for t in texts]
        sig, n = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        # Where several rows have one id, only those with the wanted set count.
        keep = [k for k, s in enumerate(sets) if len(s) == n[k] and signature(s) == sig[k]]
        return {"sig": [sig[k] for k in keep], "n": [n[k] for k in keep], "text": [texts[k] for k in keep]}

    held: list[WordHashes] = []
    keyed = docs.select(_key().alias("key"), "text")
    found = map_blocks(reps.select("key", *SET).join(keyed, "key"), run, "sig bigint, n bigint, text string")
    return found.dropDuplicates(SET)


def _key():
    return F.coalesce("doc_id", F.xxhash64("text"))


def _fits(percent: int, n: str, m: str):
    return (100 * F.least(n, m) >= percent * F.greatest(n, m))


def _compare(rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Open blocks of rows (group_sig, group_n, block, role, sig, n, text): role 0 members, role 1 queries, role 2 members as queries.

    Gives a link (a_sig, a_n, b_sig, b_n) for each query that reaches the threshold with a member; in a loose group (its
    ``group_n`` is negative) with each such member. Members as queries ask those of smaller signature only.
    """

    def run(batches):
        known = WordHashes()
        current, members, union, least = None, [], None, 0
        for batch in blocks(batches):
            links = []
            columns = [c.to_pylist() for c in batch.columns]
            for group_sig, group_n, block, role, sig, n, text in zip(*columns, strict=True):
                if current != (group_sig, group_n, block):
                    current, members, union = (group_sig, group_n, block), [], None
                tokens = token_set(text, shingle, known)
                if role == 0:
                    members.append((tokens, sig, n))
                    continue
                if union is None and members:
                    union = np.unique(np.concatenate([m[0] for m in members]))
                    least = min(m[2] for m in members)
                if not members or not _may(_overlap(union, tokens), n, least, percent):
                    continue
                for other, other_sig, other_n in members:
                    if role == 2 and (other_sig, other_n) >= (sig, n):
                        continue
                    if 100 * min(n, other_n) < percent * max(n, other_n):
                        continue
                    if _may(_overlap(other, tokens), n, other_n, percent):
                        links.append((sig, n, other_sig, other_n))
                        if group_n >= 0:
                            break
            if links:
                yield _batch(**dict(zip(("a_sig", "a_n", "b_sig", "b_n"), map(list, zip(*links, strict=True)), strict=True)))

    dealt = rows.repartition("group_sig", "group_n", "block").sortWithinPartitions("group_sig", "group_n", "block", "role")
    columns = dealt.select("group_sig", "group_n", "block", "role", "sig", "n", "text")
    return columns.mapInArrow(gives_back(run), "a_sig bigint, a_n bigint, b_sig bigint, b_n bigint")


def _overlap(one: np.ndarray, other: np.ndarray) -> int:
    if not len(one):
        return 0
    at = np.searchsorted(one, other)
    at[at == len(one)] = 0
    return int((one[at] == other).sum())


def _may(overlap: int, n: int, m: int, percent: int) -> bool:
    return 100 * overlap >= percent * (n + m - overlap)


def _blocks(count: str):
    return F.ceil(F.col(count) / GROUP_SETS).cast("bigint")


def _leaders(rows: DataFrame, percent: int) -> DataFrame:
    """(sig, n, group_sig, group_n): for each set the leader that it shares most tokens with.

    The leader of a token is the set that shares the largest part of its prefix, as the origin of many copies does.
    """
    central = F.struct("central", *SET)
    leaders = rows.groupBy("token").agg(F.max(central).alias("lead")).select(
        "token", F.col("lead.sig").alias("lead_sig"), F.col("lead.n").alias("lead_n")
    )
    return (
        rows.join(leaders, "token")
        .where("sig != lead_sig OR n != lead_n")
        .where(_fits(percent, "n", "lead_n"))
        .groupBy("sig", "n", "lead_sig", "lead_n")
        .agg(F.count("*").alias("votes"))
        .where(F.col("votes") >= _least_shared(percent))
        .groupBy("sig", "n")
        .agg(F.max(F.struct("votes", "lead_sig", "lead_n")).alias("best"))
        .select("sig", "n", F.col("best.lead_sig").alias("group_sig"), F.col("best.lead_n").alias("group_n"))
    )


def _leader_links(chosen: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links of sets with the leaders that they have chosen."""
    size = chosen.groupBy("group_sig", "group_n").agg(F.count("*").alias("members"))
    size = size.withColumn("blocks", _blocks("members"))
    leaders = (
        size.select("group_sig", "group_n", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        .join(texts.select(F.col("sig").alias("group_sig"), F.col("n").alias("group_n"), "text"), ["group_sig", "group_n"])
        .withColumns({"role": F.lit(0), "sig": F.col("group_sig"), "n": F.col("group_n")})
    )
    members = (
        chosen.join(size, ["group_sig", "group_n"])
        .withColumns({"block": F.pmod(F.xxhash64("sig", "n"), F.col("blocks")), "role": F.lit(1)})
        .drop("members", "blocks")
        .join(texts, SET)
    )
    return _compare(leaders.unionByName(members), shingle, percent)


def _groups(near: DataFrame) -> DataFrame:
    """(sig, n, group_sig, group_n) of linked sets: the leader, or the leader that the leader itself is linked with.

    Whatever is in a group is connected by links, which is all that a group needs.
    """
    step = near.select(
        F.col("a_sig").alias("sig"), F.col("a_n").alias("n"), F.col("b_sig").alias("group_sig"), F.col("b_n").alias("group_n")
    )
    above = step.toDF("group_sig", "group_n", "top_sig", "top_n")
    return step.join(above, ["group_sig", "group_n"], "left").select(
        *SET, F.coalesce("top_sig", "group_sig").alias("group_sig"), F.coalesce("top_n", "group_n").alias("group_n")
    )


def _joined(links: DataFrame, groups: DataFrame) -> DataFrame:
    """Sets that a link has joined to a group, each with one such group."""
    others = groups.select(F.col("sig").alias("b_sig"), F.col("n").alias("b_n"), "group_sig", "group_n")
    found = links.join(others, ["b_sig", "b_n"], "left").select(
        F.col("a_sig").alias("sig"),
        F.col("a_n").alias("n"),
        # A leader has no row of its own: it is the group.
        F.struct(F.coalesce("group_sig", "b_sig").alias("group_sig"), F.coalesce("group_n", "b_n").alias("group_n")).alias("group"),
    )
    return found.groupBy(*SET).agg(F.min("group").alias("group")).select(*SET, "group.group_sig", "group.group_n")


def _loose_groups(chosen: DataFrame, groups: DataFrame) -> DataFrame:
    """(sig, n, group_sig, group_n) of near misses: sets in no group, with those that have chosen the same leader.

    Many of them are dealt over several groups, whose sizes are about half of ``GROUP_SETS``.
    """
    placed = groups.select(*SET).unionByName(groups.select(F.col("group_sig").alias("sig"), F.col("group_n").alias("n")))
    missed = chosen.join(placed.distinct(), SET, "left_anti")
    size = missed.groupBy("group_sig", "group_n").agg(F.count("*").alias("members")).where("members > 1")
    deal = F.pmod(F.xxhash64("n", "sig"), F.ceil(2 * F.col("members") / GROUP_SETS))
    # A size below zero marks a loose group, and no set has one.
    return missed.join(size, ["group_sig", "group_n"]).select(
        *SET, F.xxhash64("group_sig", "group_n", deal).alias("group_sig"), (-F.col("group_n")).alias("group_n")
    )


def _loose_links(loose: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links inside loose groups."""
    members = loose.join(texts, SET).withColumn("block", F.lit(0).cast("bigint"))
    roles = F.explode(F.array(F.lit(0), F.lit(2)))
    return _compare(members.withColumn("role", roles), shingle, percent)


def _foreign_links(
    matrix: DataFrame, texts: DataFrame, groups: DataFrame, shingle: int, percent: int, alone: bool
) -> DataFrame:
    """Links between sets of different groups.

    ``alone`` lets only sets that are in no group ask, and only groups of several be asked; else all groups ask each other.
    """
    own = (
        texts.select(*SET)
        .join(groups, SET, "left")
        .select(*SET, F.coalesce("group_sig", "sig").alias("group_sig"), F.coalesce("group_n", "n").alias("group_n"))
    )
    sizes = own.groupBy("group_sig", "group_n").agg(F.count("*").alias("members"))
    own = materialize(own.join(sizes, ["group_sig", "group_n"]), "groups")
    rows = matrix.select("token", *SET).join(own, SET)
    by_group = rows.groupBy("token", "group_sig", "group_n", "members").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    several = by_group.groupBy("token").agg(F.count("*").alias("groups")).where("groups > 1").select("token")
    by_group = by_group.join(several, "token")
    queries = rows.join(several, "token")
    if alone:
        by_group, queries = by_group.where("members > 1"), queries.where("members = 1")
    other = by_group.select("token", "low", "high", *(F.col(c).alias(f"of_{c}") for c in ("group_sig", "group_n", "members")))
    # One side of two groups asks the other: that of the smaller group.
    asks = queries.join(other, "token").where(
        F.struct("members", "group_sig", "group_n") < F.struct("of_members", "of_group_sig", "of_group_n")
    ).where((100 * F.col("high") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("low")))
    asks = asks.groupBy(*SET, "of_group_sig", "of_group_n", "of_members").agg(
        F.count("*").alias("shared"), F.max("high").alias("of_n")
    )
    # The size of a group of one is known, which raises the bound.
    least = F.when(F.col("of_members") == 1, _least_shared_by(percent, "n", "of_n")).otherwise(0)
    asks = asks.where(F.col("shared") >= F.greatest(_least_shared(percent), least))
    asks = materialize(
        asks.select(
            *SET,
            F.col("of_group_sig").alias("group_sig"),
            F.col("of_group_n").alias("group_n"),
            F.when(F.col("of_group_n") < 0, 1).otherwise(_blocks("of_members")).alias("blocks"),
        ),
        "group-queries",
    )
    opened = asks.select("group_sig", "group_n", "blocks").distinct()
    members = (
        own.drop("members")
        .join(opened, ["group_sig", "group_n"])
        .withColumns({"block": F.pmod(F.xxhash64("sig", "n"), F.col("blocks")), "role": F.lit(0)})
        .drop("blocks")
        .join(texts, SET)
    )
    asking = (
        asks.withColumns({"block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "role": F.lit(1)})
        .drop("blocks")
        .join(texts, SET)
    )
    return _compare(members.unionByName(asking), shingle, percent)


def similar_components(
    frame: DataFrame,
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row.

    Two documents are linked when 100 * intersection >= percent * union of their shingle sets.
    """
    docs = documents(frame, id_column, text_column)
    profile = materialize(_profile(docs, shingle), "set-profile")
    rows = profile.where("sig IS NOT NULL")
    frequent = _frequent(profile)
    matrix = materialize(_shared_tokens(_prefixes(docs, frequent, shingle, percent)), "token-matrix")
    # A set that shares fewer tokens with all others together than it must with one is linked with none.
    counts = matrix.groupBy(*SET).agg(F.count("*").alias("shared")).where(F.col("shared") >= _least_shared(percent))
    found = materialize(counts, "shared-tokens")
    matrix = materialize(
        matrix.join(found, SET).select("token", *SET, (F.col("shared") / (F.col("n") + 16)).alias("central")), "token-matrix"
    )
    found = found.select(*SET)
    # Rows with a null id stand for their set only if no other row does; their key is the hash of their text.
    named = rows.where("doc_id IS NOT NULL").groupBy(*SET).agg(F.min("doc_id").alias("key"))
    unnamed = documents(frame, id_column, text_column).where("doc_id IS NULL")
    reps = found.join(named, SET, "left")
    if unnamed.limit(1).count():
        hashed = _unnamed_keys(unnamed, shingle)
        reps = reps.join(hashed, SET, "left").select(*SET, F.coalesce("key", "text_key").alias("key"))
    texts = materialize(_texts(docs, reps, shingle), "set-texts")
    chosen = materialize(_leaders(matrix, percent), "leaders")
    near = materialize(_leader_links(chosen, texts, shingle, percent), "leader-links")
    groups = _groups(near)
    joined = materialize(_foreign_links(matrix, texts, groups, shingle, percent, alone=True), "joined-links")
    groups = materialize(groups.unionByName(_joined(joined, groups)), "groups")
    loose = materialize(_loose_groups(chosen, groups), "loose-groups")
    inner = materialize(_loose_links(loose, texts, shingle, percent), "loose-links")
    far = _foreign_links(matrix, texts, groups.unionByName(loose), shingle, percent, alone=False)
    far = materialize(far, "foreign-links")
    roots = connected_components(_nodes(near.unionByName(joined).unionByName(inner).unionByName(far)))
    first = rows.groupBy(*SET).agg(F.min("doc_id").alias("first"))
    linked = (
        roots.select("root", F.col("node.sig").alias("sig"), F.col("node.n").alias("n"))
        .join(first, SET)
        .select(*SET, "root", "first")
    )
    named_roots = linked.groupBy("root").agg(F.min("first").alias("component"))
    by_set = linked.join(named_roots, "root").select(*SET, "component")
    labels = first.join(by_set, SET, "left").select(*SET, F.coalesce("component", "first").alias("component"))
    full = rows.select("doc_id", *SET).join(labels, SET, "left")
    return full.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
    )


def _unnamed_keys(unnamed: DataFrame, shingle: int) -> DataFrame:
    def run(batch):
        known = WordHashes()
        sets = [token_set(t, shingle, known) for t in batch.column(1).to_pylist()]
        return {"sig": [signature(s) for s in sets], "n": [len(s) for s in sets], "text_key": batch.column(0)}

    keyed = unnamed.select(F.xxhash64("text").alias("text_key"), "text")
    return map_blocks(keyed, run, "sig bigint, n bigint, text_key bigint").groupBy(*SET).agg(F.min("text_key").alias("text_key"))


def _nodes(links: DataFrame) -> DataFrame:
    return links.select(
        F.struct(F.col("a_sig").alias("sig"), F.col("a_n").alias("n")).alias("a"),
        F.struct(F.col("b_sig").alias("sig"), F.col("b_n").alias("n")).alias("b"),
    )


def drop_near_duplicates(frame: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows, with all their columns, of which one stays for each component: that of the smallest id.

    Repeated rows with one id are one document and stay once. Rows with one id and different texts are different documents.
    All rows with a null id stay, and all texts without words.
    """
    texts = documents(frame).select("doc_id", F.xxhash64("text").alias("text")).where("doc_id IS NOT NULL")
    several = texts.groupBy("doc_id").agg(F.min("text").alias("least"), F.max("text").alias("most")).where("least != most")
    if several.limit(1).count():
        return _drop_by_text(frame, shingle, percent)
    found = materialize(similar_components(frame, shingle, percent), "components")
    leave = found.where("component_id != doc_id").select(F.col("doc_id").alias("_leaves")).distinct()
    kept = frame.join(leave, F.col("doc_id") == F.col("_leaves"), "left_anti")
    ids = found.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("rows"))
    repeated = ids.where("rows > 1").limit(1).count()
    if not repeated:
        return kept
    # Rare, and the only case in which whole rows have to be compared.
    return kept.where("doc_id IS NOT NULL").dropDuplicates().unionByName(kept.where("doc_id IS NULL"))


def _drop_by_text(frame: DataFrame, shingle: int, percent: int) -> DataFrame:
    """As ``drop_near_duplicates``, where an id has several texts: each (id, text) is a document, the smallest of a component stays."""
    own = F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.col("doc_id").cast("bigint"), as_text("text")))
    keyed = frame.withColumn("_own", own)
    found = materialize(similar_components(keyed, shingle, percent, id_column="_own"), "components")
    names = keyed.where("_own IS NOT NULL").select(F.col("_own").alias("doc_id"), F.col("doc_id").alias("name")).distinct()
    members = materialize(found.where("doc_id IS NOT NULL").select("doc_id", "component_id").distinct().join(names, "doc_id"), "members")
    stay = members.groupBy("component_id").agg(F.min(F.struct("name", "doc_id"))["doc_id"].alias("stays"))
    leave = members.join(stay, "component_id").where("doc_id != stays").select(F.col("doc_id").alias("_leaves"))
    kept = keyed.join(leave, F.col("_own") == F.col("_leaves"), "left_anti").drop("_own")
    return kept.where("doc_id IS NOT NULL").dropDuplicates().unionByName(kept.where("doc_id IS NULL"))
