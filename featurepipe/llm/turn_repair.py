"""Repair of the turn structure of conversations at the least cost, by bidirectional Dijkstra over the edit lattice.

A repaired conversation has an optional system turn and then user and assistant turns in turn, or no turn at all. A row is
kept, given the role that is due, or deleted; empty turns can be put in anywhere. The lattice has a node for every (rows
read, role state). A forward and a reverse heap grow until no crossing of equal or lower cost is left; among all cheapest
ways the least audit (the initials of the edits) is read off, letter by letter, over the nodes that lie on one.

Rows are ordered by (turn, role, text), nulls first. Equal rows are counted together before they are dealt out, then the whole
table is cut by ranges of the order, so a conversation may lie in any number of tasks. Where one lies in several tasks
or is longer than a piece, each piece gives its cost and the order of its audits for every pair of states, a lattice over
pieces chooses the states at the cuts, and the pieces are repaired between these. A task holds one piece.

Faults: *blank* (no character but white space), *duplicate* (role and text occurred earlier in the conversation), *truncated*
(the last visible character ends no sentence); the first that holds counts.

Null roles and texts are one space (so such a text is blank). Null turns come first and count for no gap. Rows of a null
conversation are one conversation. Repeated rows are duplicates. An empty table gives an empty result. Texts of any length are one
row each and never cut. Columns other than these four (and ``copies``) are not kept, so none can clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from heapq import heappop, heappush
from itertools import pairwise

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.common import _parsed, arrow_schema
from featurepipe.sources.staging import materialize

# Rows and bytes of text of one piece of a conversation (a longer text is a piece of its own).
PIECE_ROWS = 4096
PIECE_BYTES = 8 << 20
# Answers for short row patterns that a task remembers, and the longest such pattern.
KEPT_ANSWERS, KEPT_PATTERN = 20_000, 40
# Characters of a text that take part in choosing the cuts of the table; the order itself uses whole texts.
CUT_CHARACTERS = 64

WHITE = " \t\n\v\f\r"
SENTENCE_ENDS = ".!?"
# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
FINAL = (NOTHING, ASSISTANT)
# The role that an inserted or re-roled turn takes in each state, and the state it leads to.
DUE = ("user", "user", "assistant", "user")
AFTER_DUE = (USER, USER, ASSISTANT, USER)
KEPT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL = {"su", "ua", "au"}

Edge = tuple[object, int, int]  # letter, cost, state


@dataclass(frozen=True)
class EditCosts:
    rerole: int = 2
    delete: int = 3
    insert: int = 2
    truncated: int = 1


class Steps:
    """The edges over one row, from and to each state."""

    def __init__(self, edges: Iterable[tuple[int, object, int, int]]):
        self.ahead: list[list[Edge]] = [[] for _ in STATES]
        self.back: list[list[Edge]] = [[] for _ in STATES]
        for state, letter, cost, following in edges:
            self.ahead[state].append((letter, cost, following))
            self.back[following].append((letter, cost, state))


def row_steps(initial: str, forced: int, truncated: bool, costs: EditCosts) -> Steps:
    """Edges over a row; ``forced`` above 0 are so many rows that must go."""
    if forced:
        return Steps((q, "D", costs.delete * forced, q) for q in STATES)
    more = costs.truncated * truncated
    edges = [(q, "D", costs.delete, q) for q in STATES]
    edges += [(q, "R", costs.rerole + more, AFTER_DUE[q]) for q in STATES]
    edges += [(q, "K", more, KEPT[q, initial]) for q in STATES if (q, initial) in KEPT]
    return Steps(edges)


def least_path(steps: list[Steps], start: int, goals: Iterable[int], inserts: Steps | None, to_end: bool) -> tuple[int, list] | None:
    """Cost and letters of the cheapest way from ``start`` before the first step to one of ``goals`` after the last.

    Of equal costs, the least sequence of letters. ``inserts`` are edges between the states of one layer, allowed
    before each step and, with ``to_end``, after the last one. None where no way exists.
    """
    last = len(steps)

    def ahead(node):
        layer, state = node
        if inserts and (layer < last or to_end):
            for letter, cost, following in inserts.ahead[state]:
                yield letter, cost, (layer, following)
        if layer < last:
            for letter, cost, following in steps[layer].ahead[state]:
                yield letter, cost, (layer + 1, following)

    def back(node):
        layer, state = node
        if inserts and (layer < last or to_end):
            for letter, cost, before in inserts.back[state]:
                yield letter, cost, (layer, before)
        if layer:
            for letter, cost, before in steps[layer - 1].back[state]:
                yield letter, cost, (layer - 1, before)

    reached = ({(0, start): 0}, {(last, goal): 0 for goal in goals})
    settled: tuple[dict, dict] = ({}, {})
    heaps = tuple([(0, node) for node in side] for side in reached)
    edges = (ahead, back)
    best = min((0 for node in reached[0] if node in reached[1]), default=None)
    while heaps[0] and heaps[1]:
        # Crossings of equal cost are finished too, for the sake of their letters.
        if best is not None and heaps[0][0][0] + heaps[1][0][0] > best:
            break
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        cost, node = heappop(heaps[side])
        if node in settled[side]:
            continue
        settled[side][node] = cost
        for _, more, other in edges[side](node):
            total = cost + more
            if total < reached[side].get(other, total + 1):
                reached[side][other] = total
                heappush(heaps[side], (total, other))
                if other in reached[1 - side] and (best is None or total + reached[1 - side][other] < best):
                    best = total + reached[1 - side][other]
    if best is None:
        return None
    return best, _least_letters(ahead, settled[0], reached[1], (0, start), best)


def _least_letters(ahead: Callable, forward: dict, reverse: dict, node: tuple[int, int], best: int) -> list:
    """The least letters of a cheapest way. Every node of such a way is settled forward, or from the other side.

    ``reverse`` holds costs of ways to the end, perhaps not the least; those that make up ``best`` are.
    """
    leads: set[tuple[int, int]] = set()

    def leads_on(node, spent) -> bool:
        if node in reverse and spent + reverse[node] == best:
            return True
        return node in leads and forward[node] == spent

    for node_before in sorted(forward, key=lambda n: (-n[0], -forward[n])):
        spent = forward[node_before]
        if any(leads_on(following, spent + cost) for _, cost, following in ahead(node_before)):
            leads.add(node_before)
    letters, spent = [], 0
    while True:
        on_the_way = [edge for edge in ahead(node) if leads_on(edge[2], spent + edge[1])]
        if not on_the_way:
            return letters
        letter, cost, node = min(on_the_way, key=lambda edge: edge[0])
        letters.append(letter)
        spent += cost


class Row(tuple):
    """turn, role, text, copies."""

    __slots__ = ()
    turn = property(lambda self: self[0])
    role = property(lambda self: self[1])
    text = property(lambda self: self[2])
    copies = property(lambda self: self[3])


def row_key(conversation: int | None, role: str, text: str) -> bytes:
    """128 bits of a role and text within a conversation."""
    return xxhash.xxh3_128_digest(f"{conversation}\0{len(role)}\0{role}{text}".encode())


class Piece:
    """Consecutive rows of one conversation: their faults, and their edits between two states."""

    def __init__(self, rows: list[Row], costs: EditCosts, is_repeated: Callable[[Row], bool] = lambda row: False):
        self.costs = costs
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.items: list[tuple[str, int, bool, Row]] = []
        seen: set[tuple[str, str]] = set()
        for row in rows:
            visible = row.text.rstrip(WHITE)
            if not visible:
                self.blank += row.copies
                self.items.append(("", row.copies, False, row))
                continue
            known = (row.role, row.text) in seen or is_repeated(row)
            seen.add((row.role, row.text))
            repeats = row.copies - (not known)
            self.duplicate += repeats
            if not known:
                cut = visible[-1] not in SENTENCE_ENDS
                self.truncated += cut
                self.items.append((row.role[:1], 0, cut, row))
            if repeats:
                self.items.append(("", repeats, False, row))
        initials = [row.role[:1] for row in rows]
        self.illegal = sum(one + other not in LEGAL for one, other in pairwise(initials))
        self.illegal += sum((row.copies - 1) * (row.role[:1] * 2 not in LEGAL) for row in rows)
        self.first, self.last = (initials[0], initials[-1]) if rows else (None, None)
        turns = [row.turn for row in rows if row.turn is not None]
        self.turns = (turns[0], turns[-1], 1 + sum(one != other for one, other in pairwise(turns))) if turns else None

    def pattern(self) -> tuple:
        return tuple(item[:3] for item in self.items)

    def steps(self) -> list[Steps]:
        return [row_steps(initial, forced, cut, self.costs) for initial, forced, cut, _ in self.items]

    def audit(self, letters: str) -> str:
        """The letters with one D for each row that a forced step deletes."""
        forced = iter([item[1] for item in self.items])
        return "".join("I" if letter == "I" else letter * max(1, next(forced)) for letter in letters)

    def repaired(self, letters: Iterable[str], state: int) -> list[tuple[str, str]]:
        """The turns that stay or are put in, from a state on."""
        out, rest = [], iter(self.items)
        for letter in letters:
            if letter == "I":
                out.append((DUE[state], ""))
                state = AFTER_DUE[state]
                continue
            initial, _, _, row = next(rest)
            if letter == "R":
                out.append((DUE[state], row.text))
                state = AFTER_DUE[state]
            elif letter == "K":
                out.append((row.role, row.text))
                state = KEPT[state, initial]
        return out


class Solver:
    """Cheapest edits of row patterns; short patterns are remembered as long as the task runs."""

    def __init__(self, costs: EditCosts):
        self.costs = costs
        self.inserts = Steps((q, "I", costs.insert, AFTER_DUE[q]) for q in STATES)
        self.known: dict[tuple, tuple[int, list[str]] | None] = {}

    def solve(self, piece: Piece, start: int, goals: tuple[int, ...], to_end: bool) -> tuple[int, list[str]] | None:
        if len(piece.items) > KEPT_PATTERN:
            return least_path(piece.steps(), start, goals, self.inserts, to_end)
        key = (piece.pattern(), start, goals, to_end)
        if key not in self.known:
            if len(self.known) >= KEPT_ANSWERS:
                self.known.clear()
            self.known[key] = least_path(piece.steps(), start, goals, self.inserts, to_end)
        return self.known[key]


TOTALS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
ANSWER = f"conv_id bigint, piece bigint, pieces bigint, audit string, repaired array<struct<role string, text string>>, {TOTALS}"
ROWS = "array<struct<turn bigint, role string, text string, copies bigint>>"
LARGEST = 2**63 - 1


def repair_conversations(
    frame: DataFrame, costs: EditCosts = EditCosts(), copies: str | None = None, piece_rows: int = PIECE_ROWS
) -> DataFrame:
    """Cheapest repair of each conversation, a row for each piece of it (nearly all have one).

    ``conv_id``, ``piece`` (0 to ``pieces`` - 1), ``pieces``, ``audit`` (K keep, R re-role, D delete, I insert), ``repaired`` (role
    and text of the turns that result), and for the whole conversation ``gaps`` in the turn numbers, rows with each fault,
    ``illegal`` neighbours and ``cost``. ``copies`` names a column that says how many times a row stands there;
    a conversation whose rows have 0 is reported as one without rows. Gaps beyond 64 bits are given as the largest long.
    """
    times = F.lit(1) if copies is None else F.col(copies)
    space = F.lit(" ")
    rows = (
        frame.select(
            F.col("conv_id").cast("bigint").alias("conv_id"),
            F.col("turn").cast("bigint").alias("turn"),
            F.coalesce(F.col("role").cast("string"), space).alias("role"),
            F.coalesce(F.col("text").cast("string"), space).alias("text"),
            times.cast("bigint").alias("copies"),
        )
        .groupBy("conv_id", "turn", "role", "text")
        .agg(F.sum("copies").alias("copies"))
    )
    order = ["conv_id", "turn", "role"]
    dealt = rows.repartitionByRange(*order, F.substring("text", 1, CUT_CHARACTERS)).sortWithinPartitions(*order, "text")
    first = materialize(_first_pass(dealt, costs, piece_rows), "pieces")
    columns = [field.name for field in _parsed(ANSWER).fields]
    closed = first.where("rows is null").select(*columns)
    return closed.unionByName(_finish(first.where("rows is not null"), costs))


def _conversations(batches: Iterable[pa.RecordBatch], piece_rows: int) -> Iterator[tuple[int | None, list[Row], bool]]:
    """(conversation, rows, whether the conversation ends here) in order; long ones come in several pieces."""
    current, held, weight, started = None, [], 0, False
    for batch in batches:
        for conversation, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if started and conversation != current:
                yield current, held, True
                held, weight = [], 0
            started, current = True, conversation
            row = Row(row)
            if not row.copies:
                continue
            if held and (len(held) >= piece_rows or weight + len(row.text) > PIECE_BYTES):
                yield current, held, False
                held, weight = [], 0
            held.append(row)
            weight += len(row.text)
    if started:
        yield current, held, False


def _first_pass(dealt: DataFrame, costs: EditCosts, piece_rows: int) -> DataFrame:
    """Answers of conversations that lie whole within a task, and the rows of all others."""

    def run(batches):
        part, solver = TaskContext.get().partitionId(), Solver(costs)
        before, opened, first = None, False, True
        for number, (conversation, rows, ends) in enumerate(_conversations(batches, piece_rows)):
            goes_on = not first and opened and conversation == before
            # What comes before the first conversation of a task is not known here, nor what follows its last.
            if ends and not first and not goes_on:
                answer = _whole(conversation, rows, solver)
            else:
                answer = {"conv_id": conversation, "rows": [dict(zip(names, row, strict=True)) for row in rows]}
            yield pa.RecordBatch.from_pylist([{"part": part, "number": number} | answer], schema=target)
            opened, before, first = not ends, conversation, first and not ends

    names = ("turn", "role", "text", "copies")
    schema = f"{ANSWER}, part int, number bigint, rows {ROWS}"
    target = arrow_schema(_parsed(schema))
    return dealt.select("conv_id", *names).mapInArrow(_in_batches(run, target), schema)


def _in_batches(run: Callable, target: pa.Schema, rows: int = 512, size: int = 4 << 20) -> Callable:
    """Small batches of a task joined to larger ones."""

    def joined(batches):
        held, weight = [], 0
        for batch in run(batches):
            held.append(batch)
            weight += batch.nbytes
            if len(held) >= rows or weight >= size:
                yield from pa.Table.from_batches(held, target).combine_chunks().to_batches()
                held, weight = [], 0
        if held:
            yield from pa.Table.from_batches(held, target).combine_chunks().to_batches()

    return joined


def _whole(conversation: int | None, rows: list[Row], solver: Solver) -> dict:
    piece = Piece(rows, solver.costs)
    cost, letters = solver.solve(piece, NOTHING, FINAL, True)
    return {
        "conv_id": conversation,
        "piece": 0,
        "pieces": 1,
        "audit": piece.audit(letters),
        "repaired": [{"role": role, "text": text} for role, text in piece.repaired(letters, NOTHING)],
        "gaps": _gaps([piece.turns]),
        "blank": piece.blank,
        "duplicate": piece.duplicate,
        "truncated": piece.truncated,
        "illegal": piece.illegal,
        "cost": cost,
    }


def _gaps(turns: Iterable[tuple[int, int, int] | None]) -> int:
    """Missing turn numbers, from the first, last and number of different turns of consecutive pieces."""
    known = [t for t in turns if t is not None]
    if not known:
        return 0
    different = sum(t[2] for t in known) - sum(one[1] == other[0] for one, other in pairwise(known))
    return min(known[-1][1] - known[0][0] + 1 - different, LARGEST)


def _finish(opened: DataFrame, costs: EditCosts) -> DataFrame:
    """Answers of conversations in several pieces."""
    at = ["part", "number"]
    known = opened.select("conv_id", *at, "rows")
    marked = known.join(_repeated_elsewhere(known), at, "left")
    chosen = _choose(_measured(marked, costs), costs)
    return _repaired(marked.join(chosen, at), costs)


def _repeated_elsewhere(opened: DataFrame) -> DataFrame:
    """``part, number, repeated``: keys of the rows of a piece that occur in an earlier piece of the conversation."""

    def run(batches):
        for batch in batches:
            for conversation, part, number, rows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys = list({row_key(conversation, row["role"], row["text"]) for row in rows})
                count = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * count, pa.int32()), pa.array([number] * count, pa.int64()), pa.array(keys, pa.binary())],
                    ["part", "number", "key"],
                )

    keys = materialize(opened.mapInArrow(run, "part int, number bigint, key binary"), "row_keys")
    place = F.struct("part", "number")
    first = keys.groupBy("key").agg(F.min(place).alias("first"))
    later = keys.join(first, "key").where(place > F.col("first"))
    return later.groupBy("part", "number").agg(F.collect_list("key").alias("repeated"))


def _piece_of(conversation: int | None, rows: list[dict], repeated: list[bytes] | None, costs: EditCosts) -> Piece:
    known = set(repeated or ())
    made = [Row((row["turn"], row["role"], row["text"], row["copies"])) for row in rows]
    return Piece(made, costs, lambda row: bool(known) and row_key(conversation, row.role, row.text) in known)


MEASURES = (
    "conv_id bigint, part int, number bigint, turns array<bigint>, initials array<string>, blank bigint, duplicate bigint, "
    "truncated bigint, illegal bigint, ways array<struct<start int, rank int, cost bigint, goal int>>"
)


def _measured(marked: DataFrame, costs: EditCosts) -> DataFrame:
    """What a piece tells about itself, with the cost and the order of audits from each state to each other."""

    def run(batches):
        solver = Solver(costs)
        for batch in batches:
            for conversation, part, number, rows, repeated in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                piece = _piece_of(conversation, rows, repeated, costs)
                yield pa.RecordBatch.from_pylist([{
                    "conv_id": conversation, "part": part, "number": number, "turns": piece.turns,
                    "initials": None if piece.first is None else [piece.first, piece.last],
                    "blank": piece.blank, "duplicate": piece.duplicate, "truncated": piece.truncated, "illegal": piece.illegal,
                    "ways": list(_ways(piece, solver)),
                }], schema=target)

    target = arrow_schema(_parsed(MEASURES))
    columns = ["conv_id", "part", "number", "rows", "repeated"]
    return materialize(marked.select(*columns).mapInArrow(run, MEASURES), "piece_measures")


def _ways(piece: Piece, solver: Solver) -> Iterator[dict]:
    """No piece but the last ends with an insert, so no audit here begins with another of the same start: their order decides."""
    for start in STATES:
        found = ((goal, solver.solve(piece, start, (goal,), False)) for goal in STATES)
        ways = sorted((letters, cost, goal) for goal, (cost, letters) in (f for f in found if f[1]))
        for rank, (_, cost, goal) in enumerate(ways):
            yield {"start": start, "rank": rank, "cost": cost, "goal": goal}


CHOICE = f"part int, number bigint, start int, goal int, tail int, piece bigint, pieces bigint, {TOTALS}"


def _choose(measures: DataFrame, costs: EditCosts) -> DataFrame:
    """The states at the cuts of each conversation. A piece of up to 4,096 rows is one small row here."""

    def run(group):
        import pandas as pd

        group = group.sort_values(["part", "number"])
        steps = [Steps((w["start"], w["rank"], w["cost"], w["goal"]) for w in ways) for ways in group["ways"]]
        # After the last row only the turns that are still due can be put in.
        tails = {NOTHING: (0, NOTHING), SYSTEM: (2, ASSISTANT), USER: (1, ASSISTANT), ASSISTANT: (0, ASSISTANT)}
        steps.append(Steps((q, 0, costs.insert * more, end) for q, (more, end) in tails.items()))
        cost, ranks = least_path(steps, NOTHING, FINAL, None, False)
        state, states = NOTHING, []
        for step, rank in zip(steps[:-1], ranks, strict=False):
            goal = next(following for letter, _, following in step.ahead[state] if letter == rank)
            states.append((state, goal))
            state = goal
        initials = [i for i in group["initials"] if i is not None]
        totals = {
            "gaps": _gaps(None if t is None else tuple(map(int, t)) for t in group["turns"]),
            "illegal": int(group["illegal"].sum()) + sum(one[1] + other[0] not in LEGAL for one, other in pairwise(initials)),
            "cost": cost,
        } | {name: int(group[name].sum()) for name in ("blank", "duplicate", "truncated")}
        count = len(states)
        return pd.DataFrame({
            "part": group["part"].to_numpy(), "number": group["number"].to_numpy(),
            "start": [s for s, _ in states], "goal": [g for _, g in states],
            "tail": [0] * (count - 1) + [tails[state][0]], "piece": range(count), "pieces": [count] * count,
        } | {name: [value] * count for name, value in totals.items()})[names]

    names = [field.name for field in _parsed(CHOICE).fields]
    return measures.groupBy("conv_id").applyInPandas(run, CHOICE)


def _repaired(placed: DataFrame, costs: EditCosts) -> DataFrame:
    """Each piece repaired between the states that were chosen for its cuts."""

    def run(batches):
        solver = Solver(costs)
        for batch in batches:
            for row in batch.to_pylist():
                piece = _piece_of(row["conv_id"], row.pop("rows"), row.pop("repeated"), costs)
                start, goal, tail = row.pop("start"), row.pop("goal"), row.pop("tail")
                letters = solver.solve(piece, start, (goal,), False)[1] + ["I"] * tail
                repaired = [{"role": role, "text": text} for role, text in piece.repaired(letters, start)]
                answer = row | {"audit": piece.audit(letters), "repaired": repaired}
                yield pa.RecordBatch.from_pylist([answer], schema=target)

    target = arrow_schema(_parsed(ANSWER))
    columns = ["conv_id", "rows", "repeated", "start", "goal", "tail", "piece", "pieces"]
    totals = [field.name for field in _parsed(TOTALS).fields]
    return placed.select(*columns, *totals).mapInArrow(run, ANSWER)


def damage(frame: DataFrame) -> DataFrame:
    """The rows of a conversation table with faults put in by the checksum of ``conv_id:turn``, nulls written as one space.

    Modulo 20: 0 drops the row (``copies`` 0), 1 empties its text, 2 takes its sentence ends away, 3 doubles it (``copies`` 2),
    4 makes it a user turn. Columns ``conv_id, turn, role, text, copies``.
    """
    space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text").cast("string"), space)
    role = F.coalesce(F.col("role").cast("string"), space)
    return frame.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, SENTENCE_ENDS, "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


def digests(answers: DataFrame) -> DataFrame:
    """A row for each conversation: its totals, its whole audit, and the SHA-256 of its repaired ``role:text`` lines.

    A conversation in several pieces is read in order by one task, as the digest is sequential; memory is that of a piece and of
    the audit, one letter a row.
    """
    totals = [field.name for field in _parsed(TOTALS).fields]
    lines = F.array_join(F.transform("repaired", lambda turn: F.concat(turn["role"], F.lit(":"), turn["text"])), "\n")
    answers = answers.select("conv_id", "piece", "pieces", *totals, "audit", F.size("repaired").alias("turns"), lines.alias("lines"))
    single = answers.where("pieces = 1").select("conv_id", *totals, "audit", F.sha2("lines", 256).alias("repaired_sha256"))
    several = answers.where("pieces > 1").repartition("conv_id").sortWithinPartitions("conv_id", "piece")

    def run(batches):
        import hashlib

        audit, state, begun = [], hashlib.sha256(), False
        for batch in batches:
            for row in batch.to_pylist():
                if row["piece"] == 0:
                    audit, state, begun = [], hashlib.sha256(), False
                audit.append(row["audit"])
                if row["turns"]:
                    state.update((begun * "\n" + row["lines"]).encode())
                    begun = True
                if row["piece"] == row["pieces"] - 1:
                    done = row | {"audit": "".join(audit), "repaired_sha256": state.hexdigest()}
                    yield pa.RecordBatch.from_pylist([done], schema=target)

    target = arrow_schema(single.schema)
    return single.unionByName(several.mapInArrow(run, single.schema))
