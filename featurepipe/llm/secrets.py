"""Secrets in text, found through a trigram inverted index.

Every rule is a regular expression with a least length. From the expression follows a Boolean query of trigrams that
each match must hold: trigrams of a literal run are joined by AND, alternatives by OR. A block of texts is indexed
once: postings list the texts in which each asked-for trigram occurs, letters in lower case. The query of a rule
intersects and unites postings, and only the candidates are verified by the expression. A rule without mandatory
trigrams scans all texts. The index reads whole texts, and nothing is shuffled.

A match is found from left to right without overlaps for each rule; one that fails the rule's length is dropped.
Positions are code points, ends exclusive. Null and empty texts have no spans; repeated rows stay repeated. An empty table gives an
empty result. A very long text is a block of its own, scanned whole. Other columns are not read by ``find_secrets`` and pass
unchanged through ``mask_secrets``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurepipe.llm.common import documents, gives_back, map_blocks

try:  # where Python keeps its parser of expressions
    from re import _constants as sre
    from re import _parser as sre_parse
except ImportError:  # pragma: no cover
    import sre_constants as sre
    import sre_parse


@dataclass(frozen=True)
class Rule:
    """``least`` is the least length of ``group`` (0: the whole match)."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        # ASCII: letters in either case are A-Z and a-z alone.
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


# The three kinds that are counted apart.
BASE_RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6,
        group=2,
        any_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
# Published shapes of keys and tokens.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("payment_key", r"[rs]k_live_[A-Za-z0-9]{16,}"),
)
RULES = BASE_RULES + MORE_RULES

# A query is True (every text), a trigram, or ("and" | "or", queries).
MOST_STRINGS = 64


def _all(parts) -> object:
    parts = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any(parts) -> object:
    parts = list(dict.fromkeys(parts))
    return True if True in parts or not parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _of_strings(strings: set[bytes]) -> object:
    return _any(_all(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(strings))


def _exact(tokens) -> set[bytes] | None:
    """All strings that a part can match, in lower case, where they are few; else None."""
    found = {b""}
    for operation, value in tokens:
        if operation is sre.LITERAL:
            own = {chr(value).encode().lower()}
        elif operation is sre.IN and all(o is sre.LITERAL for o, _ in value):
            own = {chr(v).encode().lower() for _, v in value}
        elif operation is sre.SUBPATTERN:
            own = _exact(value[3])
        elif operation is sre.BRANCH:
            each = [_exact(branch) for branch in value[1]]
            own = None if None in each else set().union(*each)
        elif operation is sre.MAX_REPEAT and value[1] is not sre.MAXREPEAT and value[1] <= 8:
            inner = _exact(value[2])
            own = None
            if inner is not None and len(inner) ** int(value[1]) <= MOST_STRINGS:
                own, power = set(), {b""}
                for count in range(int(value[1]) + 1):
                    own |= power if count >= value[0] else set()
                    power = {a + b for a in power for b in inner}
        elif operation is sre.AT:
            own = {b""}
        else:
            own = None
        if own is None or len(own) * len(found) > MOST_STRINGS:
            return None
        found = {a + b for a in found for b in own}
    return found


def trigram_query(pattern: str) -> object:
    """The trigrams, in lower case, that every match of an expression must hold."""
    return _query(list(sre_parse.parse(pattern)))


def _query(tokens) -> object:
    parts, run = [], {b""}
    for token in tokens:
        own = _exact([token])
        if own is not None and len(own) * len(run) <= MOST_STRINGS:
            run = {a + b for a in run for b in own}
            continue
        parts.append(_of_strings(run))
        run = {b""} if own is None else own
        operation, value = token
        if own is None:
            if operation is sre.SUBPATTERN:
                parts.append(_query(list(value[3])))
            elif operation is sre.BRANCH:
                parts.append(_any(_query(list(branch)) for branch in value[1]))
            elif operation is sre.MAX_REPEAT and value[0] > 0:
                parts.append(_query(list(value[2])))
    return _all([*parts, _of_strings(run)])


def _asked(query) -> set[bytes]:
    return set() if query is True else {query} if isinstance(query, bytes) else set().union(*map(_asked, query[1]))


class Index:
    """Postings of the asked-for trigrams over one block of texts."""

    def __init__(self, trigrams: list[bytes]):
        self.number = np.full(1 << 24, -1, dtype=np.int16)
        self.names = trigrams
        for k, t in enumerate(trigrams):
            self.number[t[0] << 16 | t[1] << 8 | t[2]] = k

    def postings(self, flat: bytes, starts: np.ndarray) -> dict[bytes, np.ndarray]:
        """``flat``: the texts one after another, each followed by a zero byte; ``starts``: where each begins."""
        letters = np.frombuffer(flat.lower(), dtype=np.uint8)
        code = letters.astype(np.int32)
        at = self.number[(code[:-2] << 16) | (code[1:-1] << 8) | code[2:]] if len(code) > 2 else np.empty(0, np.int16)
        where = np.flatnonzero(at >= 0)
        text = np.searchsorted(starts, where, side="right") - 1
        pairs = np.unique(at[where].astype(np.int64) * len(starts) + text)
        owner = pairs // max(1, len(starts))
        ends = np.searchsorted(owner, np.arange(len(self.names) + 1))
        return {t: pairs[ends[k] : ends[k + 1]] % len(starts) for k, t in enumerate(self.names)}


def candidates(query, postings: dict[bytes, np.ndarray], count: int) -> np.ndarray:
    if query is True:
        return np.arange(count)
    if isinstance(query, bytes):
        return postings[query]
    kind, parts = query
    found = candidates(parts[0], postings, count)
    for part in parts[1:]:
        other = candidates(part, postings, count)
        found = (np.intersect1d if kind == "and" else np.union1d)(found, other)
    return found


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(rule, rule.compiled(), trigram_query(rule.pattern)) for rule in rules]
        self.index = Index(sorted(set().union(*(_asked(query) for _, _, query in self.rules))))

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """For each text its (start, number of the rule, end), in that order."""
        raw = [text.encode() for text in texts]
        starts = np.cumsum([0, *(len(r) + 1 for r in raw)])[:-1]
        postings = self.index.postings(b"\0".join([*raw, b""]), starts)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for number, (rule, compiled, query) in enumerate(self.rules):
            for k in candidates(query, postings, len(texts)).tolist():
                for match in compiled.finditer(texts[k]):
                    if match.end(rule.group) - match.start(rule.group) >= rule.least:
                        found[k].append((match.start(), number, match.end()))
        for spans in found:
            spans.sort()
        return found


def find_secrets(
    frame: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id`` and ``secrets``: array of (kind, start, end), by start and then in the order of the rules."""
    kinds = [rule.kind for rule in rules]
    kind = "array<struct<kind:string,start:bigint,end:bigint>>"

    held: list[Scanner] = []

    def run(batch):
        # The index is as large as all trigrams, so it goes with the task.
        own = held[0] if held else Scanner(rules)
        held[:] = [own]
        found = own.scan(batch.column(1).to_pylist())
        spans = [[{"kind": kinds[r], "start": s, "end": e} for s, r, e in own] for own in found]
        return {"doc_id": batch.column(0), "secrets": spans}

    return map_blocks(documents(frame, id_column, text_column), run, f"doc_id bigint, secrets {kind}")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _masked(text: str, spans: list[tuple[int, int, int]], kinds: list[str]) -> str:
    """Overlapping spans are one; it is named after the first."""
    out, at = [], 0
    reach, name = -1, ""
    pending: list[tuple[int, int, str]] = []
    for start, rule, end in spans:
        if start < reach:
            reach = max(reach, end)
            pending[-1] = (pending[-1][0], reach, name)
        else:
            name, reach = kinds[rule], end
            pending.append((start, end, name))
    for start, end, kind in pending:
        out += [text[at:start], f"<{kind}>"]
        at = end
    return "".join([*out, text[at:]])


def mask_secrets(frame: DataFrame, rules: tuple[Rule, ...] = RULES, text_column: str = "text") -> DataFrame:
    """The same rows and columns, with every secret replaced by its kind in angle brackets; null stays null."""
    kinds = [rule.kind for rule in rules]
    schema = frame.schema
    place = schema.fieldNames().index(text_column)

    def run(batches):
        from featurepipe.llm.common import blocks

        own = Scanner(rules)
        for batch in blocks(batches, text_column):
            texts = batch.column(place).to_pylist()
            found = own.scan([t or "" for t in texts])
            clean = [_masked(t, s, kinds) if s else t for t, s in zip(texts, found, strict=True)]
            columns = [*batch.columns]
            columns[place] = pa.array(clean, type=batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return frame.mapInArrow(gives_back(run), schema)
