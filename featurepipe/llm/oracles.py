"""SQL that must give the same rows as registered queries of text operators, for small tables.

Three kinds of queries have none: those whose columns hold hashes, sketches or scores of their own (fingerprints, toxicity, spans
of more rules, shards of a tree), those that need a tokenizer, and those that would compare all byte windows or decompose a
matrix. Tests compare these with brute force, with the tokenizer library or with held-out labels.
"""

from __future__ import annotations

from featurepipe.llm.chat import BEGIN, END

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANK = r"\x20\x09-\x0D"


def _lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"


def _grams(words: str, size: str) -> str:
    """All runs of ``size`` words in order, each as one string."""
    return f"list_transform(range(1, len({words}) - {size} + 2), lambda k: array_to_string({words}[k:k + {size} - 1], ' '))"


NGRAM_COMPONENTS = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_lowered("text")}, '[^{BLANK}]+') AS w FROM documents),
x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM d),
s AS (SELECT doc_id, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o AS shingle
      FROM x WINDOW o AS (PARTITION BY doc_id ORDER BY place)),
u AS (SELECT doc_id, hash(shingle) AS h FROM s WHERE shingle IS NOT NULL
      UNION SELECT doc_id, hash(array_to_string(w, ' ')) FROM d WHERE len(w) BETWEEN 1 AND 3),
n AS (SELECT d.doc_id, count(u.h) AS n FROM d LEFT JOIN u USING (doc_id) GROUP BY d.doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_have FROM u a JOIN u b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
      WHERE 100 * both_have >= 85 * (x.n + y.n - both_have)),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT n.doc_id, n.n AS n_shingles, min(r.b) AS component_id FROM n JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n.n"""


WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all({_lowered("text")}, '{WORDS}') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all({_lowered("text")}, '{WORDS}') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS size FROM i WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, size, unnest({_grams("w", "size")}) AS gram FROM sized),
sizes AS (SELECT DISTINCT size FROM windows),
runs AS (SELECT row_id, size, unnest({_grams("w", "size")}) AS gram, unnest(range(1, len(w) - size + 2)) AS place
         FROM d, sizes WHERE len(w) >= size),
hits AS (SELECT row_id, place, size, item_id FROM runs JOIN windows USING (size, gram)),
words AS (SELECT row_id, count(DISTINCT covered) AS n_hit
          FROM (SELECT row_id, unnest(range(place, place + size)) AS covered FROM hits) GROUP BY row_id),
items AS (SELECT row_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS names
          FROM hits GROUP BY row_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (row_id) LEFT JOIN items USING (row_id)"""


def _escapes(text: str) -> str:
    """How many characters the escape of control strings adds."""
    return rf"len(regexp_extract_all({text}, '<\\*\|'))"


SAID = f"{END}{BEGIN}assistant ok"
CHAT_DIGESTS = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '{SAID}' UNION ALL SELECT -1, 1, 'assistant', '{SAID}'),
s AS (SELECT *, replace(replace(role, '\\', '\\\\'), chr(10), '\\n') AS shown FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(shown) + {_escapes("shown")} + length(text) + {_escapes("text")} + {len(BEGIN) + len(END) + 2}) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id"""


# --- repair of turns: a table of cheapest ways over rows and states, in which each way carries its audit and lines ------------

FAR = 1_000_000_000


def _way(before: str, cost: str, letter: str, line: str | None = None, allowed: str | None = None) -> str:
    """A way prolonged by an edit; one that is not allowed costs too much."""
    cost = cost if allowed is None else f"CASE WHEN {allowed} THEN {cost} ELSE {FAR} END"
    lines = f"{before}.o" if line is None else f"list_append({before}.o, {line})"
    return f"struct_pack(c := {before}.c + {cost}, a := {before}.a || '{letter}', o := {lines})"


def _inserted(before: str, role: str) -> str:
    return _way(before, "2", "I", f"'{role}:'")


def _after_row() -> str:
    """The four ways after a row ``x``, from those before it with all inserts done (``s0``, ``s1``, ``a2``, ``a3``)."""
    more, free = "x.cut", "NOT x.forced"
    keep = "x.role || ':' || x.text"

    def kept(before, initial):
        return _way(before, more, "K", keep, f"{free} AND x.initial = '{initial}'")

    def turned(before, role):
        return _way(before, f"2 + {more}", "R", f"'{role}:' || x.text", free)

    to_user = [kept(s, "u") for s in ("s0", "s1", "a3")] + [turned(s, "user") for s in ("s0", "s1", "a3")]
    return f"""
    {_way("s0", "3", "D")} AS s0,
    least({_way("s1", "3", "D")}, {kept("s0", "s")}) AS s1,
    least({", ".join([_way("a2", "3", "D"), *to_user])}) AS s2,
    least({_way("a3", "3", "D")}, {kept("a2", "a")}, {turned("a2", "assistant")}) AS s3"""


_INSERTED_USER = f"least(s2, {_inserted('s0', 'user')}, {_inserted('s1', 'user')}, {_inserted('s3', 'user')})"
_NO_WAY = f"struct_pack(c := {FAR}, a := '', o := CAST([] AS VARCHAR[]))"
_BYTES = "list_transform(string_split(key, ''), lambda letter: CAST(ascii(letter) AS BIGINT))"
_BITS = "list_reduce(CAST(range(8) AS BIGINT[]), lambda v, bit: xor(v >> 1, (v & 1) * 3988292384), xor(sofar, byte))"
_CRC32 = f"xor(list_reduce({_BYTES}, lambda sofar, byte: {_BITS}, CAST(4294967295 AS BIGINT)), 4294967295)"

TURN_REPAIR = f"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
h AS (SELECT *, {_CRC32} % 20 AS kind FROM k),
b AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM h),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
  left(role, 1) AS initial, NOT regexp_matches(text, '[^{BLANK}]') AS blank FROM b),
f AS (SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS repeats,
  lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial NOT IN ('su', 'ua', 'au') AS odd,
  regexp_extract(text, '([^{BLANK}])[{BLANK}]*$', 1) NOT IN ('.', '!', '?') AS cut FROM o),
g AS (SELECT *, NOT blank AND NOT repeats AND cut AS truncated FROM f),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE repeats) AS duplicate,
  count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE odd) AS illegal,
  list(struct_pack(role := role, text := text, initial := initial, forced := blank OR repeats, cut := CAST(truncated AS INTEGER)) ORDER BY pos) AS rows
  FROM g GROUP BY conv_id),
z AS (SELECT conv_id, 1 AS i, struct_pack(c := 0, a := '', o := CAST([] AS VARCHAR[])) AS s0, {_NO_WAY} AS s1, {_NO_WAY} AS s2, {_NO_WAY} AS s3 FROM c
  UNION ALL SELECT conv_id, i + 1, {_after_row()}
  FROM (SELECT conv_id, i, s0, s1, a2, least(s3, {_inserted("a2", "assistant")}) AS a3, x
        FROM (SELECT z.*, {_INSERTED_USER} AS a2, c.rows[i] AS x FROM z JOIN c ON z.conv_id IS NOT DISTINCT FROM c.conv_id WHERE i <= len(c.rows)))),
e AS (SELECT conv_id, i, least(s0, s3, {_inserted("a2", "assistant")}) AS best FROM (SELECT *, {_INSERTED_USER} AS a2 FROM z)),
r AS (SELECT c.*, e.best FROM c JOIN e ON c.conv_id IS NOT DISTINCT FROM e.conv_id AND e.i = len(c.rows) + 1)
SELECT k.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
  coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.o, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM k) k LEFT JOIN r ON k.conv_id IS NOT DISTINCT FROM r.conv_id"""

ORACLES = {
    "op1_ngram_jaccard": NGRAM_COMPONENTS,
    "op5_decontamination": CONTAMINATION,
    "op8_chat_format": CHAT_DIGESTS,
    "op11_turn_repair": TURN_REPAIR,
}
