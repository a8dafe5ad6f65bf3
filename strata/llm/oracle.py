"""SQL that gives the rows of the longer queries, see ``queries``."""

from __future__ import annotations

# The unsigned CRC-32 of an ASCII text, bit by bit.
CRC32 = """xor(4294967295::BIGINT, list_reduce(list_transform(string_split({0}, ''), lambda x: ord(x)::BIGINT),
    lambda c, b: list_reduce([0::BIGINT, 1, 2, 3, 4, 5, 6, 7], lambda a, z: xor(a >> 1, 3988292384 * (a & 1)), xor(c, b)), 4294967295::BIGINT))"""
BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

# ------------------------------------------------------------------ 11, conversations
# A state's value is (cost, letters, lines); states: 0 nothing yet, 1 after s, 2 after u, 3 after a.

_TURN = (2, 2, 3, 2)
_ROLE = ("", "", "user", "assistant")
_KEPT = (
    "CASE initial WHEN 's' THEN v1 WHEN 'u' THEN v2 END",
    "CASE initial WHEN 'u' THEN v2 END",
    "CASE initial WHEN 'a' THEN v3 END",
    "CASE initial WHEN 'u' THEN v2 END",
)


def _put(value: str, cost: str, letter: str, line: str | None) -> str:
    lines = f"({value}).t" if line is None else f"list_prepend({line}, ({value}).t)"
    return f"CASE WHEN {value} IS NOT NULL THEN {{'c': ({value}).c + {cost}, 'a': '{letter}' || ({value}).a, 't': {lines}}} END"


def _least(*values: str) -> str:
    return f"list_sort(list_filter([{', '.join(values)}], lambda x: x IS NOT NULL))[1]"


def _edited(s: int) -> str:
    role = _ROLE[_TURN[s]]
    keep = _put(f"({_KEPT[s]})", "cut", "K", "line")
    rerole = _put(f"v{_TURN[s]}", "1 + cut", "R", f"'{role}:' || text")
    delete = _put(f"v{s}", "2", "D", None)
    return _least(delete, f"CASE WHEN NOT doomed THEN {keep} END", f"CASE WHEN NOT doomed THEN {rerole} END") + f" AS e{s}"


def _gap(new: str, old: str) -> str:
    return ", ".join(_least(f"e{s}", _put(f"{old}{t}", "5", "I", f"'{_ROLE[t]}:'")) + f" AS {new}{s}" for s, t in enumerate(_TURN))


def _with_gaps(source: str) -> str:
    last = ", ".join(f"w{s} AS v{s}" for s in range(4))
    return f"SELECT conv, i, {last} FROM (SELECT *, {_gap('w', 'g')} FROM (SELECT *, {_gap('g', 'e')} FROM ({source})))"


_KIND = "STRUCT(c BIGINT, a VARCHAR, t VARCHAR[])"
_DONE = f"{{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}}::{_KIND}"
_NAME = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"

OP11_SQL = f"""
WITH RECURSIVE h AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {CRC32.format(_NAME)} % 20 AS lot FROM conversations),
d AS (
  SELECT conv_id, turn, CASE lot WHEN 4 THEN 'user' ELSE role END AS role,
         CASE lot WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, lot
  FROM h WHERE lot <> 0),
t AS (SELECT conv_id, turn, role, text FROM d UNION ALL SELECT conv_id, turn, role, text FROM d WHERE lot = 3),
o AS (
  SELECT coalesce('=' || conv_id, '-') AS conv, turn, role, text, role || ':' || text AS line, left(role, 1) AS initial, rtrim(text, {BLANKS}) AS core,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5((length(role) + 1) || ',' || (length(text) + 1) || ',=' || role || ',=' || text)) AS i
  FROM t),
f AS (
  SELECT *, core = '' AS blank, row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again,
         core <> '' AND right(core, 1) NOT IN ('.', '!', '?') AS unended, lag(initial) OVER (PARTITION BY conv ORDER BY i) || initial AS pair
  FROM o),
r AS (SELECT *, blank OR again AS doomed, CASE WHEN unended THEN 5 ELSE 0 END AS cut FROM f),
e AS (
  {_with_gaps(f"SELECT conv, count(*) + 1 AS i, {_DONE} AS e0, NULL::{_KIND} AS e1, NULL::{_KIND} AS e2, {_DONE} AS e3 FROM r GROUP BY conv")}
  UNION ALL
  {_with_gaps(f"SELECT r.conv, r.i, {', '.join(_edited(s) for s in range(4))} FROM e JOIN r ON r.conv = e.conv AND r.i = e.i - 1")}),
s AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (unended AND NOT again) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv),
b AS (SELECT conv, v0 FROM e WHERE i = 1)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(v0.c, 0) AS cost,
       coalesce(v0.a, '') AS audit, sha256(coalesce(array_to_string(v0.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN s ON s.conv = coalesce('=' || c.conv_id, '-') LEFT JOIN b ON b.conv = s.conv
"""

# ------------------------------------------------------------------ 13, manifest


def _hashed(text: str) -> str:
    columns = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}, '-')" for c in columns) + ")"


OP13_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, coalesce('=' || lang, '-') AS g, {_hashed("text")} AS leaf,
         CASE WHEN {CRC32.format("doc_id::VARCHAR")} % 3 = 0
              THEN {_hashed("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
t AS (
  SELECT g, 0 AS lvl, i, leaf AS h FROM p
  UNION ALL
  SELECT g, lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS many FROM t) WHERE many > 1 GROUP BY g, lvl, i // 8),
s AS (SELECT g, arg_max(h, lvl) AS h, max(lvl) AS top FROM t GROUP BY g),
u AS (
  SELECT 0 AS lvl, row_number() OVER (ORDER BY g) - 1 AS i, h FROM s
  UNION ALL
  SELECT lvl + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER () AS many FROM u)
  WHERE many > 1 GROUP BY lvl, i // 8),
w AS (SELECT arg_max(h, lvl) AS root, max(lvl) AS top FROM u),
k AS (SELECT g, row_number() OVER (ORDER BY g) - 1 AS i FROM s),
a AS (  -- the nodes of each run on the way of a leaf
  SELECT p.g, p.i, 0 AS part, n.lvl, n.i AS spot, p.i // (8 ** n.lvl)::BIGINT AS own, n.h
  FROM p JOIN s ON s.g = p.g JOIN t n ON n.g = p.g AND n.lvl < s.top AND n.i // 8 = p.i // (8 ** (n.lvl + 1))::BIGINT
  UNION ALL
  SELECT p.g, p.i, 1, n.lvl, n.i, k.i // (8 ** n.lvl)::BIGINT, n.h
  FROM p JOIN k ON k.g = p.g CROSS JOIN w JOIN u n ON n.lvl < w.top AND n.i // 8 = k.i // (8 ** (n.lvl + 1))::BIGINT),
b AS (
  SELECT g, i, part, lvl, coalesce(string_agg(h, '' ORDER BY spot) FILTER (spot < own), '') AS l,
         coalesce(string_agg(h, '' ORDER BY spot) FILTER (spot > own), '') AS r
  FROM a GROUP BY g, i, part, lvl),
c AS (SELECT g, i, string_agg(l || r, '' ORDER BY part, lvl) AS siblings, list(l || '|' || r ORDER BY part, lvl) AS steps FROM b GROUP BY g, i),
f AS (
  SELECT p.doc_id, p.leaf, s.h AS subroot, w.root, sha256(coalesce(c.siblings, '')) AS proof_sha256,
         list_reduce(coalesce(c.steps, []), lambda x, y: sha256(split_part(y, '|', 1) || x || split_part(y, '|', 2)), coalesce(p.changed, p.leaf)) AS folded_root
  FROM p JOIN s ON s.g = p.g CROSS JOIN w LEFT JOIN c ON c.g = p.g AND c.i = p.i)
SELECT *, folded_root = root AS verified FROM f
"""
