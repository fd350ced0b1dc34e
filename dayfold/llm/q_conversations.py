"""Query of conversation repair."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.conversations import conversation_digests, repair_conversations
from dayfold.llm.registry import Tables, query


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage by a checksum of their place; dropped ones are kept as not ``present``."""
    space = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(place.cast("binary")) % 20
    text = F.coalesce("text", space)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    )


def _add(ways: str, cost: str, letter: str, line: str | None = None) -> str:
    """SQL for a way (cost in 12 digits, edits, chr(1), text) with one more edit."""
    text = f"substr({ways}, instr({ways}, chr(1)) + 1)"
    if line is not None:
        text = f"CASE WHEN {text} = '' THEN {line} ELSE {text} || chr(10) || {line} END"
    return (
        f"(lpad((left({ways}, 12)::BIGINT + {cost})::VARCHAR, 12, '0') || "
        f"substr(split_part({ways}, chr(1), 1), 13) || '{letter}' || chr(1) || {text})"
    )


def _place(ways: str, role: str) -> str:
    """SQL for keeping a row as user or assistant, or making it one; NULL where the row must go."""
    keep, change = _add(ways, "more", "K", "line"), _add(ways, "1 + more", "R", f"'{role}:' || text")
    return f"CASE WHEN must_go THEN NULL WHEN initial = '{role[0]}' THEN {keep} ELSE {change} END"


_INSERT_U, _INSERT_A = (lambda ways: _add(ways, "5", "I", "'user:'")), (lambda ways: _add(ways, "5", "I", "'assistant:'"))
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

# A way ends in the start, behind a system message, behind a user's or behind an assistant's turn (w0 to w3).
REPAIR_SQL = f"""
WITH RECURSIVE crc AS (
    SELECT list(v ORDER BY i) AS tab FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                              lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
        FROM range(256) r(i))),
c AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, row_number() OVER () AS rid,
           list_prepend(4294967295, list_transform(
               string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
               lambda x: ord(x)::BIGINT)) AS bytes
    FROM conversations),
k AS (
    SELECT c.*, xor(list_reduce(bytes, lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS kind
    FROM c, crc),
d AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy, rid
    FROM k WHERE kind <> 0),
o AS (
    SELECT *, rtrim(text, {_WHITE}) AS ending,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, rid, copy) AS pos
    FROM d),
f AS (
    SELECT *, CASE WHEN ending = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
                   WHEN right(ending, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS both_roles
    FROM o),
r AS (
    SELECT conv_id, pos, text, left(role, 1) AS initial, role || ':' || text AS line,
           CASE fault WHEN 't' THEN 5 ELSE 0 END AS more, fault IN ('b', 'd') AS must_go
    FROM f),
w(conv_id, pos, w0, w1, w2, w3) AS (
    SELECT conv_id, 0::BIGINT, '000000000000' || chr(1), NULL::VARCHAR, '000000000005I' || chr(1) || 'user:',
           '000000000010II' || chr(1) || 'user:' || chr(10) || 'assistant:' FROM (SELECT DISTINCT conv_id FROM c)
    UNION ALL
    SELECT conv_id, pos, w0, w1, w2, least(w3, {_INSERT_A("w2")}) FROM (
        SELECT conv_id, pos, w0, w1, least(w2, {_INSERT_U("w0")}, {_INSERT_U("w1")}, {_INSERT_U("w3")}) AS w2, w3 FROM (
            SELECT r.conv_id, r.pos, {_add("w0", "2", "D")} AS w0,
                   least({_add("w1", "2", "D")}, CASE WHEN initial = 's' AND NOT must_go THEN {_add("w0", "more", "K", "line")} END) AS w1,
                   least({_add("w2", "2", "D")}, {_place("w0", "user")}, {_place("w1", "user")}, {_place("w3", "user")}) AS w2,
                   least({_add("w3", "2", "D")}, {_place("w2", "assistant")}) AS w3
            FROM w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.pos = w.pos + 1))),
best AS (
    SELECT conv_id, least(w0, w3) AS way FROM w
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY pos DESC) = 1),
n AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
           count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
           count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (both_roles NOT IN ('su', 'ua', 'au')) AS illegal
    FROM f GROUP BY conv_id)
SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, left(way, 12)::BIGINT AS cost,
       substr(split_part(way, chr(1), 1), 13) AS audit, sha256(substr(way, instr(way, chr(1)) + 1)) AS repaired_sha256
FROM best b LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM b.conv_id
"""


@query("op12_conversation_repair", REPAIR_SQL)
def op12_conversation_repair(t: Tables) -> DataFrame:
    """All conversations, damaged and repaired."""
    pieces = repair_conversations(damaged(t.conversations), present_col="present")
    return conversation_digests(pieces)
