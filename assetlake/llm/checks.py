"""SQL (of DuckDB) that gives the same rows as the registered queries, where SQL can express them."""

from __future__ import annotations

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(table: str, key: str) -> str:
    """(place, key, t): every term of every row."""
    text = f"translate(text, '{LETTERS}', '{LETTERS.lower()}')"
    return f"""SELECT place, {key}, unnest(regexp_extract_all({text}, '{_TERM}')) AS t
        FROM (SELECT row_number() OVER () AS place, {key}, text FROM {table})"""


RANKED_SEARCH = f"""
WITH words AS ({_terms("documents", "doc_id")}),
totals AS (SELECT count(DISTINCT place) AS n_docs, count(*) AS n_terms FROM words),
lengths AS (SELECT place, 75 + (25 * count(*) * any_value(n_docs)) // any_value(n_terms) AS m FROM words, totals GROUP BY place),
postings AS (SELECT place, doc_id, t, count(*) AS tf FROM words GROUP BY ALL),
weights AS (
    SELECT t, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM postings, totals GROUP BY t
),
asked AS (
    SELECT place AS item, item_id, t, count(*) AS times
    FROM ({_terms("(SELECT DISTINCT item_id, text FROM benchmark)", "item_id")}) GROUP BY ALL
),
scores AS (
    SELECT item, item_id, place, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
    FROM asked JOIN weights USING (t) JOIN postings USING (t) JOIN lengths USING (place) GROUP BY ALL
),
ranks AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 20
"""


def _edit(state: str, cost: str, letter: str, line: str) -> str:
    """A derivation with one more edit: six digits of cost, the letters, a mark, the lines."""
    mark = f"strpos({state}, chr(1))"
    more = f"lpad(CAST(CAST(left({state}, 6) AS INTEGER) + {cost} AS VARCHAR), 6, '0')"
    return f"({more} || substr({state}, 7, {mark} - 7) || '{letter}' || substr({state}, {mark}) || {line})"


def _insert(state: str, role: str) -> str:
    return _edit(state, "2", "I", f"chr(10) || '{role}:'")


def _stay(state: str, kind: str, role: str) -> str:
    """The row kept or given another role; NULL if it must go."""
    kept = _edit(state, "late", "K", "chr(10) || role || ':' || text")
    renamed = _edit(state, "(2 + late)", "R", f"chr(10) || '{role}:' || text")
    return f"CASE WHEN gone THEN NULL WHEN kind = '{kind}' THEN {kept} ELSE {renamed} END"


def _gone(state: str) -> str:
    return _edit(state, "3", "D", "''")


_CLOSED = f"""SELECT *, least(s3, {_insert("i2", "assistant")}) AS i3 FROM (
        SELECT *, least(s2, {_insert("s0", "user")}, {_insert("s1", "user")}, {_insert("s3", "user")}) AS i2 FROM (%s))"""
_BYTES = "list_transform(string_split(key, ''), lambda c: CAST(ord(c) AS BIGINT))"

# The letters of equally cheap derivations of one state never begin one another, so the least text is the least
# cost and among these the least letters.
CONVERSATION_REPAIR = f"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab
),
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
    FROM conversations
),
dice AS (
    SELECT * EXCLUDE (tab, key), xor(list_reduce(list_prepend(4294967295, {_BYTES}),
        lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS die
    FROM keyed, crc
),
damaged AS (
    SELECT conv_id, turn, CASE WHEN die = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN die = 1 THEN '' WHEN die = 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM (SELECT *, unnest(CASE WHEN die = 3 THEN [0, 1] ELSE [0] END) AS copy FROM dice WHERE die <> 0)
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
        rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
        CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS kind
    FROM damaged
),
faults AS (
    SELECT *, lag(kind) OVER (PARTITION BY conv_id ORDER BY k) || kind AS pair,
        CASE WHEN body = '' THEN 'blank'
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
            WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
    FROM placed
),
rows AS (
    SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS gone, CAST(coalesce(fault = 'truncated', false) AS INTEGER) AS late
    FROM faults
),
steps AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS k, '000000' || chr(1) AS s0, CAST(NULL AS VARCHAR) AS s1, CAST(NULL AS VARCHAR) AS s2,
        CAST(NULL AS VARCHAR) AS s3
    FROM (SELECT DISTINCT conv_id FROM rows)
    UNION ALL
    SELECT conv_id, k, {_gone("s0")}, least({_gone("s1")}, CASE WHEN kind = 's' AND NOT gone THEN {_stay("s0", "s", "")} END),
        least({_gone("i2")}, {_stay("s0", "u", "user")}, {_stay("s1", "u", "user")}, {_stay("i3", "u", "user")}),
        least({_gone("i3")}, {_stay("i2", "a", "assistant")})
    FROM ({_CLOSED % '''SELECT steps.conv_id, rows.k, s0, s1, s2, s3, role, text, kind, gone, late
        FROM steps JOIN rows ON steps.conv_id IS NOT DISTINCT FROM rows.conv_id AND rows.k = steps.k + 1'''})
),
best AS (
    SELECT conv_id, least(s0, i3) AS b
    FROM ({_CLOSED % "SELECT *, max(k) OVER (PARTITION BY conv_id) AS last FROM steps"}) WHERE k = last
),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM rows GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    coalesce(CAST(left(b, 6) AS BIGINT), 0) AS cost, coalesce(substr(b, 7, strpos(b, chr(1)) - 7), '') AS audit,
    sha256(coalesce(substr(b, strpos(b, chr(1)) + 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id
"""
