"""DuckDB SQL for the queries that SQL can express on whole tables."""

from streamweave.llm import chat

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{pattern}')"


_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP1 = f"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item, {words('text', _WORD)} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item, k, array_to_string(w[s:s + k - 1], ' ') AS gram FROM (
  SELECT item, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, {words('text', _WORD)} AS w FROM documents),
g AS (SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS gram FROM (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
m AS (SELECT doc_id, g.k, s, item FROM g JOIN win ON g.k = win.k AND g.gram = win.gram),
h AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM m) GROUP BY 1),
t AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM m GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(len(items), 0) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""


def _escaped(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for c in chat.CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


OP2 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, {len(chat.START) + 2} + length(replace({_escaped('role')}, chr(10), '\\' || chr(10)))
                + length({_escaped('text')}) + {len(chat.END)} AS n FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""

_VISIBLE = r"[^\x20\x09-\x0D]+"
OP3 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {words('text', _VISIBLE)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + least(3, len(w)) - 1], ' ') AS x FROM (
  SELECT doc_id, w, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
least_ AS (SELECT a, min(b) AS b FROM reach GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
       doc_id <= coalesce(b, doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN least_ ON a = doc_id"""
