"""DuckDB SQL for the test-data views, shared by the oracles.

Same definitions as ``streamweave.sources.testdata``: epoch ms / s from
the NTZ ``events.ts``, ``$.k`` of props as the item, the arrival
permutation for late-data tests, Java split semantics for words.
"""

READINGS = ("SELECT 'sensor_' || CAST(user_id AS VARCHAR) AS id, epoch_us(ts) // 1000 AS timestamp, "
            "value AS temperature, event_id AS seq FROM events")

READINGS_SHUFFLED = ("SELECT 'sensor_' || CAST(user_id AS VARCHAR) AS id, epoch_us(ts) // 1000 AS timestamp, "
                     "value AS temperature, "
                     "(event_id + (event_id * 7919) % 61) * 64 + 60 - (event_id * 7919) % 61 AS seq, "
                     "event_id FROM events")

BEHAVIORS = ("SELECT user_id AS userId, CAST(json_extract_string(props, '$.k') AS BIGINT) AS itemId, "
             "CAST(NULL AS INTEGER) AS categoryId, "
             "CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behavior, "
             "epoch_us(ts) // 1000000 AS timestamp, event_id AS seq FROM events")

LOGINS = ("SELECT user_id AS userId, CAST(NULL AS VARCHAR) AS ip, "
          "CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS loginState, "
          "epoch_us(ts) // 1000000 AS timestamp, event_id AS seq FROM events")

LINES = ("SELECT doc_id, CAST(line_no AS BIGINT) - 1 AS line_no, value FROM ("
         "SELECT doc_id, unnest(string_split(text, chr(10))) AS value, "
         "generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents)")

# Java split(" "): trailing empty strings dropped, a line of spaces has no words.
WORDS = ("SELECT doc_id, line_no, CAST(pos AS INTEGER) - 1 AS pos, word FROM ("
         "SELECT doc_id, line_no, unnest(parts) AS word, generate_subscripts(parts, 1) AS pos FROM ("
         "SELECT doc_id, line_no, CASE WHEN value <> '' AND rtrim(value, ' ') = '' THEN []::VARCHAR[] "
         "ELSE string_split(rtrim(value, ' '), ' ') END AS parts FROM lines))")


def with_views(body: str, *views: str) -> str:
    defs = {"readings": READINGS, "readings_shuffled": READINGS_SHUFFLED, "behaviors": BEHAVIORS,
            "logins": LOGINS, "lines": LINES, "words": WORDS}
    need = list(views)
    if "words" in need and "lines" not in need:
        need.insert(0, "lines")
    ctes = ",\n".join(f"{v} AS ({defs[v]})" for v in need)
    body = body.strip()
    sep = "\n" if body.upper().startswith("SELECT") else ",\n"
    return f"WITH {ctes}{sep}{body}"


def sliding_starts(t_ms: str, size_ms: int, slide_ms: int) -> str:
    """Window starts s with s <= t < s + size, slide-aligned to the epoch."""
    return f"unnest(range({t_ms} - {t_ms} % {slide_ms}, {t_ms} - {size_ms}, -{slide_ms}))"
