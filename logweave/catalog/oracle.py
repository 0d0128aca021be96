"""The same results in SQL, for comparison in another engine."""

from __future__ import annotations

EVENTS = ("SELECT CAST(user_id AS VARCHAR) AS key, event_type AS value, "
          "event_id AS seq FROM events")
BY_TYPE = ("SELECT event_type AS key, CAST(user_id AS VARCHAR) AS value, "
           "event_id AS seq FROM events")


def _unsigned(s: str) -> str:
    return (f"list_reduce(list_transform(string_split({s}, ''), "
            "lambda c: CAST(unicode(c) AS BIGINT)), "
            "lambda h, c: (h * 31 + c) % 4294967296)")


def _hash(s: str) -> str:
    u = _unsigned(s)
    return (f"CAST(CASE WHEN {u} >= 2147483648 THEN {u} - 4294967296 "
            f"ELSE {u} END AS INTEGER)")


def _odd(s: str) -> str:
    u = _unsigned(s)
    return f"({u} < 2147483648 AND {u} % 2 = 1)"


def _partition(key: str, n: int = 8) -> str:
    # 2^32 is a multiple of 8, so the sign plays no part
    return f"CAST({_unsigned(key)} % {n} AS INTEGER)"


def _upper(s: str) -> str:
    return f"upper(replace({s}, 'ß', 'SS'))"


def _frames(src: str, w: int, s: int, order: str = "seq",
            part: str = "key") -> str:
    """SELECT of src with n, win, evicted and prior."""
    def length(n):
        return (f"(CASE WHEN {n} <= {w} THEN {n} "
                f"ELSE {w + 1 - s} + ({n} - {w + 1}) % {s} END)")
    return f"""
    SELECT *, list_slice(a, len(a) - l + 1, len(a)) AS win,
           CASE WHEN l = p + 1 THEN []
                ELSE list_slice(a, len(a) - p, len(a) - l) END AS evicted,
           list_slice(a, len(a) - p, len(a) - 1) AS prior
    FROM (SELECT *, {length('n')} AS l, {length('(n - 1)')} AS p
          FROM (SELECT *, row_number() OVER (PARTITION BY {part}
                                             ORDER BY {order}) AS n,
                       list(value) OVER (PARTITION BY {part} ORDER BY {order}
                         ROWS BETWEEN {w} PRECEDING AND CURRENT ROW) AS a
                FROM ({src}) AS src) AS numbered) AS sized"""


def _window(src: str, w: int, s: int, cols: str = "seq",
            value: str = "array_to_string(win, '')") -> str:
    return (f"SELECT key, {value} AS value, {cols} "
            f"FROM ({_frames(src, w, s, cols)}) AS framed")


_STORED = f"""
SELECT key, value, seq, partition,
       row_number() OVER (PARTITION BY partition ORDER BY seq) - 1 AS "offset"
FROM (SELECT *, {_partition('key')} AS partition FROM ({EVENTS}) AS e) AS p"""

_LINES = r"""
SELECT doc_id, i - 1 AS line, parts[i] AS text FROM (
  SELECT doc_id, parts, unnest(range(1, keep + 1)) AS i FROM (
    SELECT doc_id, parts,
           len(parts) - CASE WHEN parts[len(parts)] = '' THEN 1 ELSE 0 END
             AS keep
    FROM (SELECT doc_id, regexp_split_to_array(text, '\r\n|\r|\n') AS parts
          FROM {table}) AS a) AS b) AS c"""


def _tokens(table: str) -> str:
    """Words with line and place; trailing empty words are not words."""
    return fr"""
SELECT words[i] AS value, doc_id, line, i - 1 AS word FROM (
  SELECT doc_id, line, words, unnest(range(1, keep + 1)) AS i FROM (
    SELECT doc_id, line, words,
           CASE WHEN text = '' THEN 1 ELSE coalesce(list_max(
             list_transform(range(1, len(words) + 1),
               lambda j: CASE WHEN words[j] <> '' THEN j ELSE 0 END)), 0) END
             AS keep
    FROM (SELECT *, regexp_split_to_array(text, '[ \t\n\x0b\f\r]') AS words
          FROM ({_LINES.format(table=table)}) AS l) AS a) AS b) AS c"""


_SINK_LINES = f"""
SELECT 'Partition: ' || partition || '.' || chr(9) || 'Offset: ' || "offset"
       || '.' || chr(9) || 'Key: ' || key || '.' || chr(9) || 'Value: ' || value
       AS line FROM ({_STORED}) AS s"""

_REKEYED = ("SELECT value || '-' || substr(key, 1, 1) AS key, value, seq "
            f"FROM ({EVENTS}) AS e")

_CHARS = """
SELECT key, chars[i] AS value, seq, i - 1 AS pos FROM (
  SELECT key, seq, chars, unnest(range(1, len(chars) + 1)) AS i
  FROM (SELECT key, seq, string_split(value, '') AS chars
        FROM ({src}) AS s WHERE value <> '') AS a) AS b"""

_DEMO = (f"SELECT key, {_upper('value')} AS value, seq "
         f"FROM ({_window(EVENTS, 3, 1)}) AS w")

_ODD_EVENTS = f"SELECT * FROM ({EVENTS}) AS e WHERE {_odd('key')}"

_FOUR = (f"SELECT key, {_upper('value')} AS value, seq, pos FROM ("
         + _window(_CHARS.format(src=_ODD_EVENTS), 4, 2, "seq, pos") + ") AS w")

_TWO = _window("SELECT substr(key, 1, 1) AS key, value, seq FROM ("
               + _window(EVENTS, 3, 1) + ") AS w1", 3, 2)

_LAST_PURCHASE = (f"SELECT key, max(seq) AS done FROM ({EVENTS}) AS e "
                  "WHERE value = 'purchase' GROUP BY key")

_VALUES = ("SELECT CAST(user_id AS VARCHAR) AS key, value, event_id AS seq "
           "FROM events")

_SNAPSHOT = f"""
SELECT key, n, array_to_string(win, '|') AS "window",
       array_to_string(win, '') AS value
FROM (SELECT *, max(n) OVER (PARTITION BY key) AS top
      FROM ({_frames(EVENTS, 5, 3)}) AS f) AS g WHERE n = top"""

_TEXT = f"""
SELECT key, {_upper('value')} AS value, doc_id, line, word FROM (
{_window("SELECT 'Key' || ((doc_id + line + word) % 5) AS key, value, doc_id, "
         f"line, word FROM ({_tokens('documents')}) AS t", 3, 1,
         "doc_id, line, word")}) AS w"""

_TURNS = "(SELECT conv_id || '/' || turn AS doc_id, text FROM conversations) AS turns"
_TURN_WORDS = f"SELECT doc_id || '/' || line AS key, value, word FROM ({_tokens(_TURNS)}) AS t"

_APPENDED = f"""
SELECT key, value, seq, partition,
       row_number() OVER (PARTITION BY partition ORDER BY part, seq) - 1
         AS "offset"
FROM (SELECT *, {_partition('key')} AS partition FROM (
  SELECT 0 AS part, * FROM ({EVENTS}) AS e UNION ALL
  SELECT 1, CAST(o_custkey AS VARCHAR), o_orderstatus, o_orderkey FROM orders
) AS u) AS p"""

_HOP = f"""
SELECT key, value, seq, partition,
       row_number() OVER (PARTITION BY partition ORDER BY seq) - 1 AS "offset"
FROM (SELECT *, {_partition('key')} AS partition FROM ({_window(EVENTS, 3, 1)}) AS w) AS p"""

_COUNTERS = f"""
SELECT 1 AS stage, count(*) AS records FROM ({_ODD_EVENTS}) AS e
UNION ALL SELECT s, n FROM (
  SELECT count(*) AS n FROM ({_CHARS.format(src=_ODD_EVENTS)}) AS c) AS k,
  (VALUES (2), (3), (4)) AS stages (s)"""

_REFUSALS = """
SELECT CAST(r_regionkey AS BIGINT) AS region, CAST(length AS BIGINT) AS length, fn AS "function",
       CASE WHEN length < 1
            THEN 'pipeline.length must be a positive integer'
            WHEN length > 1 THEN 'missing function.at.2'
            WHEN fn IS NULL THEN 'missing function.at.1'
            WHEN fn <> 'map' THEN 'unknown function \'\'' || fn || '\'\'' END AS why
FROM (SELECT r_regionkey, r_regionkey AS length, 'map' AS fn FROM region UNION ALL
      SELECT r_regionkey, 1, lower(r_name) FROM region UNION ALL
      SELECT r_regionkey, 1, NULL FROM region UNION ALL
      SELECT r_regionkey, 1, 'map' FROM region) AS d""".replace("\\'", "'")

# The greatest of each window, null where the window is empty.
_MAX_OF_SOME = _window(_VALUES, 3, 4, value="list_max(win)")

ORACLE = {
    # sources and sinks
    "read_log_events": _STORED,
    "read_partition_events": f"SELECT * FROM ({_STORED}) AS s "
                             "WHERE partition = 3",
    "append_log": _APPENDED,
    "append_retried": _APPENDED,
    "tokenize_documents": _tokens("documents"),
    "read_text_lines": _tokens("documents"),
    "assign_key_events": "SELECT 'Key' || (event_id % 5) AS key, "
                         "event_type AS value, event_id AS seq FROM events",
    "assign_partition_events": f"SELECT *, {_partition('key')} AS partition "
                               f"FROM ({EVENTS}) AS e",
    "assign_offset_events": _STORED,
    "format_sink_records": _SINK_LINES,
    "text_sink_lines": f"SELECT 'SINK RECORDS' AS line UNION ALL {_SINK_LINES}",
    # stateless operators
    "map_value": f"SELECT key, value || '@' || key AS value, seq "
                 f"FROM ({EVENTS}) AS e",
    "map_upper_documents": f"SELECT CAST(doc_id AS VARCHAR) AS key, "
                           f"{_upper('text')} AS value FROM documents",
    "map_multi": f"""
        SELECT key, value, seq, 0 AS pos FROM ({EVENTS}) AS e
        WHERE value <> 'error'
        UNION ALL
        SELECT 'copy-' || key, upper(value), seq, 1 FROM ({EVENTS}) AS e
        WHERE value = 'purchase'""",
    "map_multi_last_wins": f"""
        SELECT key, upper(value) AS value, seq FROM ({EVENTS}) AS e
        UNION ALL SELECT value, key, seq FROM ({EVENTS}) AS e""",
    "rekey_events": "SELECT value || '/' || length(key) AS key, value, seq "
                    f"FROM ({EVENTS}) AS e",
    "filter_predicate": f"SELECT * FROM ({EVENTS}) AS e "
                        "WHERE value <> 'error' AND length(key) > 1",
    "filter_odd_hash_events": _ODD_EVENTS,
    "filter_odd_hash_types": f"SELECT * FROM ({BY_TYPE}) AS e "
                             f"WHERE {_odd('key')}",
    "flatmap_table_events": f"""
        SELECT key, substr(value, 1, len(value) // 2) AS value, seq, 0 AS pos
        FROM ({EVENTS}) AS e WHERE value <> 'error' UNION ALL
        SELECT key, substr(value, len(value) // 2 + 1), seq, 1
        FROM ({EVENTS}) AS e WHERE value <> 'error' UNION ALL
        SELECT value, key, seq, 2 FROM ({EVENTS}) AS e WHERE value <> 'error'""",
    "map_arrow_events": f"""
        SELECT key, value, seq, 0 AS pos FROM ({EVENTS}) AS e WHERE value <> 'error'
        UNION ALL
        SELECT key || '+', upper(value), seq, 1 FROM ({EVENTS}) AS e WHERE value <> 'error'""",
    "window_arrow_aggregate": _window(EVENTS, 4, 2, value=(
        "list_reduce(win, lambda a, b: CASE WHEN len(b) >= len(a) THEN b ELSE a END)")),
    "java_hash_props": f"SELECT props AS key, event_id AS seq, "
                       f"{_hash('props')} AS hash FROM events",
    "flatmap_chars_events": _CHARS.format(src=EVENTS),
    "flatmap_multi": f"""
        SELECT key, value, seq, 0 AS entry, pos
        FROM ({_CHARS.format(src=EVENTS)}) AS c
        UNION ALL SELECT value, value, seq, 1, 0 FROM ({EVENTS}) AS e""",
    "flatmap_multi_last_wins": f"""
        SELECT value AS key, value, seq, 0 AS entry, 0 AS pos FROM ({EVENTS}) AS e
        UNION ALL SELECT value, key, seq, 0, 1 FROM ({EVENTS}) AS e""",
    # count windows
    "window_concat_3_1": f"""
        SELECT key, string_agg(value, '') OVER (
          PARTITION BY key ORDER BY seq
          ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS value, seq
        FROM ({EVENTS}) AS e""",
    "window_concat_5_3": _window(EVENTS, 5, 3),
    "window_tumbling": _window(EVENTS, 4, 4),
    "window_empty": _window(EVENTS, 3, 4),
    "window_wide": _window(EVENTS, 25, 10),
    "window_orders": _window(
        "SELECT CAST(o_custkey AS VARCHAR) AS key, o_orderstatus AS value, "
        "o_orderkey AS seq FROM orders", 3, 1),
    "window_conversations": _window(
        "SELECT CAST(conv_id AS VARCHAR) AS key, role AS value, turn AS seq "
        "FROM conversations", 2, 1),
    "window_large_keys": _window(BY_TYPE, 4, 3),
    "window_sum": _window(_VALUES, 5, 3, value="round(list_sum(win), 4)"),
    "window_sum_sliding": _window(_VALUES, 6, 1,
                                  value="round(list_sum(win), 4)"),
    "window_max": _window(_VALUES, 5, 1, value="round(list_max(win), 4)"),
    "window_min": _window(_VALUES, 4, 2, value="round(list_min(win), 4)"),
    "window_wide_sum": f"""
        SELECT key, round(sum(value) OVER (
          PARTITION BY key ORDER BY seq
          ROWS BETWEEN 999 PRECEDING AND CURRENT ROW), 4) AS value, seq
        FROM ({_VALUES}) AS e""",
    "window_wide_sum_sliding": _window(_VALUES, 700, 240, value="round(list_sum(win), 4)"),
    "window_wide_max": _window(_VALUES, 100, 30, value="round(list_max(win), 4)"),
    "window_wide_count": _window(BY_TYPE, 99, 100, value="len(win)"),
    "window_count": _window(EVENTS, 4, 3, value="len(win)"),
    "count_window_columns": f"""
        SELECT key, seq, n, array_to_string(win, '|') AS "window",
               array_to_string(evicted, '|') AS evicted,
               array_to_string(prior, '|') AS prior
        FROM ({_frames(EVENTS, 5, 3)}) AS f""",
    "evicted_values": f"""
        SELECT key, seq, array_to_string(evicted, '|') AS evicted
        FROM ({_frames(EVENTS, 3, 2)}) AS f""",
    "prior_window": f"""
        SELECT key, seq, array_to_string(prior, '|') AS prior
        FROM ({_frames(EVENTS, 3, 1)}) AS f""",
    "window_snapshot_events": _SNAPSHOT,
    "rekey_window": _window(_REKEYED, 3, 1),
    # whole pipelines
    "stages_demo": _DEMO,
    "stages_properties":
        f"SELECT key, {_upper('value')} AS value, seq, pos FROM ("
        + _CHARS.format(src=_window(EVENTS, 3, 1)) + ") AS c",
    "stages_four": _FOUR,
    "stages_two_windows": _TWO,
    "stages_text": _TEXT,
    "stages_empty_windows": _window(_MAX_OF_SOME, 3, 2, value=(
        "CASE WHEN len(win) > 0 THEN coalesce(CAST(list_max(list_transform(win, "
        "lambda x: CAST(x AS DOUBLE))) AS VARCHAR), 'none') ELSE 'none' END || '/' || len(win)")),
    "window_rekeyed_large": _window(
        f"SELECT 'all' AS key, value, seq FROM ({_window(EVENTS, 3, 1)}) AS w", 4, 3),
    "definitions_refused": _REFUSALS,
    "stages_workers": _FOUR,
    "stage_counters": _COUNTERS,
    "sink_overwritten": f"SELECT 'SINK RECORDS' AS line UNION ALL {_SINK_LINES}",
    "stage_hop": f"""
        SELECT key, value, seq, partition,
               row_number() OVER (PARTITION BY partition ORDER BY seq) - 1
                 AS "offset"
        FROM (SELECT *, {_partition('key', 4)} AS partition
              FROM ({_window(EVENTS, 3, 1)}) AS w) AS p""",
    # progress
    "catch_up_events": f"""
        SELECT w.key, w.value, w.seq FROM ({_window(EVENTS, 3, 1)}) AS w
        LEFT JOIN ({_LAST_PURCHASE}) AS d ON w.key = d.key
        WHERE d.done IS NULL OR w.seq > d.done""",
    "committed_offsets_events": f"""
        SELECT partition, max("offset") + 1 AS next_offset
        FROM ({_STORED}) AS s GROUP BY partition""",
    "consumer_lag_events": f"""
        SELECT partition, max("offset") + 1 AS end_offset,
               coalesce(max("offset") FILTER (value = 'purchase') + 1, 0)
                 AS next_offset,
               max("offset") + 1 - coalesce(
                 max("offset") FILTER (value = 'purchase') + 1, 0) AS lag
        FROM ({_STORED}) AS s GROUP BY partition""",
    # streams give what the batch gives
    "stream_window": _DEMO,
    "stream_stages": _FOUR,
    "stream_two_windows": _TWO,
    "stream_large_keys": _window(BY_TYPE, 4, 3),
    "stream_compacted": _window(EVENTS, 5, 3),
    "stream_stateless": f"SELECT key, {_upper('value')} AS value, seq "
                        f"FROM ({_ODD_EVENTS}) AS o",
    "stream_bounded_trigger": _window(EVENTS, 5, 3),
    "stream_workers": _window(EVENTS, 5, 3),
    "stream_failure": _DEMO,
    "stream_chain": _window(_window(EVENTS, 3, 1), 3, 2),
    "stream_text_window": f"SELECT key, {_upper('value')} AS value, word FROM ("
                          + _window(_TURN_WORDS, 3, 2, "word") + ") AS w",
    "stream_hop": _window(EVENTS, 3, 1),
    "stream_hop_partition": f"SELECT * FROM ({_HOP}) AS h WHERE partition = 3",
    "stream_hop_lag": f"""
        SELECT partition, max("offset") + 1 AS end_offset,
               (max("offset") + 1 + 3) // 4 AS next_offset,
               max("offset") + 1 - (max("offset") + 1 + 3) // 4 AS lag
        FROM ({_HOP}) AS h GROUP BY partition""",
    "stream_pinned": f"SELECT * FROM ({_DEMO}) AS d WHERE {_partition('key')} = 3",
    "stream_position_lag": f"""
        SELECT p.partition, coalesce(end_offset, 0) AS end_offset,
               coalesce(next_offset, 0) AS next_offset,
               coalesce(end_offset, 0) - coalesce(next_offset, 0) AS lag
        FROM (SELECT CAST(unnest(range(8)) AS INTEGER) AS partition) AS p
        LEFT JOIN (SELECT partition, count(*) AS end_offset FROM ({_APPENDED}) AS a
                   GROUP BY partition) AS e ON e.partition = p.partition
        LEFT JOIN (SELECT partition, count(*) AS next_offset FROM ({_STORED}) AS s
                   GROUP BY partition) AS n ON n.partition = p.partition""",
    "stream_sink_lines": f"SELECT 'SINK RECORDS' AS line UNION ALL {_SINK_LINES}",
    "stream_snapshot": _SNAPSHOT,
    "stream_text": f"SELECT key, {_upper('value')} AS value, word FROM ({_TURN_WORDS}) AS t",
    "stream_counters": _COUNTERS,
    "stream_rebuilt": _DEMO,
}
