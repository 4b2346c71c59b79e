"""Batch SQL answers (DuckDB dialect) for the live queries.

An append-mode stream emits a window only once the watermark (latest event
time minus the delay) has passed its end, so the batch answer keeps the
windows and sessions that end at or before ``max(ts) - delay``.
"""

from __future__ import annotations

WM = "((SELECT max(ts) FROM events) - INTERVAL '10 minutes')"

STREAM_SQL: dict[str, str] = {
    "stream_tumbling_counts": f"""SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, event_type,
  count(*) AS n_events, round(sum(value), 6) AS sum_value
FROM (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, value FROM events)
WHERE window_start + INTERVAL '1 hour' <= {WM}
GROUP BY window_start, event_type""",
    "stream_sliding_counts": f"""SELECT window_start, window_start + INTERVAL '2 hours' AS window_end, event_type,
  count(*) AS n_events, round(sum(value), 6) AS sum_value
FROM (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, value FROM events
      UNION ALL
      SELECT time_bucket(INTERVAL '1 hour', ts) - INTERVAL '1 hour' AS window_start, event_type, value FROM events)
WHERE window_start + INTERVAL '2 hours' <= {WM}
GROUP BY window_start, event_type""",
    "stream_running_totals": """SELECT event_type, count(*) AS n_events, round(sum(value), 6) AS sum_value
FROM events GROUP BY event_type""",
    "stream_level_totals": """WITH placed AS (
  SELECT e.user_id, e.value, n.n_name, r.r_name FROM events e
  LEFT JOIN customer c ON e.user_id = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT 'total' AS level, '' AS key, count(*) AS n_events, round(sum(value), 6) AS sum_value FROM placed
UNION ALL SELECT 'community', r_name, count(*), round(sum(value), 6) FROM placed GROUP BY r_name
UNION ALL SELECT 'province', n_name, count(*), round(sum(value), 6) FROM placed GROUP BY n_name
UNION ALL SELECT 'box', CAST(user_id AS VARCHAR), count(*), round(sum(value), 6) FROM placed GROUP BY user_id""",
    "stream_turnout_rate": f"""WITH places AS (
  SELECT c_custkey, r_name AS community FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
census AS (
  SELECT community, count(*) AS census FROM orders JOIN places ON o_custkey = c_custkey GROUP BY community),
votes AS (
  SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, community, count(*) AS n_votes
  FROM events LEFT JOIN places ON user_id = c_custkey GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, votes.community, n_votes, census,
  n_votes / NULLIF(census, 0) * CAST(100 AS DOUBLE) AS turnout
FROM votes LEFT JOIN census ON votes.community = census.community
WHERE window_start + INTERVAL '1 hour' <= {WM}""",
    "stream_reported_gap": """SELECT event_type, count(*) AS n_boxes, round(sum(counter), 6) AS sum_counters,
  max(reported) AS reported_total, round(max(reported) - round(sum(counter), 6), 6) AS gap
FROM (SELECT event_type, user_id, max(value) AS counter, max(event_id) AS reported FROM events
      GROUP BY event_type, user_id)
GROUP BY event_type""",
    "stream_latest_counter": """SELECT user_id, max(value) AS counter, max(ts) AS last_seen, count(*) AS n_messages
FROM events GROUP BY user_id""",
    "stream_group_from_counters": """SELECT event_type, count(*) AS n_boxes, round(sum(counter), 6) AS sum_counters
FROM (SELECT event_type, user_id, max(value) AS counter FROM events GROUP BY event_type, user_id)
GROUP BY event_type""",
    "stream_windowed_group_counters": f"""SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, event_type,
  count(*) AS n_boxes, round(sum(counter), 6) AS sum_counters
FROM (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, event_type, user_id, max(value) AS counter
      FROM events GROUP BY 1, 2, 3)
WHERE window_start + INTERVAL '1 hour' <= {WM}
GROUP BY window_start, event_type""",
    "stream_dedup": "SELECT event_id, ts, user_id, event_type, value FROM events",
    "stream_sessions": f"""WITH marked AS (
  SELECT user_id, ts,
         CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL '30 minutes'
              THEN 1 ELSE 0 END AS brk
  FROM events),
numbered AS (
  SELECT user_id, ts, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid
  FROM marked)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '30 minutes' AS session_end, count(*) AS n_events
FROM numbered GROUP BY user_id, sid
HAVING max(ts) + INTERVAL '30 minutes' <= {WM}""",
    "stream_dedup_totals": f"""WITH at_levels AS (
  SELECT ts, value, 'total' AS level, '' AS key FROM events
  UNION ALL SELECT ts, value, 'region', event_type FROM events
  UNION ALL SELECT ts, value, 'box', CAST(user_id AS VARCHAR) FROM events)
SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, level, key,
  count(*) AS n_events, round(sum(value), 6) AS sum_value
FROM (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, level, key, value FROM at_levels)
WHERE window_start + INTERVAL '1 hour' <= {WM}
GROUP BY window_start, level, key""",
    # A batch drops what lies at or before the watermark that the batch before it closed with:
    # the latest time of all batches but the last one, less the delay.
    "stream_late_rows": """WITH span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
sent AS (
  SELECT ts, (epoch_us(ts) - lo) * 8 // (hi - lo + 1) + CASE WHEN event_id % 10 = 0 THEN 2 ELSE 0 END AS slice
  FROM events, span),
batches AS (SELECT slice, row_number() OVER (ORDER BY slice) - 1 AS batch_id, count(*) AS n, max(epoch_ms(ts)) AS latest
            FROM sent GROUP BY slice),
marks AS (SELECT *, max(latest) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - 600000 AS mark
          FROM batches)
SELECT batch_id, any_value(n) AS input_rows, count(*) FILTER (WHERE epoch_us(ts) <= mark * 1000) AS late_rows
FROM marks JOIN sent USING (slice) GROUP BY batch_id""",
    "stream_silent_boxes": f"""WITH seen AS (
  SELECT user_id, max(ts) AS last_seen, count(*) AS n_messages FROM events GROUP BY user_id),
listed AS (SELECT DISTINCT c_custkey FROM customer)
SELECT coalesce(c_custkey, user_id) AS user_id, last_seen, coalesce(n_messages, 0) AS n_messages, {WM} AS as_of,
  CASE WHEN c_custkey IS NULL THEN 'unlisted' WHEN user_id IS NULL THEN 'never'
       WHEN last_seen + INTERVAL '5 days' <= {WM} THEN 'silent' ELSE 'active' END AS status
FROM listed FULL JOIN seen ON c_custkey = user_id""",
    "stream_message_intake": """SELECT
  CASE WHEN reason IS NULL THEN ts END AS sent_at,
  CASE WHEN reason IS NULL THEN CAST(user_id AS VARCHAR) END AS mesa_id,
  CASE WHEN reason IS NULL THEN event_type END AS municipio_id,
  CASE WHEN reason IS NULL THEN event_id END AS mesa_participacion,
  CASE WHEN reason IS NULL AND event_id % 20 <> 6 THEN event_id END AS total_municipio,
  reason IS NOT NULL AND event_id % 20 <> 7 AS kept_raw, reason,
  CASE WHEN reason IS NULL THEN 'good' ELSE 'bad' END AS status
FROM (SELECT *, CASE event_id % 20 WHEN 1 THEN 'malformed' WHEN 7 THEN 'malformed' WHEN 2 THEN 'missing'
                WHEN 3 THEN 'negative' WHEN 4 THEN 'bad number' WHEN 5 THEN 'bad time' END AS reason FROM events)""",
    "stream_turnout_curve": f"""WITH places AS (
  SELECT c_custkey, n_name AS province, r_name AS community FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
cast_at AS (SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start, province, community
            FROM events LEFT JOIN places ON user_id = c_custkey),
votes AS (
  SELECT window_start, level, key, count(*) AS n_votes FROM (
    SELECT window_start, 'total' AS level, '' AS key FROM cast_at
    UNION ALL SELECT window_start, 'community', community FROM cast_at
    UNION ALL SELECT window_start, 'province', province FROM cast_at)
  WHERE window_start + INTERVAL '1 hour' <= {WM} GROUP BY ALL),
held AS (SELECT province, community FROM orders JOIN places ON o_custkey = c_custkey),
census AS (
  SELECT 'total' AS level, '' AS key, count(*) AS census FROM held
  UNION ALL SELECT 'community', community, count(*) FROM held GROUP BY community
  UNION ALL SELECT 'province', province, count(*) FROM held GROUP BY province),
sofar AS (
  SELECT *, CAST(sum(n_votes) OVER (PARTITION BY level, key ORDER BY window_start) AS BIGINT) AS votes_so_far FROM votes)
SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, sofar.level, sofar.key, n_votes, votes_so_far, census,
  votes_so_far / NULLIF(census, 0) * CAST(100 AS DOUBLE) AS turnout
FROM sofar LEFT JOIN census ON sofar.level = census.level AND sofar.key = census.key""",
}
