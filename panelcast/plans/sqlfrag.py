"""Shared DuckDB SQL fragments for the oracles (the same data model as ``plans.driver``)."""

EV = """ev AS (
  SELECT CAST(user_id % 24 AS INTEGER) AS entity_id, date_trunc('hour', ts) AS hour, ts, event_type, value,
         event_id, user_id
  FROM events)"""

PANEL = EV + """,
bounds AS (SELECT min(hour) AS lo, max(hour) AS hi FROM ev),
hours AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour FROM bounds),
ents AS (SELECT CAST(range AS INTEGER) AS entity_id FROM range(24)),
cell AS (
  SELECT entity_id, hour, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS y,
         count(*) AS n_events, avg(value) AS value_avg, max(value) AS value_max
  FROM ev GROUP BY entity_id, hour),
panel AS (
  SELECT e.entity_id, h.hour, CAST(date_diff('hour', TIMESTAMP '1970-01-01', h.hour) AS BIGINT) AS t,
         COALESCE(c.y, 0) AS y, COALESCE(c.n_events, 0) AS n_events,
         COALESCE(c.value_avg, 0.0) AS value_avg, COALESCE(c.value_max, 0.0) AS value_max
  FROM hours h CROSS JOIN ents e LEFT JOIN cell c ON c.entity_id = e.entity_id AND c.hour = h.hour)"""

IV = """iv AS (
  SELECT event_id, entity_id, ts AS start, ts + to_microseconds(CAST(round(value * 60 * 1000000) AS BIGINT)) AS "end"
  FROM ev WHERE event_type = 'error')"""

INTERVALS = EV + ",\n" + IV

EDGES = """edges AS (
  SELECT CAST(range AS INTEGER) AS src, CAST((range + o) % 24 AS INTEGER) AS dst
  FROM range(24) CROSS JOIN (VALUES (1), (23), (5)) AS offs(o))"""

REPORTS = """rep_all AS (
  SELECT doc_id, n_chars, DATE '2024-01-01' + CAST(3 * (doc_id % 15) AS INTEGER) AS day FROM documents),
reports AS (
  SELECT day, max(doc_id) AS doc_id, arg_max(n_chars, doc_id) AS n_chars FROM rep_all GROUP BY day)"""

TOPICS = """topics AS (
  SELECT vec_id, TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST(vec_id % 720 AS BIGINT)) AS hour,
         list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS vec
  FROM embeddings)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts)
