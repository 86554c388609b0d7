"""SQL of the queries in ``live``, for an independent engine on the same tables."""

from __future__ import annotations

from ..contract import REQUIRED_FIELDS
from .fixtures import DELAYED, LOST
from .oracle import (
    _ALERTS,
    _OFFSETS,
    _STAGES,
    CHECKED_EDGE,
    DIRTY,
    TIME,
    _exact,
    _json,
    _member,
    _observed,
    dirty,
)


def _late(stage: str) -> str:
    modulus, rest = DELAYED[stage]
    return f"CASE WHEN event_id % {modulus} = {rest} THEN 7200000 ELSE 0 END"


def _kept(stage: str) -> str:
    modulus, rest = LOST[stage]
    return f"event_id % {modulus} <> {rest}"


_LOGS = f"""ingest AS (SELECT event_id, ts, date_trunc('millisecond', ts) AS begun FROM events WHERE ts IS NOT NULL),
processed AS (SELECT event_id, ts, begun + to_milliseconds(event_id * 7919 % 90000 + 1 + {_late("process")}) AS t
  FROM ingest WHERE {_kept("process")}),
stored AS (SELECT event_id, ts, t + to_milliseconds(event_id * 104729 % 30000 + 1 + {_late("store")}) AS t
  FROM processed WHERE {_kept("store")}),
met AS (SELECT i.event_id, i.ts, p.t AS process_time, s.t AS store_time,
    CASE WHEN s.t IS NOT NULL THEN 'store' WHEN p.t IS NOT NULL THEN 'process' ELSE 'ingest' END AS last_stage
  FROM ingest i
  LEFT JOIN processed p ON p.event_id = i.event_id AND p.t BETWEEN i.ts AND i.ts + INTERVAL 1 HOUR
  LEFT JOIN stored s ON s.event_id = i.event_id AND s.t BETWEEN i.ts AND i.ts + INTERVAL 1 HOUR)"""

_VERSIONS = f"""WITH {dirty()}, {_observed("dirty", "event_id, event_type, ingest_ts,")},
shapes AS (SELECT event_id, event_type, ingest_ts, string_agg(field || ':' || type, '|' ORDER BY field) AS shape
  FROM observed GROUP BY 1, 2, 3),
counts AS (SELECT event_type, shape, date_trunc('day', ingest_ts) AS day, count(*) AS n, min(ingest_ts) AS first_seen,
  max(ingest_ts) AS last_seen FROM shapes GROUP BY 1, 2, 3),
islands AS (SELECT *, epoch_us(day) // 86400000000
  - row_number() OVER (PARTITION BY event_type, shape ORDER BY day) AS island FROM counts),
runs AS (SELECT event_type, shape, island, sum(n)::BIGINT AS n, min(first_seen) AS first_seen, max(last_seen) AS last_seen
  FROM islands GROUP BY 1, 2, 3),
lagged AS (SELECT *, lag(shape) OVER (PARTITION BY event_type ORDER BY first_seen, shape) AS before FROM runs),
listed AS (SELECT *, string_split(shape, '|') AS now, string_split(before, '|') AS old,
  list_transform(string_split(shape, '|'), lambda x: split_part(x, ':', 1)) AS names,
  list_transform(string_split(before, '|'), lambda x: split_part(x, ':', 1)) AS old_names FROM lagged)
SELECT event_type, md5(shape) AS version, strftime(first_seen, {TIME}) AS first_seen, strftime(last_seen, {TIME}) AS last_seen,
  n, CASE WHEN before IS NOT NULL THEN
    array_to_string(list_filter(names, lambda x: NOT list_contains(old_names, x)), '|') END AS added,
  CASE WHEN before IS NOT NULL THEN
    array_to_string(list_filter(old_names, lambda x: NOT list_contains(names, x)), '|') END AS removed,
  CASE WHEN before IS NOT NULL THEN array_to_string(list_transform(list_filter(now, lambda x: NOT list_contains(old, x)
      AND list_contains(old_names, split_part(x, ':', 1))), lambda x: split_part(x, ':', 1)), '|') END AS retyped
FROM listed"""

_MISFITS = f"""list_filter([CASE WHEN {_exact("price", 12)} IS NULL THEN 'price' END,
  CASE WHEN {_exact("tax_amount", 14)} IS NULL THEN 'tax_amount' END], lambda x: x IS NOT NULL)"""

LIVE: dict[str, str] = {
    "stream_latency": f"""WITH {_LOGS} SELECT event_id, last_stage,
      (epoch_us(process_time) // 1000) - (epoch_us(ts) // 1000) AS process_ms,
      (epoch_us(store_time) // 1000) - (epoch_us(ts) // 1000) AS store_ms FROM met""",
    "stream_latency_stages": f"""WITH {_LOGS},
      whole AS (SELECT epoch_us(ts) AS a, epoch_us(process_time) AS b, epoch_us(store_time) AS c FROM met
        WHERE last_stage = 'store'),
      spans AS (SELECT 'process' AS stage, (b - a) // 1000 AS ms FROM whole UNION ALL SELECT 'store', (c - b) // 1000 FROM whole
        UNION ALL SELECT 'total', (c - a) // 1000 FROM whole)
      SELECT stage, count(ms) AS n, max(ms) AS max_ms, quantile_disc(ms, 0.5) AS p50_ms, quantile_disc(ms, 0.95) AS p95_ms
      FROM spans WHERE ms IS NOT NULL GROUP BY 1""",
    "stream_silence": f"""WITH paced AS (SELECT event_type AS flow, ts,
        lag(ts) OVER (PARTITION BY event_type ORDER BY ts) AS before FROM events),
      gaps AS (SELECT * FROM paced WHERE ts > before + INTERVAL 2 HOUR),
      lasts AS (SELECT event_type AS flow, max(ts) AS last FROM events GROUP BY 1),
      found AS (SELECT flow, before + INTERVAL 2 HOUR AS moment, 'warning' AS severity, 'No records received' AS message FROM gaps
        UNION ALL SELECT flow, ts, 'success', 'Records received again' FROM gaps
        UNION ALL SELECT flow, last + INTERVAL 2 HOUR, 'warning', 'No records received' FROM lasts
          WHERE last + INTERVAL 2 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR)
      SELECT flow, strftime(moment, {TIME}) AS "at", severity, message FROM found""",
    "stream_progress": f"""WITH {DIRTY} SELECT 6 AS batches, count(*) AS n, count(*) AS n_checked,
      count(*) FILTER (WHERE is_valid) AS n_valid, 0 AS n_dropped,
      count(*) FILTER (WHERE is_valid) * 100.0::double / count(*) AS quality_pct FROM verdicts""",
    "schema_versions": _VERSIONS,
    "stream_schema_versions": _VERSIONS,
    "ingest_array_split": f"WITH {DIRTY} SELECT errors, count(*) AS n FROM verdicts GROUP BY 1",
    "latency_sketches": f"""WITH {_STAGES}, placed AS (SELECT time_bucket(INTERVAL 28 DAY, make_timestamp(placed * 1000),
        TIMESTAMP '1970-01-01') AS w, t_last - placed AS ms FROM times)
      SELECT strftime(w, {TIME}) AS window_start, count(ms) AS n, sum(ms)::bigint / count(ms) AS mean, max(ms) AS largest,
        true AS p50_holds, true AS p95_holds FROM placed GROUP BY w""",
    "stage_health": f"""WITH RECURSIVE {_ALERTS}, {_OFFSETS},
      lagging AS (SELECT 'partition ' || partition_id AS stage, produced - coalesce(consumed, -1) AS lag
        FROM ends LEFT JOIN seen USING (partition_id)),
      newest AS (SELECT 'flow ' || event_type AS stage, arg_max(severity, window_start) AS severity FROM alerts GROUP BY 1),
      failing AS (SELECT stage FROM lagging WHERE lag > 500 UNION ALL SELECT stage FROM newest WHERE severity = 'warning'),
      edges AS (SELECT stage AS source, 'validate' AS target FROM lagging UNION ALL SELECT 'validate', stage FROM newest
        UNION ALL SELECT stage, 'store' FROM newest UNION ALL SELECT 'store', 'validate'),
      stages AS (SELECT source AS stage FROM edges UNION SELECT target FROM edges),
      reach(stage, cause) AS (SELECT stage, stage FROM failing UNION SELECT e.target, r.cause FROM reach r
        JOIN edges e ON e.source = r.stage),
      causes AS (SELECT stage, string_agg(cause, '|' ORDER BY cause) AS causes, bool_or(cause = stage) AS own FROM reach GROUP BY 1)
      SELECT stage, CASE WHEN own THEN 'failing' WHEN causes IS NOT NULL THEN 'impaired' ELSE 'ok' END AS status,
        coalesce(causes, '') AS causes FROM stages LEFT JOIN causes USING (stage)""",
    "packed_verdicts": f"WITH {DIRTY} SELECT event_id, value, is_valid, errors FROM verdicts",
    "replay_quarantine": f"""WITH {DIRTY} SELECT event_id, {_json([_member(f) for f in REQUIRED_FIELDS])} AS value FROM clean
      WHERE event_id % 10 <> 0 AND event_id IN (SELECT v.event_id FROM verdicts v WHERE NOT v.is_valid)""",
    "lake_unfit": f"""WITH {CHECKED_EDGE}, judged AS (SELECT event_id, value, is_valid, errors, {_MISFITS} AS misfits FROM verdicts)
      SELECT event_id, value, CASE WHEN is_valid THEN array_to_string(
        list_transform(misfits, lambda x: 'Value does not fit its type: ' || x), '|') ELSE errors END AS errors
      FROM judged WHERE NOT is_valid OR len(misfits) > 0""",
}
