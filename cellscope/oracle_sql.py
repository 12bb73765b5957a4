"""Reference SQL (DuckDB dialect) for every registered query.

Written independently of the DataFrame code, from the semantics of each model, so that the
two implementations check each other. Every statement starts from the base tables (here the
driver's `events`) through the same fixture CTE.
"""

from __future__ import annotations

TS_PATTERN = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"

FIXTURE = r"""
fx0 AS (
  SELECT event_id AS n, user_id AS u, ts,
         (user_id % 5 = 0 AND ts >= TIMESTAMP '2024-01-24 00:00:00' AND event_id % 3 <> 0) AS decayed
  FROM events
),
fx1 AS (
  SELECT n, u, ts, CASE WHEN decayed THEN 17 + n % 3 ELSE n % 20 END AS tm, n % 21 AS dm, n % 11 AS kd, (n * 31 + u * 17) % 101 AS rl,
         CASE WHEN u % 5 = 0 AND n % 2 = 0 THEN (u % 6) * 10 + 3 ELSE (n * 7 + u) % 60 END AS c
  FROM fx0
),
fx2 AS (
  SELECT *, (c % 10 = 3) AS deg,
    CASE WHEN tm < 7 THEN 'voice_call' WHEN tm < 17 THEN 'data_session' ELSE 'sms' END AS etype,
    CASE WHEN c % 5 = 0 THEN '3G' WHEN c % 5 = 4 THEN '5G' ELSE '4G' END AS tech,
    CASE WHEN dm <> 0 THEN 'clean' WHEN kd < 3 THEN 'null_subscriber'
         WHEN kd < 5 THEN 'bad_timestamp' WHEN kd < 7 THEN 'impossible_signal'
         WHEN kd < 9 AND tm < 17 THEN 'negative_duration'
         WHEN kd >= 9 AND tm BETWEEN 7 AND 16 THEN 'negative_volume'
         ELSE 'null_subscriber' END AS dirt
  FROM fx1
),
fx3 AS (
  SELECT *,
    CASE WHEN etype <> 'voice_call' THEN NULL
         WHEN rl < (CASE WHEN deg THEN 8 ELSE 1 END) THEN 'failed_setup'
         WHEN rl < (CASE WHEN deg THEN 33 ELSE 3 END) THEN 'dropped'
         ELSE 'completed' END AS cres,
    CASE tech WHEN '3G' THEN 3 WHEN '4G' THEN 25 ELSE 150 END AS tp_base,
    CASE tech WHEN '3G' THEN 90 WHEN '4G' THEN 40 ELSE 15 END AS lat_base
  FROM fx2
),
network_events AS (
  SELECT
    CAST(n AS VARCHAR) AS event_id,
    etype AS event_type,
    CASE WHEN dirt = 'bad_timestamp' THEN 'not-a-timestamp'
         ELSE replace(CAST(ts AS VARCHAR), ' ', 'T') END AS event_time_raw,
    CASE WHEN dirt = 'null_subscriber' THEN NULL ELSE CAST(u AS VARCHAR) END AS subscriber_id,
    '+99450***' || lpad(CAST(u % 10000 AS VARCHAR), 4, '0') AS subscriber_msisdn_masked,
    CASE WHEN u % 7 = 3 AND ts >= TIMESTAMP '2024-01-16 00:00:00' THEN 'postpaid'
         WHEN u % 10 < 6 THEN 'prepaid' WHEN u % 10 < 9 THEN 'postpaid'
         ELSE 'corporate' END AS subscriber_plan,
    CAST(DATE '1970-01-01' + CAST(18000 + u % 2000 AS INTEGER) AS DATE) AS subscriber_activation_date,
    'CELL-' || lpad(CAST(c AS VARCHAR), 4, '0') AS cell_id,
    'R' || CAST(c % 8 AS VARCHAR) AS cell_region,
    tech AS cell_radio_tech,
    CAST(CASE WHEN dirt = 'impossible_signal' THEN 1 + rl % 30
              WHEN deg THEN -104 - rl % 17 ELSE -84 - rl % 17 END AS DOUBLE) AS signal_dbm,
    CAST(CASE WHEN etype = 'sms' THEN NULL WHEN dirt = 'negative_duration' THEN -1 - rl
              WHEN cres = 'failed_setup' THEN 0 ELSE 1 + rl * 3 END AS INTEGER) AS duration_sec,
    cres AS call_result,
    CAST(CASE WHEN etype <> 'data_session' THEN NULL
              WHEN dirt = 'negative_volume' THEN -1.0e-2 - rl
              ELSE (rl * 37 + 25) / 100 END AS DOUBLE) AS data_volume_mb,
    CAST(CASE WHEN etype = 'data_session'
              THEN tp_base * (CASE WHEN deg THEN 3 ELSE 10 END) * (60 + rl) / 1000 END AS DOUBLE) AS avg_throughput_mbps,
    CAST(CASE WHEN etype = 'data_session'
              THEN lat_base * (CASE WHEN deg THEN 25 ELSE 10 END) * (60 + rl) / 1000 END AS DOUBLE) AS latency_ms,
    CASE WHEN n % 100 = 0 THEN '{"volte_enabled": true}'
         WHEN n % 100 = 50 THEN '{"volte_enabled": false}'
         WHEN n % 499 = 0 THEN '{"promo_code": "SPRING26"}'
         ELSE '{}' END AS extra,
    'raw/network_events/dt=' || strftime(ts, '%Y-%m-%d') || '/hr=' || strftime(ts, '%H')
      || '/p0_' || CAST(n - n % 200 AS VARCHAR) || '-' || CAST(n - n % 200 + 199 AS VARCHAR)
      || '.jsonl' AS _source_object_key,
    1704067200000 + n * 1000 AS _cdc_source_ts_ms,
    ts + INTERVAL 1 HOUR AS _loaded_at,
    n
  FROM fx3
)"""

STAGING = r"""
stg_typed AS (
  SELECT *,
    CASE WHEN regexp_matches(event_time_raw, '""" + TS_PATTERN + r"""')
         THEN TRY_CAST(event_time_raw AS TIMESTAMP) END AS event_time,
    TRY_CAST(json_extract_string(extra, '$.volte_enabled') AS BOOLEAN) AS volte_enabled
  FROM network_events
),
stg_flagged AS (
  SELECT *,
    list_filter([
      CASE WHEN event_time IS NULL THEN 'bad_timestamp' END,
      CASE WHEN subscriber_id IS NULL THEN 'missing_subscriber' END,
      CASE WHEN duration_sec < 0 THEN 'negative_duration' END,
      CASE WHEN data_volume_mb < 0 THEN 'negative_volume' END,
      CASE WHEN signal_dbm < -140 OR signal_dbm > -44 THEN 'signal_out_of_range' END
    ], lambda x: x IS NOT NULL) AS flags
  FROM stg_typed
),
stg AS (
  SELECT event_id, event_type, event_time, subscriber_id, subscriber_msisdn_masked,
    subscriber_plan, subscriber_activation_date, cell_id, cell_region, cell_radio_tech,
    CASE WHEN list_contains(flags, 'signal_out_of_range') THEN NULL ELSE signal_dbm END AS signal_dbm,
    duration_sec, call_result, data_volume_mb, avg_throughput_mbps, latency_ms, volte_enabled,
    extra, flags, _source_object_key, _cdc_source_ts_ms, _loaded_at, n
  FROM stg_flagged
),
valid AS (SELECT * FROM stg WHERE len(flags) = 0),
rejected AS (SELECT * FROM stg WHERE len(flags) > 0),
fct_voice AS (
  SELECT event_id, event_time, subscriber_id, cell_id, call_result, duration_sec, signal_dbm
  FROM valid WHERE event_type = 'voice_call'
),
fct_data AS (
  SELECT event_id, event_time, subscriber_id, cell_id, data_volume_mb, avg_throughput_mbps,
         latency_ms, signal_dbm
  FROM valid WHERE event_type = 'data_session'
),
dim_cell AS (
  SELECT cell_id, cell_region, cell_radio_tech, _loaded_at AS last_seen_at FROM (
    SELECT *, row_number() OVER (PARTITION BY cell_id
                                 ORDER BY _loaded_at DESC, event_time DESC, event_id DESC) AS rn
    FROM valid) WHERE rn = 1
),
now_ts AS (
  SELECT max(t) AS ts FROM (SELECT event_time AS t FROM fct_voice UNION ALL SELECT event_time AS t FROM fct_data)
),
plan_rows AS (
  SELECT subscriber_id, subscriber_plan, subscriber_msisdn_masked, subscriber_activation_date, event_time,
         row_number() OVER (PARTITION BY subscriber_id ORDER BY event_time, event_id) AS pos,
         row_number() OVER (PARTITION BY subscriber_id ORDER BY event_time, event_id)
           - row_number() OVER (PARTITION BY subscriber_id, subscriber_plan ORDER BY event_time, event_id) AS island
  FROM valid WHERE subscriber_id IS NOT NULL
),
plan_islands AS (
  SELECT subscriber_id, subscriber_plan AS plan, min(pos) AS first_pos, min(event_time) AS valid_from,
         max(subscriber_msisdn_masked) AS subscriber_msisdn_masked,
         max(subscriber_activation_date) AS subscriber_activation_date
  FROM plan_rows GROUP BY subscriber_id, subscriber_plan, island
),
dim_sub AS (
  SELECT subscriber_id, subscriber_msisdn_masked, plan, subscriber_activation_date, valid_from,
         lead(valid_from) OVER (PARTITION BY subscriber_id ORDER BY first_pos) AS valid_to,
         lead(valid_from) OVER (PARTITION BY subscriber_id ORDER BY first_pos) IS NULL AS is_current
  FROM plan_islands
),
cell_win AS (
  SELECT cell_id, TRUE AS is_voice, call_result, CAST(NULL AS DOUBLE) AS tput, CAST(NULL AS DOUBLE) AS lat
  FROM fct_voice
  WHERE event_time > (SELECT ts FROM now_ts) - INTERVAL 7 DAY AND event_time <= (SELECT ts FROM now_ts)
  UNION ALL
  SELECT cell_id, FALSE AS is_voice, NULL AS call_result, avg_throughput_mbps AS tput, latency_ms AS lat
  FROM fct_data
  WHERE event_time > (SELECT ts FROM now_ts) - INTERVAL 7 DAY AND event_time <= (SELECT ts FROM now_ts)
),
voice_by_cell AS (
  SELECT cell_id, count(*) AS voice_call_count,
         count(*) FILTER (WHERE call_result IN ('dropped', 'failed_setup')) AS dropped_or_failed_count
  FROM cell_win WHERE is_voice GROUP BY cell_id
),
data_by_cell AS (
  SELECT cell_id, count(*) AS data_session_count, avg(tput) AS avg_throughput_mbps, avg(lat) AS avg_latency_ms
  FROM cell_win WHERE NOT is_voice GROUP BY cell_id
),
cell_stats AS (
  SELECT cell_id, vc, bad, dc, tp, la,
         CASE WHEN vc = 0 THEN NULL ELSE bad * 1.0e0 / vc END AS dr
  FROM (SELECT cell_id, count(*) FILTER (WHERE is_voice) AS vc,
               count(*) FILTER (WHERE is_voice AND call_result IN ('dropped', 'failed_setup')) AS bad,
               count(*) FILTER (WHERE NOT is_voice) AS dc, avg(tput) AS tp, avg(lat) AS la
        FROM cell_win GROUP BY cell_id)
),
ranking AS (
  SELECT cell_id, cell_region, cell_radio_tech, CAST(vc AS BIGINT) AS voice_call_count,
         CAST(bad AS BIGINT) AS dropped_or_failed_count,
         CAST(round(CAST(dr AS DECIMAL(18, 9)), 4) AS DOUBLE) AS drop_rate,
         CAST(dc AS BIGINT) AS data_session_count,
         CAST(round(CAST(tp AS DECIMAL(18, 9)), 2) AS DOUBLE) AS avg_throughput_mbps,
         CAST(round(CAST(la AS DECIMAL(18, 9)), 2) AS DOUBLE) AS avg_latency_ms,
         CAST(round(score, 4) AS DOUBLE) AS quality_score,
         CAST(rank() OVER (ORDER BY score DESC) AS INTEGER) AS quality_rank
  FROM (SELECT d.cell_id, d.cell_region, d.cell_radio_tech, s.*,
               CAST(coalesce(s.dr, 0) * 100 + coalesce(s.la, 0) / 10.0e0 - coalesce(s.tp, 0) / 10.0e0
                    AS DECIMAL(18, 9)) AS score
        FROM dim_cell d JOIN cell_stats s ON s.cell_id = d.cell_id)
),
sub_ev AS (
  SELECT e.subscriber_id, e.event_time, e.call_result, e.latency_ms, c.cell_radio_tech AS tech
  FROM (SELECT subscriber_id, event_time, cell_id, call_result, CAST(NULL AS DOUBLE) AS latency_ms FROM fct_voice
        UNION ALL
        SELECT subscriber_id, event_time, cell_id, NULL AS call_result, latency_ms FROM fct_data) e
  LEFT JOIN dim_cell c ON c.cell_id = e.cell_id
  WHERE e.subscriber_id IS NOT NULL
),
sub_counts AS (
  SELECT subscriber_id,
    count(*) FILTER (WHERE event_time > (SELECT ts FROM now_ts) - INTERVAL 7 DAY
                       AND event_time <= (SELECT ts FROM now_ts)) AS l7,
    count(*) FILTER (WHERE event_time > (SELECT ts FROM now_ts) - INTERVAL 35 DAY
                       AND event_time <= (SELECT ts FROM now_ts) - INTERVAL 7 DAY) AS p28,
    count(*) FILTER (WHERE event_time > (SELECT ts FROM now_ts) - INTERVAL 14 DAY
                       AND event_time <= (SELECT ts FROM now_ts)
                       AND (call_result IN ('dropped', 'failed_setup')
                            OR (latency_ms > 100 AND tech IN ('4G', '5G')))) AS poor14
  FROM sub_ev GROUP BY subscriber_id
),
churn AS (
  SELECT c.subscriber_id, d.plan, CAST(c.l7 AS BIGINT) AS last_7_day_activity,
         round(c.p28 / 4.0e0, 2) AS trailing_4_week_weekly_avg_activity,
         CAST(c.poor14 AS BIGINT) AS poor_experience_count_14d,
         (c.p28 > 0 AND 20 * c.l7 <= 3 * c.p28) AS usage_drop_flag,
         c.poor14 >= 3 AS poor_experience_flag
  FROM sub_counts c JOIN dim_sub d ON d.subscriber_id = c.subscriber_id AND d.is_current
  WHERE c.p28 > 0 AND 20 * c.l7 <= 3 * c.p28 AND c.poor14 >= 3
)"""

STG_COLS = """event_id, event_type, event_time, subscriber_id, subscriber_msisdn_masked,
  subscriber_plan, subscriber_activation_date, cell_id, cell_region, cell_radio_tech, signal_dbm,
  duration_sec, call_result, data_volume_mb, avg_throughput_mbps, latency_ms, volte_enabled, extra,
  array_to_string(flags, ',') AS dq_flags, _source_object_key, _cdc_source_ts_ms, _loaded_at"""


def with_layers(select: str, extra_ctes: str = "") -> str:
    ctes = FIXTURE + "," + STAGING + ("," + extra_ctes if extra_ctes else "")
    return "WITH " + ctes + "\n" + select


QUERIES: dict[str, str] = {}


def _q(name: str, select: str, extra_ctes: str = "") -> None:
    QUERIES[name] = with_layers(select, extra_ctes)


_q("stg_events", f"SELECT {STG_COLS} FROM stg")
_q("stg_valid", f"SELECT {STG_COLS} FROM valid")
_q("stg_rejected", f"SELECT {STG_COLS} FROM rejected")
_q("stg_flag_counts",
   "SELECT flag, CAST(count(*) AS BIGINT) AS row_count FROM (SELECT unnest(flags) AS flag FROM stg) GROUP BY flag")
_q("fct_voice_call", "SELECT * FROM fct_voice")
_q("fct_data_session", "SELECT * FROM fct_data")
_q("dim_cell_site", "SELECT * FROM dim_cell")
_q("reference_time", "SELECT ts AS reference_time FROM now_ts")
_q("voice_agg", "SELECT cell_id, CAST(voice_call_count AS BIGINT) AS voice_call_count, "
                "CAST(dropped_or_failed_count AS BIGINT) AS dropped_or_failed_count FROM voice_by_cell")
_q("data_agg", "SELECT cell_id, CAST(data_session_count AS BIGINT) AS data_session_count, "
               "CAST(round(CAST(avg_throughput_mbps AS DECIMAL(18, 9)), 6) AS DOUBLE) AS avg_throughput_mbps, "
               "CAST(round(CAST(avg_latency_ms AS DECIMAL(18, 9)), 6) AS DOUBLE) AS avg_latency_ms FROM data_by_cell")
_q("cell_quality_ranking", "SELECT * FROM ranking")
_q("dim_subscriber", "SELECT * FROM dim_sub")
_q("churn_signals", "SELECT * FROM churn")
_q("subscriber_activity",
   "SELECT subscriber_id, CAST(l7 AS BIGINT) AS last_7_day_activity, "
   "round(p28 / 4.0e0, 2) AS trailing_4_week_weekly_avg_activity FROM sub_counts")
_q("poor_experience",
   "SELECT subscriber_id, CAST(poor14 AS BIGINT) AS poor_experience_count FROM sub_counts WHERE poor14 > 0")
_q("plan_as_of_event", """
SELECT e.event_id, e.event_type, e.event_time, e.subscriber_id, d.plan, d.valid_from
FROM (SELECT event_id, 'voice_call' AS event_type, event_time, subscriber_id FROM fct_voice
      UNION ALL
      SELECT event_id, 'data_session' AS event_type, event_time, subscriber_id FROM fct_data) e
LEFT JOIN dim_sub d
  ON d.subscriber_id = e.subscriber_id AND e.event_time >= d.valid_from
 AND (d.valid_to IS NULL OR e.event_time < d.valid_to)
WHERE e.subscriber_id IS NOT NULL""")
_q("fct_by_date", """
SELECT CAST(event_time AS DATE) AS event_date, CAST(count(*) AS BIGINT) AS row_count
FROM fct_voice GROUP BY 1""")


_q("cell_hourly_kpi", """
SELECT cell_id, date_trunc('hour', event_time) AS kpi_hour,
  CAST(count(*) FILTER (WHERE event_type = 'voice_call') AS BIGINT) AS call_attempts,
  CAST(count(*) FILTER (WHERE event_type = 'voice_call' AND call_result = 'dropped') AS BIGINT) AS dropped_calls,
  CAST(count(*) FILTER (WHERE event_type = 'voice_call' AND call_result = 'failed_setup') AS BIGINT) AS failed_setups,
  CAST(round(CAST(CASE WHEN count(*) FILTER (WHERE event_type = 'voice_call') = 0 THEN NULL
       ELSE count(*) FILTER (WHERE event_type = 'voice_call' AND call_result IN ('dropped', 'failed_setup')) * 1.0e0
            / count(*) FILTER (WHERE event_type = 'voice_call') END AS DECIMAL(18, 9)), 4) AS DOUBLE) AS drop_rate,
  CAST(count(*) FILTER (WHERE event_type = 'data_session') AS BIGINT) AS data_sessions,
  CAST(sum(CASE WHEN event_type = 'data_session' THEN CAST(data_volume_mb AS DECIMAL(18, 6)) END) AS DOUBLE) AS total_volume_mb,
  CAST(round(CAST(avg(CASE WHEN event_type = 'data_session' THEN avg_throughput_mbps END) AS DECIMAL(18, 9)), 4) AS DOUBLE) AS avg_throughput_mbps,
  round(quantile_cont(latency_ms, 0.95), 4) AS p95_latency_ms,
  CAST(round(CAST(avg(signal_dbm) AS DECIMAL(18, 9)), 4) AS DOUBLE) AS avg_signal_dbm,
  CAST(date_trunc('hour', event_time) AS DATE) AS kpi_date
FROM valid GROUP BY 1, 2""")

def _period_quality(level: str, period: str) -> str:
    return f"""
SELECT {level}, event_date, CAST(vc AS BIGINT) AS voice_call_count,
  CAST(bad AS BIGINT) AS dropped_or_failed_count,
  CAST(round(CAST(dr AS DECIMAL(18, 9)), 4) AS DOUBLE) AS drop_rate,
  CAST(dc AS BIGINT) AS data_session_count,
  CAST(round(CAST(tp AS DECIMAL(18, 9)), 2) AS DOUBLE) AS avg_throughput_mbps,
  CAST(round(CAST(lat AS DECIMAL(18, 9)), 2) AS DOUBLE) AS avg_latency_ms,
  CAST(round(score, 4) AS DOUBLE) AS quality_score,
  CASE WHEN greatest(dterm, lterm, lost) <= 0 THEN NULL WHEN dterm = greatest(dterm, lterm, lost) THEN 'drop_rate'
       WHEN lterm = greatest(dterm, lterm, lost) THEN 'latency' ELSE 'throughput' END AS kpi_at_fault,
  CAST(rank() OVER (PARTITION BY event_date ORDER BY score DESC) AS INTEGER) AS day_rank
FROM (
  SELECT *, CAST(dterm + lterm - tterm AS DECIMAL(18, 9)) AS score,
         CASE WHEN tp IS NULL THEN 0 ELSE max(tterm) OVER (PARTITION BY event_date) - tterm END AS lost FROM (
    SELECT *, CAST(coalesce(dr, 0) * 100 AS DECIMAL(18, 9)) AS dterm,
              CAST(coalesce(lat, 0) / 10.0e0 AS DECIMAL(18, 9)) AS lterm,
              CAST(coalesce(tp, 0) / 10.0e0 AS DECIMAL(18, 9)) AS tterm
    FROM (
      SELECT *, CASE WHEN vc = 0 THEN NULL ELSE bad * 1.0e0 / vc END AS dr FROM (
        SELECT {level}, CAST(date_trunc('{period}', event_time) AS DATE) AS event_date,
          count(*) FILTER (WHERE event_type = 'voice_call') AS vc,
          count(*) FILTER (WHERE event_type = 'voice_call' AND call_result IN ('dropped', 'failed_setup')) AS bad,
          count(*) FILTER (WHERE event_type = 'data_session') AS dc,
          avg(CASE WHEN event_type = 'data_session' THEN avg_throughput_mbps END) AS tp,
          avg(CASE WHEN event_type = 'data_session' THEN latency_ms END) AS lat
        FROM valid WHERE event_type IN ('voice_call', 'data_session') GROUP BY 1, 2))))"""


_q("region_quality", _period_quality("cell_region", "day"))
_q("cell_weekly_quality", _period_quality("cell_id", "week"))


def _check(name: str, model: str, column: str, severity: str, failing_sql: str) -> str:
    return (f"SELECT '{name}' AS check_name, '{model}' AS model, '{column}' AS column_name, "
            f"'{severity}' AS severity, CAST(({failing_sql}) AS BIGINT) AS failing_rows")


def _not_null(cte: str, model: str, column: str) -> str:
    return _check(f"not_null_{model}_{column}", model, column, "error",
                  f"SELECT count(*) FROM {cte} WHERE {column} IS NULL")


def _unique(cte: str, model: str, column: str) -> str:
    return _check(f"unique_{model}_{column}", model, column, "error",
                  f"SELECT count(*) FROM (SELECT {column} FROM {cte} WHERE {column} IS NOT NULL "
                  f"GROUP BY {column} HAVING count(*) > 1)")


def _accepted(cte: str, model: str, column: str, values) -> str:
    vals = ", ".join(f"'{v}'" for v in values)
    return _check(f"accepted_values_{model}_{column}", model, column, "error",
                  f"SELECT count(*) FROM {cte} WHERE {column} IS NOT NULL AND {column} NOT IN ({vals})")


def _rel(cte: str, model: str, column: str, pcte: str, pcol: str, pmodel: str) -> str:
    return _check(f"relationships_{model}_{column}_to_{pmodel}", model, column, "error",
                  f"SELECT count(*) FROM {cte} c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
                  f"(SELECT 1 FROM {pcte} p WHERE p.{pcol} = c.{column})")


def _checks(parts: list[str]) -> str:
    return ("SELECT *, CASE WHEN failing_rows = 0 THEN 'pass' WHEN severity = 'error' THEN 'fail' "
            "ELSE 'warn' END AS status FROM (" + "\nUNION ALL\n".join(parts) + ")")


STAGING_CHECKS = [_not_null("stg", "stg_network_events", "event_id"),
                  _unique("stg", "stg_network_events", "event_id")]
CURATED_NN_UNIQUE = [
    _not_null("dim_cell", "dim_cell_site", "cell_id"), _unique("dim_cell", "dim_cell_site", "cell_id"),
    _not_null("dim_sub", "dim_subscriber", "subscriber_id"), _not_null("dim_sub", "dim_subscriber", "valid_from"),
    _not_null("fct_voice", "fct_voice_call", "event_id"), _unique("fct_voice", "fct_voice_call", "event_id"),
    _not_null("fct_data", "fct_data_session", "event_id"), _unique("fct_data", "fct_data_session", "event_id"),
]
ACCEPTED = [_accepted("fct_voice", "fct_voice_call", "call_result", ("completed", "dropped", "failed_setup"))]
RELATIONSHIPS = [
    _rel("fct_voice", "fct_voice_call", "cell_id", "dim_cell", "cell_id", "dim_cell_site"),
    _rel("fct_voice", "fct_voice_call", "subscriber_id", "dim_sub", "subscriber_id", "dim_subscriber"),
    _rel("fct_data", "fct_data_session", "cell_id", "dim_cell", "cell_id", "dim_cell_site"),
    _rel("fct_data", "fct_data_session", "subscriber_id", "dim_sub", "subscriber_id", "dim_subscriber"),
]
SERVING_CHECKS = [
    _not_null("ranking", "vw_cell_quality_ranking", "cell_id"),
    _unique("ranking", "vw_cell_quality_ranking", "cell_id"),
    _not_null("ranking", "vw_cell_quality_ranking", "quality_rank"),
    _not_null("churn", "vw_subscriber_churn_signals", "subscriber_id"),
    _unique("churn", "vw_subscriber_churn_signals", "subscriber_id"),
]
CURATED_CHECKS = CURATED_NN_UNIQUE + ACCEPTED + RELATIONSHIPS

_q("dq_unique", _checks(STAGING_CHECKS + CURATED_NN_UNIQUE + SERVING_CHECKS))
_q("dq_accepted_values", _checks(ACCEPTED))
_q("dq_relationships", _checks(RELATIONSHIPS))
_q("dq_gate", """
SELECT 'curated' AS layer, CAST(count(*) AS BIGINT) AS checks_run,
  CAST(count(*) FILTER (WHERE status = 'fail') AS BIGINT) AS checks_failed,
  CAST(count(*) FILTER (WHERE status = 'warn') AS BIGINT) AS checks_warned,
  count(*) FILTER (WHERE status = 'fail') = 0 AS publish
FROM (""" + _checks(CURATED_CHECKS) + ")")

_LAYERS = [("raw", "network_events", "network_events"), ("staging", "stg_network_events", "stg"),
           ("staging", "stg_network_events_valid", "valid"), ("staging", "stg_network_events_rejected", "rejected"),
           ("curated", "dim_cell_site", "dim_cell"), ("curated", "dim_subscriber", "dim_sub"),
           ("curated", "fct_voice_call", "fct_voice"), ("curated", "fct_data_session", "fct_data"),
           ("serving", "vw_cell_quality_ranking", "ranking"), ("serving", "vw_subscriber_churn_signals", "churn")]
_q("layer_counts", "\nUNION ALL\n".join(
    f"SELECT '{layer}' AS layer, '{model}' AS model, CAST(count(*) AS BIGINT) AS row_count FROM {cte}"
    for layer, model, cte in _LAYERS))
_q("dq_completeness", _checks([_check(
    "raw_equals_valid_plus_rejected", "stg_network_events", "*", "error",
    "SELECT abs((SELECT count(*) FROM stg) - (SELECT count(*) FROM valid) - (SELECT count(*) FROM rejected))")]))
_q("dq_summary", """
SELECT 'flag' AS kind, flag AS name, CAST(count(*) AS BIGINT) AS failing_rows, 'reject' AS status
FROM (SELECT unnest(flags) AS flag FROM stg) GROUP BY flag
UNION ALL
SELECT 'test' AS kind, check_name AS name, failing_rows, status FROM (""" + _checks(STAGING_CHECKS + CURATED_CHECKS) + ")")
_q("dq_drift_keys", """
SELECT drift_key, CAST(count(*) AS BIGINT) AS row_count
FROM (SELECT unnest(json_keys(extra)) AS drift_key FROM stg)
WHERE drift_key NOT IN ('volte_enabled') GROUP BY drift_key""")
_q("stg_volte", "SELECT volte_enabled, CAST(count(*) AS BIGINT) AS row_count FROM stg GROUP BY volte_enabled")
_q("dq_freshness", """
SELECT newest_loaded_at, as_of, lag_seconds,
       CASE WHEN lag_seconds <= 7200 THEN 'pass' ELSE 'warn' END AS status
FROM (SELECT max(_loaded_at) AS newest_loaded_at, TIMESTAMP '2024-01-31 00:00:00' AS as_of,
             (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(_loaded_at))) / 1.0e6 AS lag_seconds
      FROM network_events)""")
_q("dq_reconcile", """
SELECT window_date, CAST(coalesce(source_rows, 0) AS BIGINT) AS source_rows,
  CAST(coalesce(raw_rows, 0) AS BIGINT) AS raw_rows,
  round((coalesce(source_rows, 0) - coalesce(raw_rows, 0)) * 1.0e0 / nullif(coalesce(source_rows, 0), 0), 6) AS gap_ratio,
  CASE WHEN abs((coalesce(source_rows, 0) - coalesce(raw_rows, 0)) * 1.0e0 / nullif(coalesce(source_rows, 0), 0)) > 0.02 THEN 'fail'
       WHEN abs((coalesce(source_rows, 0) - coalesce(raw_rows, 0)) * 1.0e0 / nullif(coalesce(source_rows, 0), 0)) > 0.005 THEN 'warn'
       ELSE 'pass' END AS status
FROM (SELECT CAST(ts AS DATE) AS window_date, count(*) AS source_rows FROM events GROUP BY 1) s
FULL OUTER JOIN (SELECT CAST(event_time AS DATE) AS window_date, count(*) AS raw_rows
                 FROM stg WHERE event_time IS NOT NULL GROUP BY 1) r USING (window_date)
WHERE window_date + INTERVAL 1 DAY <= (SELECT max(ts) FROM events)""")
_q("cdc_latency", """
SELECT CAST(_loaded_at AS DATE) AS load_date, CAST(count(*) AS BIGINT) AS row_count,
  round(quantile_cont(lat, 0.5), 3) AS p50_latency_s, round(quantile_cont(lat, 0.95), 3) AS p95_latency_s,
  round(max(lat), 3) AS max_latency_s
FROM (SELECT _loaded_at, (epoch_us(_loaded_at) - _cdc_source_ts_ms * 1000) / 1.0e6 AS lat
      FROM network_events WHERE _cdc_source_ts_ms IS NOT NULL)
GROUP BY 1""")
_q("degraded_recall", """
SELECT 6 AS k, CAST(count(*) AS BIGINT) AS ranked_cells,
  CAST(count(*) FILTER (WHERE degraded) AS BIGINT) AS degraded_in_top_k,
  round(count(*) FILTER (WHERE degraded) / 6.0e0, 4) AS precision_at_k
FROM ranking r
LEFT JOIN (SELECT cell_id, CAST(substr(cell_id, 6, 4) AS INTEGER) % 10 = 3 AS degraded FROM dim_cell) g
  USING (cell_id)
WHERE quality_rank <= 6""")

RECORD_COLS = """event_id, event_type, event_time_raw, subscriber_id, subscriber_msisdn_masked,
  subscriber_plan, subscriber_activation_date, cell_id, cell_region, cell_radio_tech, signal_dbm,
  duration_sec, call_result, data_volume_mb, avg_throughput_mbps, latency_ms"""
LANDED = r"""
landed AS (
  SELECT event_id, cell_region, _source_object_key, _cdc_source_ts_ms FROM network_events
  UNION ALL
  SELECT event_id, 'REPLAY' AS cell_region,
         'raw/network_events/dt=2024-12-31/hr=00/p0_replay.jsonl' AS _source_object_key, _cdc_source_ts_ms
  FROM network_events WHERE n % 97 = 0
),
objs AS (SELECT DISTINCT _source_object_key AS object_key FROM landed),
ledger AS (SELECT object_key FROM objs
           WHERE regexp_extract(object_key, 'dt=(\d{4}-\d{2}-\d{2})', 1) < '2024-01-16'),
first_delivery AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id
                                              ORDER BY _source_object_key, _cdc_source_ts_ms) AS rn
                 FROM landed) WHERE rn = 1
)"""

# change records as JSON text, written and decoded by DuckDB's own JSON functions
_FLAT = """'event_id', event_id, 'event_type', event_type, 'event_time_raw', event_time_raw, 'subscriber_id', subscriber_id,
  'subscriber_msisdn_masked', subscriber_msisdn_masked, 'subscriber_plan', subscriber_plan,
  'subscriber_activation_date', {activation}, 'cell_id', cell_id, 'cell_region', cell_region,
  'cell_radio_tech', cell_radio_tech, 'signal_dbm', signal_dbm, 'duration_sec', duration_sec, 'call_result', call_result,
  'data_volume_mb', data_volume_mb, 'avg_throughput_mbps', avg_throughput_mbps, 'latency_ms', latency_ms, 'extra', extra"""
_EPOCH_DAY = "date_diff('day', DATE '1970-01-01', subscriber_activation_date)"
WIRE = f"""
wire AS (SELECT CAST(CASE WHEN event_type <> 'sms'
    THEN json_object('before', NULL, 'after', json_object({_FLAT.format(activation=_EPOCH_DAY)}), 'source', json_object('ts_ms', _cdc_source_ts_ms), 'op', 'c')
    ELSE json_object({_FLAT.format(activation=_EPOCH_DAY)}, '__source_ts_ms', _cdc_source_ts_ms) END AS VARCHAR) AS value FROM network_events),
record AS (SELECT CASE WHEN value ->> '$.op' IS NOT NULL THEN value -> '$.after' ELSE CAST(value AS JSON) END AS r,
                  CAST(coalesce(value ->> '$.source.ts_ms', value ->> '$.__source_ts_ms') AS BIGINT) AS ts FROM wire)"""
_TYPES = {"signal_dbm": "DOUBLE", "duration_sec": "INTEGER", "data_volume_mb": "DOUBLE", "avg_throughput_mbps": "DOUBLE", "latency_ms": "DOUBLE"}
_DECODED = ", ".join(
    "DATE '1970-01-01' + CAST(r ->> '$.subscriber_activation_date' AS INTEGER) AS subscriber_activation_date" if c == "subscriber_activation_date"
    else f"CAST(r ->> '$.{c}' AS {_TYPES.get(c, 'VARCHAR')}) AS {c}" for c in (x.strip() for x in RECORD_COLS.split(",")))
_q("cdc_unwrap", f"SELECT {_DECODED}, CAST(json(r ->> '$.extra') AS VARCHAR) AS extra, ts AS _cdc_source_ts_ms FROM record", WIRE)

_q("flatten_events", """
SELECT r ->> '$.event_id' AS event_id, r ->> '$.event_type' AS event_type, r ->> '$.event_time' AS event_time_raw,
       r ->> '$.subscriber.subscriber_id' AS subscriber_id, r ->> '$.subscriber.msisdn_masked' AS subscriber_msisdn_masked,
       r ->> '$.subscriber.plan' AS subscriber_plan, CAST(r ->> '$.subscriber.activation_date' AS DATE) AS subscriber_activation_date,
       r ->> '$.cell.cell_id' AS cell_id, r ->> '$.cell.region' AS cell_region, r ->> '$.cell.radio_tech' AS cell_radio_tech,
       CAST(r ->> '$.signal_dbm' AS DOUBLE) AS signal_dbm, CAST(r ->> '$.duration_sec' AS INTEGER) AS duration_sec,
       r ->> '$.call_result' AS call_result, CAST(r ->> '$.data_volume_mb' AS DOUBLE) AS data_volume_mb,
       CAST(r ->> '$.avg_throughput_mbps' AS DOUBLE) AS avg_throughput_mbps, CAST(r ->> '$.latency_ms' AS DOUBLE) AS latency_ms,
       CAST(r -> '$.extra' AS VARCHAR) AS extra FROM nested""", """
nested AS (SELECT CAST(CAST(json_object('event_id', event_id, 'event_type', event_type, 'event_time', event_time_raw,
    'subscriber', json_object('subscriber_id', subscriber_id, 'msisdn_masked', subscriber_msisdn_masked, 'plan', subscriber_plan,
                              'activation_date', CAST(subscriber_activation_date AS VARCHAR)),
    'cell', json_object('cell_id', cell_id, 'region', cell_region, 'radio_tech', cell_radio_tech), 'signal_dbm', signal_dbm,
    'duration_sec', duration_sec, 'call_result', call_result, 'data_volume_mb', data_volume_mb,
    'avg_throughput_mbps', avg_throughput_mbps, 'latency_ms', latency_ms, 'extra', json(extra)) AS VARCHAR) AS JSON) AS r FROM network_events)""")

_q("epoch_day_decode", """
SELECT r ->> '$.event_id' AS event_id,
       CASE WHEN regexp_full_match(r ->> '$.subscriber_activation_date', '-?[0-9]+')
            THEN DATE '1970-01-01' + TRY_CAST(r ->> '$.subscriber_activation_date' AS INTEGER)
            ELSE TRY_CAST(r ->> '$.subscriber_activation_date' AS DATE) END AS subscriber_activation_date FROM dated""", f"""
dated AS (SELECT CAST(CAST(CASE WHEN event_type = 'sms' THEN json_object({_FLAT.format(activation='CAST(subscriber_activation_date AS VARCHAR)')})
    ELSE json_object({_FLAT.format(activation=_EPOCH_DAY)}) END AS VARCHAR) AS JSON) AS r FROM network_events)""")

_q("drift_extra", f"""
SELECT r ->> '$.event_id' AS event_id, key AS drift_key, CAST(drift -> key AS VARCHAR) AS drift_value
FROM (SELECT r, drift, unnest(json_keys(drift)) AS key FROM
      (SELECT r, json_merge_patch(CAST(r ->> '$.extra' AS JSON), json_object('probe_version', r -> '$.probe_version')) AS drift FROM drifted))""", f"""
drifted AS (SELECT CAST(CAST(json_object({_FLAT.format(activation=_EPOCH_DAY)}, 'probe_version', 'v2', 'inserted_at', CAST(_loaded_at AS VARCHAR),
    '__source_ts_ms', _cdc_source_ts_ms) AS VARCHAR) AS JSON) AS r FROM network_events)""")
_q("ingest_hour_partitions", """
SELECT strftime(epoch_ms(_cdc_source_ts_ms), '%Y-%m-%d') AS dt, strftime(epoch_ms(_cdc_source_ts_ms), '%H') AS hr,
       CAST(count(*) AS BIGINT) AS row_count
FROM network_events GROUP BY 1, 2""")
_q("raw_keep_first", "SELECT event_id, cell_region, _source_object_key FROM first_delivery", LANDED)
_q("load_ledger_skip", "SELECT object_key FROM objs WHERE object_key NOT IN (SELECT object_key FROM ledger)", LANDED)
_q("load_report", r"""
SELECT o.load_date, o.objects_seen, o.objects_loaded, o.objects_skipped,
       CAST(coalesce(r.rows_inserted, 0) AS BIGINT) AS rows_inserted
FROM (SELECT regexp_extract(object_key, 'dt=(\d{4}-\d{2}-\d{2})', 1) AS load_date,
             CAST(count(*) AS BIGINT) AS objects_seen,
             CAST(count(*) FILTER (WHERE object_key NOT IN (SELECT object_key FROM ledger)) AS BIGINT) AS objects_loaded,
             CAST(count(*) FILTER (WHERE object_key IN (SELECT object_key FROM ledger)) AS BIGINT) AS objects_skipped
      FROM objs GROUP BY 1) o
LEFT JOIN (
  SELECT regexp_extract(_source_object_key, 'dt=(\d{4}-\d{2}-\d{2})', 1) AS load_date, count(*) AS rows_inserted
  FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id
                                                   ORDER BY _source_object_key, _cdc_source_ts_ms) AS rn2
                       FROM landed WHERE _source_object_key NOT IN (SELECT object_key FROM ledger))
        WHERE rn2 = 1) b
  WHERE NOT EXISTS (SELECT 1 FROM landed t WHERE t.event_id = b.event_id
                      AND t._source_object_key IN (SELECT object_key FROM ledger))
  GROUP BY 1) r ON r.load_date = o.load_date""", LANDED)
_q("fct_incremental", """
SELECT 'drop' AS late_mode, * FROM (
  SELECT * FROM inc_target WHERE event_id NOT IN (SELECT event_id FROM inc_new_drop)
  UNION ALL SELECT * FROM inc_new_drop)
UNION ALL
SELECT 'upsert' AS late_mode, * FROM (
  SELECT * FROM inc_target
  UNION ALL
  SELECT * FROM fct_voice s WHERE NOT EXISTS (SELECT 1 FROM inc_target t WHERE t.event_id = s.event_id))""",
   """
inc_target AS (SELECT * FROM fct_voice WHERE event_time < TIMESTAMP '2024-01-16 00:00:00'),
inc_new_drop AS (
  SELECT * FROM fct_voice
  WHERE event_time > (SELECT coalesce(max(event_time), TIMESTAMP '1970-01-01 00:00:00') FROM inc_target)
)""")

_q("msisdn_mask", """SELECT CAST(n AS VARCHAR) AS event_id,
  CASE WHEN n % 6 <> 5 THEN '+99450***' || lpad(CAST(u % 10000 AS VARCHAR), 4, '0') END AS subscriber_msisdn_masked
FROM fx0""")
