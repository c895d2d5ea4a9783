"""SQL for DuckDB with the same results as the registered queries."""

from __future__ import annotations

from faultline.sources import synthetic

LOG_EVENTS = """
log_events AS (
  SELECT event_id AS id,
    concat(substr(h,1,8),'-',substr(h,9,4),'-',substr(h,13,4),'-',substr(h,17,4),'-',substr(h,21,12)) AS trace_id,
    concat(elem, '-service') AS service,
    concat('host-', lpad(cast(event_id % 10 + 1 AS varchar), 2, '0'), '.internal') AS host,
    CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARN' WHEN 'purchase' THEN 'DEBUG' ELSE 'INFO' END AS level,
    cast(date_trunc('millisecond', ts) AS timestamp) AS ts,
    concat(event_type, ' ', props) AS message,
    cast(floor(value) AS int) AS latency_ms,
    concat('/api/v1/', elem, '/', cast(event_id % 4 AS varchar)) AS endpoint
  FROM (SELECT *, md5(cast(event_id AS varchar)) AS h,
          CASE user_id % 5 WHEN 0 THEN 'auth' WHEN 1 THEN 'payment' WHEN 2 THEN 'order'
                           WHEN 3 THEN 'inventory' ELSE 'notification' END AS elem
        FROM events) e
)"""

# The feed of sources/driver_events.signed_latencies.
SIGNED = """
signed_events AS (
  SELECT * REPLACE (CASE WHEN id % 7 <> 0 THEN latency_ms - 150 END AS latency_ms) FROM log_events
)"""

# The retries of sources/driver_events.deliveries, with trace ids as stored.
DELIVERIES = """
deliveries AS (
  SELECT id * 4 + attempt AS id, trace_id, service, host, level,
    CASE WHEN id % 10 >= 5 THEN ts + attempt * INTERVAL 1 SECOND ELSE ts END AS ts,
    message, latency_ms, endpoint
  FROM (SELECT *, unnest(range(id % 4 + 1)) AS attempt FROM log_events)
)"""

# The damage of sources/driver_events.messages and the reason each kind of it is rejected for.
RECEIVED = """
received AS (
  SELECT *, CASE WHEN id % 32 <> 3 THEN ts END AS sent_at, concat('m', cast(id AS varchar)) AS message_id, unnest(range(1, (id // 16) % 4 + 2)) AS receive,
    CASE id % 16 WHEN 0 THEN 'level unknown' WHEN 1 THEN 'service missing' WHEN 2 THEN 'host too long'
      WHEN 3 THEN 'trace_id length' WHEN 4 THEN 'malformed body' WHEN 5 THEN 'ts missing or invalid' END AS reject_reason
  FROM log_events
)"""

COLUMNS = "id, trace_id, service, host, level, ts, message, latency_ms, endpoint"
STORED = f"{COLUMNS}, strftime(ts, '%Y-%m-%d') AS event_date"
ERRORS = "count(*) FILTER (level = 'ERROR')"
# The newest event closes windows that end no later than it less the delay.
CLOSED = "(SELECT max(ts) FROM log_events) - INTERVAL 10 MINUTE"


def _pct(part: str, total: str) -> str:
    return f"cast((20000 * {part} + {total}) // (2 * {total}) AS double) / 100"


def _rate(where: str = "TRUE", length: str = "5 minutes") -> str:
    return f"""
    SELECT service, time_bucket(INTERVAL '{length}', ts) AS window_start, count(*) AS total_events,
      {ERRORS} AS error_events, {_pct(ERRORS, 'count(*)')} AS error_rate_pct
    FROM log_events WHERE {where} GROUP BY ALL"""


def _p95(where: str = "TRUE", columns: str = "service, latency_ms AS p95_latency_ms") -> str:
    return f"""
    SELECT {columns}
    FROM (SELECT service, latency_ms, count(*) OVER (PARTITION BY service) AS cnt,
            row_number() OVER (PARTITION BY service ORDER BY latency_ms NULLS FIRST) AS rn
          FROM log_events WHERE {where})
    WHERE rn = cast(ceil(cast('0.95' AS decimal(3,2)) * cnt) AS bigint)"""


def _slowest(where: str = "TRUE") -> str:
    return f"""
    SELECT * FROM (
      SELECT *, dense_rank() OVER (PARTITION BY service ORDER BY avg_latency_ms DESC) AS latency_rank
      FROM (SELECT service, endpoint, count(*) AS call_count,
              cast((200 * cast(sum(latency_ms) AS bigint) + count(latency_ms)) // (2 * count(latency_ms)) AS double) / 100
                AS avg_latency_ms,
              max(latency_ms) AS max_latency_ms
            FROM log_events WHERE {where} GROUP BY service, endpoint))
    WHERE latency_rank <= 10"""


def _per_hour(where: str = "TRUE") -> str:
    return f"""
    SELECT service, strftime(ts, '%Y-%m-%d %H:00:00') AS hour_bucket, count(*) AS error_count
    FROM log_events WHERE level = 'ERROR' AND {where} GROUP BY ALL"""


def _first(keys: str, order: str, source: str) -> str:
    return f"""
    SELECT * EXCLUDE rn FROM (
      SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"""


def _between(lo: str, hi: str, service: str | None = None) -> str:
    only = f" AND service = '{service}'" if service else ""
    return f"ts >= TIMESTAMP '{lo}' AND ts < TIMESTAMP '{hi}'{only}"


def _schema() -> str:
    rows = [
        ("id", "bigint", None, "id IS NULL"),
        ("trace_id", "string", "trace_id", "trace_id IS NULL OR length(trace_id) <> 36"),
        ("service", "string", "service", "service IS NULL OR length(service) > 64"),
        ("host", "string", "host", "host IS NULL OR length(host) > 64"),
        ("level", "string", "level", "level IS NULL OR level NOT IN ('DEBUG', 'INFO', 'WARN', 'ERROR')"),
        ("ts", "timestamp_ntz", None, "ts IS NULL"),
        ("message", "string", "message", "FALSE"),
        ("latency_ms", "int", None, "FALSE"),
        ("endpoint", "string", "endpoint", "length(endpoint) > 128"),
    ]
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, '{kind}' AS declared_type, '{kind}' AS stored_type,
        count(*) FILTER ({name} IS NULL) AS null_rows,
        cast({f'max(length({text}))' if text else '0'} AS int) AS max_length,
        count(*) FILTER ({broken}) AS broken_rows FROM log_events"""
        for name, kind, text, broken in rows
    )


_HOURS = f"""
hours AS (
  SELECT service, time_bucket(INTERVAL '1 hour', ts) AS window_start, count(*) AS total_events, {ERRORS} AS error_events
  FROM log_events GROUP BY ALL
)"""

# Breaching hours with the number of the episode they belong to.
_EPISODES = """
breaches AS (
  SELECT *, window_start - lag(window_start) OVER w IS DISTINCT FROM INTERVAL 1 HOUR AS starts
  FROM (SELECT * FROM hours WHERE total_events >= 2
          AND cast((20000 * error_events + total_events) // (2 * total_events) AS double) / 100 > 20.0)
  WINDOW w AS (PARTITION BY service ORDER BY window_start)
)"""

_SESSIONS = """
    SELECT service, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS error_events
    FROM (SELECT *, sum(starts) OVER (PARTITION BY service ORDER BY ts, id) AS session
          FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY service ORDER BY ts, id) <= INTERVAL 30 MINUTE
                               THEN 0 ELSE 1 END AS starts
                FROM log_events WHERE level = 'ERROR'))
    GROUP BY service, session"""


def _alerts(closed: str = "TRUE") -> str:
    rules = [
        ("hourly errors", "TRUE", 60, 2, 30.0),
        ("daily errors", "TRUE", 1440, 20, 22.0),
        ("payment errors", "service = 'payment-service'", 15, 1, 10.0),
    ]
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS rule, service, window_start, cast({minutes} AS int) AS window_minutes,
          total_events, error_events, error_rate_pct
        FROM ({_rate(f'{only}', f'{minutes} minutes')})
        WHERE total_events >= {least} AND error_rate_pct > {most}
          AND {closed.format(end=f"window_start + INTERVAL {minutes} MINUTE")}"""
        for name, only, minutes, least, most in rules
    )


_ROLLUP = """
    SELECT service, level, time_bucket(INTERVAL '1 minute', ts) AS minute, count(*) AS event_count,
      count(latency_ms) AS latency_count, cast(sum(latency_ms) AS bigint) AS latency_sum, max(latency_ms) AS latency_max
    FROM log_events GROUP BY ALL"""

_ALERT_PAST = f"""
    SELECT service, count(*) AS total_events, {ERRORS} AS error_events, {_pct(ERRORS, 'count(*)')} AS error_rate_pct
    FROM log_events WHERE ts BETWEEN TIMESTAMP '2024-01-15' AND TIMESTAMP '2024-01-16' GROUP BY service"""


def _synthetic(seed: int = 42) -> str:
    """The generator of sources/synthetic.py, one event for each of the table's."""
    services, calls = list(synthetic.SERVICES), [[f"/api/v1/{a}/{c}" for c in cs] for a, cs in synthetic.CALLS.items()]

    def u(salt: int) -> str:
        digits = f"substr(md5(concat('{seed}:{salt // 2}:', id)), {1 + 16 * (salt % 2)}, 13)"
        return f"((('0x' || {digits})::BIGINT::DOUBLE + 0.5) / {float(2**52)!r}::DOUBLE)"

    def pick(values, salt: int) -> str:
        return f"{values}[cast(floor({u(salt)} * {len(values)}) AS int) + 1]"

    levels = " ".join(f"WHEN {u(3)} < {bound}::DOUBLE THEN '{name}'" for name, bound in synthetic.LEVEL_BOUNDS)
    trace = ", '-', ".join(f"substr(h, {at}, {n})" for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"""
    SELECT id, trace_id, service, host, level, ts, latency_ms, endpoint,
      concat(split_part(endpoint, '/', 5), ' ', CASE level WHEN 'ERROR' THEN 'failed' WHEN 'WARN' THEN 'was slow' WHEN 'INFO' THEN 'done'
        ELSE 'traced' END, ' after=', latency_ms, 'ms n=', id) AS message
    FROM (
      SELECT id, concat({trace}) AS trace_id, {services}[s] AS service,
        printf('host-%02d.ec2.internal', cast(floor({u(2)} * {synthetic.HOSTS}) AS int) + 1) AS host, level,
        TIMESTAMP '{synthetic.PERIOD_END}' - INTERVAL {synthetic.PERIOD_SECONDS} SECOND
          + to_milliseconds(cast(floor({u(4)} * {synthetic.PERIOD_SECONDS * 1000}) AS bigint)) AS ts,
        cast(floor(exp({synthetic.LATENCY_MU}::DOUBLE + {synthetic.LATENCY_SIGMA}::DOUBLE * sqrt(-2 * ln({u(6)})) * cos(2 * pi() * {u(7)}))) AS int)
          + CASE WHEN level = 'ERROR' THEN {pick(list(synthetic.ERROR_PENALTIES), 8)} ELSE 0 END AS latency_ms,
        {calls}[s][cast(floor({u(5)} * 4) AS int) + 1] AS endpoint
      FROM (SELECT id, md5(concat('{seed}:', id)) AS h, cast(floor({u(1)} * {len(services)}) AS int) + 1 AS s,
              CASE {levels} ELSE 'DEBUG' END AS level
            FROM log_events))"""


_PROFILE = """
        SELECT strftime(d, 'p%Y%m%d') AS partition_name, cast(date_diff('day', DATE '1970-01-01', d) + 719529 AS int) AS less_than_days,
          strftime(d, '%Y-%m-%d') AS event_date, row_count, first_ts, last_ts
        FROM (SELECT cast(ts AS date) AS d, count(*) AS row_count, min(ts) AS first_ts, max(ts) AS last_ts
              FROM log_events GROUP BY ALL)"""

_ON_EVENTS = {
    "scan_events": f"SELECT {COLUMNS} FROM log_events",
    "append_events": f"SELECT {STORED} FROM log_events",
    "layout_daily": f"SELECT {STORED} FROM log_events",
    "copy_flat": f"SELECT {COLUMNS} FROM log_events",
    "overflow_dates": """
        SELECT strftime(d, '%Y-%m-%d') AS event_date, row_count,
          CASE WHEN d < DATE '2024-01-02' THEN 'before' ELSE 'after' END AS side,
          concat('p', strftime(d, '%Y%m%d')) AS partition_name, strftime(d + INTERVAL 1 DAY, '%Y-%m-%d') AS less_than
        FROM (SELECT cast(ts AS date) AS d, count(*) AS row_count FROM log_events GROUP BY ALL)
        WHERE d < DATE '2024-01-02' OR d > DATE '2024-01-25'""",
    "retain_days": f"""
        SELECT {STORED} FROM log_events
        WHERE cast(ts AS date) >= (SELECT max(cast(ts AS date)) FROM log_events) - INTERVAL 7 DAY""",
    "partition_profile": _PROFILE,
    "stored_profile": _PROFILE,
    "stored_row_count": "SELECT count(*) AS total_count FROM log_events",
    "p95_from_rollup": _p95(),
    "p95_from_rollup_range": _p95("ts >= TIMESTAMP '2024-01-08 10:17:00' AND ts < TIMESTAMP '2024-01-15 03:05:00'"),
    "copy_check": """
        SELECT count(*) AS events_count, count(*) AS copy_count, TRUE AS same_count, TRUE AS same_content FROM log_events""",
    "scalar_functions": """
        SELECT id, cast(floor(epoch(ts)) AS bigint) AS unix_seconds,
          make_timestamp(cast(floor(epoch(ts) / 300) AS bigint) * 300 * 1000000) AS five_minutes,
          cast(ceil(cast('0.95' AS decimal(3,2)) * id) AS bigint) AS rank,
          cast((200 * cast(latency_ms AS bigint) + 7) // 14 AS double) / 100 AS weekly_ms,
          coalesce(nullif(latency_ms, 0), -1) AS nonzero_ms,
          CASE WHEN level = 'ERROR' THEN 1 ELSE 0 END AS is_error, strftime(ts, '%Y-%m-%d %H:00:00') AS hour_text,
          cast(date_diff('day', DATE '1970-01-01', cast(ts AS date)) + 719528 AS int) AS day_number,
          strftime(ts + INTERVAL 8 DAY, 'p%Y%m%d') AS partition_ahead,
          cast(list_position(['DEBUG', 'INFO', 'WARN', 'ERROR'], level) AS int) AS level_rank
        FROM log_events""",
    "row_count": "SELECT count(*) AS total_count FROM log_events",
    "schema_check": _schema(),
    "pruned_range": f"SELECT {COLUMNS} FROM log_events WHERE {_between('2024-01-10 06:00:00', '2024-01-12 18:00:00')}",
    "range_lookup": f"""
        SELECT id, trace_id, service, level, ts, latency_ms, endpoint FROM log_events
        WHERE {_between('2024-01-15 12:00:00', '2024-01-15 14:00:00', 'inventory-service')} ORDER BY ts, id LIMIT 100""",
    "error_lookup": f"""
        SELECT id, trace_id, service, level, ts, latency_ms, endpoint, message FROM log_events
        WHERE level = 'ERROR' AND {_between('2024-01-15', '2024-01-16', 'notification-service')} ORDER BY ts, id LIMIT 100""",
    "window_events": f"""
        SELECT {COLUMNS} FROM log_events
        WHERE {_between('2024-01-15 14:00:00', '2024-01-15 15:00:00', 'payment-service')}""",
    "clustered_lookup": f"SELECT {COLUMNS} FROM log_events WHERE {_between('2024-01-15', '2024-01-16', 'payment-service')}",
    "error_rate_5min": _rate(),
    "error_rate_5min_service_day": _rate(_between("2024-01-10", "2024-01-11", "payment-service")),
    "p95_rownumber": _p95(columns="service, rn, cnt, latency_ms AS p95_latency_ms"),
    "p95_histogram": _p95(),
    "p95_service_week": _p95(_between("2024-01-08", "2024-01-15", "order-service")),
    "p95_disc": """
        SELECT service, cast(percentile_disc(0.95) WITHIN GROUP (ORDER BY latency_ms) AS int) AS p95_latency_ms
        FROM log_events WHERE latency_ms IS NOT NULL GROUP BY service""",
    "p95_approx_error": "SELECT DISTINCT service, TRUE AS within_one_percent FROM log_events WHERE latency_ms IS NOT NULL",
    "slowest_endpoints_signed": """
        SELECT * FROM (
          SELECT *, dense_rank() OVER (PARTITION BY service ORDER BY avg_latency_ms DESC) AS latency_rank
          FROM (SELECT service, endpoint, calls AS call_count, max_latency_ms,
                  sign(total) * cast((200 * abs(total) + n) // (2 * n) AS double) / 100 AS avg_latency_ms
                FROM (SELECT service, endpoint, count(*) AS calls, cast(sum(latency_ms) AS bigint) AS total, count(latency_ms) AS n,
                        max(latency_ms) AS max_latency_ms
                      FROM signed_events GROUP BY service, endpoint)))
        WHERE latency_rank <= 10""",
    "latency_summary_signed": """
        SELECT service, endpoint, median(latency_ms) AS median_latency_ms, min(latency_ms) AS min_latency_ms,
          max(latency_ms) AS max_latency_ms
        FROM signed_events WHERE latency_ms IS NOT NULL GROUP BY service, endpoint""",
    "latency_row_numbers": """
        SELECT id, service, latency_ms, count(*) OVER (PARTITION BY service) AS cnt,
          row_number() OVER (PARTITION BY service ORDER BY latency_ms NULLS FIRST, id) AS rn
        FROM log_events""",
    "slowest_endpoints": _slowest(),
    "slowest_endpoints_service_week": _slowest(_between("2024-01-08", "2024-01-15", "auth-service")),
    "errors_per_hour": _per_hour(),
    "errors_per_hour_service_week": _per_hour(_between("2024-01-08", "2024-01-15", "payment-service")),
    "alert_error_rate": f"""
        SELECT service, count(*) AS total_events, {ERRORS} AS error_events, {_pct(ERRORS, 'count(*)')} AS error_rate_pct
        FROM log_events WHERE ts >= (SELECT max(ts) FROM log_events) - INTERVAL 24 HOUR GROUP BY service""",
    "alert_error_rate_past": _ALERT_PAST,
    "alert_from_rollup": f"""
        SELECT service, count(*) AS total_events, {ERRORS} AS error_events, {_pct(ERRORS, 'count(*)')} AS error_rate_pct
        FROM log_events WHERE ts >= TIMESTAMP '2024-01-15 00:01:00' AND ts < TIMESTAMP '2024-01-16 00:01:00' GROUP BY service""",
    "error_lookup_by_level": f"""
        SELECT id, trace_id, service, level, ts, latency_ms, endpoint, message FROM log_events
        WHERE level = 'ERROR' AND {_between('2024-01-15', '2024-01-16', 'notification-service')} ORDER BY ts, id LIMIT 100""",
    "rollup_incremental": _ROLLUP,
    "idempotent_append_trace": f"SELECT {STORED} FROM (SELECT * REPLACE (id * 4 AS id) FROM log_events)",
    "synthetic_events": _synthetic(),
    "latency_summary": """
        SELECT service, endpoint, median(latency_ms) AS median_latency_ms, min(latency_ms) AS min_latency_ms,
          max(latency_ms) AS max_latency_ms
        FROM log_events WHERE latency_ms IS NOT NULL GROUP BY service, endpoint""",
    "latency_pivot": """
        SELECT service, endpoint, median(latency_ms) FILTER (level = 'DEBUG') AS debug,
          median(latency_ms) FILTER (level = 'INFO') AS info, median(latency_ms) FILTER (level = 'WARN') AS warn,
          median(latency_ms) FILTER (level = 'ERROR') AS error
        FROM log_events WHERE latency_ms IS NOT NULL GROUP BY service, endpoint""",
    "latency_change": """
        SELECT *, after_ms / nullif(before_ms, 0) AS ratio,
          CASE WHEN after_ms < cast(0.9 AS double) * before_ms THEN 'better'
               WHEN after_ms <= cast(1.1 AS double) * before_ms THEN 'same' ELSE 'worse' END AS verdict
        FROM (SELECT service, endpoint, median(latency_ms) FILTER (ts < TIMESTAMP '2024-01-16') AS before_ms,
                median(latency_ms) FILTER (ts >= TIMESTAMP '2024-01-16') AS after_ms
              FROM log_events GROUP BY service, endpoint)
        WHERE before_ms IS NOT NULL AND after_ms IS NOT NULL""",
    "silent_services": """
        SELECT service, coalesce(n, 0) AS total_events, n IS NULL AS silent
        FROM (SELECT DISTINCT service FROM log_events) LEFT JOIN
          (SELECT service, count(*) AS n FROM log_events
           WHERE ts >= (SELECT max(ts) FROM log_events) - INTERVAL 1 HOUR GROUP BY service) USING (service)""",
    "level_mix": f"""
        SELECT *, abs(share_pct - expected_pct) <= 1.0 AS within_tolerance
        FROM (SELECT level, cast(list_position(['DEBUG', 'INFO', 'WARN', 'ERROR'], level) AS int) AS level_rank, row_count,
                {_pct('row_count', 'total')} AS share_pct,
                cast(CASE level WHEN 'ERROR' THEN 5 WHEN 'WARN' THEN 15 WHEN 'INFO' THEN 60 WHEN 'DEBUG' THEN 20 END AS double)
                  AS expected_pct
              FROM (SELECT level, count(*) AS row_count FROM log_events GROUP BY level),
                   (SELECT count(*) AS total FROM log_events))""",
    "rolling_errors": """
        SELECT id, service, ts, cast(sum(CASE WHEN level = 'ERROR' THEN 1 ELSE 0 END) OVER (
            PARTITION BY service ORDER BY ts RANGE BETWEEN INTERVAL 5 MINUTE PRECEDING AND CURRENT ROW) AS bigint)
          AS errors_in_window
        FROM log_events""",
    "sliding_error_rate": f"""
        SELECT service, window_start, count(*) AS total_events, {ERRORS} AS error_events,
          {_pct(ERRORS, 'count(*)')} AS error_rate_pct
        FROM (SELECT service, level, time_bucket(INTERVAL '1 minute', ts) - unnest(range(5)) * INTERVAL 1 MINUTE AS window_start
              FROM log_events)
        GROUP BY service, window_start""",
    "rollup_minute": _ROLLUP,
    "error_rate_from_rollup": _rate(),
    "errors_per_hour_from_rollup": _per_hour(),
    "threshold_alerts": _alerts(),
    "error_sessions": _SESSIONS,
    "stream_error_rate": f"SELECT * FROM ({_rate()}) WHERE window_start + INTERVAL 5 MINUTE <= {CLOSED}",
    "stream_threshold_alerts": _alerts(f"{{end}} <= {CLOSED}"),
    "stream_error_sessions": f"SELECT * FROM ({_SESSIONS}) WHERE session_end <= {CLOSED}",
    "stream_silent_services": f"""
        SELECT service, window_start, window_start + INTERVAL 1 HOUR AS window_end
        FROM (SELECT service, unnest(generate_series((SELECT date_trunc('day', min(ts)) FROM log_events), (SELECT max(ts) FROM log_events), INTERVAL 1 HOUR)) AS window_start
              FROM (SELECT DISTINCT service FROM log_events UNION ALL SELECT 'search-service'))
        WHERE window_start + INTERVAL 1 HOUR <= {CLOSED}
          AND (service, window_start) NOT IN (SELECT (service, time_bucket(INTERVAL '1 hour', ts)) FROM log_events)""",
    "stream_rolling_errors": f"""
        SELECT service, ts, count(*) AS total_events, any_value(errors_in_window) AS errors_in_window
        FROM (SELECT service, ts, cast(sum(CASE WHEN level = 'ERROR' THEN 1 ELSE 0 END) OVER (
                PARTITION BY service ORDER BY ts RANGE BETWEEN INTERVAL 5 MINUTE PRECEDING AND CURRENT ROW) AS bigint) AS errors_in_window
              FROM log_events)
        WHERE time_bucket(INTERVAL '6 hours', ts) + INTERVAL 6 HOUR <= {CLOSED} GROUP BY service, ts""",
}

_SPIKES = """
        SELECT service, window_start, error_events, previous_errors
        FROM (SELECT *, min(window_start) OVER (PARTITION BY service) AS first_start,
                cast(coalesce(sum(error_events) OVER (PARTITION BY service ORDER BY window_start
                  RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING), 0) AS bigint) AS previous_errors
              FROM hours)
        WHERE error_events >= 3 AND window_start >= first_start + INTERVAL 6 HOUR AND error_events * 6 > previous_errors * 2"""

_ON_HOURS = {
    "error_spikes": _SPIKES,
    "stream_error_spikes": f"{_SPIKES} AND window_start + INTERVAL 1 HOUR <= {CLOSED}",
}

_ON_EPISODES = {
    "alert_episodes": """
        SELECT service, min(window_start) AS episode_start, max(window_start) + INTERVAL 1 HOUR AS episode_end,
          count(*) AS windows, cast(sum(total_events) AS bigint) AS total_events, cast(sum(error_events) AS bigint) AS error_events
        FROM (SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY service ORDER BY window_start) AS episode
              FROM breaches)
        GROUP BY service, episode""",
    "stream_alert_episodes": f"""
        SELECT service, window_start AS episode_start, total_events, error_events
        FROM breaches WHERE starts AND window_start + INTERVAL 1 HOUR <= {CLOSED}""",
}

_ON_DELIVERIES = {
    "dedup_trace_ts": _first("trace_id, ts", "id", "deliveries"),
    "dedup_trace": _first("trace_id", "ts, id", "deliveries"),
    "idempotent_append": f"SELECT {STORED} FROM ({_first('trace_id, ts', 'id', 'deliveries')})",
    "retry_audit": """
        SELECT trace_id, count(DISTINCT ts) AS distinct_ts, count(*) AS deliveries, min(ts) AS first_ts, max(ts) AS last_ts,
          date_diff('millisecond', min(ts), max(ts)) AS span_ms
        FROM deliveries GROUP BY trace_id HAVING count(DISTINCT ts) > 1""",
    "stream_dedup": "SELECT DISTINCT trace_id, service, host, level, ts, message, latency_ms, endpoint FROM deliveries",
    "stream_dedup_trace": "SELECT DISTINCT trace_id, service, host, level, message, latency_ms, endpoint FROM deliveries",
}

_QUARANTINE = "SELECT message_id, sent_at, cast(receive AS int) AS receive, reject_reason FROM received WHERE reject_reason IS NOT NULL"
_DEAD = """
    SELECT message_id, count(*) AS receives, any_value(reject_reason) AS reject_reason
    FROM received WHERE reject_reason IS NOT NULL GROUP BY message_id HAVING count(*) >= 3"""

# A line of sources/driver_events.landed_lines that is cut off.
_CUT = """concat('{"message_id":"m', id, '","receive":', receive, ',"body')"""

_ON_RECEIVED = {
    "quarantine": _QUARANTINE,
    "accepted_messages": f"SELECT {COLUMNS} FROM received WHERE reject_reason IS NULL",
    "quarantine_counts": """
        SELECT coalesce(reject_reason, 'accepted') AS outcome, count(*) AS row_count FROM received GROUP BY ALL""",
    "dead_letter": _DEAD,
    "dead_letter_days": _DEAD,
    # The third receive makes the letter, in the second batch, which may bring the fourth too.
    "stream_dead_letter_days": f"SELECT *, cast(1 AS bigint) AS letter_batch FROM ({_DEAD})",
    "stream_ingest": f"SELECT DISTINCT {COLUMNS} FROM received WHERE reject_reason IS NULL",
    "archive_raw": """
        SELECT message_id, sent_at, cast(receive AS int) AS receive, coalesce(reject_reason, 'accepted') AS outcome
        FROM received""",
    "stream_quarantine": _QUARANTINE,
    "stream_dead_letter": _DEAD,
    "landed_ingest": f"SELECT DISTINCT {COLUMNS} FROM received WHERE reject_reason IS NULL AND id % 64 <> 9",
    "landed_quarantine": f"""
        SELECT CASE WHEN id % 64 = 9 THEN 'broken envelope' ELSE reject_reason END AS reject_reason, count(*) AS row_count,
          cast(sum(CASE WHEN id % 64 = 9 THEN length({_CUT}) ELSE 0 END) AS bigint) AS broken_chars
        FROM received WHERE id % 64 = 9 OR reject_reason IS NOT NULL GROUP BY 1""",
    "landed_archive": f"SELECT CASE WHEN id % 64 = 9 THEN {_CUT} END AS line, count(*) AS row_count, count(*) FILTER (id % 64 <> 9) AS message_count FROM received GROUP BY 1",
    "landed_dead_letter": _DEAD.replace("WHERE", "WHERE id % 64 <> 9 AND"),
}


def oracle_sql() -> dict[str, str]:
    groups = (
        ((LOG_EVENTS, SIGNED), _ON_EVENTS),
        ((LOG_EVENTS, _HOURS), _ON_HOURS),
        ((LOG_EVENTS, _HOURS, _EPISODES), _ON_EPISODES),
        ((LOG_EVENTS, DELIVERIES), _ON_DELIVERIES),
        ((LOG_EVENTS, RECEIVED), _ON_RECEIVED),
    )
    return {name: f"WITH {','.join(views)} {body}" for views, group in groups for name, body in group.items()}
