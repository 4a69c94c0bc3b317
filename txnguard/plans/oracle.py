"""The registered queries in plain SQL for DuckDB, written from the definitions.

Only the fixed value lists are shared with the Spark side: windows are listed one by one,
medians are ranks.
"""

from __future__ import annotations

from txnguard.sources.events import BANK_HANDLES, INDIAN_STATES, MERCHANT_CATEGORIES


def _listed(values: list[str]) -> str:
    return "[" + ",".join(f"'{v}'" for v in values) + "]"


def _padded(number: str, width: int) -> str:
    digits = f"CAST({number} AS VARCHAR)"
    return f"lpad({digits}, CAST(greatest({width}, length({digits})) AS INTEGER), '0')"


_STATES, _BANKS, _CATEGORIES = map(_listed, (INDIAN_STATES, BANK_HANDLES, MERCHANT_CATEGORIES))

_TXN_COLUMNS = (
    "txn_id, timestamp, sender_upi, sender_state, sender_device_id, receiver_upi, "
    "receiver_type, receiver_category, amount, status, is_fraud, fraud_pattern"
)
_ALERT = (
    "txn_id, sender_upi, receiver_upi, CAST(amount AS DECIMAL(28,2)) AS amount, "
    "timestamp AS txn_timestamp"
)
_POINT = f"{_ALERT}, timestamp AS window_start, timestamp AS window_end"
_NO_WINDOW = "CAST(NULL AS BIGINT) AS txn_count, CAST(NULL AS DECIMAL(38,2)) AS total_amount"

# name -> (names it builds on, body)
_PARTS: dict[str, tuple[list[str], str]] = {
    "numbered": (
        [],
        "SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events",
    ),
    "txn": (
        ["numbered"],
        f"""
        SELECT ts + to_seconds(CASE WHEN k = 95 THEN -10800 ELSE event_id % 7 END)
                 AS kafka_timestamp,
               'txn-' || {_padded('event_id', 8)} AS txn_id,
               ts AS timestamp,
               'user' || {_padded('user_id', 4)} || '@'
                 || {_BANKS}[user_id % 7 + 1] AS sender_upi,
               {_STATES}[(user_id + CASE WHEN k = 96 THEN 1 ELSE 0 END) % 15 + 1] AS sender_state,
               CASE WHEN k >= 97
                    THEN 'dev' || {_padded('user_id', 4)} || '_'
                         || CAST(day(ts) // 8 AS VARCHAR)
                    ELSE 'user' || {_padded('user_id', 4)} || '_'
                         || CAST(k % (1 + user_id % 3) AS VARCHAR) END AS sender_device_id,
               CASE WHEN k % 5 < 3
                    THEN 'merchant' || {_padded('event_id % 80', 3)} || '@'
                         || {_BANKS}[event_id % 7 + 1]
                    WHEN k >= 90
                    THEN 'stranger' || {_padded('event_id % 1000', 4)} || '@'
                         || {_BANKS}[event_id % 7 + 1]
                    ELSE 'user' || {_padded('(user_id + 1 + k) % 150', 4)} || '@'
                         || {_BANKS}[((user_id + 1 + k) % 150) % 7 + 1] END AS receiver_upi,
               CASE WHEN k % 5 < 3 THEN 'P2M' ELSE 'P2P' END AS receiver_type,
               CASE WHEN k % 5 < 3 THEN {_CATEGORIES}[event_id % 12 + 1] END AS receiver_category,
               value AS amount,
               CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'REVERSED'
                    ELSE 'SUCCESS' END AS status,
               CAST(NULL AS BOOLEAN) AS is_fraud,
               CAST(NULL AS VARCHAR) AS fraud_pattern
        FROM numbered""",
    ),
    "message": (
        ["txn"],
        """
        SELECT sender_upi AS key, kafka_timestamp, txn_id,
               '{"txn_id":"' || txn_id
               || '","timestamp":"'
               || strftime(timestamp + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S.%f') || '+05:30'
               || '","sender_upi":"' || sender_upi
               || '","sender_state":"' || sender_state
               || '","sender_device_id":"' || sender_device_id
               || '","receiver_upi":"' || receiver_upi
               || '","receiver_type":"' || receiver_type
               || '","receiver_category":' || coalesce('"' || receiver_category || '"', 'null')
               || ',"amount":' || CAST(amount AS VARCHAR)
               || ',"status":"' || status
               || '","is_fraud":null,"fraud_pattern":null}' AS value
        FROM txn""",
    ),
    "dirty": (
        ["txn"],
        """
        SELECT txn_id,
               CASE WHEN right(txn_id, 2) = '07' THEN -amount ELSE amount END AS amount,
               CASE WHEN right(txn_id, 2) = '08' THEN replace(sender_upi, '@', '')
                    ELSE sender_upi END AS sender_upi,
               CASE WHEN right(txn_id, 2) = '09' THEN '' ELSE sender_state END AS sender_state,
               CASE WHEN right(txn_id, 1) <> '4' THEN receiver_category END AS receiver_category,
               receiver_type
        FROM txn""",
    ),
    "broken": (
        ["dirty"],
        """
        SELECT txn_id, sender_upi, amount, 'missing_sender_state' AS violation, 1 AS pos
        FROM dirty WHERE sender_state = ''
        UNION ALL SELECT txn_id, sender_upi, amount, 'bad_sender_upi', 2 FROM dirty
        WHERE NOT regexp_full_match(sender_upi, '[A-Za-z0-9]+@[A-Za-z]+')
        UNION ALL SELECT txn_id, sender_upi, amount, 'bad_amount', 3 FROM dirty WHERE amount <= 0
        UNION ALL SELECT txn_id, sender_upi, amount, 'p2m_without_category', 4 FROM dirty
        WHERE receiver_type = 'P2M' AND receiver_category IS NULL""",
    ),
    "twice": (
        ["txn"],
        "SELECT * FROM txn UNION ALL SELECT * FROM txn WHERE right(txn_id, 2) = '50'",
    ),
    "silver": (["txn"], "SELECT * FROM txn WHERE amount > 0"),
    "past": (
        ["silver"],
        "SELECT * FROM silver WHERE status = 'SUCCESS' "
        "AND timestamp < TIMESTAMP '2024-01-16 00:00:00'",
    ),
    "now_txn": (
        ["silver"],
        "SELECT * FROM silver WHERE timestamp >= TIMESTAMP '2024-01-16 00:00:00'",
    ),
    "spend": (
        ["past"],
        """
        SELECT sender_upi, (min(amount) + max(amount)) / 2 AS typical_spend FROM (
          SELECT sender_upi, amount,
                 row_number() OVER (PARTITION BY sender_upi ORDER BY amount) AS rn,
                 count(*) OVER (PARTITION BY sender_upi) AS n
          FROM past) WHERE rn IN ((n + 1) // 2, (n + 2) // 2)
        GROUP BY sender_upi""",
    ),
    "rated": (
        ["now_txn", "spend"],
        """
        SELECT t.*, s.typical_spend, t.amount / greatest(s.typical_spend, 10.0) AS ratio
        FROM now_txn t JOIN spend s USING (sender_upi)""",
    ),
    "amount_hits": (
        ["rated"],
        f"SELECT {_POINT}, 'amount_anomaly' AS fraud_reason, {_NO_WINDOW} FROM rated "
        "WHERE ratio >= 5",
    ),
    "odd_hits": (
        ["rated"],
        f"SELECT {_POINT}, 'odd_hour_high_value' AS fraud_reason, {_NO_WINDOW} FROM rated "
        "WHERE ratio >= 3 AND hour(timestamp + INTERVAL 330 MINUTE) BETWEEN 1 AND 4",
    ),
    "location_hits": (
        ["rated", "past"],
        f"SELECT {_POINT}, 'location_anomaly' AS fraud_reason, {_NO_WINDOW} FROM rated r "
        "WHERE NOT EXISTS (SELECT 1 FROM past p WHERE p.sender_upi = r.sender_upi "
        "AND p.sender_state = r.sender_state)",
    ),
    "burst_rows": (
        ["now_txn"],
        "SELECT * FROM now_txn WHERE receiver_type = 'P2P' AND status = 'SUCCESS' "
        "AND amount <= 200",
    ),
    "burst_windows": (
        ["burst_rows"],
        """
        SELECT sender_upi, sender_device_id, w AS window_start, w + INTERVAL 6 HOUR AS window_end,
               count(*) AS txn_count, sum(CAST(amount AS DECIMAL(28,2))) AS total_amount
        FROM (SELECT *, unnest(generate_series(
                time_bucket(INTERVAL 1 HOUR, timestamp, TIMESTAMP '1970-01-01')
                  - INTERVAL 5 HOUR,
                time_bucket(INTERVAL 1 HOUR, timestamp, TIMESTAMP '1970-01-01'),
                INTERVAL 1 HOUR)) AS w
              FROM burst_rows)
        GROUP BY ALL HAVING count(*) >= 2 AND count(DISTINCT receiver_upi) >= 2""",
    ),
    "burst_hits": (
        ["burst_rows", "burst_windows"],
        f"""
        SELECT {_ALERT}, window_start, window_end, 'rapid_fire_burst' AS fraud_reason,
               CAST(txn_count AS BIGINT) AS txn_count,
               CAST(total_amount AS DECIMAL(38,2)) AS total_amount
        FROM (SELECT b.*, w.window_start, w.window_end, w.txn_count, w.total_amount,
                     row_number() OVER (PARTITION BY txn_id ORDER BY w.window_start) AS rn
              FROM burst_rows b JOIN burst_windows w
                ON b.sender_upi = w.sender_upi AND b.sender_device_id = w.sender_device_id
               AND b.timestamp >= w.window_start AND b.timestamp < w.window_end)
        WHERE rn = 1""",
    ),
    "drain_rows": (
        ["rated", "past"],
        """
        SELECT *, time_bucket(INTERVAL 7 DAY, timestamp, TIMESTAMP '1970-01-01') AS window_start
        FROM rated r WHERE receiver_type = 'P2P' AND status = 'SUCCESS' AND ratio >= 0.5
        AND NOT EXISTS (SELECT 1 FROM past p WHERE p.sender_upi = r.sender_upi
                        AND p.sender_device_id = r.sender_device_id)""",
    ),
    "drain_hits": (
        ["drain_rows"],
        f"""
        SELECT {_ALERT}, window_start, window_start + INTERVAL 7 DAY AS window_end,
               'unseen_device_drain' AS fraud_reason, CAST(n AS BIGINT) AS txn_count,
               CAST(total AS DECIMAL(38,2)) AS total_amount
        FROM (SELECT *, count(*) OVER g AS n, sum(CAST(amount AS DECIMAL(28,2))) OVER g AS total
              FROM drain_rows
              WINDOW g AS (PARTITION BY sender_upi, sender_device_id, window_start))
        WHERE n >= 2""",
    ),
    "sliding_rows": (
        ["rated", "past"],
        """
        SELECT * FROM rated r WHERE receiver_type = 'P2P' AND status = 'SUCCESS' AND ratio >= 0.05
        AND NOT EXISTS (SELECT 1 FROM past p WHERE p.sender_upi = r.sender_upi
                        AND p.sender_device_id = r.sender_device_id)""",
    ),
    "sliding_windows": (
        ["sliding_rows"],
        """
        SELECT sender_upi, sender_device_id, day AS window_start, day + INTERVAL 7 DAY AS window_end,
               count(*) AS txn_count, sum(CAST(amount AS DECIMAL(28,2))) AS total_amount
        FROM sliding_rows, unnest(range(7)) AS back(k),
             LATERAL (SELECT date_trunc('day', timestamp) - INTERVAL 1 DAY * k AS day)
        GROUP BY ALL HAVING count(*) >= 2""",
    ),
    "every_alert": (
        ["drain_hits", "burst_hits", "amount_hits", "odd_hits", "location_hits"],
        "SELECT * FROM drain_hits UNION ALL SELECT * FROM burst_hits "
        "UNION ALL SELECT * FROM amount_hits UNION ALL SELECT * FROM odd_hits "
        "UNION ALL SELECT * FROM location_hits",
    ),
    "one_alert": (
        ["every_alert"],
        """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (PARTITION BY txn_id ORDER BY
            CASE fraud_reason WHEN 'unseen_device_drain' THEN 1 WHEN 'rapid_fire_burst' THEN 2
              WHEN 'amount_anomaly' THEN 3 WHEN 'odd_hour_high_value' THEN 4 ELSE 5 END,
            window_start) AS rn
          FROM every_alert) WHERE rn = 1""",
    ),
    "labels_now": (
        ["now_txn"],
        f"""
        SELECT txn_id,
               CASE WHEN sender_device_id LIKE 'dev%' THEN 'unseen_device_drain'
                    ELSE 'location_anomaly' END AS pattern
        FROM now_txn WHERE sender_device_id LIKE 'dev%' OR sender_state
          <> {_STATES}[CAST(regexp_extract(sender_upi, '^user([0-9]+)@', 1) AS BIGINT) % 15 + 1]""",
    ),
    "minute": (
        ["message"],
        """
        SELECT date_trunc('minute', kafka_timestamp) AS minute_start, count(*) AS n_rows,
               sum(strlen(key) + strlen(value)) AS n_bytes
        FROM message GROUP BY 1""",
    ),
    "rate": (
        ["minute"],
        "SELECT minute_start, n_rows, CAST(n_bytes AS BIGINT) AS n_bytes, "
        "CAST(ceil(n_bytes / 60.0 / 10.0) AS BIGINT) AS partitions_needed FROM minute",
    ),
}

_PAIRS = "txn_id, sender_upi, sender_device_id, receiver_upi, timestamp"
_MIX = (
    "count(*) AS n_txns, sum(CAST(amount AS DECIMAL(28,2))) AS total_amount, "
    "CAST(sum(CAST(amount AS DECIMAL(28,2))) AS DOUBLE) / count(*) AS mean_amount"
)


def _seen(attribute: str, negate: str) -> str:
    return (
        f"SELECT {_PAIRS} FROM now_txn t WHERE {negate} EXISTS (SELECT 1 FROM past p "
        f"WHERE p.sender_upi = t.sender_upi AND p.{attribute} = t.{attribute})"
    )


# key -> (parts used, final query)
_FINAL: dict[str, tuple[list[str], str]] = {
    "bronze_txn": (["txn"], "SELECT * FROM txn"),
    "bronze_count": (["txn"], "SELECT count(*) AS n_rows FROM txn"),
    "publish_frame": (["message"], "SELECT key, value FROM message"),
    "parse_flatten": (["txn"], "SELECT * FROM txn"),
    "json_contract": (
        ["txn"],
        """
        SELECT violation, count(*) AS n_rows FROM (
          SELECT unnest(CASE right(txn_id, 2)
            WHEN '05' THEN ['timestamp_without_offset']
            WHEN '06' THEN ['wrong_json_type', 'bad_amount']
            WHEN '11' THEN ['wrong_json_type']
            WHEN '12' THEN ['wrong_json_type', 'missing_txn_id', 'missing_sender_upi',
              'missing_sender_state', 'missing_sender_device_id', 'missing_receiver_upi',
              'missing_receiver_type', 'missing_status', 'missing_timestamp', 'bad_amount']
            WHEN '13' THEN ['wrong_json_type']
            ELSE [] END) AS violation FROM txn
          UNION ALL
          SELECT 'bad_amount' FROM txn
          WHERE amount <= 0 AND right(txn_id, 2) NOT IN ('06', '12'))
        GROUP BY violation""",
    ),
    "unknown_fields": (
        ["txn"],
        """
        SELECT field, count(*) AS n_rows
        FROM (SELECT unnest(CASE right(txn_id, 1) WHEN '3' THEN ['channel'] WHEN '7' THEN ['channel', 'note']
                ELSE [] END) AS field FROM txn)
        GROUP BY field""",
    ),
    "contract_violations": (
        ["broken"],
        "SELECT violation, count(*) AS n_rows FROM broken GROUP BY violation",
    ),
    "contract_split": (
        ["dirty", "broken"],
        """
        SELECT d.txn_id, d.sender_upi, d.amount, coalesce(b.reasons, '') AS reasons
        FROM dirty d LEFT JOIN (
          SELECT txn_id, string_agg(violation, ',' ORDER BY pos) AS reasons
          FROM broken GROUP BY txn_id) b USING (txn_id)""",
    ),
    "txn_lookup": (
        ["txn"],
        "SELECT txn_id, sender_upi, receiver_upi, amount, status FROM txn "
        "WHERE txn_id = 'txn-00000123'",
    ),
    "dup_txn": (
        ["twice"],
        "SELECT txn_id, count(*) AS count FROM twice GROUP BY txn_id HAVING count(*) > 1",
    ),
    "txn_dedup": (["twice"], "SELECT DISTINCT * FROM twice"),
    "skew_guard": (
        ["txn"],
        "SELECT * FROM txn WHERE timestamp <= kafka_timestamp + INTERVAL 60 SECOND",
    ),
    "iso_time": (
        ["txn"],
        """
        SELECT txn_id,
               strftime(timestamp + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S.%f') || '+05:30'
                 AS iso_ist,
               strftime(timestamp, '%Y-%m-%dT%H:%M:%SZ') AS iso_utc
        FROM txn""",
    ),
    "text_normalize": (
        [],
        """
        SELECT c_custkey, raw_id,
               TRY_CAST(replace(trim(raw_id), ',', '') AS BIGINT) AS id,
               list_aggregate(list_transform(range(1, length(name) + 1), lambda i:
                 CASE WHEN i = 1 OR NOT regexp_matches(name[i - 1], '[A-Za-z]')
                      THEN upper(name[i]) ELSE lower(name[i]) END), 'string_agg', '') AS name,
               email LIKE '%@%.%' AS email_ok,
               lower(trim(email)) AS email
        FROM (SELECT c_custkey,
                CASE WHEN c_custkey % 5 = 4 THEN 'n/a'
                     ELSE '  ' || CAST(c_custkey // 1000 AS VARCHAR) || ','
                          || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || ' ' END AS raw_id,
                replace(c_name, '#', ' o''neil-') || 'x ' || c_mktsegment AS name,
                ' ' || c_name || CASE WHEN c_custkey % 4 = 1 THEN '' ELSE '@' END || c_mktsegment
                  || CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '.' END || 'Com ' AS email
              FROM customer)""",
    ),
    "sender_profile": (
        ["past", "spend"],
        """
        SELECT sender_upi, any_value(typical_spend) AS typical_spend, count(*) AS n_txns,
               count(DISTINCT sender_device_id) AS n_devices,
               count(DISTINCT sender_state) AS n_states,
               count(DISTINCT receiver_upi) AS n_payees,
               array_to_string(list_sort(list_distinct(list(sender_device_id))), ',') AS devices,
               array_to_string(list_sort(list_distinct(list(sender_state))), ',') AS states
        FROM past JOIN spend USING (sender_upi) GROUP BY sender_upi""",
    ),
    "sender_values": (
        ["past"],
        """
        SELECT sender_upi, kind, value, count(*) AS n FROM (
          UNPIVOT (SELECT sender_upi, sender_device_id, sender_state, receiver_upi FROM past)
          ON sender_device_id, sender_state, receiver_upi INTO NAME kind VALUE value)
        GROUP BY ALL""",
    ),
    "txn_enriched": (
        ["now_txn", "spend"],
        """
        SELECT txn_id, sender_upi, round(amount, 2) AS amount, typical_spend,
               CASE WHEN typical_spend IS NOT NULL
                    THEN amount / greatest(typical_spend, 10.0) END AS ratio
        FROM now_txn LEFT JOIN spend USING (sender_upi)""",
    ),
    "unseen_device_txn": (["now_txn", "past"], _seen("sender_device_id", "NOT")),
    "known_device_txn": (["now_txn", "past"], _seen("sender_device_id", "")),
    "new_payee_txn": (["now_txn", "past"], _seen("receiver_upi", "NOT")),
    "rule_amount_anomaly": (["amount_hits"], "SELECT * FROM amount_hits"),
    "rule_odd_hour": (["odd_hits"], "SELECT * FROM odd_hits"),
    "rule_location": (["location_hits"], "SELECT * FROM location_hits"),
    "rule_rapid_fire": (["burst_hits"], "SELECT * FROM burst_hits"),
    "rule_unseen_device": (["drain_hits"], "SELECT * FROM drain_hits"),
    "rule_unseen_device_sliding": (
        ["sliding_rows", "sliding_windows"],
        f"""
        SELECT {_ALERT}, window_start, window_end, 'unseen_device_drain' AS fraud_reason,
               CAST(txn_count AS BIGINT) AS txn_count,
               CAST(total_amount AS DECIMAL(38,2)) AS total_amount
        FROM sliding_rows JOIN sliding_windows USING (sender_upi, sender_device_id)
        WHERE timestamp >= window_start AND timestamp < window_end
        QUALIFY row_number() OVER (PARTITION BY txn_id ORDER BY window_start) = 1""",
    ),
    "alerts_all": (["every_alert"], "SELECT * FROM every_alert"),
    "alerts_dedup": (["one_alert"], "SELECT * FROM one_alert"),
    "alerts_new": (
        ["one_alert", "amount_hits"],
        "SELECT * FROM one_alert WHERE txn_id NOT IN (SELECT txn_id FROM amount_hits)",
    ),
    "alerts_retract": (
        ["every_alert", "now_txn"],
        "SELECT * FROM every_alert WHERE txn_id NOT IN "
        "(SELECT txn_id FROM now_txn WHERE status = 'REVERSED')",
    ),
    "alert_feed": (
        ["one_alert"],
        "SELECT * FROM one_alert ORDER BY txn_timestamp DESC, txn_id LIMIT 50",
    ),
    "alerts_by_sender": (
        ["every_alert"],
        "SELECT * FROM every_alert WHERE sender_upi = 'user0008@okhdfcbank' "
        "ORDER BY txn_timestamp DESC, txn_id",
    ),
    "alerts_by_reason": (
        ["one_alert"],
        "SELECT fraud_reason, date_trunc('hour', txn_timestamp) AS hour_start, "
        "count(*) AS n_alerts, sum(amount) AS alert_amount FROM one_alert GROUP BY ALL",
    ),
    "rule_quality": (
        ["every_alert", "labels_now"],
        """
        SELECT fraud_pattern, n_labelled, n_alerted, n_both,
               CASE WHEN n_labelled > 0 THEN n_both / n_labelled END AS recall,
               CASE WHEN n_alerted > 0 THEN n_both / n_alerted END AS precision
        FROM (SELECT coalesce(l.pattern, a.fraud_reason) AS fraud_pattern,
                     count(l.txn_id) AS n_labelled, count(a.txn_id) AS n_alerted,
                     count(CASE WHEN l.txn_id IS NOT NULL THEN a.txn_id END) AS n_both
              FROM labels_now l FULL JOIN every_alert a
                ON l.txn_id = a.txn_id AND l.pattern = a.fraud_reason
              GROUP BY 1)""",
    ),
    "sender_window_stats": (
        ["silver"],
        """
        SELECT sender_upi, w AS window_start, w + INTERVAL 12 HOUR AS window_end,
               count(*) AS txn_count, sum(CAST(amount AS DECIMAL(28,2))) AS total_amount
        FROM (SELECT sender_upi, amount, unnest(generate_series(
                time_bucket(INTERVAL 4 HOUR, timestamp, TIMESTAMP '1970-01-01')
                  - INTERVAL 8 HOUR,
                time_bucket(INTERVAL 4 HOUR, timestamp, TIMESTAMP '1970-01-01'),
                INTERVAL 4 HOUR)) AS w FROM silver)
        GROUP BY sender_upi, w""",
    ),
    "sender_velocity": (
        ["silver"],
        """
        SELECT txn_id, sender_upi, timestamp, count(*) OVER r AS recent_count,
               sum(CAST(amount AS DECIMAL(28,2))) OVER r AS recent_amount
        FROM silver WINDOW r AS (PARTITION BY sender_upi ORDER BY timestamp
          RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW)""",
    ),
    "traffic_mix": (
        ["silver"],
        "SELECT receiver_type, receiver_category, "
        "grouping_id(receiver_type, receiver_category) AS level, "
        f"{_MIX} FROM silver GROUP BY ROLLUP (receiver_type, receiver_category)",
    ),
    "traffic_by_status": (["silver"], f"SELECT status, {_MIX} FROM silver GROUP BY status"),
    "traffic_by_state": (
        ["silver"],
        f"SELECT sender_state, {_MIX} FROM silver GROUP BY sender_state",
    ),
    "key_skew": (
        ["txn"],
        """
        SELECT CAST('0x' || substr(md5(sender_upi), 1, 8) AS BIGINT) % 12 AS topic_partition,
               CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, max(n) AS heaviest_key_rows
        FROM (SELECT sender_upi, count(*) AS n FROM txn GROUP BY 1) GROUP BY 1""",
    ),
    "ingest_rate": (["rate"], "SELECT * FROM rate"),
    "ingest_peak": (
        ["rate"],
        "SELECT max(n_rows) AS peak_rows, max(n_bytes) AS peak_bytes, "
        "max(partitions_needed) AS partitions_needed, count(*) AS n_minutes FROM rate",
    ),
}


def _needed(names: list[str], found: list[str]) -> list[str]:
    for name in names:
        if name not in found:
            _needed(_PARTS[name][0], found)
            found.append(name)
    return found


def _with_parts(names: list[str], final: str) -> str:
    parts = [f"{name} AS ({_PARTS[name][1]})" for name in _needed(names, [])]
    return f"WITH {', '.join(parts)} {final}" if parts else final


ORACLE_SQL: dict[str, str] = {
    key: _with_parts(names, final) for key, (names, final) in _FINAL.items()
}
