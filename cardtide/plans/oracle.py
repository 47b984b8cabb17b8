"""The same queries as SQL over the ``events`` table, for an independent engine."""

from __future__ import annotations

from cardtide.schema import AMBER_AT, CATEGORIES, CITIES, RECENT_WINDOWS, RED_AT


def _list(names: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{name}'" for name in names) + "]"


TX = f"""
    keyed AS (
        SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
    ),
    labelled AS (
        SELECT *,
            CASE WHEN k < 10 THEN CASE event_type
                WHEN 'error' THEN 'high_amount'
                WHEN 'signup' THEN 'card_testing'
                WHEN 'purchase' THEN 'impossible_travel'
            END END AS fraud_type
        FROM keyed
    ),
    tx AS (
        SELECT
            CAST(event_id AS VARCHAR) AS transaction_id,
            'card_' || lpad(CAST(user_id AS VARCHAR),
                            CAST(greatest(4, length(CAST(user_id AS VARCHAR))) AS INTEGER), '0') AS card_id,
            value AS amount,
            'merchant_' || CAST(k AS VARCHAR) AS merchant,
            {_list(CATEGORIES)}[k % {len(CATEGORIES)} + 1] AS category,
            {_list(CITIES)}[(user_id + CASE WHEN k < 15 THEN k ELSE 0 END) % {len(CITIES)} + 1] AS city,
            CASE WHEN date_trunc('second', ts) = ts THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                 ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END || '+00:00' AS "timestamp",
            fraud_type IS NOT NULL AS is_fraud,
            fraud_type,
            ts AS event_time
        FROM labelled
    )"""

_DECODED = f"WITH {TX} SELECT * FROM tx"


def _gold(unit: str) -> str:
    total = "CAST(SUM(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE)"
    return f"""
    gold AS (
        SELECT
            date_trunc('{unit}', event_time) AS window_start,
            date_trunc('{unit}', event_time) + INTERVAL 1 {unit} AS window_end,
            COUNT(*) AS tx_count,
            {total} AS total_amount,
            {total} / COUNT(amount) AS avg_amount,
            COUNT(*) FILTER (WHERE fraud_type = 'high_amount') AS fraud_high_amount,
            COUNT(*) FILTER (WHERE fraud_type = 'card_testing') AS fraud_card_testing,
            COUNT(*) FILTER (WHERE fraud_type = 'impossible_travel') AS fraud_impossible_travel,
            COUNT(*) FILTER (WHERE is_fraud) AS fraud_total
        FROM tx
        GROUP BY ALL
    )"""


def _over_gold(unit: str, body: str) -> str:
    return f"WITH {TX}, {_gold(unit)} {body}"


_CLOSED = "WHERE window_end <= (SELECT max(event_time) FROM tx) - INTERVAL 2 MINUTE"

_KPI = """
    kpi AS (
        SELECT
            COUNT(*) AS n_windows,
            CAST(SUM(tx_count) AS BIGINT) AS total_tx,
            CAST(SUM(fraud_total) AS BIGINT) AS total_fraud,
            CAST(SUM(fraud_total) AS DOUBLE) / CAST(SUM(tx_count) AS DOUBLE) * 100 AS fraud_rate_pct,
            CAST(SUM(CAST(total_amount AS DECIMAL(18, 2))) AS DOUBLE) AS total_amount
        FROM gold
    )"""

_RECENT = f"""
    recent AS (
        SELECT
            window_start, tx_count,
            round_even(total_amount * 100, 0) / 100 AS total_amount,
            round_even(avg_amount * 100, 0) / 100 AS avg_amount,
            fraud_card_testing, fraud_high_amount, fraud_impossible_travel, fraud_total
        FROM gold ORDER BY window_start DESC LIMIT {RECENT_WINDOWS}
    )"""

_NORMS = """
    exact AS (
        SELECT category, COUNT(*) AS n, SUM(CAST(amount AS DECIMAL(18, 2))) AS total,
               MIN(amount) AS min_amount, MAX(amount) AS max_amount
        FROM tx WHERE amount > 0 GROUP BY category
    )"""

# Exact: the amount times the number against five times the sum, without a division.
_HIGH = f"""{_NORMS},
    high_amount AS (
        SELECT tx.* FROM tx JOIN exact USING (category)
        WHERE CAST(amount AS DECIMAL(18, 2)) * n > 5 * total
    )"""

_TESTING = """
    counted AS (
        SELECT *, COUNT(*) OVER (
            PARTITION BY card_id ORDER BY event_time
            RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW
        ) AS n
        FROM tx WHERE amount <= 5
    ),
    card_testing AS (SELECT * EXCLUDE (n) FROM counted WHERE n >= 2)"""

_TRAVEL = """
    impossible_travel AS (
        SELECT b.* FROM tx b
        WHERE EXISTS (
            SELECT 1 FROM tx a
            WHERE a.card_id = b.card_id AND a.city <> b.city
              AND a.event_time < b.event_time AND b.event_time <= a.event_time + INTERVAL 2 HOUR
        )
    )"""

_DETECTED = "transaction_id, card_id, event_time, amount, category, city"

_CONFUSION_ROW = """
    SELECT
        '{name}' AS detector,
        COUNT(*) FILTER (WHERE f AND fraud_type = '{name}') AS tp,
        COUNT(*) FILTER (WHERE f AND fraud_type IS DISTINCT FROM '{name}') AS fp,
        COUNT(*) FILTER (WHERE NOT f AND fraud_type = '{name}') AS fn,
        COUNT(*) FILTER (WHERE NOT f AND fraud_type IS DISTINCT FROM '{name}') AS tn,
        COUNT(*) FILTER (WHERE f AND is_fraud) AS any_tp,
        COUNT(*) FILTER (WHERE f AND NOT is_fraud) AS any_fp,
        COUNT(*) FILTER (WHERE NOT f AND is_fraud) AS any_fn,
        COUNT(*) FILTER (WHERE NOT f AND NOT is_fraud) AS any_tn
    FROM (SELECT *, transaction_id IN (SELECT transaction_id FROM {name}) AS f FROM tx)"""

_SESSIONS = """
    small AS (
        SELECT *, lag(event_time) OVER (PARTITION BY card_id ORDER BY event_time) AS before
        FROM tx WHERE amount <= 5
    ),
    numbered AS (
        SELECT *, SUM(CASE WHEN before IS NULL OR event_time > before + INTERVAL 1 DAY THEN 1 ELSE 0 END)
            OVER (PARTITION BY card_id ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS run
        FROM small
    ),
    sessions AS (
        SELECT card_id, MIN(event_time) AS session_start,
               MAX(event_time) + INTERVAL 1 DAY AS session_end,
               COUNT(*) AS n_charges, MAX(amount) AS max_amount
        FROM numbered GROUP BY card_id, run
    )"""

# The last batch is late; by then the watermark stands where the batch before the last one left it.
_LATE = f"""
    bounds AS (
        SELECT min(epoch_us(event_time)) AS first, max(epoch_us(event_time)) AS last, max(event_time) AS newest FROM tx
    ),
    placed AS (
        SELECT *, CAST(transaction_id AS BIGINT) % 50 = 0 AS late,
               least(floor((epoch_us(event_time) - first) * 4 / greatest(last - first, 1)), 3) AS batch
        FROM tx, bounds
    ),
    kept AS (
        SELECT * FROM placed
        WHERE NOT late OR date_trunc('minute', event_time) + INTERVAL 1 MINUTE
              > (SELECT max(event_time) FROM placed WHERE NOT late AND batch <= 2) - INTERVAL 2 MINUTE
    ),
    {_gold("minute").replace("FROM tx", "FROM kept")},
    closed AS (SELECT * FROM gold WHERE window_end <= (SELECT max(event_time) FROM kept) - INTERVAL 2 MINUTE)"""

_HOME = f"""WITH {TX},
    counts AS (SELECT card_id, city, COUNT(*) AS n FROM tx GROUP BY card_id, city)
    SELECT card_id, city AS home_city, n FROM counts
    QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY n DESC, city) = 1"""

ORACLE: dict[str, str] = {
    "decode_payload": _DECODED,
    "encode_payload": f"""WITH {TX}
        SELECT card_id AS key, * EXCLUDE (event_time, is_fraud), CAST(is_fraud AS VARCHAR) AS is_fraud FROM tx""",
    "bronze_landing": _DECODED,
    "gold_1m": _over_gold("minute", "SELECT * FROM gold"),
    "gold_1h": _over_gold("hour", "SELECT * FROM gold"),
    "gold_1d": _over_gold("day", "SELECT * FROM gold"),
    "stream_gold_1m": _over_gold("minute", f"SELECT * FROM gold {_CLOSED}"),
    "replayed_gold_1m": _over_gold("minute", f"SELECT * FROM gold {_CLOSED}"),
    "stream_late_rows": f"WITH {TX}, {_LATE} SELECT * FROM closed",
    "late_rows_corrected": _over_gold("minute", "SELECT * FROM gold"),
    "stream_accounts": f"""WITH {TX}, {_LATE}
        SELECT rows_in, rejected, windows_out, rows_out, rows_in - rejected - rows_out AS late_or_open
        FROM (SELECT count(*) AS rows_in, count(*) FILTER (WHERE event_time IS NULL) AS rejected FROM tx),
             (SELECT count(*) AS windows_out, sum(tx_count)::BIGINT AS rows_out FROM closed)""",
    "gold_1h_rolled": _over_gold("hour", "SELECT * FROM gold"),
    "gold_1d_rolled": _over_gold("day", "SELECT * FROM gold"),
    "gold_1h_refreshed": _over_gold("hour", "SELECT * FROM gold"),
    "gold_export_refreshed": _over_gold("minute", "SELECT * FROM gold"),
    "gold_1m_doubles": _over_gold("minute", """
        SELECT * REPLACE (round(total_amount, 7) AS total_amount, round(avg_amount, 7) AS avg_amount) FROM gold"""),
    "gold_union": _over_gold("minute", """
        SELECT * FROM gold WHERE window_start >= TIMESTAMP '2024-01-16'
        UNION ALL BY NAME
        SELECT * EXCLUDE (avg_amount) FROM gold WHERE window_start < TIMESTAMP '2024-01-16'"""),
    "gold_snapshot": _over_gold("minute", "SELECT * FROM gold"),
    "kpi_summary": _over_gold("minute", f", {_KPI} SELECT * FROM kpi"),
    "kpi_display": _over_gold("minute", f""", {_KPI}
        SELECT format('{{:,}}', total_tx) AS "Transactions", format('{{:,}}', total_fraud) AS "Frauds detected",
               format('{{:.1f}}%', fraud_rate_pct) AS "Fraud rate",
               format('${{:,.0f}}', total_amount) AS "Volume processed"
        FROM kpi"""),
    "throughput_series": _over_gold("minute", "SELECT window_start, tx_count FROM gold ORDER BY window_start"),
    "fraud_by_type": _over_gold("hour", """
        SELECT window_start, 'card_testing' AS fraud_type, fraud_card_testing AS n FROM gold
        UNION ALL SELECT window_start, 'high_amount', fraud_high_amount FROM gold
        UNION ALL SELECT window_start, 'impossible_travel', fraud_impossible_travel FROM gold"""),
    "recent_windows": _over_gold("hour", f", {_RECENT} SELECT * FROM recent"),
    "recent_display": _over_gold("hour", f""", {_RECENT}
        SELECT window_start AS "Window", format('{{:,}}', tx_count) AS "Tx",
               format('${{:,.0f}}', total_amount) AS "Total $", format('${{:,.2f}}', avg_amount) AS "Avg $",
               fraud_card_testing AS "Card testing", fraud_high_amount AS "High amount",
               fraud_impossible_travel AS "Impossible travel", fraud_total AS "Frauds"
        FROM recent"""),
    "window_alerts": _over_gold("day", f"""
        SELECT window_start, fraud_total,
               CASE WHEN fraud_total >= {RED_AT} THEN 'red' WHEN fraud_total >= {AMBER_AT} THEN 'amber' ELSE '' END
                   AS severity
        FROM gold"""),
    "category_norms": f"""WITH {TX}, {_NORMS}
        SELECT category, n, CAST(total AS DOUBLE) AS sum_amount, min_amount, max_amount FROM exact""",
    "detect_high_amount": f"WITH {TX}, {_HIGH} SELECT {_DETECTED} FROM high_amount",
    "category_quantiles": f"""WITH {TX}, {_NORMS}
        SELECT category, n, quantile, TRUE AS within FROM exact, (SELECT unnest([0.5, 0.9, 0.99]::DOUBLE[]) AS quantile)""",
    "detect_high_amount_in_force": f"""WITH {TX},
        days AS (
            SELECT category, date_trunc('day', event_time) AS day, count(*) AS n, sum(CAST(amount AS DECIMAL(18, 2))) AS total
            FROM tx WHERE amount > 0 GROUP BY ALL
        ),
        versions AS (
            SELECT category, day + INTERVAL 1 DAY AS valid_from, CAST(sum(n) OVER upto AS BIGINT) AS n, sum(total) OVER upto AS total
            FROM days WINDOW upto AS (PARTITION BY category ORDER BY day)
        )
        SELECT transaction_id, card_id, event_time, amount, tx.category, city
        FROM tx ASOF JOIN versions v ON tx.category = v.category AND tx.event_time >= v.valid_from
        WHERE CAST(amount AS DECIMAL(18, 2)) * v.n > 5 * v.total""",
    "high_amount_thresholds": f"""WITH {TX}, {_NORMS},
        scored AS (
            SELECT amount / (CAST(total AS DOUBLE) / n) AS score, coalesce(fraud_type = 'high_amount', FALSE) AS hit
            FROM tx LEFT JOIN exact USING (category)
        ),
        by_score AS (SELECT score, count(*) AS flagged, count(*) FILTER (WHERE hit) AS hits FROM scored WHERE score IS NOT NULL GROUP BY score),
        summed AS (SELECT score, CAST(sum(flagged) OVER w AS BIGINT) AS n_flagged, CAST(sum(hits) OVER w AS BIGINT) AS n_hits
                   FROM by_score WINDOW w AS (ORDER BY score DESC))
        SELECT score, n_flagged, n_hits, CAST(n_hits AS DOUBLE) / n_flagged AS precision,
               CAST(n_hits AS DOUBLE) / (SELECT count(*) FROM scored WHERE hit) AS recall
        FROM summed""",
    "detect_card_testing": f"WITH {TX}, {_TESTING} SELECT {_DETECTED} FROM card_testing",
    "stream_probe_sessions": f"""WITH {TX}, {_SESSIONS}
        SELECT * FROM sessions
        WHERE n_charges >= 2 AND session_end <= (SELECT max(event_time) FROM small) - INTERVAL 2 MINUTE""",
    # A slice is given out when it has closed.
    "stream_card_testing": f"""WITH {TX}, {_TESTING}
        SELECT {_DETECTED} FROM card_testing
        WHERE time_bucket(INTERVAL 1 DAY, event_time) + INTERVAL 1 DAY <= (SELECT max(event_time) FROM tx) - INTERVAL 2 MINUTE""",
    "detect_impossible_travel": f"WITH {TX}, {_TRAVEL} SELECT {_DETECTED} FROM impossible_travel",
    # A flagged row comes out when its two-hour slice has closed.
    "stream_impossible_travel": f"""WITH {TX}, {_TRAVEL}
        SELECT {_DETECTED} FROM impossible_travel
        WHERE time_bucket(INTERVAL 2 HOUR, event_time) + INTERVAL 2 HOUR
              <= (SELECT max(event_time) FROM tx) - INTERVAL 2 MINUTE""",
    "stream_high_amount": f"WITH {TX}, {_HIGH} SELECT {_DETECTED} FROM high_amount",
    "card_home_city": _HOME,
    "card_home_city_of_many": _HOME,
    "detector_confusion": f"WITH {TX}, {_HIGH}, {_TESTING}, {_TRAVEL} "
    + " UNION ALL ".join(
        _CONFUSION_ROW.format(name=name) for name in ("high_amount", "card_testing", "impossible_travel")
    ),
}
