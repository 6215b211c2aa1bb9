"""SQL for DuckDB that gives the rows of each registered query, from the same tables."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-29 00:00:00'"
LATER = "TIMESTAMP '2024-01-29 12:00:00'"
EARLIER = "TIMESTAMP '2024-01-15 00:00:00'"
REPORT_TIME = "TIMESTAMP '2024-01-31 00:00:00'"
RUN_1 = "run-20240129000000-00000001"
RUN_2 = "run-20240129000000-00000002"

_FIELDS = "transaction_id, account_id, posted_at, amount, currency, description, updated_at, status"
_REASON = f"""
    CASE
      WHEN posted_failed OR amount_failed OR updated_failed THEN 'parsing_error'
      WHEN account_id IS NULL OR account_id = '' THEN 'missing_account_id'
      WHEN amount_value IS NULL THEN 'missing_amount'
      WHEN posted_ts IS NULL THEN 'missing_posted_at'
      WHEN posted_ts > {AS_OF} + INTERVAL 1 DAY THEN 'future_posted_at'
    END
"""
_REFRESHED_BY_MONTH = f"""
    CASE WHEN date_trunc('month', posted_at) IN (
      SELECT date_trunc('month', posted_at) FROM bronze_late WHERE load_run_id = '{RUN_2}'
    ) THEN {LATER} ELSE {AS_OF} END
"""
_TYPED = """
    SELECT *,
      posted_at <> '' AND posted_ts IS NULL AS posted_failed,
      coalesce(amount, '') <> '' AND amount_value IS NULL AS amount_failed,
      updated_at <> '' AND updated_ts IS NULL AS updated_failed
    FROM (
      SELECT *,
        try_cast(nullif(posted_at, '') AS TIMESTAMP) AS posted_ts,
        try_cast(nullif(amount, '') AS DOUBLE) AS amount_value,
        try_cast(nullif(updated_at, '') AS TIMESTAMP) AS updated_ts
      FROM {rows}
    )
"""


def _bronze(rows: str, run_id: str) -> str:
    return f"""
    SELECT '{run_id}' AS load_run_id, source_name, transaction_id AS raw_transaction_id, account_id,
      posted_ts AS posted_at, amount_value AS amount, currency, description, updated_ts AS updated_at,
      status, raw_line_hash, {AS_OF} AS ingested_at
    FROM {rows} WHERE quarantine_reason IS NULL
    """


def _standardized(bronze: str) -> str:
    return f"""
    SELECT source_name || '|' || coalesce(raw_transaction_id, '') || '|' || CAST(posted_at AS VARCHAR)
        AS natural_key,
      source_name, raw_transaction_id, account_id, posted_at, amount, upper(currency) AS currency,
      trim(description) AS description, coalesce(updated_at, posted_at) AS updated_at,
      lower(coalesce(status, 'posted')) AS status, load_run_id, raw_line_hash
    FROM {bronze} WHERE posted_at IS NOT NULL
    """


def _silver(standardized: str, refreshed: str = AS_OF) -> str:
    return f"""
    SELECT natural_key, source_name, raw_transaction_id, account_id, posted_at, amount, currency,
      description, updated_at, status, load_run_id, {refreshed} AS refreshed_at
    FROM (
      SELECT *, row_number() OVER (
          PARTITION BY natural_key ORDER BY updated_at DESC, load_run_id DESC, raw_line_hash) AS rn
      FROM {standardized}
    )
    WHERE rn = 1 AND account_id IS NOT NULL AND amount IS NOT NULL
      AND posted_at <= {AS_OF} + INTERVAL 1 DAY AND status <> 'deleted'
    """


def _gold(silver: str, refreshed: str) -> str:
    return f"""
    SELECT CAST(posted_at AS DATE) AS run_date, account_id, currency, round(sum(amount), 2) AS total_amount,
      count(*) AS transaction_count, {refreshed} AS last_refresh_ts
    FROM {silver} GROUP BY 1, 2, 3
    """


_DURATION = "date_diff('second', start_ts, end_ts)"

_CTES = {
    "source_a": """
    SELECT 'source_a' AS source_name, 'A' || o_orderkey AS transaction_id,
      CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE 'ACC-' || o_custkey END AS account_id,
      CASE WHEN o_orderkey % 211 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END AS posted_at,
      CASE WHEN o_orderkey % 89 = 0 THEN 'abc' WHEN o_orderkey % 83 = 0 THEN ''
        ELSE CAST(o_totalprice AS VARCHAR) END AS amount,
      CASE o_orderkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'usd' ELSE 'Usd' END AS currency,
      ' ' || o_orderpriority || ' ' AS description,
      CASE WHEN o_orderkey % 5 = 0 THEN ''
        ELSE strftime(o_orderdate + to_seconds(o_orderkey % 3600), '%Y-%m-%dT%H:%M:%S') END AS updated_at,
      CASE WHEN o_orderkey % 50 = 0 THEN 'Deleted' WHEN o_orderstatus = 'P' THEN 'pending'
        ELSE 'posted' END AS status
    FROM orders
    """,
    "source_b_base": """
    SELECT event_id, ts, 'source_b' AS source_name, 'B' || event_id AS transaction_id,
      CASE WHEN event_id % 101 = 0 THEN '' ELSE 'ACC-' || user_id END AS account_id,
      strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS posted_at,
      CASE WHEN event_id % 103 = 0 THEN 'abc' ELSE CAST(value AS VARCHAR) END AS amount,
      'USD' AS currency, event_type AS description,
      strftime(ts + INTERVAL 60 SECOND, '%Y-%m-%dT%H:%M:%S.%f') AS updated_at, 'posted' AS status
    FROM events
    """,
    "source_b": f"""
    SELECT source_name, {_FIELDS} FROM source_b_base
    UNION ALL
    SELECT source_name, {_FIELDS} FROM source_b_base WHERE event_id % 7 = 0
    UNION ALL
    SELECT source_name, transaction_id, account_id, posted_at,
      CASE WHEN event_id % 103 = 0 THEN 'abc' ELSE CAST(event_id % 500 + 0.25 AS VARCHAR) END,
      currency, description, strftime(ts + INTERVAL 86400 SECOND, '%Y-%m-%dT%H:%M:%S.%f'),
      CASE WHEN event_id % 40 = 0 THEN 'DELETED' ELSE 'posted' END
    FROM source_b_base WHERE event_id % 10 = 0
    """,
    "feed": "SELECT * FROM source_a UNION ALL SELECT * FROM source_b",
    "hashed": f"SELECT *, sha256(concat_ws('|', source_name, {_FIELDS})) AS raw_line_hash FROM feed",
    "deduped": "SELECT DISTINCT * FROM hashed",
    "typed": _TYPED.format(rows="deduped"),
    "routed": f"SELECT *, {_REASON} AS quarantine_reason FROM typed",
    "bronze": _bronze("routed", RUN_1),
    "quarantine": f"""
    SELECT '{RUN_1}' AS load_run_id, source_name, transaction_id AS raw_transaction_id, account_id,
      posted_at AS posted_at_text, amount AS amount_text, currency, description,
      updated_at AS updated_at_text, status, quarantine_reason, {AS_OF} AS quarantined_at
    FROM routed WHERE quarantine_reason IS NOT NULL
    """,
    "standardized": _standardized("bronze"),
    "silver": _silver("standardized"),
    "gold": _gold("silver", AS_OF),
    "gold_a": _gold("silver WHERE source_name = 'source_a'", AS_OF),
    "notes": """
    SELECT natural_key, account_id, CAST(posted_at AS DATE) AS transaction_date, amount, currency,
      concat('Account ', account_id, ' posted ', CAST(amount AS VARCHAR), ' ', currency, ' on ',
        CAST(CAST(posted_at AS DATE) AS VARCHAR), '. Description: ', description) AS semantic_text
    FROM silver WHERE description IS NOT NULL
    """,
    "mart": _gold("silver", "max(refreshed_at)"),
    # Two deliveries: even transaction numbers first, then everything.
    "load_1": "SELECT * FROM routed WHERE CAST(substr(transaction_id, 2) AS BIGINT) % 2 = 0",
    "load_2": """
    SELECT * FROM routed r WHERE NOT EXISTS (
      SELECT 1 FROM load_1 f WHERE f.quarantine_reason IS NULL
        AND f.source_name = r.source_name AND f.raw_line_hash = r.raw_line_hash)
    """,
    "bronze_two": f"{_bronze('load_1', RUN_1)} UNION ALL {_bronze('load_2', RUN_2)}",
    "standardized_two": _standardized("bronze_two"),
    "silver_two": _silver("standardized_two"),
    # Two deliveries, the second later and for a few months: 1996 with its odd numbers, June 1995 deleted.
    "tombstones": f"""
    SELECT *, sha256(concat_ws('|', source_name, {_FIELDS})) AS raw_line_hash FROM (
      SELECT DISTINCT source_name, transaction_id, account_id, posted_at, amount, currency, description,
        '2024-01-20T00:00:00' AS updated_at, 'deleted' AS status
      FROM feed WHERE substr(posted_at, 1, 7) = '1995-06'
    )
    """,
    "late_typed": _TYPED.format(rows="tombstones"),
    "late_routed": f"SELECT *, {_REASON} AS quarantine_reason FROM late_typed",
    "early_part": """
    SELECT * FROM routed
    WHERE NOT (substr(posted_at, 1, 4) = '1996' AND CAST(substr(transaction_id, 2) AS BIGINT) % 2 = 1)
    """,
    "late_part": """
    SELECT * FROM routed
    WHERE substr(posted_at, 1, 4) = '1996' AND CAST(substr(transaction_id, 2) AS BIGINT) % 2 = 1
    """,
    "bronze_late": f"""
    {_bronze('early_part', RUN_1)} UNION ALL {_bronze('late_part', RUN_2)}
    UNION ALL {_bronze('late_routed', RUN_2)}
    """,
    "standardized_late": _standardized("bronze_late"),
    "silver_late": _silver("standardized_late", _REFRESHED_BY_MONTH),
    # Columns that a feed has lost.
    "lost_feed": """
    SELECT DISTINCT source_name, CAST(NULL AS VARCHAR) AS transaction_id, account_id, posted_at, amount, currency,
      description, CAST(NULL AS VARCHAR) AS updated_at, CAST(NULL AS VARCHAR) AS status FROM source_a
    UNION ALL
    SELECT DISTINCT source_name, transaction_id, account_id, posted_at, amount, currency,
      CAST(NULL AS VARCHAR), updated_at, status FROM source_b
    """,
    "lost_hashed": f"""
    SELECT *, sha256(concat_ws('|', source_name, {', '.join(f"coalesce({c}, '')" for c in _FIELDS.split(', '))}))
      AS raw_line_hash FROM lost_feed
    """,
    "lost_typed": _TYPED.format(rows="lost_hashed"),
    "lost_routed": f"SELECT *, {_REASON} AS quarantine_reason FROM lost_typed",
    "lost_bronze": _bronze("lost_routed", RUN_1),
    "lost_standardized": _standardized("lost_bronze"),
    "lost_silver": _silver("lost_standardized"),
    # Records with whole texts; of the documents every tenth is cut off after the amount.
    "text_feed": """
    SELECT 'source_a' AS source_name, doc_id AS k, 'D' || doc_id AS transaction_id, 'ACC-' || doc_id % 100 AS account_id,
      doc_id || '.5' AS amount, coalesce(text, '') AS description, doc_id % 10 = 3 AS cut,
      CASE WHEN doc_id % 4 = 0 THEN 'Deleted' ELSE 'posted' END AS status FROM documents
    UNION ALL
    SELECT 'source_b', conv_id, 'C' || conv_id || '-' || turn, 'ACC-' || conv_id % 100, turn || '.5',
      coalesce(text, ''), false, CASE WHEN turn % 4 = 0 THEN 'Deleted' ELSE 'posted' END
    FROM conversations WHERE position(chr(10) IN coalesce(text, '')) = 0
    """,
    "runs": """
    SELECT 'run-' || strftime(day, '%Y%m%d') AS run_id, start_ts, end_ts,
      CASE WHEN errors > 70 THEN 'failed' ELSE 'success' END AS status, records_ingested, records_silver,
      errors AS records_quarantine, freshness_lag_minutes,
      CASE WHEN errors > 70 THEN 'too many errors' END AS error_message
    FROM (
      SELECT CAST(ts AS DATE) AS day, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS records_ingested,
        count(DISTINCT user_id) AS records_silver,
        count(*) FILTER (event_type = 'error') AS errors, max(event_id) % 1000 AS freshness_lag_minutes
      FROM events GROUP BY 1
    )
    """,
    "latest": f"""
    SELECT *, {_DURATION} AS duration_seconds FROM runs ORDER BY end_ts DESC, run_id DESC LIMIT 1
    """,
    "stats": f"""
    SELECT count(*) AS runs_last_7d,
      CAST(sum(CASE WHEN status = 'success' THEN 1 ELSE 0 END) AS BIGINT) AS successful_runs_last_7d,
      round(avg(records_quarantine), 2) AS avg_quarantine_last_7d,
      round(avg(freshness_lag_minutes), 2) AS avg_freshness_lag_last_7d,
      round(avg({_DURATION}), 2) AS avg_duration_seconds_last_7d
    FROM runs WHERE end_ts >= {REPORT_TIME} - INTERVAL 7 DAY
    """,
    "breakdown": "SELECT quarantine_reason, count(*) AS issue_count FROM quarantine GROUP BY 1",
    "top_reasons": """
    SELECT string_agg(quarantine_reason || ':' || issue_count, ', '
      ORDER BY issue_count DESC, quarantine_reason) AS top_quarantine_reasons FROM breakdown
    """,
    "counters": """
    SELECT source_name, count(*) FILTER (quarantine_reason IS NULL) AS ingested,
      count(*) FILTER (quarantine_reason IS NOT NULL) AS quarantined
    FROM routed GROUP BY 1
    """,
    "lag": f"""
    SELECT CAST(floor(date_diff('microsecond', max(posted_at), {AS_OF}) / 60000000.0) AS BIGINT)
      AS freshness_lag_minutes FROM silver
    """,
}


def _with(final: str) -> str:
    """Put the CTEs that the statement uses, directly or through others, in front of it."""
    needed: set[str] = set()
    words = set(final.replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split())
    for name in reversed(_CTES):
        if name in words:
            needed.add(name)
            body = _CTES[name]
            words |= set(body.replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split())
    ctes = ",\n".join(f"{name} AS ({_CTES[name].strip()})" for name in _CTES if name in needed)
    return f"WITH {ctes}\n{final.strip()}" if ctes else final.strip()


def _checks(dataset: str, rows: str, clock: str) -> str:
    return f"""
    SELECT '{dataset}' AS dataset, check_name, failing_count = 0 AS passed, failing_count FROM (
      SELECT 'null_key_check' AS check_name, count(*) AS failing_count FROM {rows}
        WHERE account_id IS NULL OR currency IS NULL
      UNION ALL
      SELECT 'future_timestamp_check', count(*) FROM {rows} WHERE posted_at > {clock} + INTERVAL 1 DAY
      UNION ALL
      SELECT 'duplicate_natural_key_check', count(*)
        FROM (SELECT natural_key FROM {rows} GROUP BY 1 HAVING count(*) > 1)
    )
    """


def _rule(model: str, rule: str, column: str, count_sql: str) -> str:
    return f"""
    SELECT '{model}' AS model, '{rule}' AS rule, '{column}' AS column_name, failing_count = 0 AS passed,
      failing_count FROM (SELECT {count_sql} AS failing_count)
    """


def _not_null(model: str, rows: str, columns: list[str]) -> list[str]:
    return [
        _rule(model, "not_null", c, f"(SELECT count(*) FROM {rows} WHERE {c} IS NULL )") for c in columns
    ]


def _unique(model: str, rows: str, column: str) -> str:
    found = f"SELECT {column} FROM {rows} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
    return _rule(model, "unique", column, f"(SELECT count(*) FROM ({found}))")


def _accepted(model: str, rows: str) -> str:
    return _rule(
        model, "accepted_values", "currency", f"(SELECT count(*) FROM {rows} WHERE currency NOT IN ('USD'))"
    )


_STG_NOT_NULL = _not_null(
    "stg_silver_transactions", "silver", ["natural_key", "account_id", "currency", "amount"]
)
_MART_NOT_NULL = _not_null("fct_daily_account_summary", "mart", ["run_date", "account_id", "total_amount"])
_PARSED_NOT_NULL = _not_null("parsed_feed", "typed", ["posted_ts", "amount_value", "updated_ts"])
_STG_UNIQUE = _unique("stg_silver_transactions", "silver", "natural_key")
_STG_ACCEPTED = _accepted("stg_silver_transactions", "silver")
_ROUTE = "CASE WHEN quarantine_reason IS NULL THEN 'bronze' ELSE 'quarantine' END AS route"
_ROUTED_COLUMNS = (
    f"source_name, transaction_id AS raw_transaction_id, raw_line_hash, {_ROUTE}, quarantine_reason"
)
_REPORT = """
SELECT l.run_id, l.status AS latest_status, l.duration_seconds, l.records_ingested, l.records_silver,
  l.records_quarantine, l.freshness_lag_minutes, s.runs_last_7d, s.successful_runs_last_7d,
  round(s.successful_runs_last_7d / nullif(s.runs_last_7d, 0) * 100, 2) AS success_rate_last_7d,
  s.avg_quarantine_last_7d, s.avg_freshness_lag_last_7d, s.avg_duration_seconds_last_7d,
  t.top_quarantine_reasons, l.error_message
FROM latest l, stats s, top_reasons t
"""
_DRIFTED = _TYPED.format(
    rows="""(SELECT DISTINCT source_name, transaction_id, account_id, posted_at,
        CAST(NULL AS VARCHAR) AS amount, currency, description, updated_at, status FROM source_b )"""
)

_FINAL = {
    "csv_feed_scan": "SELECT * FROM source_a",
    "feed_union": "SELECT * FROM feed",
    "object_store_feed": "SELECT * FROM counters",
    "feed_malformed_rows": """
    SELECT DISTINCT source_name, transaction_id AS raw_transaction_id,
      md5(CASE WHEN cut THEN '' ELSE description END) AS description_md5,
      CASE WHEN cut THEN '' ELSE status END AS status,
      CASE WHEN NOT cut THEN CAST(amount AS DOUBLE) END AS amount,
      CASE WHEN cut THEN 'damaged record: ' || transaction_id || ',' || account_id || ',2024-01-05T08:00:00,' || amount
        END AS posted_at_text,
      CASE WHEN cut THEN 'parsing_error' END AS quarantine_reason
    FROM text_feed
    """,
    "feed_quoted_parallel": """
    SELECT 'source_a' AS source_name, 'D' || doc_id AS transaction_id, md5(coalesce(text, '')) AS description_md5,
      doc_id || '.5' AS amount, CASE WHEN doc_id % 4 = 0 THEN 'Deleted' ELSE 'posted' END AS status
    FROM documents
    """,
    "feed_damaged_pieces": """
    SELECT 'source_b' AS source_name, 'parsing_error' AS quarantine_reason, count(*) AS pieces,
      CAST(sum(strlen(piece)) AS BIGINT) AS bytes
    FROM (
      SELECT DISTINCT unnest(regexp_split_to_array(
        'C' || conv_id || '-' || turn || ',ACC-' || conv_id % 100 || ',2024-01-05T08:00:00,' || turn || '.5,USD,"'
        || replace(text, '"', '""') || '",2024-01-06T08:00:00,' || CASE WHEN turn % 4 = 0 THEN 'Deleted' ELSE 'posted' END,
        '\r\n|\r|\n')) AS piece
      FROM conversations WHERE regexp_matches(text, '[\r\n]')
    )
    WHERE trim(piece) <> '' HAVING count(*) > 0
    """,
    "landing_objects": f"""
    SELECT source_name, coalesce(nullif(substr(posted_at, 1, 4), ''), 'undated') AS delivery_year,
      CAST(sum(strlen(concat_ws('|', {_FIELDS})) + 1) AS BIGINT) AS bytes
    FROM feed GROUP BY 1, 2
    """,
    "landing_changes": f"""
    SELECT change, source_name, '1996' AS delivery_year,
      CAST(sum(strlen(concat_ws('|', {_FIELDS})) + 1) AS BIGINT) AS bytes
    FROM (
      SELECT 'gone' AS change, * FROM feed UNION ALL
      SELECT 'new', * FROM feed WHERE CAST(substr(transaction_id, 2) AS BIGINT) % 2 = 1
    ) WHERE substr(posted_at, 1, 4) = '1996' GROUP BY ALL
    UNION ALL SELECT 'new', 'marker', '1996', 4
    """,
    "feed_line_hash": "SELECT source_name, transaction_id, raw_line_hash FROM hashed",
    "feed_dedup_exact": "SELECT * FROM deduped",
    "feed_typed_parse": """
    SELECT raw_line_hash, posted_ts, amount_value, updated_ts, posted_failed, amount_failed, updated_failed
    FROM typed
    """,
    "feed_quarantine_routing": f"SELECT {_ROUTED_COLUMNS} FROM routed",
    "bronze_accepted": "SELECT * FROM bronze",
    "quarantine_rows": "SELECT * FROM quarantine",
    "run_counters": "SELECT * FROM counters",
    "feed_replay_antijoin": f"SELECT {_ROUTED_COLUMNS} FROM load_2",
    "drift_quarantine_breakdown": f"""
    SELECT quarantine_reason, count(*) AS issue_count
    FROM (SELECT {_REASON} AS quarantine_reason FROM ({_DRIFTED}))
    WHERE quarantine_reason IS NOT NULL GROUP BY 1
    """,
    "silver_standardize": "SELECT * FROM standardized",
    "silver_latest": "SELECT * FROM silver",
    "gold_daily_account_summary": "SELECT * FROM gold",
    "ai_ready_notes": "SELECT * FROM notes",
    "ai_ready_csv_roundtrip": "SELECT * FROM notes",
    "staging_view": "SELECT * FROM silver WHERE amount IS NOT NULL",
    "mart_daily_summary": "SELECT * FROM mart",
    "backfill_by_date": f"""
    SELECT CAST(posted_at AS DATE) AS posted_date, count(*) AS row_count
    FROM silver_two WHERE load_run_id = '{RUN_2}' GROUP BY 1
    """,
    "silver_incremental_merge": "SELECT * FROM silver_late",
    "gold_incremental_publish": _gold("silver_late", "max(refreshed_at)"),
    "notes_export_incremental": _CTES["notes"].replace("FROM silver ", "FROM silver_late "),
    "stored_manifest": """
    SELECT 'bronze' AS route, source_name, CAST(date_trunc('month', posted_at) AS DATE) AS posted_period,
      count(*) AS row_count, min(posted_at) AS least, max(posted_at) AS greatest, count(*) AS rows_read
    FROM bronze_late GROUP BY ALL
    UNION ALL
    SELECT 'quarantine', source_name, NULL, count(*), NULL, NULL, count(*) FROM (
      SELECT source_name FROM early_part WHERE quarantine_reason IS NOT NULL
      UNION ALL SELECT source_name FROM routed WHERE quarantine_reason IS NOT NULL AND substr(posted_at, 1, 4) = '1996'
      UNION ALL SELECT source_name FROM late_routed WHERE quarantine_reason IS NOT NULL
    ) GROUP BY ALL
    """,
    "silver_absent_columns": """
    SELECT natural_key, raw_transaction_id, account_id, amount, description, updated_at, status,
      CASE WHEN description IS NOT NULL THEN concat('Account ', account_id, ' posted ', CAST(amount AS VARCHAR), ' ',
        currency, ' on ', CAST(CAST(posted_at AS DATE) AS VARCHAR), '. Description: ', description) END AS semantic_text
    FROM lost_silver
    """,
    "silver_date_range": """
    SELECT * FROM silver
    WHERE posted_at >= TIMESTAMP '1998-03-10 00:00:00' AND posted_at < TIMESTAMP '1998-07-20 00:00:00'
    """,
    "quality_checks": _checks("silver", "silver", AS_OF)
    + "UNION ALL"
    + _checks("versions", "standardized", EARLIER),
    "quality_checks_from_counts": _checks("later", "silver_late", LATER)
    + "UNION ALL"
    + _checks("earlier", "silver_late", EARLIER),
    "freshness_lag": "SELECT * FROM lag",
    "rule_not_null": "UNION ALL".join(_STG_NOT_NULL + _MART_NOT_NULL + _PARSED_NOT_NULL),
    "rule_unique": "UNION ALL".join([_STG_UNIQUE, _unique("bronze_transactions", "bronze", "raw_transaction_id")]),
    "rule_accepted_values": "UNION ALL".join([_STG_ACCEPTED, _accepted("bronze_transactions", "bronze")]),
    "published_model_rules": "UNION ALL".join(_STG_NOT_NULL + [_STG_UNIQUE, _STG_ACCEPTED] + _MART_NOT_NULL),
    "latest_run": "SELECT * FROM latest",
    "run_stats_7d": "SELECT * FROM stats",
    "quarantine_breakdown": "SELECT * FROM breakdown",
    "quarantine_top": "SELECT * FROM top_reasons",
    "run_health_report": _REPORT,
    "run_health_report_csv": _REPORT,
    "layer_counts": """
    SELECT 'silver' AS layer, count(*) AS row_count FROM silver
    UNION ALL SELECT 'gold', count(*) FROM gold
    UNION ALL SELECT 'quarantine', count(*) FROM quarantine
    """,
    "run_audit": f"""
    SELECT '{RUN_1}' AS run_id, {AS_OF} AS start_ts, true AS ends_after_start, 'success' AS status,
      (SELECT CAST(sum(ingested) AS BIGINT) FROM counters) AS records_ingested,
      (SELECT count(*) FROM silver) AS records_silver,
      (SELECT CAST(sum(quarantined) AS BIGINT) FROM counters) AS records_quarantine,
      (SELECT freshness_lag_minutes FROM lag) AS freshness_lag_minutes,
      CAST(NULL AS VARCHAR) AS error_message
    """,
    "failed_gate_run": f"""
    SELECT CASE source_name WHEN 'source_a' THEN '{RUN_1}' ELSE '{RUN_2}' END AS run_id,
      CASE source_name WHEN 'source_a' THEN {EARLIER} ELSE {AS_OF} END AS start_ts,
      CASE source_name WHEN 'source_a' THEN 'success' ELSE 'failed' END AS status,
      ingested AS records_ingested,
      (SELECT count(*) FROM silver s WHERE s.source_name <= c.source_name) AS records_silver,
      quarantined AS records_quarantine,
      CASE source_name WHEN 'source_a' THEN (
        SELECT CAST(floor(date_diff('microsecond', max(posted_at), {EARLIER}) / 60000000.0) AS BIGINT)
        FROM silver WHERE source_name = 'source_a') END AS freshness_lag_minutes,
      CASE source_name WHEN 'source_b' THEN 'Quality checks failed: null_key_check' END AS error_message,
      (SELECT count(*) FROM gold_a ) AS gold_rows,
      (SELECT CAST(sum(transaction_count) AS BIGINT) FROM gold_a ) AS gold_transactions,
      {EARLIER} AS gold_refreshed_at
    FROM counters c
    """,
    "metrics_roundtrip": f"""
    SELECT '{RUN_1}/' || source_name AS run_id, 'success' AS status, ingested AS records_ingested,
      CAST(NULL AS BIGINT) AS records_silver, quarantined AS records_quarantine,
      CAST(NULL AS BIGINT) AS freshness_lag_minutes, '2024-01-29T00:00:00+00:00' AS event_ts
    FROM counters
    """,
    "promoted_tables": """
    SELECT 'SILVER_TRANSACTIONS' AS target_table, count(*) AS rows_reported, count(*) AS row_count FROM silver
    UNION ALL
    SELECT 'GOLD_DAILY_ACCOUNT_SUMMARY', count(*), count(*) FROM gold
    """,
}

ORACLE_SQL: dict[str, str] = {name: _with(final) for name, final in _FINAL.items()}
