"""Oracle SQL per query key (see :mod:`ledgerflow.plans.oracle_sql` for the stages)."""

from __future__ import annotations

from ledgerflow.plans.oracle_sql import AS_OF, REQUIRED, cte, nm, ts, with_ctes

ORACLE: dict[str, str] = {}


def oracle(name: str, final_sql: str, *ctes: str):
    ORACLE[name] = with_ctes(final_sql, *ctes)


oracle("star_rollup", """
SELECT CASE WHEN f.merchant_key = -1 THEN 'Unknown' ELSE dm.category_group END AS category_group,
  CASE WHEN f.merchant_key = -1 THEN 'Unknown' ELSE dm.merchant_region END AS merchant_region,
  CASE WHEN f.customer_key = -1 THEN 'Unknown' ELSE dc.customer_tier END AS customer_tier,
  CAST(strftime(f.transaction_timestamp, '%Y%m') AS INTEGER) AS month_key,
  count(*) AS txn_count, CAST(sum(f.amount_usd) AS DECIMAL(38,2)) AS amount_usd
FROM fact f
LEFT JOIN dim_merchant dm ON f.merchant_key = dm.merchant_key AND dm.merchant_key <> -1
LEFT JOIN dim_customer dc ON f.customer_key = dc.customer_key AND dc.is_current AND dc.customer_key <> -1
GROUP BY 1, 2, 3, 4""", "fact", "dim_merchant", "dim_customer")

oracle("stage_clean", "SELECT * EXCLUDE (card_number), CASE WHEN regexp_matches(regexp_replace(card_number, '[- ]', '', 'g'), '^[0-9]{13,}$') THEN 'unmasked ****' || right(regexp_replace(card_number, '[- ]', '', 'g'), 4) ELSE card_number END AS card_number FROM clean", "clean")

oracle("dedup_latest", """
SELECT transaction_id, _loaded_at, amount_text FROM (
  SELECT trim(transaction_id) AS transaction_id, _loaded_at, amount AS amount_text,
    row_number() OVER (PARTITION BY trim(transaction_id) ORDER BY _loaded_at DESC, _source_file DESC, amount DESC NULLS LAST) AS rn
  FROM raw_transactions WHERE transaction_id IS NOT NULL) WHERE rn = 1""", "raw_transactions")

oracle("dim_customer_load", "SELECT * FROM dim_customer", "dim_customer")
oracle("scd2_changes", "SELECT customer_id, new_hash, existing_hash, change_type FROM changes2", "changes2")
oracle("scd2_expire", "SELECT * FROM hist2", "hist2")
oracle("scd2_late_snapshot", "SELECT * FROM hist2", "hist2")
oracle("fact_load", "SELECT * FROM fact", "fact")
oracle("merchant_stats", "SELECT * FROM merchant_stats", "merchant_stats")


# --- monitoring ------------------------------------------------------------------------------
import datetime as _dt  # noqa: E402

from ledgerflow.plans.oracle_sql import (  # noqa: E402
    AS_OF, METRIC_DAYS, cte, minutes_sql, rate_sql, seconds_sql, ts, window,
)

oracle("raw_profile", f"""
SELECT count(*) AS record_count, count(DISTINCT transaction_id) AS unique_txns, min(transaction_timestamp) AS min_ts,
  max(transaction_timestamp) AS max_ts, count(CASE WHEN transaction_id IS NULL THEN 1 END) AS null_ids,
  count(CASE WHEN amount IS NULL THEN 1 END) AS null_amounts,
  CASE WHEN count(*) = 0 THEN 'EMPTY' ELSE 'OK' END AS status
FROM raw_transactions WHERE {window('_loaded_at', AS_OF, METRIC_DAYS)}""", "raw_transactions")

MINS = METRIC_DAYS * 24 * 60
cte("qm_agg", f"""
SELECT count(*) AS n, max(_batch_id) AS batch_id, count(CASE WHEN amount IS NULL THEN 1 END) AS null_amounts,
  count(DISTINCT transaction_id) AS distinct_ids, avg(amount_usd) AS avg_usd, min(amount_usd) AS min_usd,
  max(amount_usd) AS max_usd,
  (SELECT max(transaction_timestamp) FROM fact) AS max_ts, (SELECT max(_batch_id) FROM fact) AS all_batch_id
FROM fact WHERE {window('processed_at', AS_OF, METRIC_DAYS)}""", ["fact"])

QM = {
    "row_count": f"""SELECT 'row_count' AS metric_name, CAST(n AS DECIMAL(18,6)) AS metric_value,
  CAST(1000 AS DECIMAL(18,6)) AS threshold, CASE WHEN n >= 1000 THEN 'PASS' ELSE 'WARNING' END AS status,
  'Total rows in last {MINS} min: ' || CAST(n AS VARCHAR) AS details, batch_id FROM qm_agg""",
    "null_rate_amount": f"""SELECT 'null_rate_amount', {rate_sql('null_amounts', 'n')}, CAST(0.001 AS DECIMAL(18,6)),
  CASE WHEN {rate_sql('null_amounts', 'n')} <= 0.001 THEN 'PASS' ELSE 'FAIL' END,
  'Null amounts: ' || CAST(null_amounts AS VARCHAR), batch_id FROM qm_agg""",
    "duplicate_rate": f"""SELECT 'duplicate_rate', {rate_sql('n - distinct_ids', 'n')}, CAST(0 AS DECIMAL(18,6)),
  CASE WHEN n = distinct_ids THEN 'PASS' ELSE 'FAIL' END, 'Duplicates: ' || CAST(n - distinct_ids AS VARCHAR),
  batch_id FROM qm_agg""",
    "data_freshness_minutes": f"""SELECT 'data_freshness_minutes',
  CAST({minutes_sql('max_ts', ts(AS_OF))} AS DECIMAL(18,6)), CAST(60 AS DECIMAL(18,6)),
  CASE WHEN {minutes_sql('max_ts', ts(AS_OF))} <= 60 THEN 'PASS' ELSE 'WARNING' END,
  'Last transaction: ' || coalesce(CAST(max_ts AS VARCHAR), ''), all_batch_id FROM qm_agg""",
    "avg_amount_usd": """SELECT 'avg_amount_usd', CAST(CAST(avg_usd AS DECIMAL(18,2)) AS DECIMAL(18,6)),
  CAST(NULL AS DECIMAL(18,6)), 'INFO',
  'Avg: $' || coalesce(CAST(CAST(avg_usd AS DECIMAL(18,2)) AS VARCHAR), '') || ' | Min: $'
  || coalesce(CAST(min_usd AS VARCHAR), '') || ' | Max: $' || coalesce(CAST(max_usd AS VARCHAR), ''),
  batch_id FROM qm_agg""",
}


def _qm_sql(names):
    body = "\nUNION ALL\n".join(QM[n] for n in names)
    return (f"SELECT {ts(AS_OF)} AS metric_timestamp, 'fct_transactions' AS table_name, metric_name, metric_value, "
            f"threshold, status, details, batch_id FROM ({body}) m(metric_name, metric_value, threshold, status, details, batch_id)")


for _k, _m in [("metric_row_count", "row_count"), ("metric_null_rate", "null_rate_amount"),
               ("metric_duplicate_rate", "duplicate_rate"), ("metric_freshness", "data_freshness_minutes"),
               ("metric_avg_amount", "avg_amount_usd")]:
    oracle(_k, _qm_sql([_m]), "qm_agg")
oracle("quality_metrics", _qm_sql(list(QM)), "qm_agg")

cte("sla_agg", f"""
SELECT count(*) AS n, min(processed_at) AS first_processed, max(processed_at) AS last_processed,
  avg({seconds_sql('transaction_timestamp', 'processed_at')}) AS avg_latency,
  quantile_disc({seconds_sql('transaction_timestamp', 'processed_at')}, 0.95) AS p95_latency,
  count(CASE WHEN customer_key <> -1 AND merchant_key <> -1 THEN 1 END) AS covered,
  count(CASE WHEN NOT (customer_key <> -1 AND merchant_key <> -1) THEN 1 END) AS orphans
FROM fact WHERE {window('processed_at', AS_OF, METRIC_DAYS)}""", ["fact"])

THR = rate_sql("n", f"greatest({minutes_sql('first_processed', 'last_processed')}, 1)")
COV = f"CAST({rate_sql('covered', 'n', 12)} * 100 AS DECIMAL(18,6))"
SLA = {
    "throughput_records_per_minute": f"""SELECT 'throughput_records_per_minute' AS metric_name, {THR} AS metric_value,
  'records/min' AS unit, CASE WHEN {THR} >= 100 THEN 'HEALTHY' ELSE 'DEGRADED' END AS status,
  'Processed ' || CAST(n AS VARCHAR) || ' records in last {MINS} min' AS details FROM sla_agg""",
    "e2e_latency_seconds": """SELECT 'e2e_latency_seconds', CAST(CAST(round(avg_latency, 0) AS DECIMAL(38,0)) AS DECIMAL(18,6)),
  'seconds', CASE WHEN avg_latency <= 120 THEN 'WITHIN_SLA' ELSE 'SLA_BREACH' END,
  'Avg latency: ' || coalesce(CAST(CAST(round(avg_latency, 1) AS DECIMAL(18,1)) AS VARCHAR), '') || 's | P95: '
  || coalesce(CAST(p95_latency AS VARCHAR), '') || 's' FROM sla_agg""",
    "dimension_coverage_pct": f"""SELECT 'dimension_coverage_pct', {COV}, 'percent',
  CASE WHEN {rate_sql('covered', 'n', 12)} >= 0.99 THEN 'PASS' ELSE 'WARNING' END,
  'Orphan records: ' || CAST(orphans AS VARCHAR) FROM sla_agg""",
}


def _sla_sql(names, src="sla_agg"):
    body = "\nUNION ALL\n".join(SLA[n] for n in names)
    return (f"SELECT {ts(AS_OF)} AS metric_timestamp, 'transaction_pipeline' AS dag_id, {ts(AS_OF)} AS execution_date, "
            f"metric_name, metric_value, unit, status, details FROM ({body}) m(metric_name, metric_value, unit, status, details)")


for _k, _m in [("sla_throughput", "throughput_records_per_minute"), ("sla_latency", "e2e_latency_seconds"),
               ("dimension_coverage", "dimension_coverage_pct")]:
    oracle(_k, _sla_sql([_m]), "sla_agg")

oracle("sla_latency_p95", """SELECT 'e2e_latency_p95_seconds' AS metric_name,
  CAST(p95_latency AS DECIMAL(18,6)) AS metric_value, n AS sample_size FROM sla_agg""", "sla_agg")

oracle("sla_bands", """
SELECT metric_name, metric_value,
  CASE WHEN metric_value >= 120 THEN 'red' WHEN metric_value >= 90 THEN 'yellow'
       WHEN metric_value IS NOT NULL THEN 'green' END AS band
FROM (SELECT 'e2e_latency_seconds' AS metric_name,
        CAST(CAST(round(avg_latency, 0) AS DECIMAL(38,0)) AS DECIMAL(18,6)) AS metric_value FROM sla_agg
      UNION ALL
      SELECT 'e2e_latency_p95_seconds', CAST(p95_latency AS DECIMAL(18,6)) FROM sla_agg) b""", "sla_agg")

_LAST = AS_OF.date() - _dt.timedelta(days=1)
oracle("daily_volume", f"""
SELECT {ts(AS_OF)} AS metric_timestamp, 'transaction_pipeline' AS dag_id, {ts(AS_OF)} AS execution_date,
  'daily_volume' AS metric_name, CAST(count(*) AS DECIMAL(18,6)) AS metric_value, 'records' AS unit,
  CASE WHEN count(*) >= 30000 THEN 'ON_TRACK' ELSE 'BELOW_TARGET' END AS status,
  'Today: ' || CAST(count(*) AS VARCHAR) || ' records (target: 500K/day)' AS details
FROM fact WHERE transaction_timestamp >= TIMESTAMP '{_LAST} 00:00:00'
  AND transaction_timestamp < TIMESTAMP '{_LAST} 00:00:00' + INTERVAL 1 DAY""", "fact")

cte("g_daily", """SELECT CAST(processed_at AS DATE) AS day, count(*) AS n,
  count(CASE WHEN amount IS NULL THEN 1 END) AS nulls, count(DISTINCT transaction_id) AS ids,
  max(_batch_id) AS batch_id FROM fact GROUP BY 1""", ["fact"])

cte("daily_qm", f"""
SELECT CAST(day AS TIMESTAMP) AS metric_timestamp, 'fct_transactions' AS table_name, batch_id, metric_name,
  metric_value, status FROM (
  SELECT day, batch_id, 'row_count' AS metric_name, CAST(n AS DECIMAL(18,6)) AS metric_value,
    CASE WHEN n >= 1000 THEN 'PASS' ELSE 'WARNING' END AS status FROM g_daily
  UNION ALL SELECT day, batch_id, 'null_rate_amount', {rate_sql('nulls', 'n')},
    CASE WHEN {rate_sql('nulls', 'n')} <= 0.001 THEN 'PASS' ELSE 'FAIL' END FROM g_daily
  UNION ALL SELECT day, batch_id, 'duplicate_rate', {rate_sql('n - ids', 'n')},
    CASE WHEN n = ids THEN 'PASS' ELSE 'FAIL' END FROM g_daily) x""", ["g_daily"])
oracle("top_failed_metrics", """
SELECT * FROM daily_qm WHERE status IN ('FAIL', 'WARNING')
ORDER BY metric_timestamp DESC, metric_name, table_name LIMIT 20""", "daily_qm")

oracle("reconcile_counts", """
SELECT s.staged_rows, f.fact_rows, s.staged_rows - f.fact_rows AS difference,
  CASE WHEN s.staged_rows = f.fact_rows THEN 'MATCH' ELSE 'MISMATCH' END AS status
FROM (SELECT count(*) AS staged_rows FROM staged) s, (SELECT count(*) AS fact_rows FROM fact) f""", "staged", "fact")

oracle("volume_over_time", """
SELECT 'ingested' AS layer, CAST(_loaded_at AS DATE) AS day, count(*) AS records FROM raw_transactions GROUP BY 2
UNION ALL SELECT 'staged', CAST(_staged_at AS DATE), count(*) FROM staged GROUP BY 2
UNION ALL SELECT 'loaded', CAST(processed_at AS DATE), count(*) FROM fact GROUP BY 2""",
       "raw_transactions", "staged", "fact")

oracle("volume_variance", """
SELECT day, records, expected,
  CAST((records - expected) / expected AS DECIMAL(18,6)) AS variance,
  CASE WHEN expected IS NULL THEN 'NO_HISTORY'
       WHEN abs(CAST((records - expected) / expected AS DECIMAL(18,6))) <= 0.2 THEN 'PASS' ELSE 'WARNING' END AS status
FROM (SELECT day, records, CAST(avg(records) OVER (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
        AS DECIMAL(18,6)) AS expected
      FROM (SELECT CAST(processed_at AS DATE) AS day, count(*) AS records FROM fact GROUP BY 1) d) v""", "fact")


# --- data-quality checks --------------------------------------------------------------------
from ledgerflow import constants as _C  # noqa: E402
from ledgerflow.plans.oracle_sql import in_list as _in  # noqa: E402

_ASOF = ts(AS_OF)
_NUM = "TRY_CAST(amount AS DECIMAL(38,6))"
_TIME = "TRY_CAST(CAST(transaction_timestamp AS VARCHAR) AS TIMESTAMP)"


def _bad_set(c, vals):
    return f"count(CASE WHEN {c} IS NOT NULL AND lower(CAST({c} AS VARCHAR)) NOT IN {_in([v.lower() for v in vals])} THEN 1 END)"


cte("dq_frame", "SELECT * FROM clean", ["clean"])
cte("dq_agg", f"""
SELECT count(*) AS n,
  count(CASE WHEN transaction_id IS NULL THEN 1 END) AS c1, count(DISTINCT transaction_id) AS c2,
  count(CASE WHEN {_NUM} < 0.01 OR {_NUM} > 999999.99 THEN 1 END) AS c3,
  count(CASE WHEN {_NUM} > 999999.99 THEN 1 END) AS c4,
  {_bad_set('currency', _C.VALID_CURRENCIES)} AS c5, count(currency) AS c5_n,
  {_bad_set('status', _C.VALID_STATUSES)} AS c6, count(status) AS c6_n,
  count(CASE WHEN {_TIME} > {_ASOF} THEN 1 END) AS c7,
  count(CASE WHEN customer_id IS NULL THEN 1 END) AS c8, count(CASE WHEN merchant_id IS NULL THEN 1 END) AS c9,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM dq_frame) x) AS c10,
  max({_TIME}) AS c13,
  {_bad_set('channel', _C.VALID_CHANNELS)} AS c14, count(channel) AS c14_n,
  count(CASE WHEN regexp_matches(regexp_replace(CAST(card_number AS VARCHAR), '[- ]', '', 'g'), '^[0-9]{{13,}}$')
        THEN 1 END) AS c15
FROM dq_frame""", ["dq_frame"])


def _r(num, den):
    return f"(1 - {rate_sql(num, den)})"


_AGE_US = f"(epoch_us({_ASOF}) - epoch_us(c13))"
DQ_ROWS = {
    1: f"SELECT 1, 'Check 1: Transaction ID not null', 'completeness', c1 * 1000 <= n, 'Null rows: ' || c1 || ' of ' || n, {_r('c1', 'n')}, 0.999 FROM dq_agg",
    2: f"SELECT 2, 'Check 2: Transaction ID unique', 'uniqueness', n - c2 = 0, (n - c2) || ' duplicates', {_r('n - c2', 'greatest(n, 1)')}, 1.0 FROM dq_agg",
    3: f"SELECT 3, 'Check 3: Amount > 0', 'accuracy', {_r('c3', 'greatest(n, 1)')} >= 0.999, c3 || ' out of range', {_r('c3', 'greatest(n, 1)')}, 0.999 FROM dq_agg",
    4: f"SELECT 4, 'Check 4: Amount < 1M', 'accuracy', {_r('c4', 'greatest(n, 1)')} >= 0.9999, c4 || ' exceed max', {_r('c4', 'greatest(n, 1)')}, 0.9999 FROM dq_agg",
    5: f"SELECT 5, 'Check 5: Valid currency', 'referential', {_r('c5', 'greatest(c5_n, 1)')} >= 0.995, c5 || ' invalid values', {_r('c5', 'greatest(c5_n, 1)')}, 0.995 FROM dq_agg",
    6: f"SELECT 6, 'Check 6: Valid status', 'referential', {_r('c6', 'greatest(c6_n, 1)')} >= 0.995, c6 || ' invalid values', {_r('c6', 'greatest(c6_n, 1)')}, 0.995 FROM dq_agg",
    7: "SELECT 7, 'Check 7: No future timestamps', 'timeliness', c7 = 0, c7 || ' future timestamps', CASE WHEN c7 = 0 THEN 1 ELSE 0 END, 1.0 FROM dq_agg",
    8: f"SELECT 8, 'Check 8: Customer ID exists', 'completeness', c8 * 1000 <= n, 'Null rows: ' || c8 || ' of ' || n, {_r('c8', 'n')}, 0.999 FROM dq_agg",
    9: f"SELECT 9, 'Check 9: Merchant ID exists', 'completeness', c9 * 1000 <= n, 'Null rows: ' || c9 || ' of ' || n, {_r('c9', 'n')}, 0.999 FROM dq_agg",
    10: f"SELECT 10, 'Check 10: No duplicate rows', 'uniqueness', n - c10 = 0, (n - c10) || ' duplicate rows', {_r('n - c10', 'greatest(n, 1)')}, 1.0 FROM dq_agg",
    11: "SELECT 11, 'Check 11: Schema compliance', 'schema', TRUE, 'All columns present', 1, 1.0 FROM dq_agg",
    12: "SELECT 12, 'Check 12: Row count in range', 'volume', n >= 100, 'Rows: ' || n || ' (min: 100)', n, 100 FROM dq_agg",
    13: f"""SELECT 13, 'Check 13: Data freshness', 'timeliness',
      CASE WHEN c13 IS NULL THEN FALSE ELSE {_AGE_US} <= 3600000000 END,
      CASE WHEN c13 IS NULL THEN 'No valid timestamps' ELSE 'Age: ' || CAST(floor({_AGE_US} / 60000000) AS BIGINT) || ' min' END,
      CASE WHEN c13 IS NOT NULL AND {_AGE_US} <= 3600000000 THEN 1 ELSE 0 END, 0.99 FROM dq_agg""",
    14: f"SELECT 14, 'Check 14: Valid channel', 'referential', {_r('c14', 'greatest(c14_n, 1)')} >= 0.995, c14 || ' invalid values', {_r('c14', 'greatest(c14_n, 1)')}, 0.995 FROM dq_agg",
    15: "SELECT 15, 'Check 15: Card number masked', 'security', c15 = 0, c15 || ' unmasked in ''card_number''', CASE WHEN c15 = 0 THEN 1 ELSE 0 END, 1 FROM dq_agg",
}


def _dq_sql(ids):
    body = "\nUNION ALL\n".join(DQ_ROWS[i] for i in ids)
    return (f"SELECT check_id, check_name, check_type, success, details, CAST(metric_value AS DECIMAL(18,6)) AS metric_value, "
            f"CAST(threshold AS DECIMAL(18,6)) AS threshold FROM ({body}) r(check_id, check_name, check_type, success, "
            f"details, metric_value, threshold) WHERE (SELECT n FROM dq_agg) > 0")


for _k, _ids in {"dq_all": list(range(1, 16)), "dq_completeness": [1, 8, 9], "dq_uniqueness": [2, 10],
                 "dq_accuracy": [3, 4], "dq_referential": [5, 6, 14], "dq_timeliness": [7, 13],
                 "dq_security": [15]}.items():
    oracle(_k, _dq_sql(_ids), "dq_agg")

oracle("dq_duplicate_rows", """
SELECT * EXCLUDE (card_number, n), right(card_number, 4) AS card_number, n - 1 AS duplicate_copies
FROM (SELECT * EXCLUDE (_loaded_at, _source_file), count(*) AS n
      FROM (SELECT * FROM raw_transactions UNION ALL
            SELECT * FROM raw_transactions WHERE substr(md5(transaction_id), 1, 1) = '0') r GROUP BY ALL) g
WHERE n > 1""", "raw_transactions")

cte("dq_results", _dq_sql(list(range(1, 16))), ["dq_agg"])
oracle("dq_summary", """
SELECT count(CASE WHEN success THEN 1 END) AS passed, count(CASE WHEN NOT success THEN 1 END) AS failed,
  list_sort(list(check_name) FILTER (WHERE NOT success)) AS failed_checks,
  CASE WHEN count(*) = 0 THEN 'SKIPPED' WHEN count(CASE WHEN NOT success THEN 1 END) = 0 THEN 'PASSED'
       ELSE 'WARNING' END AS status
FROM dq_results""", "dq_results")


# --- sources, sinks, projections ---------------------------------------------------------------
from ledgerflow.plans.oracle_sql import (  # noqa: E402
    FULL_DAYS, RUN1, STAGED_COLS, category_group_sql, clean_sql, d, dim_merchant_rows_sql, fact_sql, key_sql,
    merchant_stats_sql, region_sql, staged_sql, UNKNOWN_MERCHANT, usd_sql,
)

_RAW15 = ", ".join(["transaction_id", "customer_id", "merchant_id", "amount", "currency", "transaction_timestamp",
                    "status", "channel", "card_type", "card_number", "merchant_category", "merchant_city",
                    "merchant_country", "response_code", "auth_code"])
oracle("null_markers", f"SELECT {_RAW15} FROM raw_transactions", "raw_transactions")
oracle("recent_window", f"SELECT transaction_id, _loaded_at, amount FROM raw_transactions "
       f"WHERE {window('_loaded_at', AS_OF, METRIC_DAYS)}", "raw_transactions")
oracle("raw_retention", f"SELECT CAST(_loaded_at AS DATE) AS load_date, count(*) AS records FROM raw_transactions "
       f"WHERE {window('_loaded_at', AS_OF, 90)} GROUP BY 1", "raw_transactions")
oracle("merchant_enrich", "SELECT merchant_id, merchant_category, category_group, merchant_country, merchant_region, "
       "is_online FROM dim_merchant WHERE merchant_key <> -1", "dim_merchant")
oracle("fx_convert", f"""
SELECT currency, count(*) AS txn_count, CAST(sum(amount) AS DECIMAL(38,2)) AS amount,
  CAST(sum({usd_sql('amount', 'currency')}) AS DECIMAL(38,2)) AS amount_usd
FROM staged GROUP BY currency""", "staged")
oracle("date_key", "SELECT transaction_id, transaction_timestamp, "
       "CAST(strftime(transaction_timestamp, '%Y%m%d') AS INTEGER) AS transaction_date_key FROM staged", "staged")
oracle("scalar_functions", f"""
SELECT transaction_id,
  concat_ws('|', coalesce(merchant_category, ''), upper(merchant_city)) AS text_concat,
  md5(concat_ws('|', customer_id, merchant_id)) AS hash_md5,
  regexp_replace('4111-1111 ' || card_last_four, '[- ]', '', 'g') AS digits,
  nullif(status, 'approved') AS status_nullif,
  greatest(amount, CAST(100 AS DECIMAL(18,2))) AS amount_floor100,
  CAST(round(amount / 3, 2) AS DECIMAL(18,2)) AS amount_third,
  strftime(transaction_timestamp, '%Y%m%d') AS day_text,
  CAST(date_diff('day', CAST(transaction_timestamp AS DATE), {d(AS_OF.date())}) AS INTEGER) AS age_days,
  CAST(transaction_timestamp AS DATE) AS txn_date,
  lower(' X' || currency) AS lower_text,
  right(auth_code, 4) AS auth_tail
FROM staged""", "staged")
oracle("dim_date", """
SELECT CAST(strftime(dd, '%Y%m%d') AS INTEGER) AS transaction_date_key, CAST(dd AS DATE) AS date,
  CAST(year(dd) AS INTEGER) AS year, CAST(quarter(dd) AS INTEGER) AS quarter, CAST(month(dd) AS INTEGER) AS month,
  CAST(day(dd) AS INTEGER) AS day, CAST(isodow(dd) - 1 AS INTEGER) AS day_of_week, isodow(dd) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series(min(CAST(transaction_timestamp AS DATE)), max(CAST(transaction_timestamp AS DATE)),
      INTERVAL 1 DAY)) AS dd FROM fact) x""", "fact")

# --- two incremental runs ------------------------------------------------------------------------
_RUN2_DAYS = (AS_OF - RUN1).total_seconds() / 86400
cte("raw_run1", f"SELECT * FROM raw_transactions WHERE _loaded_at < {ts(RUN1)}", ["raw_transactions"])
cte("clean_run1", clean_sql("raw_run1", RUN1, FULL_DAYS), ["raw_run1"])
cte("staged_run1", staged_sql("clean_run1", RUN1), ["clean_run1"])
cte("clean_run2", clean_sql("raw_transactions", AS_OF, _RUN2_DAYS), ["raw_transactions"])
cte("staged2_src", staged_sql("clean_run2", AS_OF, keep_loaded=True), ["clean_run2"])
_TAKE = "(t.transaction_id IS NULL OR (s.transaction_id IS NOT NULL AND s._loaded_at > t._staged_at))"
_UP_COLS = STAGED_COLS + ["_staged_at", "_batch_id"]
cte("staged_run2", "SELECT " + ", ".join(f"CASE WHEN {_TAKE} THEN s.{c} ELSE t.{c} END AS {c}" for c in _UP_COLS)
    + f", CASE WHEN {_TAKE} THEN coalesce(s._source_file, t._source_file) ELSE t._source_file END AS _source_file"
    + " FROM staged_run1 t FULL OUTER JOIN staged2_src s ON t.transaction_id = s.transaction_id",
    ["staged_run1", "staged2_src"])
oracle("stage_upsert", "SELECT * FROM staged_run2", "staged_run2")
oracle("stage_merge_partitions", "SELECT * FROM staged_run2", "staged_run2")

cte("merchant_stats_run1", merchant_stats_sql("staged_run1"), ["staged_run1"])
cte("dim_merchant_run1", dim_merchant_rows_sql("merchant_stats_run1", RUN1) + "\nUNION ALL\n" + UNKNOWN_MERCHANT,
    ["merchant_stats_run1"])
cte("merchant_stats_run2", merchant_stats_sql(f"(SELECT * FROM staged_run2 WHERE _staged_at > {ts(RUN1)})"),
    ["staged_run2"])
_NEW = "t.merchant_id IS NULL"
_MATCH = "(t.merchant_id IS NOT NULL AND s.merchant_id IS NOT NULL)"


def _merged(a):
    return f"(CASE WHEN {_NEW} THEN s.{a} WHEN {_MATCH} THEN coalesce(s.{a}, t.{a}) ELSE t.{a} END)"


_CAT, _CTRY = _merged("merchant_category"), _merged("merchant_country")
cte("dim_merchant_run2", f"""
SELECT CASE WHEN {_NEW} THEN {key_sql('s.merchant_id')} ELSE t.merchant_key END AS merchant_key,
  coalesce(t.merchant_id, s.merchant_id) AS merchant_id, coalesce(t.merchant_name, s.merchant_id) AS merchant_name,
  {_CAT} AS merchant_category,
  CASE WHEN t.merchant_key = -1 THEN t.category_group ELSE {category_group_sql(_CAT)} END AS category_group,
  t.mcc_code AS mcc_code, {_merged('merchant_city')} AS merchant_city, t.merchant_state AS merchant_state,
  {_CTRY} AS merchant_country,
  CASE WHEN t.merchant_key = -1 THEN t.merchant_region ELSE {region_sql(_CTRY)} END AS merchant_region,
  CASE WHEN t.merchant_key = -1 THEN t.is_online ELSE coalesce({_CAT} IN ('online', 'streaming', 'digital'), FALSE) END
    AS is_online,
  coalesce(t.risk_score, CAST(0 AS DECIMAL(5,2))) AS risk_score,
  CASE WHEN {_NEW} THEN CAST(s.first_seen AS DATE) ELSE t.first_seen_date END AS first_seen_date,
  CASE WHEN {_NEW} THEN CAST(s.last_seen AS DATE)
       WHEN {_MATCH} THEN greatest(t.last_transaction_date, CAST(s.last_seen AS DATE))
       ELSE t.last_transaction_date END AS last_transaction_date,
  CAST(CASE WHEN {_NEW} THEN s.txn_count WHEN {_MATCH} THEN t.total_transaction_count + s.txn_count
       ELSE t.total_transaction_count END AS BIGINT) AS total_transaction_count,
  CASE WHEN {_NEW} OR {_MATCH} THEN {ts(AS_OF)} ELSE t._loaded_at END AS _loaded_at
FROM dim_merchant_run1 t FULL OUTER JOIN merchant_stats_run2 s ON t.merchant_id = s.merchant_id""",
    ["dim_merchant_run1", "merchant_stats_run2"])
oracle("dim_merchant_upsert", "SELECT * FROM dim_merchant_run2", "dim_merchant_run2")

cte("fact_run1", fact_sql("staged_run1", "dim_customer", "dim_merchant_run1", RUN1, FULL_DAYS),
    ["staged_run1", "dim_customer", "dim_merchant_run1"])
cte("fact_run2_new", fact_sql("staged_run2", "dim_customer", "dim_merchant_run2", AS_OF, _RUN2_DAYS,
                              existing="fact_run1"), ["staged_run2", "dim_customer", "dim_merchant_run2", "fact_run1"])
oracle("fact_load_incremental", "SELECT * FROM fact_run2_new", "fact_run2_new")

cte("fact_reload", fact_sql("staged_run2", "dim_customer", "dim_merchant_run2", AS_OF, FULL_DAYS),
    ["staged_run2", "dim_customer", "dim_merchant_run2"])
oracle("fact_upsert", f"""
SELECT * FROM fact_run1 WHERE transaction_id NOT IN (SELECT transaction_id FROM staged_run2 WHERE _staged_at = {ts(AS_OF)})
UNION ALL
SELECT * FROM fact_reload WHERE transaction_id IN (SELECT transaction_id FROM staged_run2 WHERE _staged_at = {ts(AS_OF)})""",
       "fact_run1", "fact_reload", "staged_run2")
oracle("fact_full_reload", """
SELECT coalesce(s._batch_id, f._batch_id) AS _batch_id, coalesce(s.staged_rows, 0) AS staged_rows,
  coalesce(f.fact_rows, 0) AS fact_rows
FROM (SELECT _batch_id, count(*) AS staged_rows FROM staged_run2 GROUP BY 1) s
FULL OUTER JOIN (SELECT _batch_id, count(*) AS fact_rows FROM fact_reload GROUP BY 1) f ON s._batch_id = f._batch_id""",
       "staged_run2", "fact_reload")

oracle("unknown_members", """
SELECT 'dim_merchant' AS dimension, merchant_key AS member_key, merchant_id AS member_id, merchant_name AS member_name
FROM dim_merchant WHERE merchant_key = -1
UNION ALL
SELECT 'dim_customer', customer_key, customer_id, first_name FROM dim_customer WHERE customer_key = -1""",
       "dim_merchant", "dim_customer")

oracle("orphan_keys", """
SELECT 'customer_key' AS key_name, count(*) AS fact_rows, count(CASE WHEN customer_key = -1 THEN 1 END) AS unknown_member_rows,
  count(CASE WHEN customer_key NOT IN (SELECT customer_key FROM dim_customer) THEN 1 END) AS orphan_rows FROM fact
UNION ALL
SELECT 'merchant_key', count(*), count(CASE WHEN merchant_key = -1 THEN 1 END),
  count(CASE WHEN merchant_key NOT IN (SELECT merchant_key FROM dim_merchant) THEN 1 END) FROM fact""",
       "fact", "dim_customer", "dim_merchant")

_POINT_IN_TIME = """
SELECT s.transaction_id, s.customer_id, h.customer_key AS asof_customer_key, h.customer_tier AS asof_customer_tier
FROM staged s LEFT JOIN hist2 h ON s.customer_id = h.customer_id
  AND CAST(s.transaction_timestamp AS DATE) >= h.effective_date AND CAST(s.transaction_timestamp AS DATE) <= h.expiry_date"""
for _key in ("scd2_as_of_lookup", "scd2_late_facts"):
    oracle(_key, _POINT_IN_TIME, "staged", "hist2")

# --- merchant windows, profiles ---------------------------------------------------------------------
oracle("merchant_latest", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY merchant_id
  ORDER BY _staged_at DESC, transaction_timestamp DESC, transaction_id DESC) AS rn
  FROM staged WHERE merchant_id IS NOT NULL) WHERE rn = 1""", "staged")
oracle("merchant_first_value", """
SELECT merchant_id, transaction_id,
  first_value(merchant_category) OVER w AS latest_category, first_value(merchant_city) OVER w AS latest_city,
  first_value(merchant_country) OVER w AS latest_country
FROM staged WHERE merchant_id IS NOT NULL
WINDOW w AS (PARTITION BY merchant_id ORDER BY _staged_at DESC, transaction_timestamp DESC, transaction_id DESC)""",
       "staged")
oracle("merchant_window_stats", """
SELECT merchant_id, transaction_id,
  min(transaction_timestamp) OVER (PARTITION BY merchant_id) AS merchant_first_seen,
  max(transaction_timestamp) OVER (PARTITION BY merchant_id) AS merchant_last_seen,
  count(*) OVER (PARTITION BY merchant_id) AS merchant_txn_count
FROM staged WHERE merchant_id IS NOT NULL""", "staged")
oracle("dataset_profile", """
SELECT count(*) AS rows, 19 AS columns, min(transaction_timestamp) AS first_ts, max(transaction_timestamp) AS last_ts,
  count(DISTINCT customer_id) AS customers, count(DISTINCT merchant_id) AS merchants, min(amount) AS amount_min,
  max(amount) AS amount_max, CAST(avg(amount) AS DECIMAL(18,2)) AS amount_mean FROM staged""", "staged")
oracle("value_breakdown", """
SELECT column_name, value, count,
  CAST(round(CAST(count AS DECIMAL(20,0)) * 100 / sum(count) OVER (PARTITION BY column_name), 2) AS DECIMAL(9,2))
    AS percent
FROM (SELECT column_name, value, count(*) AS count FROM (
  SELECT 'status' AS column_name, status AS value FROM staged
  UNION ALL SELECT 'channel', channel FROM staged
  UNION ALL SELECT 'currency', currency FROM staged) t GROUP BY 1, 2) c""", "staged")
oracle("distinct_counts", """
SELECT count(DISTINCT transaction_id) AS distinct_transactions, count(DISTINCT customer_id) AS distinct_customers,
  count(DISTINCT merchant_id) AS distinct_merchants FROM staged""", "staged")


# --- events ------------------------------------------------------------------------------------------
_PAYLOAD = """'{"transaction_id":"' ||
    CASE WHEN event_id % 61 = 0 THEN 'T' WHEN event_id % 20 = 19 THEN 'TXN_' || CAST(event_id - 1 AS VARCHAR)
         ELSE 'TXN_' || CAST(event_id AS VARCHAR) END
  || '","customer_id":"CUST_' || CAST(user_id AS VARCHAR) || '"'
  || CASE WHEN event_id % 59 <> 0 THEN ',"merchant_id":"MERCH_' || CAST(event_id % 50 AS VARCHAR) || '"' ELSE '' END
  || ',"amount":' || CASE WHEN event_id % 67 = 0 THEN '"abc"' WHEN event_id % 50 = 0 THEN '-5.00'
                          WHEN event_id % 71 = 0 THEN '2000000.00' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END
  || ',"currency":"' || CASE WHEN event_id % 53 = 0 THEN 'FAKE' WHEN event_id % 3 = 0 THEN 'eur' ELSE 'USD' END || '"'
  || ',"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '"'
  || CASE WHEN event_id % 5 <> 0 THEN ',"status":"Approved","channel":"Online"' ELSE '' END
  || CASE WHEN event_id % 7 = 0 THEN ',"card_number":"4111-1111-1111-' || CAST(1000 + event_id % 9000 AS VARCHAR) || '"'
          ELSE '' END
  || '}'"""
cte("ev_lines", f"""
SELECT event_id, ts, CASE event_id % 4 WHEN 0 THEN payload WHEN 1 THEN '{{"body":' || payload || '}}'
  WHEN 2 THEN '{{"source":"card.events","detail":' || payload || '}}'
  ELSE '{{"Records":[{{"messageId":"m' || CAST(event_id AS VARCHAR) || '","body":"' || replace(payload, '"', '\\"')
       || '"}}]}}' END AS line
FROM (SELECT event_id, ts, {_PAYLOAD} AS payload FROM events) p""")


def _items_sql(t):
    return (f"(CASE WHEN json_type({t}) = 'ARRAY' THEN list_transform(CAST(CAST({t} AS JSON) AS JSON[]), "
            f"lambda x: CAST(x AS VARCHAR)) ELSE [{t}] END)")


cte("ev_keyed", """SELECT event_id, ts, line,
  CASE WHEN json_valid(line) AND json_type(line) = 'OBJECT' THEN json_keys(line) END AS k FROM ev_lines""",
    ["ev_lines"])
cte("ev_lists", f"""
SELECT event_id, ts, CASE
  WHEN list_contains(k, 'Records') THEN coalesce(flatten(list_transform(
       CAST(json_extract(line, '$.Records') AS JSON[]), lambda r: {_items_sql("json_extract_string(r, '$.body')")})), [])
  WHEN list_contains(k, 'body') THEN {_items_sql("json_extract_string(line, '$.body')")}
  WHEN list_contains(k, 'detail') THEN [json_extract_string(line, '$.detail')]
  WHEN list_contains(k, 'transaction_id') THEN [line]
  WHEN json_valid(line) AND json_type(line) = 'ARRAY' THEN list_transform(CAST(CAST(line AS JSON) AS JSON[]),
       lambda x: CAST(x AS VARCHAR))
  WHEN k IS NULL AND NOT json_valid(line) THEN [line]
  ELSE [] END AS evs
FROM ev_keyed""", ["ev_keyed"])
cte("ev", """SELECT event_id, ts, CAST(unnest(range(len(evs))) AS INTEGER) AS event_pos, unnest(evs) AS payload FROM ev_lists
  WHERE len(evs) > 0""", ["ev_lists"])
_REQ = "['amount', 'currency', 'customer_id', 'merchant_id', 'timestamp', 'transaction_id']"
cte("ev_checked", f"""
SELECT *, CASE
  WHEN keys IS NULL THEN 'Malformed event: not a JSON object'
  WHEN len(missing) > 0 THEN 'Missing required fields: ' || array_to_string(missing, ', ')
  WHEN raw_amount IS NULL THEN 'Invalid amount: None — float() argument must be a string or a real number, not ''NoneType'''
  WHEN amt IS NULL THEN 'Invalid amount: ' || raw_amount || ' — could not convert string to float: ''' || raw_amount || ''''
  WHEN amt <= 0 THEN 'Invalid amount: ' || shown || ' — Invalid amount: ' || CAST(amt AS VARCHAR) || ' (must be > 0)'
  WHEN amt > 999999.99 THEN 'Invalid amount: ' || shown || ' — Amount exceeds maximum: ' || CAST(amt AS VARCHAR)
  WHEN cur NOT IN ('USD', 'EUR', 'GBP', 'CAD', 'AUD', 'JPY', 'CHF', 'INR') THEN 'Invalid currency: ' || cur
  WHEN length(tid) < 3 THEN 'Invalid transaction_id: ' || tid
  END AS error
FROM (SELECT *, list_filter({_REQ}, lambda x: NOT list_contains(keys, x)) AS missing,
        TRY_CAST(raw_amount AS DOUBLE) AS amt,
        CASE WHEN json_type(payload, '$.amount') = 'DOUBLE' THEN CAST(TRY_CAST(raw_amount AS DOUBLE) AS VARCHAR)
             ELSE raw_amount END AS shown,
        upper(coalesce(json_extract_string(payload, '$.currency'), 'None')) AS cur,
        coalesce(json_extract_string(payload, '$.transaction_id'), 'None') AS tid
      FROM (SELECT *, CASE WHEN json_valid(payload) AND json_type(payload) = 'OBJECT' THEN json_keys(payload) END AS keys,
              json_extract_string(payload, '$.amount') AS raw_amount FROM ev) a) b""", ["ev"])

oracle("event_unwrap", """
SELECT event_id, event_pos, json_extract_string(payload, '$.transaction_id') AS transaction_id,
  json_extract_string(payload, '$.customer_id') AS customer_id, json_extract_string(payload, '$.merchant_id') AS merchant_id,
  TRY_CAST(json_extract_string(payload, '$.amount') AS DECIMAL(18,2)) AS amount,
  json_extract_string(payload, '$.currency') AS currency, json_extract_string(payload, '$.timestamp') AS timestamp,
  CAST(len(json_keys(payload)) AS INTEGER) AS n_fields
FROM ev""", "ev")
oracle("event_validate", "SELECT event_id, event_pos, json_extract_string(payload, '$.transaction_id') AS transaction_id, "
       "error FROM ev_checked", "ev_checked")
oracle("event_enrich", """
SELECT event_id, ts, event_pos, json_extract_string(payload, '$.transaction_id') AS transaction_id,
  json_extract_string(payload, '$.customer_id') AS customer_id, json_extract_string(payload, '$.merchant_id') AS merchant_id,
  TRY_CAST(raw_amount AS DECIMAL(18,2)) AS amount, upper(json_extract_string(payload, '$.currency')) AS currency,
  json_extract_string(payload, '$.timestamp') AS timestamp,
  lower(coalesce(json_extract_string(payload, '$.status'), 'pending')) AS status,
  lower(coalesce(json_extract_string(payload, '$.channel'), 'unknown')) AS channel,
  CASE WHEN json_extract_string(payload, '$.card_number') IS NULL THEN NULL
       WHEN length(regexp_replace(json_extract_string(payload, '$.card_number'), '[- ]', '', 'g')) >= 4
       THEN '****' || right(regexp_replace(json_extract_string(payload, '$.card_number'), '[- ]', '', 'g'), 4)
       ELSE '****' END AS card_number,
  ts AS _ingested_at, md5(CAST(event_id AS VARCHAR) || '-' || CAST(event_pos AS VARCHAR)) AS _request_id,
  'development' AS _environment, 'lambda_ingestion' AS _source, CAST(NULL AS VARCHAR) AS extra
FROM ev_checked WHERE error IS NULL""", "ev_checked")
oracle("mask_card", """
SELECT event_id, event_pos, 
  CASE WHEN length(regexp_replace(json_extract_string(payload, '$.card_number'), '[- ]', '', 'g')) >= 4
       THEN '****' || right(regexp_replace(json_extract_string(payload, '$.card_number'), '[- ]', '', 'g'), 4)
       ELSE '****' END AS card_number
FROM ev WHERE json_extract_string(payload, '$.card_number') IS NOT NULL""", "ev")
oracle("event_summary", """
SELECT (SELECT count(*) FROM ev_checked WHERE error IS NULL) AS processed,
  (SELECT count(*) FROM ev_checked WHERE error IS NOT NULL) AS failed,
  coalesce((SELECT list(error ORDER BY event_id, event_pos) FROM (
     SELECT event_id, event_pos, error FROM ev_checked WHERE error IS NOT NULL ORDER BY event_id, event_pos LIMIT 10) f),
     []) AS first_errors""", "ev_checked")
oracle("event_rejects", "SELECT event_id, event_pos, error, ts AS timestamp FROM ev_checked WHERE error IS NOT NULL",
       "ev_checked")
oracle("stream_volume_over_time", f"""
SELECT layer, day, count(*) AS records
FROM (SELECT unnest(['received', CASE WHEN error IS NULL THEN 'accepted' ELSE 'rejected' END]) AS layer,
        CAST(TIMESTAMP '{AS_OF}' AS DATE) - CAST(1 - event_id % 2 AS INTEGER) AS day
      FROM ev_checked) v GROUP BY 1, 2""", "ev_checked")
oracle("hourly_volume", "SELECT date_trunc('hour', ts) AS hour_start, count(*) AS events FROM ev GROUP BY 1", "ev")
oracle("sliding_metrics", """
SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, count(*) AS events,
  CAST(sum(amount) AS DECIMAL(38,2)) AS amount
FROM (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS window_start, TRY_CAST(raw_amount AS DECIMAL(18,2)) AS amount
      FROM ev_checked WHERE error IS NULL
      UNION ALL
      SELECT time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 15 MINUTE, TRY_CAST(raw_amount AS DECIMAL(18,2))
      FROM ev_checked WHERE error IS NULL) w GROUP BY 1""", "ev_checked")
oracle("event_sink_partitions", """
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
  CAST(hour(ts) AS INTEGER) AS hour, count(*) AS events
FROM ev_checked WHERE error IS NULL GROUP BY 1, 2, 3, 4""", "ev_checked")


# --- oracles for keys whose result is deterministic though written through files -----------------
oracle("quality_score", """
SELECT passed, failed, CAST(passed * 100.0 / NULLIF(passed + failed, 0) AS DECIMAL(9,4)) AS quality_score,
  CASE WHEN CAST(passed * 100.0 / NULLIF(passed + failed, 0) AS DECIMAL(9,4)) >= 99 THEN 'green'
       WHEN CAST(passed * 100.0 / NULLIF(passed + failed, 0) AS DECIMAL(9,4)) >= 90 THEN 'yellow'
       WHEN passed + failed > 0 THEN 'red' END AS band
FROM (SELECT count(CASE WHEN success THEN 1 END) AS passed, count(CASE WHEN NOT success THEN 1 END) AS failed
      FROM dq_results) s""", "dq_results")

cte("dq2_agg", f"""SELECT count(*) AS n, count(CASE WHEN transaction_id IS NULL THEN 1 END) AS c1,
  count(DISTINCT transaction_id) AS c2,
  count(CASE WHEN {_NUM} < 0.01 OR {_NUM} > 999999.99 THEN 1 END) AS c3,
  count(CASE WHEN {_NUM} > 999999.99 THEN 1 END) AS c4,
  (SELECT count(*) FROM (SELECT DISTINCT transaction_id, amount FROM clean) x) AS c10
FROM clean""", ["clean"])
_MISSING = [
    (5, "Check 5: Valid currency", "referential", "currency", "1"),
    (6, "Check 6: Valid status", "referential", "status", "1"),
    (7, "Check 7: No future timestamps", "timeliness", "transaction_timestamp", "1"),
    (8, "Check 8: Customer ID exists", "completeness", "customer_id", "1"),
    (9, "Check 9: Merchant ID exists", "completeness", "merchant_id", "1"),
    (13, "Check 13: Data freshness", "timeliness", "transaction_timestamp", "0.99"),
    (14, "Check 14: Valid channel", "referential", "channel", "1"),
]
_dq2 = [DQ_ROWS[i].replace("FROM dq_agg", "FROM dq2_agg") for i in (1, 2, 3, 4, 10)]
_dq2.append("SELECT 11, 'Check 11: Schema compliance', 'schema', FALSE, "
            "'Missing: [''currency'', ''customer_id'', ''merchant_id'', ''status'', ''transaction_timestamp'']', "
            "0.285714, 1.0 FROM dq2_agg")
_dq2.append(DQ_ROWS[12].replace("FROM dq_agg", "FROM dq2_agg"))
_dq2.append("SELECT 15, 'Check 15: Card number masked', 'security', TRUE, 'No card column - N/A', 1, 1 FROM dq2_agg")
for cid, name, typ, col, thr in _MISSING:
    _dq2.append(f"SELECT {cid}, '{name}', '{typ}', FALSE, 'Column ''{col}'' missing', 0, {thr} FROM dq2_agg")
oracle("dq_missing_columns", "SELECT check_id, check_name, check_type, success, details, "
       "CAST(metric_value AS DECIMAL(18,6)) AS metric_value, CAST(threshold AS DECIMAL(18,6)) AS threshold FROM ("
       + "\nUNION ALL\n".join(_dq2) + ") r(check_id, check_name, check_type, success, details, metric_value, threshold) "
       "WHERE (SELECT n FROM dq2_agg) > 0", "dq2_agg")

oracle("fact_layout", "SELECT *, CAST(transaction_date_key // 100 AS INTEGER) AS date_month FROM fact", "fact")
oracle("bulk_load_modes", "SELECT s.*, [c.n, c.n, c.n] AS _rows_written FROM staged s, (SELECT count(*) AS n FROM staged) c",
       "staged")


# late rows: the oldest quarter of the event-time range, re-sent with new ids after the rest
cte("ev_bounds", """SELECT min(ts) AS lo, max(ts) AS hi,
  min(ts) + to_microseconds(CAST(round((epoch_us(max(ts)) - epoch_us(min(ts))) / 4) AS BIGINT)) AS b1
  FROM ev_lines""", ["ev_lines"])
oracle("late_rows", """
SELECT replace(json_extract_string(c.payload, '$.transaction_id'), 'TXN_', 'LATE_')
    AS transaction_id, TRY_CAST(c.raw_amount AS DECIMAL(18,2)) AS amount,
  upper(json_extract_string(c.payload, '$.currency')) AS currency,
  lower(coalesce(json_extract_string(c.payload, '$.status'), 'pending')) AS status,
  lower(coalesce(json_extract_string(c.payload, '$.channel'), 'unknown')) AS channel,
  CAST(json_extract_string(c.payload, '$.timestamp') AS TIMESTAMP) AS event_time
FROM ev_checked c, ev_bounds b WHERE c.error IS NULL AND c.ts >= b.lo AND c.ts < b.b1""", "ev_checked", "ev_bounds")


# --- landing and streaming keys ----------------------------------------------------------------------
_RAW_FIELDS = ["transaction_id", "customer_id", "merchant_id", "amount", "currency", "transaction_timestamp", "status", "channel",
               "card_type", "card_number", "merchant_category", "merchant_city", "merchant_country", "response_code", "auth_code"]
_LANDED = ", ".join(f"{nm(c)} AS {c}" for c in _RAW_FIELDS)
oracle("ingest_csv", f"SELECT {_LANDED}, {ts(AS_OF)} AS _loaded_at, FALSE AS _rejected FROM raw_transactions", "raw_transactions")
oracle("ingest_json", f"SELECT {', '.join(_RAW_FIELDS)}, {ts(AS_OF)} AS _loaded_at FROM raw_transactions", "raw_transactions")
oracle("landing_rejects", f"""
SELECT {nm('transaction_id')} AS transaction_id, {nm('customer_id')} AS customer_id, {nm('amount')} AS amount
FROM raw_transactions WHERE substr(md5(transaction_id), 1, 1) = '0'""", "raw_transactions")
_REASON = "coalesce(" + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c} is null or unparseable' END" for c in REQUIRED) + ")"
oracle("staging_rejects", f"""
SELECT transaction_id, customer_id, amount, _loaded_at, {_REASON} AS _reject_reason, {ts(AS_OF)} AS _rejected_at
FROM clean WHERE {_REASON} IS NOT NULL""", "clean")
oracle("stream_incremental_ingest", f"""
SELECT json_extract_string(payload, '$.transaction_id') AS transaction_id,
  json_extract_string(payload, '$.customer_id') AS customer_id, json_extract_string(payload, '$.merchant_id') AS merchant_id,
  TRY_CAST(raw_amount AS DECIMAL(18,2)) AS amount, upper(json_extract_string(payload, '$.currency')) AS currency,
  json_extract_string(payload, '$.timestamp') AS timestamp,
  TRY_CAST(json_extract_string(payload, '$.timestamp') AS TIMESTAMP) AS event_time,
  lower(coalesce(json_extract_string(payload, '$.status'), 'pending')) AS status,
  lower(coalesce(json_extract_string(payload, '$.channel'), 'unknown')) AS channel,
  CASE WHEN json_extract_string(payload, '$.card_number') IS NOT NULL
       THEN '****' || right(json_extract_string(payload, '$.card_number'), 4) END AS card_number,
  {ts(AS_OF)} AS _ingested_at, 'development' AS _environment, 'lambda_ingestion' AS _source, CAST(NULL AS VARCHAR) AS extra
FROM ev_checked WHERE error IS NULL""", "ev_checked")
oracle("stream_dedup", "SELECT DISTINCT json_extract_string(payload, '$.transaction_id') AS transaction_id FROM ev_checked "
       "WHERE error IS NULL", "ev_checked")
_MARKED = ", ".join(f"{nm(c)} AS {c}" for c in _RAW_FIELDS)
oracle("stream_stage_upsert", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY _loaded_at DESC NULLS LAST, amount DESC NULLS LAST,
      transaction_timestamp DESC NULLS LAST, status DESC NULLS LAST, customer_id DESC NULLS LAST) AS rn
  FROM (SELECT trim(transaction_id) AS transaction_id, trim(customer_id) AS customer_id, trim(merchant_id) AS merchant_id,
      TRY_CAST(amount AS DECIMAL(18,2)) AS amount, upper(trim(currency)) AS currency,
      TRY_CAST(transaction_timestamp AS TIMESTAMP) AS transaction_timestamp, lower(trim(status)) AS status,
      lower(trim(channel)) AS channel, trim(card_type) AS card_type, right(trim(card_number), 4) AS card_last_four,
      trim(merchant_category) AS merchant_category, trim(merchant_city) AS merchant_city,
      upper(trim(merchant_country)) AS merchant_country,
      CASE WHEN upper(trim(merchant_country)) != 'US' THEN TRUE ELSE FALSE END AS is_international,
      trim(response_code) AS response_code, trim(auth_code) AS auth_code, _loaded_at
    FROM (SELECT {_MARKED}, _loaded_at FROM raw_transactions) m
    WHERE transaction_id IS NOT NULL AND amount IS NOT NULL) c
  WHERE {" AND ".join(f"{c} IS NOT NULL" for c in REQUIRED)}) v
WHERE rn = 1""", "raw_transactions")


# --- generators: md5 draws repeated in SQL -------------------------------------------------------------
def _pick_sql(draw: str, values: list[str]) -> str:
    return "list_extract([" + ", ".join(f"'{v}'" for v in values) + f"], CAST({draw} % {len(values)} AS INTEGER) + 1)"


def _draw(salt: int) -> str:
    return f"CAST('0x' || substr(md5(k || '|{salt}'), 1, 12) AS BIGINT)"


def _pad(x: str, width: int) -> str:
    return f"CASE WHEN length(CAST({x} AS VARCHAR)) >= {width} THEN CAST({x} AS VARCHAR) ELSE lpad(CAST({x} AS VARCHAR), {width}, '0') END"


def _country(salt: int) -> str:
    d = f"({_draw(salt)} % 93)"
    return (f"CASE WHEN {d} < 50 THEN 'US' WHEN {d} < 60 THEN 'GB' WHEN {d} < 68 THEN 'CA' WHEN {d} < 73 THEN 'DE' "
            f"WHEN {d} < 78 THEN 'JP' WHEN {d} < 83 THEN 'AU' WHEN {d} < 93 THEN 'IN' END")


_STATUS = _pick_sql(_draw(3), ["approved", "approved", "approved", "approved", "approved", "declined", "pending", "reversed", "settled"])
_BAND = f"({_draw(6)} % 100)"


def _cents(lo: int, hi: int) -> str:
    return f"{_draw(7)} % {hi - lo + 1} + {lo}"


oracle("generate_transactions", f"""
SELECT 'TXN_' || upper(substr(md5(k), 1, 12)) AS transaction_id,
  'CUST_' || {_pad(f"({_draw(1)} % 200 + 1)", 4)} AS customer_id,
  'MERCH_' || {_pad(f"({_draw(2)} % 50 + 1)", 3)} AS merchant_id,
  CAST(CAST((CASE WHEN {_BAND} < 50 THEN {_cents(500, 5000)} WHEN {_BAND} < 80 THEN {_cents(5000, 20000)}
        WHEN {_BAND} < 95 THEN {_cents(20000, 100000)} ELSE {_cents(100000, 1000000)} END) / 100.0 AS DECIMAL(18,2)) AS VARCHAR) AS amount,
  {_pick_sql(_draw(9), ["USD", "USD", "USD", "USD", "EUR", "GBP", "CAD", "AUD", "JPY", "INR"])} AS currency,
  strftime({ts(AS_OF)} - to_minutes(CAST({_draw(8)} % 1441 AS INTEGER)), '%Y-%m-%dT%H:%M:%S') AS transaction_timestamp,
  {_STATUS} AS status,
  {_pick_sql(_draw(10), ["online", "online", "in_store", "in_store", "mobile", "atm", "phone"])} AS channel,
  {_pick_sql(_draw(11), ["visa", "visa", "mastercard", "mastercard", "amex", "discover"])} AS card_type,
  '****' || CAST({_draw(12)} % 9000 + 1000 AS VARCHAR) AS card_number,
  {_pick_sql(_draw(13), ["grocery", "retail", "restaurant", "gas", "travel", "entertainment", "healthcare", "utilities",
                         "streaming", "dining", "hotel", "airline", "clothing", "pharmacy"])} AS merchant_category,
  'City_' || {_country(4)} || '_' || CAST({_draw(5)} % 40 + 1 AS VARCHAR) AS merchant_city,
  {_country(4)} AS merchant_country,
  CASE WHEN {_STATUS} = 'declined' THEN {_pick_sql(_draw(14), ["05", "14", "51", "54"])} ELSE '00' END AS response_code,
  CASE WHEN {_STATUS} = 'approved' THEN 'AUTH' || CAST({_draw(15)} % 900000 + 100000 AS VARCHAR) ELSE '' END AS auth_code
FROM (SELECT concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
        CAST(l_suppkey AS VARCHAR), CAST(CAST(l_shipdate AS DATE) AS VARCHAR),
        CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)) AS k FROM lineitem) b""")
_CID = "'CUST_' || " + _pad("k", 4)
oracle("generate_customers", f"""
SELECT {_CID} AS customer_id, 'First' || CAST({_draw(22)} % 5000 + 1 AS VARCHAR) AS first_name,
  'Last' || CAST({_draw(23)} % 20000 + 1 AS VARCHAR) AS last_name, lower({_CID}) || '@example.com' AS email,
  '+1' || CAST({_draw(24)} % 8000000000 + 2000000000 AS VARCHAR) AS phone,
  CAST({_draw(25)} % 9999 + 1 AS VARCHAR) || ' Street ' || CAST({_draw(26)} % 400 + 1 AS VARCHAR) AS address_line_1,
  'City_' || {_country(21)} || '_' || CAST({_draw(27)} % 40 + 1 AS VARCHAR) AS city, '' AS state, {_country(21)} AS country,
  CAST({_draw(28)} % 90000 + 10000 AS VARCHAR) AS postal_code,
  {_pick_sql(_draw(29), ["standard", "standard", "standard", "gold", "gold", "platinum"])} AS customer_tier,
  CAST({ts(AS_OF)} AS DATE) - CAST({_draw(30)} % 1796 + 30 AS INTEGER) AS account_open_date
FROM (SELECT CAST(c_custkey AS VARCHAR) AS k FROM customer) b""")


# --- monitoring runs over time --------------------------------------------------------------------
cte("runs", f"""SELECT r.k AS run, {ts(AS_OF)} - to_days(CAST(15 * r.k AS INTEGER)) AS as_of
FROM range(0, (SELECT coalesce(greatest(date_diff('day', CAST(min(processed_at) AS DATE), CAST({ts(AS_OF)} AS DATE)), 0) // 15, 0) + 1 FROM fact)) r(k)""",
    ["fact"])
cte("run_window", f"SELECT r.as_of, f.* FROM runs r JOIN fact f ON f.processed_at >= r.as_of - INTERVAL {METRIC_DAYS} DAY AND f.processed_at <= r.as_of",
    ["runs", "fact"])
cte("run_upto", """SELECT r.as_of, max(f.transaction_timestamp) AS max_ts, max(f._batch_id) AS all_batch_id
FROM runs r LEFT JOIN fact f ON f.processed_at <= r.as_of GROUP BY 1""", ["runs", "fact"])
cte("runs_qm_agg", """
SELECT u.as_of, coalesce(w.n, 0) AS n, w.batch_id, coalesce(w.null_amounts, 0) AS null_amounts, coalesce(w.distinct_ids, 0) AS distinct_ids,
  w.avg_usd, w.min_usd, w.max_usd, u.max_ts, u.all_batch_id
FROM run_upto u LEFT JOIN (SELECT as_of, count(*) AS n, max(_batch_id) AS batch_id, count(CASE WHEN amount IS NULL THEN 1 END) AS null_amounts,
  count(DISTINCT transaction_id) AS distinct_ids, avg(amount_usd) AS avg_usd, min(amount_usd) AS min_usd, max(amount_usd) AS max_usd
  FROM run_window GROUP BY 1) w ON u.as_of = w.as_of""", ["run_upto", "run_window"])
_RUNS_QM = "\nUNION ALL\n".join(
    "SELECT as_of, " + QM[m].strip().removeprefix("SELECT ").replace("FROM qm_agg", "FROM runs_qm_agg").replace(ts(AS_OF), "as_of") for m in QM)
cte("runs_qm", f"""SELECT as_of AS metric_timestamp, 'fct_transactions' AS table_name, metric_name, metric_value, threshold, status, details, batch_id
FROM ({_RUNS_QM}) m(as_of, metric_name, metric_value, threshold, status, details, batch_id)""", ["runs_qm_agg"])
oracle("pane_quality_metrics", "SELECT * FROM runs_qm", "runs_qm")
oracle("metric_history", "SELECT * FROM runs_qm", "runs_qm")
oracle("top_failed_history", """SELECT * FROM runs_qm WHERE status IN ('FAIL', 'WARNING')
ORDER BY metric_timestamp DESC, metric_name, table_name LIMIT 20""", "runs_qm")

cte("runs_sla_agg", f"""
SELECT r.as_of, count(w.as_of) AS n, min(w.processed_at) AS first_processed, max(w.processed_at) AS last_processed,
  avg({seconds_sql('w.transaction_timestamp', 'w.processed_at')}) AS avg_latency,
  quantile_disc({seconds_sql('w.transaction_timestamp', 'w.processed_at')}, 0.95) AS p95_latency,
  count(CASE WHEN w.customer_key <> -1 AND w.merchant_key <> -1 THEN 1 END) AS covered,
  count(CASE WHEN NOT (w.customer_key <> -1 AND w.merchant_key <> -1) THEN 1 END) AS orphans
FROM runs r LEFT JOIN run_window w ON w.as_of = r.as_of GROUP BY 1""", ["runs", "run_window"])
_RUNS_SLA = "\nUNION ALL\n".join(
    "SELECT as_of, " + SLA[m].strip().removeprefix("SELECT ").replace("FROM sla_agg", "FROM runs_sla_agg") for m in SLA)
oracle("pane_sla_metrics", f"""SELECT as_of AS metric_timestamp, 'transaction_pipeline' AS dag_id, as_of AS execution_date, metric_name, metric_value,
  unit, status, details FROM ({_RUNS_SLA}) m(as_of, metric_name, metric_value, unit, status, details)""", "runs_sla_agg")
oracle("pane_latency_sketch", f"""SELECT as_of AS metric_timestamp, count({seconds_sql('transaction_timestamp', 'processed_at')}) AS sample_size,
  TRUE AS rank_within_one_percent FROM run_window GROUP BY 1 HAVING count({seconds_sql('transaction_timestamp', 'processed_at')}) > 0""", "run_window")
