"""Independent SQL statements of every query, for DuckDB over the driver's tables.

Written as plain ANSI-style SQL with CTEs; each CTE mirrors one pipeline stage. The
statements do not call into the library: they restate the rules as SQL so the Spark
plans are checked against an independent formulation.
"""

from __future__ import annotations

import datetime as dt

from ledgerflow import constants as C
from ledgerflow.sources import adapters as A


def ts(v: dt.datetime) -> str:
    return f"TIMESTAMP '{v:%Y-%m-%d %H:%M:%S}'"


def d(v: dt.date) -> str:
    return f"DATE '{v:%Y-%m-%d}'"


def q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def pick(expr: str, values: list) -> str:
    whens = " ".join(f"WHEN {i} THEN {q(v)}" for i, v in enumerate(values))
    return f"CASE {expr} {whens} END"


def key_sql(*parts: str) -> str:
    """Same 60-bit md5 surrogate key as the Spark helper."""
    txt = "concat_ws('|', " + ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts) + ")"
    return f"CAST(('0x' || substr(md5({txt}), 1, 15)) AS BIGINT)"


def nm(col: str) -> str:
    """Null markers NULL / null / empty text."""
    return f"CASE WHEN {col} IN ('NULL', 'null', '') THEN NULL ELSE {col} END"


def category_group_sql(c: str) -> str:
    whens = " ".join(f"WHEN {c} IN {in_list(m)} THEN {q(g)}" for g, m in C.CATEGORY_GROUPS)
    return f"CASE {whens} ELSE {q(C.OTHER_GROUP)} END"


def region_sql(c: str) -> str:
    whens = " ".join(f"WHEN {q(code)} THEN {q(r)}" for code, r in C.COUNTRY_REGIONS)
    return f"CASE {c} {whens} ELSE {q(C.OTHER_REGION)} END"


def usd_sql(amount: str, currency: str) -> str:
    whens = " ".join(
        f"WHEN {q(code)} THEN {amount}" if code == "USD" else f"WHEN {q(code)} THEN {amount} * {r}"
        for code, r in C.USD_RATES)
    return f"CAST(ROUND(CASE {currency} {whens} ELSE {amount} END, 2) AS DECIMAL(18,2))"


def minutes_sql(a: str, b: str) -> str:
    return f"date_diff('minute', date_trunc('minute', {a}), date_trunc('minute', {b}))"


def seconds_sql(a: str, b: str) -> str:
    return f"date_diff('second', date_trunc('second', {a}), date_trunc('second', {b}))"


def rate_sql(num: str, den: str, scale: int = 6) -> str:
    return f"CAST(CAST({num} AS DECIMAL(38,12)) / NULLIF(CAST({den} AS DECIMAL(38,12)), 0) AS DECIMAL(18,{scale}))"


FULL_DAYS = A.TXN_FULL_LOOKBACK_DAYS
AS_OF = A.TXN_AS_OF
RUN1 = A.TXN_RUN1_AS_OF
METRIC_DAYS = A.TXN_METRIC_LOOKBACK_DAYS


def window(col: str, as_of: dt.datetime, days: float) -> str:
    lo = as_of - dt.timedelta(days=days)
    return f"{col} >= {ts(lo)} AND {col} <= {ts(as_of)}"


CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, sql: str, deps: list[str] | None = None):
    CTES[name] = (sql, deps or [])


def with_ctes(final_sql: str, *names: str) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for dep in CTES[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return final_sql
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order) + "\n" + final_sql


# --- adapter A ------------------------------------------------------------------------
cte("raw_transactions", f"""
SELECT
  CASE WHEN l.l_partkey % 401 = 0 THEN NULL
       ELSE ' TXN_' || CAST(l.l_orderkey AS VARCHAR) || '_' || CAST(l.l_linenumber AS VARCHAR) || ' ' END AS transaction_id,
  'CUST_' || CAST(o.o_custkey AS VARCHAR) AS customer_id,
  'MERCH_' || CAST(l.l_suppkey AS VARCHAR) AS merchant_id,
  CASE WHEN l.l_partkey % 211 = 0 THEN 'n/a' WHEN l.l_partkey % 199 = 0 THEN NULL
       ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
  {pick('l.l_partkey % 10', A.TXN_CURRENCY_BY_PART10)} AS currency,
  CAST(l.l_shipdate AS VARCHAR) AS transaction_timestamp,
  CASE WHEN l.l_returnflag = 'R' THEN 'Reversed' WHEN l.l_linestatus = 'F' THEN ' SETTLED' ELSE 'approved ' END AS status,
  {pick('l.l_suppkey % 5', A.TXN_CHANNEL_BY_SUPP5)} AS channel,
  {pick('l.l_linenumber % 3', A.TXN_CARD_TYPE_BY_LINE3)} AS card_type,
  '4111-1111-1111-' || CAST(1000 + l.l_partkey % 9000 AS VARCHAR) AS card_number,
  {pick('l.l_suppkey % 11', A.TXN_CATEGORY_BY_SUPP11)} AS merchant_category,
  'City_' || CAST(s.s_nationkey AS VARCHAR) AS merchant_city,
  {pick('s.s_nationkey % 9', A.TXN_COUNTRY_BY_NATION9)} AS merchant_country,
  '00' AS response_code,
  'AUTH' || CAST(100000 + l.l_orderkey AS VARCHAR) AS auth_code,
  l.l_shipdate + to_seconds(l.l_partkey) AS _loaded_at,
  'transactions_' || strftime(l.l_shipdate, '%Y%m') || '.csv' AS _source_file
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN supplier s ON l.l_suppkey = s.s_suppkey""")

RAW_STRING_COLS = ["transaction_id", "customer_id", "merchant_id", "amount", "currency", "transaction_timestamp",
                   "status", "channel", "card_type", "card_number", "merchant_category", "merchant_city",
                   "merchant_country", "response_code", "auth_code", "_source_file"]


def clean_sql(src: str, as_of: dt.datetime, days: float) -> str:
    marked = ", ".join(f"{nm(c)} AS {c}" for c in RAW_STRING_COLS)
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT
    trim(transaction_id) AS transaction_id, trim(customer_id) AS customer_id, trim(merchant_id) AS merchant_id,
    TRY_CAST(amount AS DECIMAL(18,2)) AS amount, upper(trim(currency)) AS currency,
    TRY_CAST(transaction_timestamp AS TIMESTAMP) AS transaction_timestamp,
    lower(trim(status)) AS status, lower(trim(channel)) AS channel, trim(card_type) AS card_type,
    right(trim(card_number), 4) AS card_last_four, trim(merchant_category) AS merchant_category,
    trim(merchant_city) AS merchant_city, upper(trim(merchant_country)) AS merchant_country,
    CASE WHEN upper(trim(merchant_country)) != 'US' THEN TRUE ELSE FALSE END AS is_international,
    trim(response_code) AS response_code, trim(auth_code) AS auth_code, _loaded_at, _source_file, card_number,
    row_number() OVER (PARTITION BY trim(transaction_id)
      ORDER BY _loaded_at DESC, _source_file DESC NULLS LAST, TRY_CAST(amount AS DECIMAL(18,2)) DESC NULLS LAST,
               TRY_CAST(transaction_timestamp AS TIMESTAMP) DESC NULLS LAST) AS rn
  FROM (SELECT {marked}, _loaded_at FROM {src}) r
  WHERE {window('_loaded_at', as_of, days)} AND transaction_id IS NOT NULL AND amount IS NOT NULL
) WHERE rn = 1"""


STAGED_COLS = ["transaction_id", "customer_id", "merchant_id", "amount", "currency", "transaction_timestamp",
               "status", "channel", "card_type", "card_last_four", "merchant_category", "merchant_city",
               "merchant_country", "is_international", "response_code", "auth_code"]
REQUIRED = ["transaction_id", "customer_id", "merchant_id", "amount", "currency", "transaction_timestamp", "status",
            "channel"]


def staged_sql(src: str, as_of: dt.datetime, keep_loaded: bool = False) -> str:
    cols = ", ".join(STAGED_COLS)
    extra = ", _loaded_at" if keep_loaded else ""
    cond = " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED)
    return (f"SELECT {cols}, {ts(as_of)} AS _staged_at, 'batch_{as_of:%Y%m%d_%H%M%S}' AS _batch_id, _source_file{extra}"
            f" FROM {src} WHERE {cond}")


cte("clean", clean_sql("raw_transactions", AS_OF, FULL_DAYS), ["raw_transactions"])
cte("staged", staged_sql("clean", AS_OF), ["clean"])

# --- adapter C and the customer history -----------------------------------------------------
HASH_ATTRS = ["first_name", "last_name", "email", "phone", "address_line_1", "city", "state", "country",
              "postal_code", "customer_tier"]
CUST_ATTRS = HASH_ATTRS + ["account_open_date"]


def snapshot_sql(n: int) -> str:
    load = A.CUSTOMER_SNAPSHOT_1 if n == 1 else A.CUSTOMER_SNAPSHOT_2
    phone = "'555-' || lpad(CAST(k % 10000 AS VARCHAR), 4, '0')"
    city = "'City_' || CAST(c_nationkey AS VARCHAR)"
    tier = "CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN 'gold' ELSE 'standard' END"
    where = "k % 50 <> 0" + (" AND k % 19 <> 0" if n == 1 else "")
    if n == 2:
        phone = f"CASE WHEN k % 11 = 0 THEN {phone} || '7' ELSE {phone} END"
        city = f"CASE WHEN k % 13 = 0 THEN NULL ELSE {city} END"
        tier = f"CASE WHEN k % 7 = 0 THEN 'platinum' ELSE {tier} END"
    body = f"""
  SELECT 'CUST_' || CAST(k AS VARCHAR) AS customer_id, 'First' || CAST(k % 24 AS VARCHAR) AS first_name,
    'Last' || CAST(k % 18 AS VARCHAR) AS last_name, 'customer' || CAST(k AS VARCHAR) || '@example.com' AS email,
    {phone} AS phone, CAST(k AS VARCHAR) || ' Main Street' AS address_line_1, {city} AS city,
    CAST(NULL AS VARCHAR) AS state, n_name AS country, CAST(10000 + k % 90000 AS VARCHAR) AS postal_code,
    {tier} AS customer_tier, DATE '1990-01-01' + CAST(k % 1800 AS INTEGER) AS account_open_date,
    {ts(dt.datetime.combine(load, dt.time()))} AS _loaded_at, k % 17 = 0 AS _dup
  FROM (SELECT c.c_custkey AS k, c.c_nationkey, c.c_mktsegment, n.n_name
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey) b
  WHERE {where}"""
    cols = "customer_id, first_name, last_name, email, phone, address_line_1, city, state, country, postal_code, customer_tier, account_open_date"
    return f"""
SELECT {cols}, _loaded_at FROM ({body}) s
UNION ALL
SELECT customer_id, first_name, last_name, 'old.' || email, phone, address_line_1, city, state, country, postal_code,
  customer_tier, account_open_date, _loaded_at - INTERVAL 1 HOUR FROM ({body}) s2 WHERE _dup"""


def hash_sql(prefix: str = "") -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce({prefix}{a}, '')" for a in HASH_ATTRS) + "))"


def dedup_customers_sql(src: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
  ORDER BY _loaded_at DESC, email DESC NULLS LAST) AS rn FROM {src}) WHERE rn = 1"""


def changes_sql(src: str, hist: str) -> str:
    return f"""
SELECT s.*, {hash_sql('s.')} AS new_hash, h._hash_key AS existing_hash,
  CASE WHEN h.customer_key IS NULL THEN 'INSERT' WHEN h._hash_key != {hash_sql('s.')} THEN 'UPDATE'
       ELSE 'NO_CHANGE' END AS change_type
FROM ({dedup_customers_sql(src)}) s LEFT JOIN {hist} h ON s.customer_id = h.customer_id AND h.is_current"""


def merge_sql(hist: str, changes: str, as_of: dt.date) -> str:
    attrs = ", ".join(f"h.{a}" for a in CUST_ATTRS)
    now = ts(dt.datetime.combine(as_of, dt.time()))
    exp = "(u.customer_id IS NOT NULL AND h.is_current)"
    return f"""
SELECT h.customer_key, h.customer_id, {attrs}, h.effective_date,
  CASE WHEN {exp} THEN {d(as_of - dt.timedelta(days=1))} ELSE h.expiry_date END AS expiry_date,
  CASE WHEN {exp} THEN FALSE ELSE h.is_current END AS is_current, h._hash_key,
  CASE WHEN {exp} THEN {now} ELSE h._updated_at END AS _updated_at
FROM {hist} h LEFT JOIN (SELECT customer_id FROM {changes} WHERE change_type = 'UPDATE') u ON h.customer_id = u.customer_id
UNION ALL
SELECT {key_sql('customer_id', d(as_of))} AS customer_key, customer_id, {", ".join(CUST_ATTRS)},
  {d(as_of)} AS effective_date, DATE '{C.OPEN_END_DATE}' AS expiry_date, TRUE AS is_current, new_hash AS _hash_key,
  {now} AS _updated_at
FROM {changes} WHERE change_type IN ('INSERT', 'UPDATE')"""


EMPTY_HIST = ("SELECT CAST(NULL AS BIGINT) AS customer_key, CAST(NULL AS VARCHAR) AS customer_id, "
              + ", ".join(f"CAST(NULL AS VARCHAR) AS {a}" for a in HASH_ATTRS)
              + ", CAST(NULL AS DATE) AS account_open_date, CAST(NULL AS DATE) AS effective_date, "
              "CAST(NULL AS DATE) AS expiry_date, CAST(NULL AS BOOLEAN) AS is_current, "
              "CAST(NULL AS VARCHAR) AS _hash_key, CAST(NULL AS TIMESTAMP) AS _updated_at WHERE FALSE")

cte("cust_snap1", snapshot_sql(1))
cte("cust_snap2", snapshot_sql(2))
cte("hist0", EMPTY_HIST)
cte("changes1", changes_sql("cust_snap1", "hist0"), ["cust_snap1", "hist0"])
cte("hist1", merge_sql("hist0", "changes1", A.CUSTOMER_SNAPSHOT_1), ["hist0", "changes1"])
cte("changes2", changes_sql("cust_snap2", "hist1"), ["cust_snap2", "hist1"])
cte("hist2", merge_sql("hist1", "changes2", A.CUSTOMER_SNAPSHOT_2), ["hist1", "changes2"])

DIM_C_COLS = ["customer_key", "customer_id", "first_name", "last_name", "full_name", "email", "phone", "city", "state",
              "country", "postal_code", "customer_tier", "account_open_date", "account_age_days", "effective_date",
              "expiry_date", "is_current", "_loaded_at"]

cte("dim_c0", "SELECT CAST(-1 AS BIGINT) AS customer_key, 'UNKNOWN' AS customer_id, 'Unknown' AS first_name, "
    "CAST(NULL AS VARCHAR) AS last_name, CAST(NULL AS VARCHAR) AS full_name, CAST(NULL AS VARCHAR) AS email, "
    "CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state, "
    "CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS postal_code, CAST(NULL AS VARCHAR) AS customer_tier, "
    "CAST(NULL AS DATE) AS account_open_date, CAST(NULL AS INTEGER) AS account_age_days, "
    "CAST(NULL AS DATE) AS effective_date, CAST(NULL AS DATE) AS expiry_date, TRUE AS is_current, "
    "CAST(NULL AS TIMESTAMP) AS _loaded_at")


def load_dim_sql(dim: str, hist: str, as_of: dt.date) -> str:
    now = ts(dt.datetime.combine(as_of, dt.time()))
    keep = ", ".join(f"t.{c}" for c in DIM_C_COLS if c not in ("expiry_date", "is_current", "_loaded_at"))
    exp = ("(t.is_current AND t.customer_key <> -1 AND n.effective_date IS NOT NULL "
           "AND NOT (n.effective_date IS NOT DISTINCT FROM t.effective_date))")
    return f"""
SELECT {keep},
  CASE WHEN {exp} THEN {d(as_of - dt.timedelta(days=1))} ELSE t.expiry_date END AS expiry_date,
  CASE WHEN {exp} THEN FALSE ELSE t.is_current END AS is_current,
  CASE WHEN {exp} THEN {now} ELSE t._loaded_at END AS _loaded_at
FROM {dim} t LEFT JOIN (SELECT customer_id, effective_date FROM {hist} WHERE is_current) n ON t.customer_id = n.customer_id
UNION ALL
SELECT s.customer_key, s.customer_id, s.first_name, s.last_name,
  concat(coalesce(s.first_name, ''), ' ', coalesce(s.last_name, '')) AS full_name, s.email, s.phone, s.city, s.state,
  s.country, s.postal_code, coalesce(s.customer_tier, 'standard') AS customer_tier, s.account_open_date,
  CAST(date_diff('day', s.account_open_date, {d(as_of)}) AS INTEGER) AS account_age_days,
  s.effective_date, s.expiry_date, s.is_current, {now} AS _loaded_at
FROM {hist} s WHERE s.is_current AND NOT EXISTS (
  SELECT 1 FROM {dim} x WHERE x.customer_id = s.customer_id AND x.is_current AND x.effective_date = s.effective_date)"""


cte("dim_c1", load_dim_sql("dim_c0", "hist1", A.CUSTOMER_SNAPSHOT_1), ["dim_c0", "hist1"])
cte("dim_customer", load_dim_sql("dim_c1", "hist2", A.CUSTOMER_SNAPSHOT_2), ["dim_c1", "hist2"])

# --- merchants ------------------------------------------------------------------------------


def merchant_stats_sql(src: str) -> str:
    return f"""
SELECT merchant_id, merchant_category, merchant_city, merchant_country, first_seen, last_seen, txn_count FROM (
  SELECT merchant_id,
    first_value(merchant_category) OVER w AS merchant_category,
    first_value(merchant_city) OVER w AS merchant_city,
    first_value(merchant_country) OVER w AS merchant_country,
    min(transaction_timestamp) OVER (PARTITION BY merchant_id) AS first_seen,
    max(transaction_timestamp) OVER (PARTITION BY merchant_id) AS last_seen,
    count(*) OVER (PARTITION BY merchant_id) AS txn_count,
    row_number() OVER w AS rn
  FROM {src} WHERE merchant_id IS NOT NULL
  WINDOW w AS (PARTITION BY merchant_id ORDER BY _staged_at DESC, transaction_timestamp DESC, transaction_id DESC)
) WHERE rn = 1"""


def dim_merchant_rows_sql(stats: str, as_of: dt.datetime) -> str:
    return f"""
SELECT {key_sql('merchant_id')} AS merchant_key, merchant_id, merchant_id AS merchant_name, merchant_category,
  {category_group_sql('merchant_category')} AS category_group, CAST(NULL AS VARCHAR) AS mcc_code, merchant_city,
  CAST(NULL AS VARCHAR) AS merchant_state, merchant_country, {region_sql('merchant_country')} AS merchant_region,
  coalesce(merchant_category IN {in_list(C.ONLINE_CATEGORIES)}, FALSE) AS is_online,
  CAST(0 AS DECIMAL(5,2)) AS risk_score, CAST(first_seen AS DATE) AS first_seen_date,
  CAST(last_seen AS DATE) AS last_transaction_date, CAST(txn_count AS BIGINT) AS total_transaction_count,
  {ts(as_of)} AS _loaded_at
FROM {stats}"""


UNKNOWN_MERCHANT = ("SELECT CAST(-1 AS BIGINT), 'UNKNOWN', 'Unknown', NULL, NULL, NULL, NULL, NULL, NULL, NULL, "
                    "CAST(NULL AS BOOLEAN), CAST(NULL AS DECIMAL(5,2)), CAST(NULL AS DATE), CAST(NULL AS DATE), "
                    "CAST(NULL AS BIGINT), CAST(NULL AS TIMESTAMP)")

cte("merchant_stats", merchant_stats_sql("staged"), ["staged"])
cte("dim_merchant", dim_merchant_rows_sql("merchant_stats", AS_OF) + "\nUNION ALL\n" + UNKNOWN_MERCHANT,
    ["merchant_stats"])

# --- fact -------------------------------------------------------------------------------------


def fact_sql(staged: str, dim_c: str, dim_m: str, as_of: dt.datetime, days: float, existing: str | None = None,
             processed: str | None = None) -> str:
    processed = processed or ("s.transaction_timestamp + to_seconds((CAST(s.card_last_four AS INTEGER) - 1000) % 300)")
    anti = (f" AND NOT EXISTS (SELECT 1 FROM {existing} f WHERE f.transaction_id = s.transaction_id)"
            if existing else "")
    return f"""
SELECT s.transaction_id, coalesce(dc.customer_key, -1) AS customer_key, coalesce(dm.merchant_key, -1) AS merchant_key,
  CAST(strftime(s.transaction_timestamp, '%Y%m%d') AS INTEGER) AS transaction_date_key, s.amount, s.currency,
  {usd_sql('s.amount', 's.currency')} AS amount_usd, s.status, s.channel, s.is_international, s.card_type,
  s.response_code, s.auth_code, s.transaction_timestamp, {processed} AS processed_at, s._batch_id
FROM {staged} s
LEFT JOIN (SELECT customer_id, customer_key FROM {dim_c} WHERE is_current AND customer_key <> -1) dc
  ON s.customer_id = dc.customer_id
LEFT JOIN (SELECT merchant_id, merchant_key FROM {dim_m} WHERE merchant_key <> -1) dm ON s.merchant_id = dm.merchant_id
WHERE {window('s._staged_at', as_of, days)}{anti}"""


cte("fact", fact_sql("staged", "dim_customer", "dim_merchant", AS_OF, FULL_DAYS),
    ["staged", "dim_customer", "dim_merchant"])
