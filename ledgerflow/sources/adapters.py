"""Adapters from the driver's tables to the schemas of the card pipeline.

The driver's tables carry no dirt, so the defects a real feed has (untrimmed ids,
unparseable amounts, mixed case codes, duplicates, missing fields) are injected by
fixed modular rules on the keys. Every rule is a built-in column expression, so an
adapter is one scan-join-project plan that scales with the input tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.columns import date_lit
from ledgerflow.sources.tables import read_table, spread

# Scenario times for the transaction adapter (A).
TXN_AS_OF = dt.datetime(2001, 11, 5, 0, 0, 0)
# First of two incremental runs; the second run is TXN_AS_OF.
TXN_RUN1_AS_OF = dt.datetime(1998, 1, 1, 0, 0, 0)
# Lookback that covers every row of the adapter (loads span 1995 to 2001).
TXN_FULL_LOOKBACK_DAYS = 36500
# Lookback of the monitoring window for this adapter (days instead of 30 minutes).
TXN_METRIC_LOOKBACK_DAYS = 30

# Scenario times for the customer adapter (C).
CUSTOMER_SNAPSHOT_1 = dt.date(1995, 1, 1)
CUSTOMER_SNAPSHOT_2 = dt.date(1998, 7, 1)

# Scenario time for the event adapter (B).
EVENT_AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)


def _pick(key: Column, values: list) -> Column:
    """values[key] for key in 0..len-1 as a CASE chain (None allowed)."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast(T.StringType())
        expr = (F.when if expr is None else expr.when)(key == F.lit(i), lit)
    return expr


def _s(c: Column) -> Column:
    return c.cast(T.StringType())


# --- fixed values: adapter A code lists (by key modulo) -----------------------------------
TXN_CURRENCY_BY_PART10 = [" eur ", "GBP", "cad", "AUD", "JPY", "CHF", "INR", "XXX", "usd", "usd"]
TXN_CHANNEL_BY_SUPP5 = ["Online", "in_store", "ATM", "mobile", "phone"]
TXN_CARD_TYPE_BY_LINE3 = ["visa", "mastercard", "amex"]
TXN_CATEGORY_BY_SUPP11 = ["grocery", "gas", "dining", "clothing", "hotel", "streaming", "pharmacy", "utilities",
                          "online", None, "misc"]
TXN_COUNTRY_BY_NATION9 = [" us", "CA", "gb", "DE", "FR", "JP", "AU", "IN", None]


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_transactions`` (15 strings + audit columns) from lineitem ⋈ orders ⋈ supplier."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_linestatus",
        "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = (spread(li).join(orders, li.l_orderkey == orders.o_orderkey)
         .join(supplier, li.l_suppkey == supplier.s_suppkey))
    part, supp, line, order = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"), F.col("l_orderkey")
    return j.select(
        F.when(part % 401 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(" TXN_"), _s(order), F.lit("_"), _s(line), F.lit(" "))).alias("transaction_id"),
        F.concat(F.lit("CUST_"), _s(F.col("o_custkey"))).alias("customer_id"),
        F.concat(F.lit("MERCH_"), _s(supp)).alias("merchant_id"),
        F.when(part % 211 == 0, F.lit("n/a"))
         .when(part % 199 == 0, F.lit(None).cast("string"))
         .otherwise(_s(F.col("l_extendedprice").cast(T.DecimalType(18, 2)))).alias("amount"),
        _pick(part % 10, TXN_CURRENCY_BY_PART10).alias("currency"),
        _s(F.col("l_shipdate")).alias("transaction_timestamp"),
        F.when(F.col("l_returnflag") == "R", F.lit("Reversed"))
         .when(F.col("l_linestatus") == "F", F.lit(" SETTLED"))
         .otherwise(F.lit("approved ")).alias("status"),
        _pick(supp % 5, TXN_CHANNEL_BY_SUPP5).alias("channel"),
        _pick(line % 3, TXN_CARD_TYPE_BY_LINE3).alias("card_type"),
        F.concat(F.lit("4111-1111-1111-"), _s(F.lit(1000) + part % 9000)).alias("card_number"),
        _pick(supp % 11, TXN_CATEGORY_BY_SUPP11).alias("merchant_category"),
        F.concat(F.lit("City_"), _s(F.col("s_nationkey"))).alias("merchant_city"),
        _pick(F.col("s_nationkey") % 9, TXN_COUNTRY_BY_NATION9).alias("merchant_country"),
        F.lit("00").alias("response_code"),
        F.concat(F.lit("AUTH"), _s(F.lit(100000) + order)).alias("auth_code"),
        (F.col("l_shipdate") + part * F.expr("INTERVAL '1' SECOND")).alias("_loaded_at"),
        F.concat(F.lit("transactions_"), F.date_format("l_shipdate", "yyyyMM"), F.lit(".csv")).alias("_source_file"),
    )


def simulated_processed_at(staged_or_fact: DataFrame) -> Column:
    """Adapter A's load time of a fact row: transaction time plus (part key mod 300) seconds.

    The part key survives in the last four card characters (1000 + part mod 9000, and
    300 divides 9000), so the latency is repeatable from staged columns alone.
    """
    lag = (F.col("card_last_four").cast(T.IntegerType()) - F.lit(1000)) % 300
    return F.col("transaction_timestamp") + F.make_dt_interval(secs=lag.cast(T.DecimalType(18, 6)))


# --- adapter C: customer master snapshots -------------------------------------------------

def raw_customer_snapshot(spark: SparkSession, sf_dir: str, snapshot: int) -> DataFrame:
    """``raw_customer_master`` rows of snapshot 1 or 2 from customer ⋈ nation.

    Customers with key % 50 == 0 are never delivered (their facts become orphans).
    Snapshot 1 also lacks key % 19 == 0 (new in snapshot 2). Snapshot 2 changes the
    phone of key % 11 == 0, clears the city of key % 13 == 0 and upgrades the tier of
    key % 7 == 0. Key % 17 == 0 is delivered twice; the earlier copy carries a stale
    e-mail, the later copy (one hour later) is the true row.
    """
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    base = cust.join(nation, cust.c_nationkey == nation.n_nationkey).where(k % 50 != 0)
    if snapshot == 1:
        base = base.where(k % 19 != 0)
    load_date = CUSTOMER_SNAPSHOT_1 if snapshot == 1 else CUSTOMER_SNAPSHOT_2
    phone = F.concat(F.lit("555-"), F.lpad(_s(k % 10000), 4, "0"))
    city = F.concat(F.lit("City_"), _s(F.col("c_nationkey")))
    tier = (F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None).cast("string"))
            .when(F.col("c_mktsegment") == "MACHINERY", F.lit("gold")).otherwise(F.lit("standard")))
    if snapshot == 2:
        phone = F.when(k % 11 == 0, F.concat(phone, F.lit("7"))).otherwise(phone)
        city = F.when(k % 13 == 0, F.lit(None).cast("string")).otherwise(city)
        tier = F.when(k % 7 == 0, F.lit("platinum")).otherwise(tier)
    loaded = F.lit(dt.datetime.combine(load_date, dt.time(0, 0))).cast(T.TimestampNTZType())
    rows = base.select(
        F.concat(F.lit("CUST_"), _s(k)).alias("customer_id"),
        F.concat(F.lit("First"), _s(k % 24)).alias("first_name"),
        F.concat(F.lit("Last"), _s(k % 18)).alias("last_name"),
        F.concat(F.lit("customer"), _s(k), F.lit("@example.com")).alias("email"),
        phone.alias("phone"),
        F.concat(_s(k), F.lit(" Main Street")).alias("address_line_1"),
        city.alias("city"),
        F.lit(None).cast("string").alias("state"),
        F.col("n_name").alias("country"),
        _s(F.lit(10000) + k % 90000).alias("postal_code"),
        tier.alias("customer_tier"),
        F.date_add(date_lit("1990-01-01"), (k % 1800).cast("int")).alias("account_open_date"),
        loaded.alias("_loaded_at"),
        (k % 17 == 0).alias("_dup"),
    )
    # customers with a repeated delivery get a second, earlier and stale copy: one scan,
    # copies made by explode
    copy = F.explode(F.when(F.col("_dup"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    out = rows.select("*", copy.alias("_copy"))
    stale = F.col("_copy") == 1
    return (out.withColumn("email", F.when(stale, F.concat(F.lit("old."), F.col("email"))).otherwise(F.col("email")))
            .withColumn("_loaded_at", F.when(stale, F.col("_loaded_at") - F.expr("INTERVAL 1 HOUR"))
                        .otherwise(F.col("_loaded_at")))
            .drop("_dup", "_copy"))


# --- adapter B: event payloads ---------------------------------------------------------------

def _js(c: Column) -> Column:
    """A JSON string literal of a text column (the ids and codes here need no escaping)."""
    return F.concat(F.lit('"'), c, F.lit('"'))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw event message per ``events`` row, ``(event_id, ts, line)``.

    The payload is built by plain text concatenation (so any engine can rebuild the same
    text) and wrapped by event_id % 4: 0 bare, 1 ``body`` object, 2 ``detail`` object,
    3 a ``Records`` list whose ``body`` is the payload as a JSON string.
    """
    ev = spread(read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value"))
    e = F.col("event_id")
    tid = (F.when(e % 61 == 0, F.lit("T"))
           .when(e % 20 == 19, F.concat(F.lit("TXN_"), _s(e - 1)))
           .otherwise(F.concat(F.lit("TXN_"), _s(e))))
    amount = (F.when(e % 67 == 0, F.lit('"abc"'))
              .when(e % 50 == 0, F.lit("-5.00"))
              .when(e % 71 == 0, F.lit("2000000.00"))
              .otherwise(_s(F.col("value").cast(T.DecimalType(18, 2)))))
    currency = F.when(e % 53 == 0, F.lit("FAKE")).when(e % 3 == 0, F.lit("eur")).otherwise(F.lit("USD"))
    ts_text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    opt = lambda cond, text: F.when(cond, text).otherwise(F.lit(""))
    payload = F.concat(
        F.lit('{"transaction_id":'), _js(tid),
        F.lit(',"customer_id":'), _js(F.concat(F.lit("CUST_"), _s(F.col("user_id")))),
        opt(e % 59 != 0, F.concat(F.lit(',"merchant_id":'), _js(F.concat(F.lit("MERCH_"), _s(e % 50))))),
        F.lit(',"amount":'), amount,
        F.lit(',"currency":'), _js(currency),
        F.lit(',"timestamp":'), _js(ts_text),
        opt(e % 5 != 0, F.lit(',"status":"Approved","channel":"Online"')),
        opt(e % 7 == 0, F.concat(F.lit(',"card_number":'),
                                 _js(F.concat(F.lit("4111-1111-1111-"), _s(F.lit(1000) + e % 9000))))),
        F.lit("}"))
    escaped = F.replace(payload, F.lit('"'), F.lit('\\"'))
    line = (F.when(e % 4 == 0, payload)
            .when(e % 4 == 1, F.concat(F.lit('{"body":'), payload, F.lit("}")))
            .when(e % 4 == 2, F.concat(F.lit('{"source":"card.events","detail":'), payload, F.lit("}")))
            .otherwise(F.concat(F.lit('{"Records":[{"messageId":"m'), _s(e), F.lit('","body":"'), escaped,
                                F.lit('"}]}'))))
    return ev.select("event_id", "ts", line.alias("line"))
