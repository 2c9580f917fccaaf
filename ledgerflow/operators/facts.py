"""Fact table load (star schema) and the analysis joins over it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow import constants as C
from ledgerflow.functions.columns import date_key, month_key, ts_lit, usd_amount
from ledgerflow.operators.joins import lookup_join
from ledgerflow.operators.merchant import DIM_MERCHANT_COLUMNS
from ledgerflow.operators.scd2 import DIM_CUSTOMER_COLUMNS
from ledgerflow.operators.staging import recent

FACT_COLUMNS = [
    "transaction_id", "customer_key", "merchant_key", "transaction_date_key", "amount", "currency", "amount_usd",
    "status", "channel", "is_international", "card_type", "response_code", "auth_code", "transaction_timestamp",
    "processed_at", "_batch_id",
]


def unknown_customer(spark) -> DataFrame:
    row = {c: None for c in DIM_CUSTOMER_COLUMNS}
    row.update(customer_key=C.UNKNOWN_KEY, customer_id=C.UNKNOWN_ID, first_name=C.UNKNOWN_NAME, is_current=True)
    from ledgerflow.operators.scd2 import empty_dim_customer
    return spark.createDataFrame([tuple(row[c] for c in DIM_CUSTOMER_COLUMNS)], empty_dim_customer(spark).schema)


def unknown_merchant(dim_merchant: DataFrame) -> DataFrame:
    lits = {c: F.lit(None).cast(dim_merchant.schema[c].dataType) for c in DIM_MERCHANT_COLUMNS}
    lits.update(merchant_key=F.lit(C.UNKNOWN_KEY).cast(T.LongType()), merchant_id=F.lit(C.UNKNOWN_ID),
                merchant_name=F.lit(C.UNKNOWN_NAME))
    spark = dim_merchant.sparkSession
    return spark.range(1).select(*[lits[c].alias(c) for c in DIM_MERCHANT_COLUMNS])


def ensure_unknown_member(dim: DataFrame, member: DataFrame, key: str) -> DataFrame:
    """Insert-if-missing of the unknown member (key -1): the dimension's own -1 row wins
    over the literal one (top-1 of at most a few rows by priority), so re-running adds
    nothing and no join is needed."""
    known = dim.where(F.col(key) != C.UNKNOWN_KEY)
    candidates = (dim.where(F.col(key) == C.UNKNOWN_KEY).withColumn("_prio", F.lit(0))
                  .unionByName(member.withColumn("_prio", F.lit(1))))
    return known.unionByName(candidates.orderBy("_prio").limit(1).drop("_prio"))


def load_fact(staged: DataFrame, dim_customer: DataFrame, dim_merchant: DataFrame, as_of: dt.datetime,
              lookback: dt.timedelta, existing_fact: DataFrame | None = None,
              processed_at: Column | None = None, existing_from_key: int | None = None) -> DataFrame:
    """Fact rows for recently staged transactions not yet in the fact.

    Dimension lookups are left joins on the natural key to the current customer version
    and to the merchant; misses get the unknown member -1. The lookup sides hold one row
    per key, so a hot customer or merchant can only skew the fact side: the customer
    lookup and the merchant lookup are joins whose skewed partitions AQE splits, and the
    feed is evaluated once. The "already loaded" test is a left-anti join on
    transaction_id; ``existing_from_key`` limits it to fact rows from that date key on
    (their month folders alone are read) where older transactions cannot come again.
    """
    feed = recent(staged, "_staged_at", as_of, lookback)
    if existing_fact is not None:
        loaded = existing_fact
        if existing_from_key is not None:
            loaded = loaded.where(F.col("transaction_date_key") >= existing_from_key)
        feed = feed.join(loaded.select("transaction_id"), "transaction_id", "left_anti")
    cust = (dim_customer.where(F.col("is_current") & (F.col("customer_key") != C.UNKNOWN_KEY))
            .select("customer_id", "customer_key"))
    merch = dim_merchant.where(F.col("merchant_key") != C.UNKNOWN_KEY).select("merchant_id", "merchant_key")
    j = lookup_join(lookup_join(feed, cust, "customer_id"), merch, "merchant_id")
    return j.select(
        "transaction_id",
        F.coalesce(F.col("customer_key"), F.lit(C.UNKNOWN_KEY).cast(T.LongType())).alias("customer_key"),
        F.coalesce(F.col("merchant_key"), F.lit(C.UNKNOWN_KEY).cast(T.LongType())).alias("merchant_key"),
        date_key(F.col("transaction_timestamp")).alias("transaction_date_key"),
        "amount", "currency",
        usd_amount(F.col("amount"), F.col("currency")).alias("amount_usd"),
        "status", "channel", "is_international", "card_type", "response_code", "auth_code",
        "transaction_timestamp",
        (processed_at if processed_at is not None else ts_lit(as_of)).alias("processed_at"),
        "_batch_id",
    )


def unknown_safe_key(key: str, *spread: str, buckets: int = 1024) -> Column:
    """Join key that sends unknown-member rows (-1) to no dimension row and spreads them
    over ``buckets`` negative keys, so a large -1 share never lands in one join task.
    Dimension keys are non-negative, so the negative keys never match."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(buckets))
    return F.when(F.col(key) == C.UNKNOWN_KEY, F.lit(-2) - salt).otherwise(F.col(key))


def star_rollup(fact: DataFrame, dim_customer: DataFrame, dim_merchant: DataFrame) -> DataFrame:
    """USD amount and count by merchant category group x region x current customer tier x month.

    Plan shape chosen for scale: the fact first meets the merchant attributes (a small
    table: broadcast by Spark's size check, else a join that AQE balances), then is
    aggregated to (customer_key, group, region, month) with map-side partial aggregation,
    so the customer join sees a customer's few combinations instead of its transactions.
    Rows on the unknown member (-1) get a spread, never-matching join key
    (:func:`unknown_safe_key`) and the unknown attributes directly, so the -1 key is no
    hot partition.
    """
    unknown = F.lit(C.UNKNOWN_NAME)
    merch = dim_merchant.where(F.col("merchant_key") != C.UNKNOWN_KEY).select(
        F.col("merchant_key").alias("_mk"), "category_group", "merchant_region")
    m_unknown = F.col("merchant_key") == C.UNKNOWN_KEY
    tagged = (fact.select("customer_key", "merchant_key", "amount_usd", "transaction_id",
                          month_key(F.col("transaction_timestamp")).alias("month_key"))
              .withColumn("_mj", unknown_safe_key("merchant_key", "transaction_id"))
              .join(merch, F.col("_mj") == F.col("_mk"), "left"))
    pre = (tagged.groupBy("customer_key", F.when(m_unknown, unknown).otherwise(F.col("category_group")).alias("category_group"),
                          F.when(m_unknown, unknown).otherwise(F.col("merchant_region")).alias("merchant_region"), "month_key")
           .agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount_usd").alias("amount_usd")))
    cust = dim_customer.where(F.col("is_current") & (F.col("customer_key") != C.UNKNOWN_KEY)).select(
        F.col("customer_key").alias("_ck"), "customer_tier")
    j = (pre.withColumn("_cj", unknown_safe_key("customer_key", "category_group", "merchant_region", "month_key"))
         .join(cust, F.col("_cj") == F.col("_ck"), "left"))
    tier = F.when(F.col("customer_key") == C.UNKNOWN_KEY, unknown).otherwise(F.col("customer_tier"))
    return (j.groupBy("category_group", "merchant_region", tier.alias("customer_tier"), "month_key")
            .agg(F.sum("txn_count").cast(T.LongType()).alias("txn_count"),
                 F.sum("amount_usd").cast(T.DecimalType(38, 2)).alias("amount_usd")))


def dim_date(fact: DataFrame, ts_col: str = "transaction_timestamp") -> DataFrame:
    """Calendar rows from the first to the last fact day (one global min/max, then
    ``sequence`` + ``explode``: one row per day, bounded by the calendar)."""
    bounds = fact.agg(F.min(F.to_date(ts_col)).alias("lo"), F.max(F.to_date(ts_col)).alias("hi"))
    days = bounds.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return days.select(
        date_key(F.col("date")).alias("transaction_date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.weekday("date").alias("day_of_week"),
        (F.weekday("date") >= 5).alias("is_weekend"),
    )


def orphan_keys(fact: DataFrame, dim_customer: DataFrame, dim_merchant: DataFrame) -> DataFrame:
    """Referential test per key column: rows on the unknown member (-1) and true orphans (a key
    no dimension row carries). The fact is scanned once per key and counted by key before
    any join, so a hot key is one row when the dimension's keys are looked up."""
    out = []
    for key, dim in (("customer_key", dim_customer), ("merchant_key", dim_merchant)):
        counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        known = dim.select(F.col(key).alias("_known")).distinct()
        found = counts.join(known, F.col(key) == F.col("_known"), "left")
        none = F.lit(0).cast(T.LongType())
        out.append(found.agg(
            F.coalesce(F.sum("_n"), none).alias("fact_rows"),
            F.coalesce(F.sum(F.when(F.col(key) == C.UNKNOWN_KEY, F.col("_n"))), none).alias("unknown_member_rows"),
            F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_n"))), none).alias("orphan_rows"))
            .select(F.lit(key).alias("key_name"), "fact_rows", "unknown_member_rows", "orphan_rows"))
    return out[0].unionByName(out[1])
