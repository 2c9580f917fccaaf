"""Merchant dimension (type 1): per-batch merchant statistics, insert of new merchants
with derived attributes, and the additive upsert of known ones."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow import constants as C
from ledgerflow.functions.columns import category_group, hash_key, merchant_region, online_flag, ts_lit
from ledgerflow.operators.joins import lookup_join

DIM_MERCHANT_COLUMNS = [
    "merchant_key", "merchant_id", "merchant_name", "merchant_category", "category_group", "mcc_code",
    "merchant_city", "merchant_state", "merchant_country", "merchant_region", "is_online", "risk_score",
    "first_seen_date", "last_transaction_date", "total_transaction_count", "_loaded_at",
]


def merchant_batch_stats(staged: DataFrame, since: dt.datetime | None = None) -> DataFrame:
    """One row per merchant: first/last seen, row count, latest category/city/country.

    A hash aggregate for the numbers and a top-1 window with group limits for the attributes,
    both cut to one row per merchant and map task before the shuffle: a merchant holding a
    third of all rows is no hot partition, and nothing is sorted beyond the task's merchants. ``since`` limits the input to rows staged after the previous run, so counts
    are not added twice; ``since=None`` counts every staged row.
    """
    src = staged.where(F.col("merchant_id").isNotNull())
    if since is not None:
        src = src.where(F.col("_staged_at") > ts_lit(since))
    numbers = (src.groupBy("merchant_id")
               .agg(F.min("transaction_timestamp").alias("first_seen"), F.max("transaction_timestamp").alias("last_seen"),
                    F.count(F.lit(1)).alias("txn_count")))
    latest = merchant_latest_rows(src).select("merchant_id", "merchant_category", "merchant_city", "merchant_country")
    return (latest.join(numbers, "merchant_id")
            .select("merchant_id", "merchant_category", "merchant_city", "merchant_country", "first_seen", "last_seen", "txn_count"))


def _dim_row(df: DataFrame, as_of: dt.datetime) -> DataFrame:
    return df.select(
        hash_key(F.col("merchant_id")).alias("merchant_key"),
        F.col("merchant_id"),
        F.col("merchant_id").alias("merchant_name"),
        F.col("merchant_category"),
        category_group(F.col("merchant_category")).alias("category_group"),
        F.lit(None).cast(T.StringType()).alias("mcc_code"),
        F.col("merchant_city"),
        F.lit(None).cast(T.StringType()).alias("merchant_state"),
        F.col("merchant_country"),
        merchant_region(F.col("merchant_country")).alias("merchant_region"),
        online_flag(F.col("merchant_category")).alias("is_online"),
        F.lit(0).cast(T.DecimalType(5, 2)).alias("risk_score"),
        F.to_date("first_seen").alias("first_seen_date"),
        F.to_date("last_seen").alias("last_transaction_date"),
        F.col("txn_count").cast(T.LongType()).alias("total_transaction_count"),
        ts_lit(as_of).alias("_loaded_at"),
    )


def build_dim_merchant(staged: DataFrame, as_of: dt.datetime) -> DataFrame:
    """First load: every merchant is new."""
    return _dim_row(merchant_batch_stats(staged), as_of)


def upsert_dim_merchant(dim: DataFrame, stats: DataFrame, as_of: dt.datetime) -> DataFrame:
    """MERGE of a batch's merchant statistics into the dimension.

    Matched: attributes keep the old value when the batch has none, the last date is
    the later of both, the count is added. New: inserted with derived attributes. The
    unknown member (key -1) and untouched merchants pass through unchanged. Derived
    attributes (group, region, online flag) follow the merged attributes.
    """
    t = dim.alias("t")
    s = stats.alias("s")
    j = t.join(s, F.col("t.merchant_id") == F.col("s.merchant_id"), "full_outer")
    new = F.col("t.merchant_id").isNull()
    matched = F.col("t.merchant_id").isNotNull() & F.col("s.merchant_id").isNotNull()

    def merged(attr: str):
        return (F.when(new, F.col(f"s.{attr}"))
                .when(matched, F.coalesce(F.col(f"s.{attr}"), F.col(f"t.{attr}")))
                .otherwise(F.col(f"t.{attr}")))

    cat, country = merged("merchant_category"), merged("merchant_country")
    touched = new | matched
    return j.select(
        F.when(new, hash_key(F.col("s.merchant_id"))).otherwise(F.col("t.merchant_key")).alias("merchant_key"),
        F.coalesce(F.col("t.merchant_id"), F.col("s.merchant_id")).alias("merchant_id"),
        F.coalesce(F.col("t.merchant_name"), F.col("s.merchant_id")).alias("merchant_name"),
        cat.alias("merchant_category"),
        F.when(F.col("t.merchant_key") == C.UNKNOWN_KEY, F.col("t.category_group"))
         .otherwise(category_group(cat)).alias("category_group"),
        F.col("t.mcc_code").alias("mcc_code"),
        merged("merchant_city").alias("merchant_city"),
        F.col("t.merchant_state").alias("merchant_state"),
        country.alias("merchant_country"),
        F.when(F.col("t.merchant_key") == C.UNKNOWN_KEY, F.col("t.merchant_region"))
         .otherwise(merchant_region(country)).alias("merchant_region"),
        F.when(F.col("t.merchant_key") == C.UNKNOWN_KEY, F.col("t.is_online"))
         .otherwise(online_flag(cat)).alias("is_online"),
        F.coalesce(F.col("t.risk_score"), F.lit(0).cast(T.DecimalType(5, 2))).alias("risk_score"),
        F.when(new, F.to_date("s.first_seen")).otherwise(F.col("t.first_seen_date")).alias("first_seen_date"),
        F.when(new, F.to_date("s.last_seen"))
         .when(matched, F.greatest(F.col("t.last_transaction_date"), F.to_date("s.last_seen")))
         .otherwise(F.col("t.last_transaction_date")).alias("last_transaction_date"),
        F.when(new, F.col("s.txn_count"))
         .when(matched, F.col("t.total_transaction_count") + F.col("s.txn_count"))
         .otherwise(F.col("t.total_transaction_count")).cast(T.LongType()).alias("total_transaction_count"),
        F.when(touched, ts_lit(as_of)).otherwise(F.col("t._loaded_at")).alias("_loaded_at"),
    )


def merchant_latest_rows(staged: DataFrame) -> DataFrame:
    """The whole latest staged row per merchant (QUALIFY ROW_NUMBER() = 1)."""
    from ledgerflow.operators.staging import latest_per_key
    return latest_per_key(staged.where(F.col("merchant_id").isNotNull()), "merchant_id",
                          [F.col("_staged_at").desc(), F.col("transaction_timestamp").desc(),
                           F.col("transaction_id").desc()])


def merchant_first_values(staged: DataFrame) -> DataFrame:
    """Per staged row, the merchant's latest category/city/country (FIRST_VALUE over the
    merchant ordered latest first, nulls respected).

    Computed as an aggregate joined back rather than a window: a window would pull every
    row of a hot merchant into one task; the aggregate pre-aggregates map-side and the
    join back is a one-row-per-merchant lookup with hot merchants joined by broadcast
    (:func:`ledgerflow.operators.joins.lookup_join`).
    """
    stats = merchant_batch_stats(staged).select(
        "merchant_id", F.col("merchant_category").alias("latest_category"),
        F.col("merchant_city").alias("latest_city"), F.col("merchant_country").alias("latest_country"))
    rows = staged.where(F.col("merchant_id").isNotNull()).select("transaction_id", "merchant_id")
    return lookup_join(rows, stats, "merchant_id", "left")


def merchant_window_stats(staged: DataFrame) -> DataFrame:
    """Per staged row, MIN/MAX(transaction_timestamp) and COUNT(*) of its merchant
    (window without order), again as aggregate + lookup join for skew safety."""
    stats = merchant_batch_stats(staged).select(
        "merchant_id", F.col("first_seen").alias("merchant_first_seen"),
        F.col("last_seen").alias("merchant_last_seen"), F.col("txn_count").alias("merchant_txn_count"))
    rows = staged.where(F.col("merchant_id").isNotNull()).select("transaction_id", "merchant_id")
    return lookup_join(rows, stats, "merchant_id", "left")
