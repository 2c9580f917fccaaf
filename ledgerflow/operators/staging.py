"""Staging of raw transactions: recency filter, cleaning, latest-per-id dedup,
reject split and the load-time-guarded upsert into the staging table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow import constants as C
from ledgerflow.functions.columns import (
    batch_id, international_flag, last_four, mask_card, null_markers, safe_decimal, safe_timestamp, ts_lit, unmasked_card,
)

STAGED_COLUMNS = [
    "transaction_id", "customer_id", "merchant_id", "amount", "currency", "transaction_timestamp", "status",
    "channel", "card_type", "card_last_four", "merchant_category", "merchant_city", "merchant_country",
    "is_international", "response_code", "auth_code", "_staged_at", "_batch_id", "_source_file",
]
CLEAN_COLUMNS = [c for c in STAGED_COLUMNS if c not in ("_staged_at", "_batch_id", "_source_file")] + [
    "_loaded_at", "_source_file", "card_number"]
# Columns the staging table declares NOT NULL.
STAGED_REQUIRED = ["transaction_id", "customer_id", "merchant_id", "amount", "currency", "transaction_timestamp",
                   "status", "channel"]


def recent(df: DataFrame, ts_col: str, as_of: dt.datetime, lookback: dt.timedelta) -> DataFrame:
    """Rows whose ``ts_col`` lies in [as_of - lookback, as_of]. A plain column-vs-literal
    range, so Parquet pushes it into the scan."""
    return df.where((F.col(ts_col) >= ts_lit(as_of - lookback)) & (F.col(ts_col) <= ts_lit(as_of)))


def carried_columns() -> list[Column]:
    """The cleaned columns, the card number as it came and no column that follows from others: what
    :func:`latest_per_key` has to carry."""
    t = F.trim
    return [
        t("transaction_id").alias("transaction_id"),
        t("customer_id").alias("customer_id"),
        t("merchant_id").alias("merchant_id"),
        safe_decimal(F.col("amount")).alias("amount"),
        F.upper(t("currency")).alias("currency"),
        safe_timestamp(F.col("transaction_timestamp")).alias("transaction_timestamp"),
        F.lower(t("status")).alias("status"),
        F.lower(t("channel")).alias("channel"),
        t("card_type").alias("card_type"),
        t("merchant_category").alias("merchant_category"),
        t("merchant_city").alias("merchant_city"),
        F.upper(t("merchant_country")).alias("merchant_country"),
        t("response_code").alias("response_code"),
        t("auth_code").alias("auth_code"),
        F.col("_loaded_at"),
        F.col("_source_file"),
        F.col("card_number"),
    ]


def with_derived(carried: DataFrame) -> DataFrame:
    """The cleaned rows: carried columns and those that follow from them."""
    derived = {
        "card_last_four": last_four(F.col("card_number")),
        "is_international": international_flag(F.col("merchant_country")),
        # never the number itself: check 15 counts the marks
        "card_number": F.when(unmasked_card(F.col("card_number")), F.concat(F.lit(C.UNMASKED_MARK), mask_card(F.col("card_number"))))
        .otherwise(F.col("card_number")),
    }
    return carried.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in CLEAN_COLUMNS])


def latest_per_key(df: DataFrame, key: str | list[str], order: list[Column]) -> DataFrame:
    """Keep the first row per key under ``order`` (a total order: add a tie-break).

    ``row_number() == 1`` plans as a WindowGroupLimit on both sides of the shuffle, so
    each map task sends at most one row per key: a key holding a third of all rows
    costs one row per task in the exchange, not a third of the data in one task.

    The rows are sorted by a hash of the key before the key itself: a sort compares eight bytes of its
    first column at once, and ids begin with the same letters, so that it would go to the
    texts of the rows for almost every comparison.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(F.hash(*[F.col(k) for k in keys]), *keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def carried_rows(raw: DataFrame, as_of: dt.datetime, lookback: dt.timedelta) -> DataFrame:
    src = recent(null_markers(raw), "_loaded_at", as_of, lookback)
    src = src.where(F.col("transaction_id").isNotNull() & F.col("amount").isNotNull())
    return src.select(*carried_columns())


def clean_rows(raw: DataFrame, as_of: dt.datetime, lookback: dt.timedelta) -> DataFrame:
    """Recent raw rows with id and amount text, cleaned, every version kept."""
    return with_derived(carried_rows(raw, as_of, lookback))


def latest_valid(raw: DataFrame, as_of: dt.datetime, lookback: dt.timedelta) -> tuple[DataFrame, DataFrame]:
    """(staged rows with ``_loaded_at``, rejects): of each id the latest version that parses. The
    order has no file name in it, so the way rows are spread over files does not matter."""
    staged, refused = stage_transactions(clean_rows(raw, as_of, lookback), as_of, keep_load_time=True)
    return latest_per_key(staged, "transaction_id", version_order()), refused


def version_order(prefix: str = "") -> list[Column]:
    """Newest version first: load time, then the values themselves."""
    return [F.col(f"{prefix}{c}").desc_nulls_last() for c in ("_loaded_at", "amount", "transaction_timestamp", "status", "customer_id")]


def clean_transactions(raw: DataFrame, as_of: dt.datetime, lookback: dt.timedelta) -> DataFrame:
    """Recent raw rows with id and amount text, cleaned and deduplicated (latest load wins).

    The not-null test runs on the raw text before the cast; rows whose amount does not
    parse keep a null amount here and are split off by :func:`stage_transactions`.
    """
    carried = carried_rows(raw, as_of, lookback)
    # tie-break after load time: source file, then the raw amount (total order)
    latest = latest_per_key(carried, "transaction_id",
                            [F.col("_loaded_at").desc(), F.col("_source_file").desc_nulls_last(),
                             F.col("amount").desc_nulls_last(), F.col("transaction_timestamp").desc_nulls_last()])
    # derived for the rows kept only, and not sorted and shuffled with them
    return with_derived(latest)


def _reject_reason() -> Column:
    checks = [F.when(F.col(c).isNull(), F.lit(f"{c} is null or unparseable")) for c in STAGED_REQUIRED]
    return F.coalesce(*checks)


def stage_transactions(clean: DataFrame, as_of: dt.datetime, keep_load_time: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split cleaned rows into (staged rows, rejects). Both are projections of one input,
    so persisting ``clean`` lets the two writes share one scan. ``keep_load_time`` keeps
    ``_loaded_at`` on the staged rows, as :func:`upsert_staging` needs it."""
    with_reason = clean.withColumn("_reject_reason", _reject_reason())
    # no reason: plain tests that reach the scan
    staged = (clean.where(" AND ".join(f"{c} IS NOT NULL" for c in STAGED_REQUIRED))
              .withColumn("_staged_at", ts_lit(as_of))
              .withColumn("_batch_id", batch_id(as_of))
              .select(*STAGED_COLUMNS, *(["_loaded_at"] if keep_load_time else [])))
    rejects = with_reason.where(F.col("_reject_reason").isNotNull()).withColumn("_rejected_at", ts_lit(as_of))
    return staged, rejects


def upsert_staging(target: DataFrame, source_staged: DataFrame) -> DataFrame:
    """MERGE semantics without row-level writes: new ids are inserted, a matched id is
    replaced only when the source row was loaded after the target row was staged.

    ``source_staged`` carries ``_loaded_at`` besides the staged columns. One full-outer
    join on the unique id (one row per id on each side, so no skew), then one projection
    picks each column from the winning side.
    """
    s = source_staged.alias("s")
    t = target.alias("t")
    j = t.join(s, F.col("t.transaction_id") == F.col("s.transaction_id"), "full_outer")
    take_src = F.col("t.transaction_id").isNull() | (F.col("s.transaction_id").isNotNull()
                                                      & (F.col("s._loaded_at") > F.col("t._staged_at")))
    out = []
    for c in STAGED_COLUMNS:
        if c == "_source_file":
            # kept from the target when the source leaves it empty
            out.append(F.when(take_src, F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}"))).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(take_src, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    return j.select(*out)


def staging_changes(target: DataFrame, source_staged: DataFrame) -> DataFrame:
    """The change feed of :func:`upsert_staging`: one row for each id that the source inserts or
    replaces, with the staged columns after the change and ``before_timestamp``, the time of the
    transaction before it (null for an insert). Give it the part of the target that can
    hold the source's ids; rows that stay as they are do not appear."""
    t = target.select(F.col("transaction_id").alias("_t_id"), F.col("transaction_timestamp").alias("before_timestamp"),
                      F.col("_staged_at").alias("_t_staged_at"), F.col("_source_file").alias("_t_file"))
    j = source_staged.join(t, F.col("transaction_id") == F.col("_t_id"), "left")
    taken = j.where(F.col("_t_id").isNull() | (F.col("_loaded_at") > F.col("_t_staged_at")))
    after = [F.coalesce("_source_file", "_t_file").alias(c) if c == "_source_file" else F.col(c) for c in STAGED_COLUMNS]
    return taken.select(*after, F.when(F.col("_t_id").isNull(), "insert").otherwise("update").alias("change"), "before_timestamp")
