"""Customer history (slowly changing dimension, type 2) in staging and in the mart.

``scd2_merge(history, incoming, as_of)`` returns the new history: unchanged rows, the
current rows of changed customers closed the day before ``as_of``, and one new
current version per new or changed customer. Re-running with the same input changes
nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow import constants as C
from ledgerflow.functions.columns import date_lit, hash_key, ts_lit
from ledgerflow.operators.staging import latest_per_key

# The attributes whose change makes a new version, in hash order.
HASH_ATTRIBUTES = ["first_name", "last_name", "email", "phone", "address_line_1", "city", "state", "country",
                   "postal_code", "customer_tier"]
CUSTOMER_ATTRIBUTES = HASH_ATTRIBUTES + ["account_open_date"]
HISTORY_COLUMNS = (["customer_key", "customer_id"] + CUSTOMER_ATTRIBUTES
                   + ["effective_date", "expiry_date", "is_current", "_hash_key", "_updated_at"])
DIM_CUSTOMER_COLUMNS = [
    "customer_key", "customer_id", "first_name", "last_name", "full_name", "email", "phone", "city", "state",
    "country", "postal_code", "customer_tier", "account_open_date", "account_age_days", "effective_date",
    "expiry_date", "is_current", "_loaded_at",
]


def attribute_hash():
    """md5 of the ten attributes joined by '|', nulls as empty text."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(a), F.lit("")) for a in HASH_ATTRIBUTES]))


def empty_history(spark) -> DataFrame:
    schema = T.StructType([
        T.StructField("customer_key", T.LongType()), T.StructField("customer_id", T.StringType()),
        *[T.StructField(a, T.StringType()) for a in HASH_ATTRIBUTES],
        T.StructField("account_open_date", T.DateType()), T.StructField("effective_date", T.DateType()),
        T.StructField("expiry_date", T.DateType()), T.StructField("is_current", T.BooleanType()),
        T.StructField("_hash_key", T.StringType()), T.StructField("_updated_at", T.TimestampNTZType()),
    ])
    return spark.createDataFrame([], schema)


def latest_customers(incoming: DataFrame) -> DataFrame:
    """One incoming row per customer: the latest load wins (a feed may repeat a customer)."""
    return latest_per_key(incoming, "customer_id", [F.col("_loaded_at").desc(), F.col("email").desc_nulls_last()])


def classify_changes(history: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming customers with their new hash, the stored hash and INSERT / UPDATE / NO_CHANGE.

    A left join of the (deduplicated) feed to the current history rows: one current
    row per customer on the right, so a customer never multiplies feed rows.
    """
    src = latest_customers(incoming).withColumn("new_hash", attribute_hash())
    cur = history.where("is_current").select("customer_id", F.col("customer_key").alias("_cur_key"),
                                             F.col("_hash_key").alias("existing_hash"))
    j = src.join(cur, "customer_id", "left")
    change = (F.when(F.col("_cur_key").isNull(), F.lit("INSERT"))
              .when(F.col("existing_hash") != F.col("new_hash"), F.lit("UPDATE"))
              .otherwise(F.lit("NO_CHANGE")))
    return j.withColumn("change_type", change).drop("_cur_key")


def scd2_merge(history: DataFrame, incoming: DataFrame, as_of: dt.date) -> DataFrame:
    """One pass: a full outer join of the whole history with the deduplicated feed, on the
    customer and only against the current row. Each joined row then yields the old row
    (closed when its hash changed) and, for new or changed customers, the new version,
    through one ``explode``. History rows of other versions pass through unmatched.
    """
    src = latest_customers(incoming).select(
        F.col("customer_id").alias("_s_id"), *[F.col(a).alias(f"_s_{a}") for a in CUSTOMER_ATTRIBUTES],
        attribute_hash().alias("_s_hash"))
    j = history.join(src, (history.customer_id == src._s_id) & history.is_current, "full_outer")
    now = ts_lit(dt.datetime.combine(as_of, dt.time()))
    has_old = F.col("customer_key").isNotNull()
    has_new = F.col("_s_id").isNotNull()
    # INSERT: no current row; UPDATE: stored hash differs (a null stored hash is NO_CHANGE)
    insert = has_new & ~has_old
    update = has_new & has_old & F.coalesce(F.col("_hash_key") != F.col("_s_hash"), F.lit(False))
    old = F.struct(
        F.col("customer_key"), F.col("customer_id"), *[F.col(a) for a in CUSTOMER_ATTRIBUTES],
        F.col("effective_date"),
        F.when(update, F.date_sub(date_lit(as_of), 1)).otherwise(F.col("expiry_date")).alias("expiry_date"),
        F.when(update, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"),
        F.col("_hash_key"),
        F.when(update, now).otherwise(F.col("_updated_at")).alias("_updated_at"),
    )
    new = F.struct(
        hash_key(F.col("_s_id"), date_lit(as_of)).alias("customer_key"), F.col("_s_id").alias("customer_id"),
        *[F.col(f"_s_{a}").alias(a) for a in CUSTOMER_ATTRIBUTES],
        date_lit(as_of).alias("effective_date"), date_lit(C.OPEN_END_DATE).alias("expiry_date"),
        F.lit(True).alias("is_current"), F.col("_s_hash").alias("_hash_key"), now.alias("_updated_at"),
    )
    out = F.filter(F.array(F.when(has_old, old), F.when(insert | update, new)), lambda x: x.isNotNull())
    return j.select(F.explode(out).alias("r")).select("r.*")


def as_of_lookup(facts: DataFrame, history: DataFrame, ts_col: str = "transaction_timestamp") -> DataFrame:
    """Point-in-time version of the customer for each fact row: the version whose
    [effective_date, expiry_date] holds the fact's date. An equi join on the customer
    plus a range filter; a customer has few versions, so no pair explosion."""
    versions = history.select("customer_id", F.col("customer_key").alias("asof_customer_key"),
                              F.col("customer_tier").alias("asof_customer_tier"), "effective_date", "expiry_date")
    d = F.to_date(F.col(ts_col))
    return (facts.join(versions, (facts.customer_id == versions.customer_id)
                       & (d >= versions.effective_date) & (d <= versions.expiry_date), "left")
            .drop(versions.customer_id).drop("effective_date", "expiry_date"))


# --- snapshots in any order -----------------------------------------------------------------

def observations(incoming: DataFrame, seen_on: dt.date) -> DataFrame:
    """A snapshot as rows of the observation log: what was seen of each customer on a day. The log
    keeps every snapshot, also where it changed nothing, so that a late one between two equal
    ones is told from one at their end."""
    return latest_customers(incoming).select("customer_id", *CUSTOMER_ATTRIBUTES, date_lit(seen_on).alias("seen_on"))


def history_of(seen: DataFrame) -> DataFrame:
    """The type-2 history of an observation log, by one sweep over each customer's days: a version
    starts where the attributes differ from the day before it was seen last, and ends the day
    before the next starts. Equals :func:`scd2_merge` over the snapshots in order, whatever
    order they arrived in. A customer has one row a snapshot, so no group is large."""
    by_day = Window.partitionBy("customer_id").orderBy("seen_on")
    hashed = seen.withColumn("_hash_key", attribute_hash())
    starts = (hashed.withColumn("_before", F.lag("_hash_key").over(by_day))
              .where(F.col("_before").isNull() | (F.col("_before") != F.col("_hash_key")))
              .withColumn("_next", F.lead("seen_on").over(by_day)))
    closed = F.col("_next").isNotNull()
    rows = starts.select(
        hash_key(F.col("customer_id"), F.col("seen_on")).alias("customer_key"), "customer_id", *CUSTOMER_ATTRIBUTES,
        F.col("seen_on").alias("effective_date"),
        F.when(closed, F.date_sub("_next", 1)).otherwise(date_lit(C.OPEN_END_DATE)).alias("expiry_date"),
        (~closed).alias("is_current"), "_hash_key",
        F.coalesce("_next", "seen_on").cast(T.TimestampNTZType()).alias("_updated_at"))
    return rows.select(*HISTORY_COLUMNS)


def insert_snapshot(history: DataFrame, seen: DataFrame, incoming: DataFrame, seen_on: dt.date) -> DataFrame:
    """The history after a snapshot of any day, earlier or later than those in the log ``seen``
    (without it): the versions of its customers are swept anew, all others stay as they are.
    A second snapshot of a day in the log replaces what was seen of its customers then."""
    new = observations(incoming, seen_on)
    ids = new.select("customer_id")
    before = (seen.join(ids, "customer_id", "left_semi").where(F.col("seen_on") != date_lit(seen_on)))
    return history.join(ids, "customer_id", "left_anti").select(*HISTORY_COLUMNS).unionByName(
        history_of(before.unionByName(new)))


def rekey(keyed: DataFrame, history: DataFrame, changed: DataFrame, ts_col: str = "transaction_timestamp") -> DataFrame:
    """Point-in-time keys (:func:`as_of_lookup`) brought up to date after the customers in ``changed`` got
    other versions; the rows of all other customers keep theirs."""
    ids = changed.select("customer_id").distinct()
    again = keyed.join(ids, "customer_id", "left_semi").drop("asof_customer_key", "asof_customer_tier")
    # columns of their own: ``keyed`` may come from a part of the same history
    versions = history.join(ids, "customer_id", "left_semi").select(*[F.col(c).alias(c) for c in HISTORY_COLUMNS])
    return keyed.join(ids, "customer_id", "left_anti").unionByName(as_of_lookup(again, versions, ts_col))


# --- mart: dim_customer -------------------------------------------------------------------

def empty_dim_customer(spark) -> DataFrame:
    schema = T.StructType([
        T.StructField("customer_key", T.LongType()), T.StructField("customer_id", T.StringType()),
        *[T.StructField(c, T.StringType()) for c in ["first_name", "last_name", "full_name", "email", "phone", "city",
                                                      "state", "country", "postal_code", "customer_tier"]],
        T.StructField("account_open_date", T.DateType()), T.StructField("account_age_days", T.IntegerType()),
        T.StructField("effective_date", T.DateType()), T.StructField("expiry_date", T.DateType()),
        T.StructField("is_current", T.BooleanType()), T.StructField("_loaded_at", T.TimestampNTZType()),
    ])
    return spark.createDataFrame([], schema)


def load_dim_customer(dim: DataFrame, history: DataFrame, as_of: dt.date) -> DataFrame:
    """Bring the mart dimension up to the staging history, in one full outer join.

    The current staged version of each customer is matched with the current dimension
    row. A different version closes the dimension row and inserts the staged one; a
    customer without a current dimension row is inserted; the same version changes
    nothing. Comparing versions (the staged history already applied one attribute list)
    means a phone- or address-only change can never leave two current rows. The unknown
    member and closed rows pass through unmatched.
    """
    stg = history.where("is_current").select(*[F.col(c).alias(f"_s_{c}") for c in HISTORY_COLUMNS])
    j = dim.join(stg, (dim.customer_id == stg._s_customer_id) & dim.is_current
                 & (dim.customer_key != C.UNKNOWN_KEY), "full_outer")
    now = ts_lit(dt.datetime.combine(as_of, dt.time()))
    has_old = F.col("customer_key").isNotNull()
    has_new = F.col("_s_customer_id").isNotNull()
    changed = has_old & has_new & ~F.col("effective_date").eqNullSafe(F.col("_s_effective_date"))
    insert = has_new & (~has_old | changed)
    old = F.struct(
        *[F.col(c) for c in DIM_CUSTOMER_COLUMNS if c not in ("expiry_date", "is_current", "_loaded_at")],
        F.when(changed, F.date_sub(date_lit(as_of), 1)).otherwise(F.col("expiry_date")).alias("expiry_date"),
        F.when(changed, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"),
        F.when(changed, now).otherwise(F.col("_loaded_at")).alias("_loaded_at"),
    )
    s = lambda c: F.col(f"_s_{c}")
    new = F.struct(
        s("customer_key").alias("customer_key"), s("customer_id").alias("customer_id"),
        s("first_name").alias("first_name"), s("last_name").alias("last_name"),
        F.concat(F.coalesce(s("first_name"), F.lit("")), F.lit(" "), F.coalesce(s("last_name"), F.lit(""))).alias("full_name"),
        *[s(c).alias(c) for c in ["email", "phone", "city", "state", "country", "postal_code"]],
        F.coalesce(s("customer_tier"), F.lit(C.DEFAULT_TIER)).alias("customer_tier"),
        s("account_open_date").alias("account_open_date"),
        F.datediff(date_lit(as_of), s("account_open_date")).alias("account_age_days"),
        s("effective_date").alias("effective_date"), s("expiry_date").alias("expiry_date"),
        s("is_current").alias("is_current"), now.alias("_loaded_at"),
    )
    out = F.filter(F.array(F.when(has_old, old), F.when(insert, new)), lambda x: x.isNotNull())
    return j.select(F.explode(out).alias("r")).select("r.*")
