"""Column expressions shared by the jobs. All are built-in Spark expressions,
so they run inside whole-stage code generation; none is a Python UDF."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow import constants as C

__all__ = [
    "ts_lit", "date_lit", "null_markers", "trimmed", "safe_decimal", "safe_timestamp", "last_four",
    "international_flag", "category_group", "merchant_region", "online_flag", "usd_amount", "date_key",
    "month_key", "minutes_between", "seconds_between", "hash_key", "mask_card", "batch_id",
    "in_set_ci", "rate", "as_decimal", "rate_table", "usd_amount_by_table",
]


def ts_lit(value: dt.datetime | str) -> Column:
    """A ``timestamp_ntz`` literal."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    return F.lit(value).cast(T.TimestampNTZType())


def date_lit(value: dt.date | str) -> Column:
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value).cast(T.DateType())


def null_markers(df: DataFrame, markers: Iterable[str] = ("NULL", "null", ""), columns: Iterable[str] | None = None) -> DataFrame:
    """Turn the text null markers of the bulk loader into real nulls (string columns only)."""
    markers = list(markers)
    cols = set(columns) if columns is not None else {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[
        (F.when(F.col(f.name).isin(markers), F.lit(None).cast(T.StringType())).otherwise(F.col(f.name)).alias(f.name)
         if f.name in cols else F.col(f.name))
        for f in df.schema.fields
    ])


def trimmed(name: str) -> Column:
    return F.trim(F.col(name))


def safe_decimal(c: Column, precision: int = 18, scale: int = 2) -> Column:
    """Unparseable text becomes null instead of failing the job (ANSI mode)."""
    return c.try_cast(T.DecimalType(precision, scale))


def safe_timestamp(c: Column) -> Column:
    return c.try_cast(T.TimestampNTZType())


def last_four(c: Column) -> Column:
    return F.right(F.trim(c), F.lit(4))


def international_flag(country: Column) -> Column:
    """True when the country is not US; a null country gives False."""
    return F.when(F.upper(F.trim(country)) != F.lit("US"), F.lit(True)).otherwise(F.lit(False))


def category_group(category: Column) -> Column:
    expr = None
    for group, members in C.CATEGORY_GROUPS:
        expr = (F.when if expr is None else expr.when)(category.isin(members), F.lit(group))
    return expr.otherwise(F.lit(C.OTHER_GROUP))


def merchant_region(country: Column) -> Column:
    expr = None
    for code, region in C.COUNTRY_REGIONS:
        expr = (F.when if expr is None else expr.when)(country == F.lit(code), F.lit(region))
    return expr.otherwise(F.lit(C.OTHER_REGION))


def online_flag(category: Column) -> Column:
    return F.coalesce(category.isin(C.ONLINE_CATEGORIES), F.lit(False))


def usd_amount(amount: Column, currency: Column) -> Column:
    """Fixed-rate conversion, stored at 2 decimals (half-up); unknown currency keeps its amount."""
    expr = None
    for code, r in C.USD_RATES:
        conv = amount if code == "USD" else amount * F.lit(r)
        expr = (F.when if expr is None else expr.when)(currency == F.lit(code), conv)
    return F.round(expr.otherwise(amount), 2).cast(T.DecimalType(18, 2))


def rate_table(spark) -> DataFrame:
    """The conversion rates as a small table (8 rows, fixed size: safe to broadcast)."""
    schema = T.StructType([T.StructField("currency", T.StringType()), T.StructField("usd_rate", T.DecimalType(10, 4))])
    return spark.createDataFrame(C.USD_RATES, schema)


def date_key(ts: Column) -> Column:
    """Integer yyyyMMdd."""
    return F.date_format(ts, "yyyyMMdd").cast(T.IntegerType())


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMM").cast(T.IntegerType())


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from start to end (warehouse DATEDIFF('minute'))."""
    return F.floor(
        (F.unix_micros(F.date_trunc("minute", end).cast(T.TimestampType()))
         - F.unix_micros(F.date_trunc("minute", start).cast(T.TimestampType()))) / F.lit(60_000_000)
    ).cast(T.LongType())


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from start to end (warehouse DATEDIFF('second'))."""
    return F.floor(
        (F.unix_micros(F.date_trunc("second", end).cast(T.TimestampType()))
         - F.unix_micros(F.date_trunc("second", start).cast(T.TimestampType()))) / F.lit(1_000_000)
    ).cast(T.LongType())


def hash_key(*parts: Column) -> Column:
    """Repeatable 60-bit surrogate key from natural key parts (md5 prefix as bigint)."""
    text = F.concat_ws("|", *[F.coalesce(p.cast(T.StringType()), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast(T.LongType())


def _card_digits(card: Column) -> Column:
    """The text without '-' and ' '; ``replace`` works on its bytes, ``translate`` makes a string of every character."""
    text = card.cast(T.StringType())
    return F.replace(F.replace(text, F.lit("-"), F.lit("")), F.lit(" "), F.lit(""))


def unmasked_card(card: Column) -> Column:
    """True for 13 or more digits and nothing else but spaces and hyphens."""
    digits = _card_digits(card)
    return F.coalesce(digits.rlike("^[0-9]{13,}$"), F.lit(False))


def mask_card(card: Column) -> Column:
    """Strip '-' and ' ', keep '****' + last four, or '****' when shorter."""
    digits = _card_digits(card)
    return (F.when(card.isNull(), F.lit(None).cast(T.StringType()))
            .when(F.length(digits) >= 4, F.concat(F.lit("****"), F.right(digits, F.lit(4))))
            .otherwise(F.lit("****")))


# 13 to 19 digits with single spaces or hyphens between them, as card numbers are written
_CARD_RUN = r"\d(?:[ -]?\d){8,14}[ -]?(\d[ -]?\d[ -]?\d[ -]?\d)(?!\d)"


def mask_card_runs(text: Column) -> Column:
    """The text with every card-like run of digits cut to its last four."""
    return F.regexp_replace(text, _CARD_RUN, "****$1")


def batch_id(as_of: dt.datetime) -> Column:
    return F.lit(f"batch_{as_of:%Y%m%d_%H%M%S}")


def in_set_ci(c: Column, values: Iterable[str]) -> Column:
    """Case-insensitive membership on the text of the value; null stays null."""
    return F.lower(c.cast(T.StringType())).isin([v.lower() for v in values])


def rate(num: Column, den: Column, scale: int = 6) -> Column:
    """count / count as decimal(18, scale); null when den is 0. Inputs are whole counts;
    decimal(20,0) operands keep 18 exact fraction digits in the quotient."""
    q = num.cast(T.DecimalType(20, 0)) / F.nullif(den, F.lit(0)).cast(T.DecimalType(20, 0))
    return q.cast(T.DecimalType(18, scale))


def as_decimal(c: Column, precision: int = 18, scale: int = 6) -> Column:
    return c.cast(T.DecimalType(precision, scale))


def usd_amount_by_table(df: DataFrame, rates: DataFrame, amount: str = "amount", currency: str = "currency",
                        out: str = "amount_usd") -> DataFrame:
    """Conversion through a rate table instead of a CASE chain. The rate table is a
    reference list (one row per currency, size fixed by the list), so it is broadcast."""
    r = rates.select(F.col("currency").alias("_fx_ccy"), F.col("usd_rate").alias("_fx_rate"))
    j = df.join(F.broadcast(r), F.col(currency) == F.col("_fx_ccy"), "left")
    conv = F.when(F.col("_fx_rate").isNull(), F.col(amount)).otherwise(F.col(amount) * F.col("_fx_rate"))
    return j.withColumn(out, F.round(conv, 2).cast(T.DecimalType(18, 2))).drop("_fx_ccy", "_fx_rate")
