"""The 15 data-quality checks as one distributed aggregate.

``run_checks(df, as_of)`` returns one row per check (``check_name, check_type,
success, details, metric_value, threshold``). Schema checks are decided on the
driver from ``df.columns`` (no job); every data check is one column of a single
``df.agg(...)``, so the whole suite is one scan and one tiny result, whatever the
input size. An empty input yields no rows; a missing column fails its check with
value 0.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow import constants as C
from ledgerflow.functions.columns import in_set_ci, rate, ts_lit, unmasked_card

DEC = T.DecimalType(18, 6)
RESULT_COLUMNS = ["check_id", "check_name", "check_type", "success", "details", "metric_value", "threshold"]


@dataclass(frozen=True)
class Check:
    check_id: int
    name: str
    check_type: str
    kind: str
    column: str | None = None
    threshold: str = "1"


# --- fixed values: the check suite, in order ---------------------------------------------------
CHECKS = [
    Check(1, "Check 1: Transaction ID not null", "completeness", "not_null", "transaction_id", "0.999"),
    Check(2, "Check 2: Transaction ID unique", "uniqueness", "unique", "transaction_id", "1.0"),
    Check(3, "Check 3: Amount > 0", "accuracy", "range", "amount", "0.999"),
    Check(4, "Check 4: Amount < 1M", "accuracy", "amount_max", "amount", "0.9999"),
    Check(5, "Check 5: Valid currency", "referential", "in_set", "currency", "0.995"),
    Check(6, "Check 6: Valid status", "referential", "in_set", "status", "0.995"),
    Check(7, "Check 7: No future timestamps", "timeliness", "future", "transaction_timestamp", "1.0"),
    Check(8, "Check 8: Customer ID exists", "completeness", "not_null", "customer_id", "0.999"),
    Check(9, "Check 9: Merchant ID exists", "completeness", "not_null", "merchant_id", "0.999"),
    Check(10, "Check 10: No duplicate rows", "uniqueness", "dup_rows", None, "1.0"),
    Check(11, "Check 11: Schema compliance", "schema", "schema", None, "1.0"),
    Check(12, "Check 12: Row count in range", "volume", "volume", None, str(C.DQ_MIN_ROWS)),
    Check(13, "Check 13: Data freshness", "timeliness", "freshness", "transaction_timestamp", "0.99"),
    Check(14, "Check 14: Valid channel", "referential", "in_set", "channel", "0.995"),
    Check(15, "Check 15: Card number masked", "security", "card_masked", None, "1"),
]
VALID_SETS = {"currency": C.VALID_CURRENCIES, "status": C.VALID_STATUSES, "channel": C.VALID_CHANNELS}
# threshold reported when the checked column is missing
MISSING_THRESHOLD = {"not_null": "1", "unique": "1", "range": "0.999", "amount_max": "0.9999", "in_set": "1",
                     "future": "1", "freshness": "0.99"}


def _d(v) -> Column:
    return (v if isinstance(v, Column) else F.lit(str(v))).cast(DEC)


def _s(c: Column) -> Column:
    return c.cast(T.StringType())


def card_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if "card" in c.lower() and "number" in c.lower()]


def _as_number(c: Column) -> Column:
    return c.try_cast(T.DecimalType(38, 6))


def _as_time(c: Column) -> Column:
    return c.cast(T.StringType()).try_cast(T.TimestampNTZType())


def run_checks(df: DataFrame, as_of: dt.datetime, check_ids: list[int] | None = None) -> DataFrame:
    cols = {c.lower(): c for c in df.columns}
    col = lambda name: F.col(f"`{cols[name]}`")
    chosen = [c for c in CHECKS if check_ids is None or c.check_id in check_ids]
    n = F.count(F.lit(1))
    aggs: dict[str, Column] = {"n": n}
    for c in chosen:
        k = f"c{c.check_id}"
        if c.column is not None and c.column not in cols:
            continue
        if c.kind == "not_null":
            aggs[k] = F.count(F.when(col(c.column).isNull(), 1))
        elif c.kind == "unique":
            aggs[k] = F.count_distinct(col(c.column))
        elif c.kind == "range":
            v = _as_number(col(c.column))
            aggs[k] = F.count(F.when((v < F.lit(C.DQ_AMOUNT_MIN)) | (v > F.lit(C.DQ_AMOUNT_MAX)), 1))
        elif c.kind == "amount_max":
            aggs[k] = F.count(F.when(_as_number(col(c.column)) > F.lit(C.DQ_AMOUNT_MAX), 1))
        elif c.kind == "in_set":
            v = col(c.column)
            aggs[k] = F.count(F.when(v.isNotNull() & ~in_set_ci(v, VALID_SETS[c.column]), 1))
            aggs[k + "_n"] = F.count(v)
        elif c.kind == "future":
            aggs[k] = F.count(F.when(_as_time(col(c.column)) > ts_lit(as_of), 1))
        elif c.kind == "dup_rows":
            whole = [F.col(f"`{x}`") for x in df.columns]
            # 128 bits of a row in place of the row
            aggs[k] = F.count_distinct(F.xxhash64(*whole), F.xxhash64(F.lit(1), *whole, *[x.isNull() for x in whole]))
        elif c.kind == "freshness":
            aggs[k] = F.max(_as_time(col(c.column)))
        elif c.kind == "card_masked":
            for i, cc in enumerate(card_columns(df.columns)):
                card = F.col(f"`{cc}`")
                open_ = unmasked_card(card) | F.coalesce(card.cast(T.StringType()).startswith(C.UNMASKED_MARK), F.lit(False))
                aggs[f"{k}_{i}"] = F.count(F.when(open_, 1))
    # distinct counts apart, each over its own narrow column: two of them in one aggregate
    # would triple the rows before the shuffle
    distinct = {k for k, kind in ((f"c{c.check_id}", c.kind) for c in chosen) if kind in ("unique", "dup_rows") and k in aggs}
    a = df.agg(*[v.alias(k) for k, v in aggs.items() if k not in distinct])
    for k in sorted(distinct):
        a = a.unionByName(df.agg(aggs[k].alias(k)), allowMissingColumns=True)
    a = a.agg(*[F.max(k).alias(k) for k in aggs])
    N = F.col("n")
    denom = F.greatest(N, F.lit(1))
    rows: list[Column] = []

    def add(c: Check, success: Column, details: Column, value: Column, threshold: str):
        rows.append(F.struct(F.lit(c.check_id).alias("check_id"), F.lit(c.name).alias("check_name"),
                             F.lit(c.check_type).alias("check_type"), success.alias("success"),
                             details.alias("details"), _d(value).alias("metric_value"),
                             _d(threshold).alias("threshold")))

    for c in chosen:
        k = f"c{c.check_id}"
        if c.column is not None and c.column not in cols:
            add(c, F.lit(False), F.lit(f"Column '{c.column}' missing"), F.lit(0), MISSING_THRESHOLD[c.kind])
            continue
        if c.kind == "not_null":
            nulls = F.col(k)
            add(c, nulls * 1000 <= N, F.concat(F.lit("Null rows: "), _s(nulls), F.lit(" of "), _s(N)),
                F.lit(1) - rate(nulls, N), c.threshold)
        elif c.kind == "unique":
            dups = N - F.col(k)
            add(c, dups == 0, F.concat(_s(dups), F.lit(" duplicates")), F.lit(1) - rate(dups, denom), c.threshold)
        elif c.kind in ("range", "amount_max"):
            bad = F.col(k)
            r = F.lit(1) - rate(bad, denom)
            word = " out of range" if c.kind == "range" else " exceed max"
            add(c, r >= F.lit(c.threshold).cast(DEC), F.concat(_s(bad), F.lit(word)), r, c.threshold)
        elif c.kind == "in_set":
            bad = F.col(k)
            r = F.lit(1) - rate(bad, F.greatest(F.col(k + "_n"), F.lit(1)))
            add(c, r >= F.lit(c.threshold).cast(DEC), F.concat(_s(bad), F.lit(" invalid values")), r, c.threshold)
        elif c.kind == "future":
            fut = F.col(k)
            add(c, fut == 0, F.concat(_s(fut), F.lit(" future timestamps")),
                F.when(fut == 0, 1).otherwise(0), c.threshold)
        elif c.kind == "dup_rows":
            dups = N - F.col(k)
            add(c, dups == 0, F.concat(_s(dups), F.lit(" duplicate rows")), F.lit(1) - rate(dups, denom), c.threshold)
        elif c.kind == "schema":
            req = C.DQ_REQUIRED_COLUMNS
            missing = sorted(set(req) - set(cols))
            present = len(set(req) & set(cols))
            value = 1 if not missing else present / len(req)
            add(c, F.lit(not missing), F.lit("All columns present" if not missing else f"Missing: {missing}"),
                F.lit(f"{value:.6f}"), c.threshold)
        elif c.kind == "volume":
            add(c, N >= C.DQ_MIN_ROWS, F.concat(F.lit("Rows: "), _s(N), F.lit(f" (min: {C.DQ_MIN_ROWS})")),
                N, c.threshold)
        elif c.kind == "freshness":
            mx = F.col(k)
            age_s = F.unix_micros(ts_lit(as_of).cast(T.TimestampType())) - F.unix_micros(mx.cast(T.TimestampType()))
            ok = age_s <= F.lit(C.DQ_FRESHNESS_HOURS * 3600 * 1_000_000)
            rows.append(F.when(mx.isNull(), F.struct(
                F.lit(c.check_id).alias("check_id"), F.lit(c.name).alias("check_name"),
                F.lit(c.check_type).alias("check_type"), F.lit(False).alias("success"),
                F.lit("No valid timestamps").alias("details"), _d(0).alias("metric_value"),
                _d(c.threshold).alias("threshold"))).otherwise(F.struct(
                F.lit(c.check_id).alias("check_id"), F.lit(c.name).alias("check_name"),
                F.lit(c.check_type).alias("check_type"), ok.alias("success"),
                F.concat(F.lit("Age: "), _s(F.floor(age_s / 60_000_000)), F.lit(" min")).alias("details"),
                _d(F.when(ok, 1).otherwise(0)).alias("metric_value"), _d(c.threshold).alias("threshold"))))
        elif c.kind == "card_masked":
            ccols = card_columns(df.columns)
            if not ccols:
                add(c, F.lit(True), F.lit("No card column - N/A"), F.lit(1), c.threshold)
            for i, cc in enumerate(ccols):
                um = F.col(f"{k}_{i}")
                add(c, um == 0, F.concat(_s(um), F.lit(f" unmasked in '{cc}'")), F.when(um == 0, 1).otherwise(0),
                    c.threshold)
    out = a.where(N > 0).select(F.inline(F.array(*rows)))
    return out.select(*RESULT_COLUMNS)


def check_summary(results: DataFrame) -> DataFrame:
    """Passed, failed, the failed names (sorted) and the overall verdict."""
    a = results.agg(F.count(F.when(F.col("success"), 1)).alias("passed"),
                    F.count(F.when(~F.col("success"), 1)).alias("failed"),
                    F.array_sort(F.collect_list(F.when(~F.col("success"), F.col("check_name")))).alias("failed_checks"))
    status = (F.when(F.col("passed") + F.col("failed") == 0, "SKIPPED")
              .when(F.col("failed") == 0, "PASSED").otherwise("WARNING"))
    return a.withColumn("status", status)


def quality_score(results: DataFrame) -> DataFrame:
    """passed / (passed + failed) x 100 with the dashboard colour bands 90 / 99."""
    s = check_summary(results)
    score = (F.col("passed") * 100.0 / F.nullif(F.col("passed") + F.col("failed"), F.lit(0))).cast(T.DecimalType(9, 4))
    lo, hi = C.QUALITY_SCORE_BANDS
    return s.select("passed", "failed", score.alias("quality_score"),
                    F.when(score >= hi, "green").when(score >= lo, "yellow").when(score.isNotNull(), "red").alias("band"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Whole rows that occur more than once, with their count of extra copies
    (first copy kept). One grouped aggregate over all columns."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies"))
            .where(F.col("_copies") > 1).withColumn("duplicate_copies", F.col("_copies") - 1).drop("_copies"))
