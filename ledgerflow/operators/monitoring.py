"""Monitoring rows: data-quality metrics and pipeline service-level metrics.

Every family is computed as one aggregate over the scanned rows and turned into tall
metric rows with ``stack``; a UNION ALL of per-metric aggregates would scan the fact
once per metric. Thresholds and window are parameters; ``as_of`` replaces the wall
clock so results repeat.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow import constants as C
from ledgerflow.functions.columns import minutes_between, rate, seconds_between, ts_lit

DEC = T.DecimalType(18, 6)
QUALITY_METRICS = ["row_count", "null_rate_amount", "duplicate_rate", "data_freshness_minutes", "avg_amount_usd"]
METRIC_COLUMNS = ["metric_timestamp", "table_name", "metric_name", "metric_value", "threshold", "status", "details",
                  "batch_id"]
SLA_COLUMNS = ["metric_timestamp", "dag_id", "execution_date", "metric_name", "metric_value", "unit", "status",
               "details"]


def _s(c: Column) -> Column:
    return c.cast(T.StringType())


def _dec(c) -> Column:
    return (c if isinstance(c, Column) else F.lit(c)).cast(DEC)


def _window_minutes(lookback: dt.timedelta) -> int:
    return int(lookback.total_seconds() // 60)


def _in_window(col: str, as_of: dt.datetime, lookback: dt.timedelta) -> Column:
    return (F.col(col) >= ts_lit(as_of - lookback)) & (F.col(col) <= ts_lit(as_of))


# --- data-quality metrics -----------------------------------------------------------------------

def _quality_parts(fact: DataFrame, as_of: dt.datetime, lookback: dt.timedelta, names: set[str]) -> DataFrame:
    """One row of aggregates: windowed ones from a pushed-down window scan, freshness
    (defined over all rows) from a one-column scan; merged without a join."""
    win = fact.where(_in_window("processed_at", as_of, lookback))
    aggs = [F.count(F.lit(1)).alias("n"), F.max("_batch_id").alias("batch_id")]
    if "null_rate_amount" in names:
        aggs.append(F.count(F.when(F.col("amount").isNull(), 1)).alias("null_amounts"))
    if "duplicate_rate" in names:
        aggs.append(F.count_distinct("transaction_id").alias("distinct_ids"))
    if "avg_amount_usd" in names:
        aggs += [F.avg("amount_usd").alias("avg_usd"), F.min("amount_usd").alias("min_usd"),
                 F.max("amount_usd").alias("max_usd")]
    parts = win.agg(*aggs)
    if "data_freshness_minutes" in names:
        fresh = fact.agg(F.max("transaction_timestamp").alias("max_ts"), F.max("_batch_id").alias("all_batch_id"))
        parts = (parts.unionByName(fresh, allowMissingColumns=True)
                 .agg(*[F.max(c).alias(c) for c in parts.columns + fresh.columns]))
    return parts


def quality_metrics(fact: DataFrame, as_of: dt.datetime, lookback: dt.timedelta = dt.timedelta(minutes=30),
                    table_name: str = "fct_transactions", metrics: list[str] | None = None) -> DataFrame:
    """Rows of the data_quality_metrics table: row_count, null_rate_amount,
    duplicate_rate, data_freshness_minutes, avg_amount_usd (or the chosen subset)."""
    names = [m for m in QUALITY_METRICS if metrics is None or m in metrics]
    return quality_rows(_quality_parts(fact, as_of, lookback, set(names)), ts_lit(as_of), lookback, table_name, names)


def quality_rows(a: DataFrame, as_of: Column, lookback: dt.timedelta, table_name: str,
                 names: list[str] | None = None) -> DataFrame:
    """Metric rows from windows' aggregates, one row of ``a`` for each window that ends at ``as_of``."""
    names = QUALITY_METRICS if names is None else names
    mins = _window_minutes(lookback)
    n = F.col("n")
    rows = {}
    rows["row_count"] = (
        _dec(n), _dec(C.METRIC_MIN_ROWS),
        F.when(n >= C.METRIC_MIN_ROWS, "PASS").otherwise("WARNING"),
        F.concat(F.lit(f"Total rows in last {mins} min: "), _s(n)), F.col("batch_id"))
    if "null_rate_amount" in names:
        r = rate(F.col("null_amounts"), n)
        rows["null_rate_amount"] = (
            r, _dec(C.METRIC_MAX_NULL_RATE),
            F.when(r <= F.lit(C.METRIC_MAX_NULL_RATE), "PASS").otherwise("FAIL"),
            F.concat(F.lit("Null amounts: "), _s(F.col("null_amounts"))), F.col("batch_id"))
    if "duplicate_rate" in names:
        dups = n - F.col("distinct_ids")
        rows["duplicate_rate"] = (
            rate(dups, n), _dec(0),
            F.when(n == F.col("distinct_ids"), "PASS").otherwise("FAIL"),
            F.concat(F.lit("Duplicates: "), _s(dups)), F.col("batch_id"))
    if "data_freshness_minutes" in names:
        age = minutes_between(F.col("max_ts"), as_of)
        rows["data_freshness_minutes"] = (
            _dec(age), _dec(C.METRIC_FRESHNESS_MINUTES),
            F.when(age <= C.METRIC_FRESHNESS_MINUTES, "PASS").otherwise("WARNING"),
            F.concat(F.lit("Last transaction: "), F.coalesce(_s(F.col("max_ts")), F.lit(""))),
            F.col("all_batch_id"))
    if "avg_amount_usd" in names:
        avg2 = F.col("avg_usd").cast(T.DecimalType(18, 2))
        rows["avg_amount_usd"] = (
            _dec(avg2), F.lit(None).cast(DEC), F.lit("INFO"),
            F.concat(F.lit("Avg: $"), F.coalesce(_s(avg2), F.lit("")), F.lit(" | Min: $"),
                     F.coalesce(_s(F.col("min_usd")), F.lit("")), F.lit(" | Max: $"),
                     F.coalesce(_s(F.col("max_usd")), F.lit(""))),
            F.col("batch_id"))
    structs = [F.struct(F.lit(m).alias("metric_name"), v.alias("metric_value"), t.alias("threshold"),
                        _s(st).alias("status"), det.alias("details"), b.alias("batch_id"))
               for m, (v, t, st, det, b) in rows.items() if m in names]
    out = a.select(as_of.alias("metric_timestamp"), F.inline(F.array(*structs)))
    return out.select("metric_timestamp", F.lit(table_name).alias("table_name"), "metric_name",
                      "metric_value", "threshold", "status", "details", "batch_id")


def daily_quality_metrics(fact: DataFrame, table_name: str = "fct_transactions") -> DataFrame:
    """Row count, null rate and duplicate rate per processing day (one grouped
    aggregate), the history the "latest failures" report ranks."""
    day = F.to_date("processed_at")
    g = fact.groupBy(day.alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("amount").isNull(), 1)).alias("nulls"),
        F.count_distinct("transaction_id").alias("ids"), F.max("_batch_id").alias("batch_id"))
    n = F.col("n")
    nr = rate(F.col("nulls"), n)
    structs = [
        F.struct(F.lit("row_count").alias("metric_name"), _dec(n).alias("metric_value"),
                 F.when(n >= C.METRIC_MIN_ROWS, "PASS").otherwise("WARNING").alias("status")),
        F.struct(F.lit("null_rate_amount").alias("metric_name"), nr.alias("metric_value"),
                 F.when(nr <= F.lit(C.METRIC_MAX_NULL_RATE), "PASS").otherwise("FAIL").alias("status")),
        F.struct(F.lit("duplicate_rate").alias("metric_name"), rate(n - F.col("ids"), n).alias("metric_value"),
                 F.when(n == F.col("ids"), "PASS").otherwise("FAIL").alias("status")),
    ]
    return g.select(F.col("day").cast(T.TimestampNTZType()).alias("metric_timestamp"),
                    F.lit(table_name).alias("table_name"), "batch_id", F.inline(F.array(*structs)))


def top_failed_metrics(metrics: DataFrame, n: int = 20) -> DataFrame:
    """Latest ``n`` failed or warning metrics, newest first (total order for ties).
    Plans as TakeOrderedAndProject: each task keeps its own top n."""
    return (metrics.where(F.col("status").isin("FAIL", "WARNING"))
            .orderBy(F.col("metric_timestamp").desc(), F.col("metric_name"), F.col("table_name"))
            .limit(n))


# --- service-level metrics ------------------------------------------------------------------------

def _sla_rows(agg: DataFrame, rows: list[tuple], as_of: Column) -> DataFrame:
    structs = [F.struct(F.lit(name).alias("metric_name"), v.alias("metric_value"), F.lit(unit).alias("unit"),
                        st.alias("status"), det.alias("details")) for name, v, unit, st, det in rows]
    return agg.select(as_of.alias("metric_timestamp"), F.inline(F.array(*structs))).select(
        "metric_timestamp", F.lit(C.PIPELINE_NAME).alias("dag_id"),
        F.col("metric_timestamp").alias("execution_date"), "metric_name", "metric_value", "unit", "status", "details")


def sla_window_aggregates(fact: DataFrame, as_of: dt.datetime, lookback: dt.timedelta) -> DataFrame:
    """One pass over the window: count, first/last processing time, latency average
    and P95, dimension coverage. P95 is exact: the aggregate keeps a count per latency in
    whole seconds, merged map-side, so its size follows the spread of latencies, not the rows."""
    win = fact.where(_in_window("processed_at", as_of, lookback))
    lat = seconds_between(F.col("transaction_timestamp"), F.col("processed_at"))
    known = (F.col("customer_key") != C.UNKNOWN_KEY) & (F.col("merchant_key") != C.UNKNOWN_KEY)
    return win.withColumn("_latency", lat).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("processed_at").alias("first_processed"), F.max("processed_at").alias("last_processed"),
        F.avg(lat).alias("avg_latency"),
        F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY _latency)").cast(T.LongType()).alias("p95_latency"),
        F.count(F.when(known, 1)).alias("covered"),
        F.count(F.when(~known, 1)).alias("orphans"),
    )


def sla_metrics(fact: DataFrame, as_of: dt.datetime, lookback: dt.timedelta = dt.timedelta(minutes=30),
                metrics: list[str] | None = None) -> DataFrame:
    """Rows of pipeline_sla_metrics: throughput, end-to-end latency (with P95 in the
    details) and dimension coverage over the window."""
    return sla_rows(sla_window_aggregates(fact, as_of, lookback), ts_lit(as_of), lookback, metrics)


def sla_rows(a: DataFrame, as_of: Column, lookback: dt.timedelta, metrics: list[str] | None = None) -> DataFrame:
    """Service-level rows from windows' aggregates, one row of ``a`` for each window that ends at ``as_of``."""
    n = F.col("n")
    mins = F.greatest(minutes_between(F.col("first_processed"), F.col("last_processed")), F.lit(1))
    thr = rate(n, mins)
    avg0 = F.round(F.col("avg_latency"), 0).cast(T.DecimalType(38, 0))
    avg1 = F.round(F.col("avg_latency"), 1).cast(T.DecimalType(18, 1))
    cov = rate(F.col("covered"), n, 12)
    mins_w = _window_minutes(lookback)
    rows = [
        ("throughput_records_per_minute", thr, "records/min",
         F.when(thr >= C.SLA_MIN_THROUGHPUT, "HEALTHY").otherwise("DEGRADED"),
         F.concat(F.lit("Processed "), _s(n), F.lit(f" records in last {mins_w} min"))),
        ("e2e_latency_seconds", _dec(avg0), "seconds",
         F.when(F.col("avg_latency") <= C.SLA_MAX_LATENCY_SECONDS, "WITHIN_SLA").otherwise("SLA_BREACH"),
         F.concat(F.lit("Avg latency: "), F.coalesce(_s(avg1), F.lit("")), F.lit("s | P95: "),
                  F.coalesce(_s(F.col("p95_latency")), F.lit("")), F.lit("s"))),
        ("dimension_coverage_pct", _dec(cov * 100), "percent",
         F.when(cov >= F.lit(C.SLA_MIN_COVERAGE), "PASS").otherwise("WARNING"),
         F.concat(F.lit("Orphan records: "), _s(F.col("orphans")))),
    ]
    if metrics is not None:
        rows = [r for r in rows if r[0] in metrics]
    return _sla_rows(a, rows, as_of)


def latency_p95(fact: DataFrame, as_of: dt.datetime, lookback: dt.timedelta) -> DataFrame:
    a = sla_window_aggregates(fact, as_of, lookback)
    return a.select(F.lit("e2e_latency_p95_seconds").alias("metric_name"),
                    _dec(F.col("p95_latency")).alias("metric_value"), F.col("n").alias("sample_size"))


def daily_volume(fact: DataFrame, day: dt.date, as_of: dt.datetime) -> DataFrame:
    """Transactions on one calendar day. The day test is a timestamp range, so it
    pushes into the Parquet scan."""
    lo = dt.datetime.combine(day, dt.time())
    d = fact.where((F.col("transaction_timestamp") >= ts_lit(lo))
                   & (F.col("transaction_timestamp") < ts_lit(lo + dt.timedelta(days=1))))
    a = d.agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    return _sla_rows(a, [("daily_volume", _dec(n), "records",
                          F.when(n >= C.SLA_DAILY_TARGET, "ON_TRACK").otherwise("BELOW_TARGET"),
                          F.concat(F.lit("Today: "), _s(n), F.lit(" records (target: 500K/day)")))], ts_lit(as_of))


def latency_bands(sla: DataFrame) -> DataFrame:
    """Dashboard colour band of the latency metrics: green, yellow from 90 s, red from 120 s."""
    v = F.col("metric_value")
    return (sla.where(F.col("metric_name").startswith("e2e_latency"))
            .select("metric_name", "metric_value",
                    F.when(v >= C.SLA_MAX_LATENCY_SECONDS, "red").when(v >= C.SLA_LATENCY_YELLOW_SECONDS, "yellow")
                    .when(v.isNotNull(), "green").alias("band")))


# --- volumes over time ----------------------------------------------------------------------------

def volume_over_time(raw: DataFrame, staged: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows per layer and day: ingested (load time), staged (staging time), loaded
    (processing time). Three grouped aggregates with partial aggregation."""
    def per_day(df, col, layer):
        return (df.groupBy(F.to_date(col).alias("day")).agg(F.count(F.lit(1)).alias("records"))
                .select(F.lit(layer).alias("layer"), "day", "records"))
    return (per_day(raw, "_loaded_at", "ingested").unionByName(per_day(staged, "_staged_at", "staged"))
            .unionByName(per_day(fact, "processed_at", "loaded")))


def volume_variance(fact: DataFrame, days_back: int = 7, tolerance: float = 0.2) -> DataFrame:
    """Daily volume against the average of the previous ``days_back`` days that had data.

    The daily counts come from one grouped aggregate; the window then runs over one
    row per day (bounded by the calendar), not over transactions.
    """
    daily = fact.groupBy(F.to_date("processed_at").alias("day")).agg(F.count(F.lit(1)).alias("records"))
    w = Window.orderBy("day").rowsBetween(-days_back, -1)
    prev = F.avg("records").over(w)
    out = daily.select("day", "records", prev.cast(T.DecimalType(18, 6)).alias("expected"))
    var = ((F.col("records") - F.col("expected")) / F.col("expected")).cast(T.DecimalType(18, 6))
    return out.select("day", "records", "expected", var.alias("variance"),
                      F.when(F.col("expected").isNull(), "NO_HISTORY")
                      .when(F.abs(var) <= F.lit(tolerance), "PASS").otherwise("WARNING").alias("status"))


def reconcile_counts(staged: DataFrame, fact: DataFrame) -> DataFrame:
    s = staged.agg(F.count(F.lit(1)).alias("staged_rows"))
    f = fact.agg(F.count(F.lit(1)).alias("fact_rows"))
    both = s.unionByName(f, allowMissingColumns=True).agg(F.max("staged_rows").alias("staged_rows"),
                                                         F.max("fact_rows").alias("fact_rows"))
    return both.select("staged_rows", "fact_rows", (F.col("staged_rows") - F.col("fact_rows")).alias("difference"),
                       F.when(F.col("staged_rows") == F.col("fact_rows"), "MATCH").otherwise("MISMATCH").alias("status"))
