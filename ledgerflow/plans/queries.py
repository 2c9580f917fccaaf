"""The registry of named queries: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame; computed columns carry
the same names as the SQL oracle's.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.slices import in_slices
from ledgerflow.operators import facts as FA
from ledgerflow.operators import merchant as M
from ledgerflow.operators import scd2 as S
from ledgerflow.operators import staging as ST
from ledgerflow.plans.layers import Layers
from ledgerflow.session import store
from ledgerflow.sources import adapters as A

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# folder name of the stored pipeline layers (None: the application's own; the bench sets a
# fresh one so it builds and times every layer)
RUN_ID: str | None = None


def P(spark, sf_dir) -> Layers:
    return Layers(spark, sf_dir, run_id=RUN_ID)


# --- flagship ----------------------------------------------------------------------------
@query("star_rollup")
def q_star_rollup(spark, sf_dir):
    p = P(spark, sf_dir)
    return FA.star_rollup(p.fact(), p.dim_customer(), p.dim_merchant())


# --- staging -------------------------------------------------------------------------------
@query("stage_clean")
def q_stage_clean(spark, sf_dir):
    return P(spark, sf_dir).build_clean()


@query("dedup_latest")
def q_dedup_latest(spark, sf_dir):
    """Latest row per trimmed id over the whole raw feed (ids with several loads)."""
    raw = P(spark, sf_dir).raw().where(F.col("transaction_id").isNotNull())
    latest = ST.latest_per_key(raw.withColumn("transaction_id", F.trim("transaction_id")), "transaction_id",
                               [F.col("_loaded_at").desc(), F.col("_source_file").desc(), F.col("amount").desc_nulls_last()])
    return latest.select("transaction_id", "_loaded_at", F.col("amount").alias("amount_text"))


# --- dimensions and facts ---------------------------------------------------------------------
@query("dim_customer_load")
def q_dim_customer_load(spark, sf_dir):
    return P(spark, sf_dir).build_dim_customer()


@query("scd2_changes")
def q_scd2_changes(spark, sf_dir):
    p = P(spark, sf_dir)
    ch = S.classify_changes(p.customer_history_1(), A.raw_customer_snapshot(spark, sf_dir, 2))
    return ch.select("customer_id", "new_hash", "existing_hash", "change_type")


@query("scd2_expire")
def q_scd2_expire(spark, sf_dir):
    return P(spark, sf_dir).build_customer_history()


@query("fact_load")
def q_fact_load(spark, sf_dir):
    return P(spark, sf_dir).build_fact()


@query("merchant_stats")
def q_merchant_stats(spark, sf_dir):
    return M.merchant_batch_stats(P(spark, sf_dir).staged())


# --- monitoring ------------------------------------------------------------------------------
from ledgerflow.operators import monitoring as MO  # noqa: E402
from ledgerflow.plans.layers import METRIC_WINDOW  # noqa: E402

LAST_DAY = A.TXN_AS_OF.date() - datetime.timedelta(days=1)


@query("raw_profile")
def q_raw_profile(spark, sf_dir):
    """Profile of the recent raw batch (count, distinct ids, time range, null ids and
    amounts); an empty batch is reported as EMPTY instead of failing later."""
    raw = ST.recent(P(spark, sf_dir).raw(), "_loaded_at", A.TXN_AS_OF, METRIC_WINDOW)
    a = raw.agg(F.count(F.lit(1)).alias("record_count"), F.count_distinct("transaction_id").alias("unique_txns"),
                F.min("transaction_timestamp").alias("min_ts"), F.max("transaction_timestamp").alias("max_ts"),
                F.count(F.when(F.col("transaction_id").isNull(), 1)).alias("null_ids"),
                F.count(F.when(F.col("amount").isNull(), 1)).alias("null_amounts"))
    return a.withColumn("status", F.when(F.col("record_count") == 0, "EMPTY").otherwise("OK"))


def _qm(metric):
    def run(spark, sf_dir):
        return MO.quality_metrics(P(spark, sf_dir).fact(), A.TXN_AS_OF, METRIC_WINDOW, metrics=[metric])
    return run


for _k, _m in [("metric_row_count", "row_count"), ("metric_null_rate", "null_rate_amount"),
               ("metric_duplicate_rate", "duplicate_rate"), ("metric_freshness", "data_freshness_minutes"),
               ("metric_avg_amount", "avg_amount_usd")]:
    QUERIES[_k] = _qm(_m)


@query("quality_metrics")
def q_quality_metrics(spark, sf_dir):
    return MO.quality_metrics(P(spark, sf_dir).fact(), A.TXN_AS_OF, METRIC_WINDOW)


def _sla(metric):
    def run(spark, sf_dir):
        return MO.sla_metrics(P(spark, sf_dir).fact(), A.TXN_AS_OF, METRIC_WINDOW, metrics=[metric])
    return run


for _k, _m in [("sla_throughput", "throughput_records_per_minute"), ("sla_latency", "e2e_latency_seconds"),
               ("dimension_coverage", "dimension_coverage_pct")]:
    QUERIES[_k] = _sla(_m)


@query("sla_latency_p95")
def q_sla_latency_p95(spark, sf_dir):
    return MO.latency_p95(P(spark, sf_dir).fact(), A.TXN_AS_OF, METRIC_WINDOW)


@query("sla_bands")
def q_sla_bands(spark, sf_dir):
    fact = P(spark, sf_dir).fact()
    lat = MO.sla_metrics(fact, A.TXN_AS_OF, METRIC_WINDOW, metrics=["e2e_latency_seconds"])
    p95 = MO.latency_p95(fact, A.TXN_AS_OF, METRIC_WINDOW).drop("sample_size")
    return MO.latency_bands(lat.select("metric_name", "metric_value").unionByName(p95))


@query("daily_volume")
def q_daily_volume(spark, sf_dir):
    """Volume of the last full day before as_of."""
    return MO.daily_volume(P(spark, sf_dir).fact(), LAST_DAY, A.TXN_AS_OF)


@query("top_failed_metrics")
def q_top_failed_metrics(spark, sf_dir):
    return MO.top_failed_metrics(MO.daily_quality_metrics(P(spark, sf_dir).fact()), 20)


@query("reconcile_counts")
def q_reconcile_counts(spark, sf_dir):
    p = P(spark, sf_dir)
    return MO.reconcile_counts(p.staged(), p.fact())


@query("volume_over_time")
def q_volume_over_time(spark, sf_dir):
    p = P(spark, sf_dir)
    return MO.volume_over_time(p.raw(), p.staged(), p.fact())


@query("volume_variance")
def q_volume_variance(spark, sf_dir):
    return MO.volume_variance(P(spark, sf_dir).fact())


# --- data-quality checks --------------------------------------------------------------------
from ledgerflow.operators import quality as Q  # noqa: E402


def check_frame(spark, sf_dir):
    """The cleaned batch with its raw card number: what the checks see before staging."""
    return P(spark, sf_dir).clean()


DQ_GROUPS = {
    "dq_all": None,
    "dq_completeness": [1, 8, 9],
    "dq_uniqueness": [2, 10],
    "dq_accuracy": [3, 4],
    "dq_referential": [5, 6, 14],
    "dq_timeliness": [7, 13],
    "dq_security": [15],
}


def _dq(ids):
    def run(spark, sf_dir):
        return Q.run_checks(check_frame(spark, sf_dir), A.TXN_AS_OF, ids)
    return run


for _k, _ids in DQ_GROUPS.items():
    QUERIES[_k] = _dq(_ids)


@query("dq_duplicate_rows")
def q_dq_duplicate_rows(spark, sf_dir):
    """Whole raw rows that occur more than once (two loads of the feed, so that there are some)."""
    raw = P(spark, sf_dir).raw().select(*L.RAW_TXN_FIELDS)
    again = raw.where(F.substring(F.md5("transaction_id"), 1, 1) == "0")
    return Q.duplicate_rows(raw.unionByName(again)).withColumn("card_number", F.right("card_number", F.lit(4)))


@query("dq_missing_columns")
def q_dq_missing_columns(spark, sf_dir):
    return Q.run_checks(check_frame(spark, sf_dir).select("transaction_id", "amount"), A.TXN_AS_OF)


@query("dq_summary")
def q_dq_summary(spark, sf_dir):
    return Q.check_summary(Q.run_checks(check_frame(spark, sf_dir), A.TXN_AS_OF))


@query("quality_score")
def q_quality_score(spark, sf_dir):
    return Q.quality_score(Q.run_checks(check_frame(spark, sf_dir), A.TXN_AS_OF))


# --- sources and sinks -----------------------------------------------------------------------
import datetime as _dt  # noqa: E402
import os  # noqa: E402

from ledgerflow.functions.columns import date_key as _date_key  # noqa: E402
from ledgerflow.functions.columns import rate_table, usd_amount_by_table  # noqa: E402
from ledgerflow.session import scratch_path  # noqa: E402
from ledgerflow.sources import landing as L  # noqa: E402


def _fresh_dir(spark, name):
    import uuid
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@query("null_markers")
def q_null_markers(spark, sf_dir):
    """Raw rows written to landing CSV with nulls as the text NULL, bulk-loaded back:
    the markers must come back as nulls and every value unchanged."""
    path = _fresh_dir(spark, "landing-csv")
    L.write_landing_csv(P(spark, sf_dir).raw(), path, null_token="NULL")
    good, _ = L.split_corrupt(L.read_landing_csv(spark, path, A.TXN_AS_OF))
    return good.select(*L.RAW_TXN_FIELDS)


@query("ingest_csv")
def q_ingest_csv(spark, sf_dir):
    """Landing CSV load with audit columns and the corrupt-row split (rows + rejects)."""
    path = _fresh_dir(spark, "landing-csv")
    L.write_landing_csv(P(spark, sf_dir).raw(), path)
    good, bad = L.split_corrupt(L.read_landing_csv(spark, path, A.TXN_AS_OF))
    # names of written part files are random: left out
    return good.withColumn("_rejected", F.lit(False)).unionByName(
        bad.drop(L.CORRUPT).withColumn("_rejected", F.lit(True))).drop("_source_file")


@query("ingest_json")
def q_ingest_json(spark, sf_dir):
    path = _fresh_dir(spark, "landing-json")
    L.write_landing_json_array(P(spark, sf_dir).raw(), path)
    return L.read_landing_json(spark, path, A.TXN_AS_OF).drop("_source_file")


@query("staging_rejects")
def q_staging_rejects(spark, sf_dir):
    """Rows that staging refuses, with the reason, as the job writes them."""
    p = P(spark, sf_dir)
    return p.staging_rejects().select("transaction_id", "customer_id", "amount", "_loaded_at", "_reject_reason", "_rejected_at")


@query("landing_rejects")
def q_landing_rejects(spark, sf_dir):
    """Landing lines that do not fit the schema: one row in sixteen, picked by its id, lands
    with a field too many and must come back as a reject."""
    path = _fresh_dir(spark, "landing-rejects")
    raw = P(spark, sf_dir).raw().select(*L.RAW_TXN_FIELDS)
    odd = F.substring(F.md5("transaction_id"), 1, 1) == "0"
    L.write_named_csv(raw.where(F.coalesce(~odd, F.lit(True))), path)
    L.write_named_csv(raw.where(odd).withColumn("surplus", F.lit("x")), path, "more_transactions_")
    _, bad = L.split_corrupt(L.read_landing_csv(spark, path, A.TXN_AS_OF))
    return L.masked_rejects(bad).select("transaction_id", "customer_id", "amount")


@query("recent_window")
def q_recent_window(spark, sf_dir):
    raw = ST.recent(P(spark, sf_dir).raw(), "_loaded_at", A.TXN_AS_OF, METRIC_WINDOW)
    return raw.select("transaction_id", "_loaded_at", "amount")


@query("raw_retention")
def q_raw_retention(spark, sf_dir):
    """The raw table stored by load day, 90-day retention applied at as_of by dropping
    old day partitions, then rows kept per load day."""
    from ledgerflow.sources import sinks as SK
    path = _fresh_dir(spark, "raw-by-day")
    SK.write_by_day(P(spark, sf_dir).raw(), path, "_loaded_at")
    cutoff = A.TXN_AS_OF - _dt.timedelta(days=90)
    SK.drop_partitions_before(spark, path, cutoff.date())
    kept = SK.retain(spark.read.parquet(path), "_loaded_at", A.TXN_AS_OF, 90)
    return kept.groupBy(F.col("load_date")).agg(F.count(F.lit(1)).alias("records"))


@query("merchant_enrich")
def q_merchant_enrich(spark, sf_dir):
    d = P(spark, sf_dir).build_dim_merchant().where(F.col("merchant_key") != -1)
    return d.select("merchant_id", "merchant_category", "category_group", "merchant_country", "merchant_region",
                    "is_online")


@query("fx_convert")
def q_fx_convert(spark, sf_dir):
    """USD totals per currency through the broadcast rate table."""
    conv = usd_amount_by_table(P(spark, sf_dir).staged(), rate_table(spark))
    return conv.groupBy("currency").agg(F.count(F.lit(1)).alias("txn_count"),
                                        F.sum("amount").cast("decimal(38,2)").alias("amount"),
                                        F.sum("amount_usd").cast("decimal(38,2)").alias("amount_usd"))


@query("date_key")
def q_date_key(spark, sf_dir):
    s = P(spark, sf_dir).staged()
    return s.select("transaction_id", "transaction_timestamp",
                    _date_key(F.col("transaction_timestamp")).alias("transaction_date_key"))


@query("scalar_functions")
def q_scalar_functions(spark, sf_dir):
    """One column per scalar family the pipeline uses, over the staged rows."""
    s = P(spark, sf_dir).staged()
    return s.select(
        "transaction_id",
        F.concat_ws("|", F.coalesce("merchant_category", F.lit("")), F.upper("merchant_city")).alias("text_concat"),
        F.md5(F.concat_ws("|", "customer_id", "merchant_id")).alias("hash_md5"),
        F.regexp_replace(F.concat(F.lit("4111-1111 "), F.col("card_last_four")), "[- ]", "").alias("digits"),
        F.nullif(F.col("status"), F.lit("approved")).alias("status_nullif"),
        F.greatest(F.col("amount"), F.lit(100).cast("decimal(18,2)")).alias("amount_floor100"),
        F.round(F.col("amount") / 3, 2).cast("decimal(18,2)").alias("amount_third"),
        F.date_format("transaction_timestamp", "yyyyMMdd").alias("day_text"),
        F.datediff(F.lit(A.TXN_AS_OF.date()), F.to_date("transaction_timestamp")).alias("age_days"),
        F.to_date("transaction_timestamp").alias("txn_date"),
        F.lower(F.concat(F.lit(" X"), F.col("currency"))).alias("lower_text"),
        F.right(F.col("auth_code"), F.lit(4)).alias("auth_tail"),
    )


@query("dim_date")
def q_dim_date(spark, sf_dir):
    return FA.dim_date(P(spark, sf_dir).fact())


@query("fact_full_reload")
def q_fact_full_reload(spark, sf_dir):
    """Fact rebuilt from all of staging (no lookback), reconciled per staging batch."""
    p = P(spark, sf_dir)
    staged = p.staged_run2()
    from ledgerflow.plans.layers import FULL
    fact = FA.load_fact(staged, p.dim_customer(), p.dim_merchant_run2(), A.TXN_AS_OF, FULL,
                        processed_at=A.simulated_processed_at(staged))
    s = staged.groupBy("_batch_id").agg(F.count(F.lit(1)).alias("staged_rows"))
    f = fact.groupBy("_batch_id").agg(F.count(F.lit(1)).alias("fact_rows"))
    return s.join(f, "_batch_id", "full_outer").select(
        "_batch_id", F.coalesce("staged_rows", F.lit(0)).alias("staged_rows"),
        F.coalesce("fact_rows", F.lit(0)).alias("fact_rows"))


# --- upserts and incremental loads -------------------------------------------------------------
@query("stage_upsert")
def q_stage_upsert(spark, sf_dir):
    return P(spark, sf_dir).build_staged_run2()


def _staged_months(spark, sf_dir):
    """The staging table of run 1, kept by month, and run 2's staged batch."""
    p = P(spark, sf_dir)
    root = _fresh_dir(spark, "staging")
    table = os.path.join(root, "staging")
    PT.write_partitioned(p.staged_run1().withColumn("txn_day", SI.staging_day("month")), table, "txn_day", "transaction_id")
    return p, root, table, p.batch_run2()


@query("stage_merge_partitions")
def q_stage_merge_partitions(spark, sf_dir):
    """Run 2's batch merged into the staging table kept by month: only the months that take its rows
    or hold its ids are read and written."""
    _, root, table, source = _staged_months(spark, sf_dir)
    SI.merge_staging_table(spark, table, source, os.path.join(root, "scratch"), grain="month")
    return spark.read.parquet(table).drop("txn_day")


@query("fact_upsert")
def q_fact_upsert(spark, sf_dir):
    """The fact of run 1 after the changes that run 2 made to staging: replaced transactions are
    retracted and inserted anew, new ones added."""
    p, root, table, source = _staged_months(spark, sf_dir)
    holding = PT.partitions_holding(spark, table, source, "txn_day", "transaction_id")
    target = spark.read.parquet(table).where(F.col("txn_day").isin(holding))
    feed, fact = os.path.join(root, "changes"), os.path.join(root, "fact")
    for before, batch in in_slices([target, source], "transaction_id", os.path.join(root, "scratch")):
        store(ST.staging_changes(before, batch), feed, mode="append")
    SK.write_fact(p.fact_run1(), fact, stored=True)
    changes = spark.read.parquet(feed)
    PT.upsert_fact(spark, fact, changes, p.dim_customer(), p.dim_merchant_run2(), A.TXN_AS_OF, A.simulated_processed_at(changes),
                   os.path.join(root, "scratch"))
    return spark.read.parquet(fact).drop("transaction_key", "date_month")


@query("dim_merchant_upsert")
def q_dim_merchant_upsert(spark, sf_dir):
    return P(spark, sf_dir).build_dim_merchant_run2()


@query("fact_load_incremental")
def q_fact_load_incremental(spark, sf_dir):
    return P(spark, sf_dir).fact_run2_new()


@query("unknown_members")
def q_unknown_members(spark, sf_dir):
    """Unknown members after inserting them twice (the second insert adds nothing)."""
    p = P(spark, sf_dir)
    dm = p.dim_merchant()
    dm = FA.ensure_unknown_member(dm, FA.unknown_merchant(dm), "merchant_key")
    dc = FA.ensure_unknown_member(p.dim_customer(), FA.unknown_customer(spark), "customer_key")
    m = dm.where(F.col("merchant_key") == -1).select(F.lit("dim_merchant").alias("dimension"),
                                                    F.col("merchant_key").alias("member_key"),
                                                    F.col("merchant_id").alias("member_id"),
                                                    F.col("merchant_name").alias("member_name"))
    c = dc.where(F.col("customer_key") == -1).select(F.lit("dim_customer").alias("dimension"),
                                                    F.col("customer_key").alias("member_key"),
                                                    F.col("customer_id").alias("member_id"),
                                                    F.col("first_name").alias("member_name"))
    return m.unionByName(c)


@query("orphan_keys")
def q_orphan_keys(spark, sf_dir):
    p = P(spark, sf_dir)
    return FA.orphan_keys(p.fact(), p.dim_customer(), p.dim_merchant())


@query("scd2_as_of_lookup")
def q_scd2_as_of_lookup(spark, sf_dir):
    p = P(spark, sf_dir)
    rows = p.staged().select("transaction_id", "customer_id", "transaction_timestamp")
    return S.as_of_lookup(rows, p.customer_history()).drop("transaction_timestamp")


def _late_snapshot(p, spark, sf_dir):
    """The second customer snapshot loaded first, then the first one, late."""
    first, second = (A.raw_customer_snapshot(spark, sf_dir, k) for k in (1, 2))
    seen = S.observations(second, A.CUSTOMER_SNAPSHOT_2)
    early = p.table("customer_history_early", lambda: S.history_of(seen))
    return early, S.insert_snapshot(early, seen, first, A.CUSTOMER_SNAPSHOT_1), first


@query("scd2_late_snapshot")
def q_scd2_late_snapshot(spark, sf_dir):
    """A customer snapshot that arrives after a later one ends between the versions it belongs to."""
    return _late_snapshot(P(spark, sf_dir), spark, sf_dir)[1]


@query("scd2_late_facts")
def q_scd2_late_facts(spark, sf_dir):
    """Point-in-time keys given under the history before the late snapshot, given anew to the
    transactions of the customers it holds."""
    p = P(spark, sf_dir)
    early, history, late = _late_snapshot(p, spark, sf_dir)
    rows = p.staged().select("transaction_id", "customer_id", "transaction_timestamp")
    keyed = S.as_of_lookup(rows, early)
    return S.rekey(keyed, history, late).drop("transaction_timestamp")


# --- merchant windows ----------------------------------------------------------------------------
@query("merchant_latest")
def q_merchant_latest(spark, sf_dir):
    return M.merchant_latest_rows(P(spark, sf_dir).staged())


@query("merchant_first_value")
def q_merchant_first_value(spark, sf_dir):
    return M.merchant_first_values(P(spark, sf_dir).staged())


@query("merchant_window_stats")
def q_merchant_window_stats(spark, sf_dir):
    return M.merchant_window_stats(P(spark, sf_dir).staged())


# --- profiles ----------------------------------------------------------------------------------------
@query("dataset_profile")
def q_dataset_profile(spark, sf_dir):
    s = P(spark, sf_dir).staged()
    return s.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(s.columns)).alias("columns"),
                 F.min("transaction_timestamp").alias("first_ts"), F.max("transaction_timestamp").alias("last_ts"),
                 F.count_distinct("customer_id").alias("customers"), F.count_distinct("merchant_id").alias("merchants"),
                 F.min("amount").alias("amount_min"), F.max("amount").alias("amount_max"),
                 F.avg("amount").cast("decimal(18,2)").alias("amount_mean"))


@query("value_breakdown")
def q_value_breakdown(spark, sf_dir):
    """Value counts with percent of rows for status, channel and currency, most
    frequent first: one pass (the three columns stacked), then a window over the
    grouped counts only (one row per distinct value)."""
    from pyspark.sql import Window
    s = P(spark, sf_dir).staged()
    tall = s.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value"))
                                       for c in ["status", "channel", "currency"]])))
    counts = tall.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy("column_name"))
    pct = F.round(F.col("count").cast("decimal(20,0)") * 100 / total.cast("decimal(20,0)"), 2).cast("decimal(9,2)")
    return counts.withColumn("percent", pct).orderBy("column_name", F.desc("count"), "value")


@query("distinct_counts")
def q_distinct_counts(spark, sf_dir):
    s = P(spark, sf_dir).staged()
    return s.agg(F.count_distinct("transaction_id").alias("distinct_transactions"),
                 F.count_distinct("customer_id").alias("distinct_customers"),
                 F.count_distinct("merchant_id").alias("distinct_merchants"))


# --- events -----------------------------------------------------------------------------------------
from ledgerflow.operators import events as E  # noqa: E402


def _validated(spark, sf_dir):
    return E.validate(E.unwrap(P(spark, sf_dir).event_lines()))


def _request_id():
    return F.md5(F.concat_ws("-", F.col("event_id").cast("string"), F.col("event_pos").cast("string")))


def _enriched(spark, sf_dir):
    accepted, _ = E.split(_validated(spark, sf_dir))
    return E.enrich(accepted, ingested_at=F.col("ts"), request_id=_request_id())


def _f(name):
    return F.get_json_object(F.col("payload"), f"$.{name}")


@query("event_unwrap")
def q_event_unwrap(spark, sf_dir):
    ev = E.unwrap(P(spark, sf_dir).event_lines())
    return ev.select("event_id", "event_pos", _f("transaction_id").alias("transaction_id"),
                     _f("customer_id").alias("customer_id"), _f("merchant_id").alias("merchant_id"),
                     _f("amount").try_cast("decimal(18,2)").alias("amount"), _f("currency").alias("currency"),
                     _f("timestamp").alias("timestamp"),
                     F.size(F.json_object_keys("payload")).alias("n_fields"))


@query("event_validate")
def q_event_validate(spark, sf_dir):
    return _validated(spark, sf_dir).select("event_id", "event_pos", _f("transaction_id").alias("transaction_id"),
                                            F.col("_error").alias("error"))


@query("event_enrich")
def q_event_enrich(spark, sf_dir):
    """Every column that a sink writes."""
    return _enriched(spark, sf_dir)


@query("mask_card")
def q_mask_card(spark, sf_dir):
    ev = E.unwrap(P(spark, sf_dir).event_lines()).where(_f("card_number").isNotNull())
    from ledgerflow.functions.columns import mask_card
    return ev.select("event_id", "event_pos", mask_card(_f("card_number")).alias("card_number"))


@query("event_summary")
def q_event_summary(spark, sf_dir):
    return E.batch_summary(_validated(spark, sf_dir), ["event_id", "event_pos"], 10)


@query("event_rejects")
def q_event_rejects(spark, sf_dir):
    _, rejected = E.split(_validated(spark, sf_dir))
    return E.rejects(rejected, F.col("ts")).select("event_id", "event_pos", "error", "timestamp")


@query("hourly_volume")
def q_hourly_volume(spark, sf_dir):
    ev = E.unwrap(P(spark, sf_dir).event_lines())
    return (ev.groupBy(F.window("ts", "1 hour").start.alias("hour_start"))
            .agg(F.count(F.lit(1)).alias("events")))


@query("sliding_metrics")
def q_sliding_metrics(spark, sf_dir):
    """Accepted events in 30-minute windows every 15 minutes (overlapping), the batch
    form of the streaming monitor."""
    en = _enriched(spark, sf_dir)
    return (en.groupBy(F.window("ts", "30 minutes", "15 minutes").alias("w"))
            .agg(F.count(F.lit(1)).alias("events"), F.sum("amount").cast("decimal(38,2)").alias("amount"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "events", "amount"))


@query("event_sink_partitions")
def q_event_sink_partitions(spark, sf_dir):
    """Accepted events written as JSON lines partitioned by ingest hour, read back and
    counted per partition directory."""
    from ledgerflow.sources.sinks import read_event_batches, write_event_batches
    path = _fresh_dir(spark, "event-sink")
    write_event_batches(_enriched(spark, sf_dir), path)
    back = read_event_batches(spark, path)
    return back.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("events"))


# --- streaming ----------------------------------------------------------------------------------------
from ledgerflow.streaming import ingest as SI  # noqa: E402


def _landed_messages(spark, sf_dir, n_chunks=4):
    root = _fresh_dir(spark, "stream")
    src = os.path.join(root, "in")
    lines = P(spark, sf_dir).event_lines()
    return root, src, SI.time_chunks(lines, "ts", n_chunks)


@query("stream_incremental_ingest")
def q_stream_incremental_ingest(spark, sf_dir):
    """Two availableNow runs over a growing landing folder: the second run loads only
    the files that arrived after the first (load-once through the checkpoint)."""
    root, src, chunks = _landed_messages(spark, sf_dir)
    ck, out = os.path.join(root, "ck"), os.path.join(root, "out")
    for c in chunks[:2]:
        SI.land_messages(c, src)
    now = F.lit(A.TXN_AS_OF).cast("timestamp_ntz")
    SI.ingest_events(spark, src, out, ck, now)
    for c in chunks[2:]:
        SI.land_messages(c, src)
    SI.ingest_events(spark, src, out, ck, now)
    return spark.read.parquet(os.path.join(out, "accepted")).drop("_source_file", "event_pos", "_request_id", "_batch")


@query("stream_volume_over_time")
def q_stream_volume_over_time(spark, sf_dir):
    """Events per layer and day of ingest, from the counts that the micro-batches of two daily runs
    left: events of even ids land before the first run, all others before the second."""
    root = _fresh_dir(spark, "stream-volumes")
    src, out, ck, table = (os.path.join(root, x) for x in ("in", "out", "ck", "volumes"))
    lines, odd = P(spark, sf_dir).event_lines(), F.col("event_id") % 2 == 1
    for landed, days_ago in ((lines.where(~odd), 1), (lines.where(odd), 0)):
        SI.land_messages(landed, src)
        at = F.lit(A.TXN_AS_OF - datetime.timedelta(days=days_ago)).cast("timestamp_ntz")
        SI.ingest_events(spark, src, out, ck, at, max_files_per_trigger=4, volumes=table)
    return SI.stream_volumes(spark, table)


@query("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """The ids kept by the dedup job: each accepted id once, whatever files share a batch."""
    root, src, chunks = _landed_messages(spark, sf_dir)
    for c in chunks:
        SI.land_messages(c, src)
    out = os.path.join(root, "out")
    SI.dedup_events(spark, src, out, os.path.join(root, "ck"), F.localtimestamp(), max_files_per_trigger=4)
    return spark.read.parquet(out).select("transaction_id")


@query("late_rows")
def q_late_rows(spark, sf_dir):
    """Messages land in four time slices, then a late file re-sends the oldest slice
    with new ids: those rows go to the late side table. The allowed delay (8 days) is
    longer than one slice, so rows of one slice are never late against each other; the
    late file lands before a second run, 15+ days behind what the first run has seen."""
    root, src, chunks = _landed_messages(spark, sf_dir)
    out = os.path.join(root, "out")
    for c in chunks:
        SI.land_messages(c, src)
    late = chunks[0].withColumn("line", F.regexp_replace("line", "TXN_", "LATE_"))
    for landed in (None, late):
        if landed is not None:
            SI.land_messages(landed, src)
        SI.late_event_split(spark, src, out, os.path.join(root, "ck"), _dt.timedelta(days=8), F.localtimestamp(),
                            max_files_per_trigger=8)
    return spark.read.parquet(os.path.join(out, "late")).select(
        "transaction_id", "amount", "currency", "status", "channel", "event_time")


@query("stream_stage_upsert")
def q_stream_stage_upsert(spark, sf_dir):
    """Landing CSVs staged by micro-batch upserts into the staging table kept by day. Each id
    ends with its latest valid version (an id whose newest row is unparseable keeps the
    version before)."""
    root = _fresh_dir(spark, "stream-stage")
    src, table = os.path.join(root, "in"), os.path.join(root, "staging")
    raw = P(spark, sf_dir).raw()
    for c in SI.time_chunks(raw, "_loaded_at", 3):
        SI.land_transactions_csv(c, src, compression="gzip")
    from ledgerflow.plans.layers import FULL
    SI.stage_landing_stream(spark, src, table, os.path.join(root, "ck"), os.path.join(root, "scratch"),
                            os.path.join(root, "rejects"), FULL, as_of_of_batch="data", max_files_per_trigger=8,
                            file_glob=f"{L.TXN_CSV_GLOB}.gz", grain="month")
    # the batch that brought a row depends on the files it shared a batch with
    return spark.read.parquet(table).drop("txn_day", "_staged_at", "_batch_id", "_source_file")


# --- generators, table writes --------------------------------------------------------------------------
from ledgerflow.sources import generators as G  # noqa: E402
from ledgerflow.sources import partitioned as PT  # noqa: E402
from ledgerflow.sources import sinks as SK  # noqa: E402


@query("generate_transactions")
def q_generate_transactions(spark, sf_dir):
    """One synthetic transaction per lineitem row (scales with the table)."""
    from ledgerflow.sources.tables import read_table
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]
    base = read_table(spark, sf_dir, "lineitem").select(
        *keys[:4], F.to_date("l_shipdate").alias("l_shipdate"), F.col("l_extendedprice").cast("decimal(18,2)").alias("l_extendedprice"))
    return G.generate_transactions(base, keys, A.TXN_AS_OF)


@query("generate_customers")
def q_generate_customers(spark, sf_dir):
    from ledgerflow.sources.tables import read_table
    return G.generate_customers(read_table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey",
                                A.TXN_AS_OF.date())


@query("bulk_load_modes")
def q_bulk_load_modes(spark, sf_dir):
    """Append twice, then replace: the table ends with one copy of the staged rows; the
    row counts come from the writes themselves."""
    path = _fresh_dir(spark, "table-staging")
    staged = P(spark, sf_dir).staged()
    n1 = SK.write_table(staged, path, mode="append")
    n2 = SK.write_table(staged, path, mode="append")
    n3 = SK.write_table(staged, path, mode="overwrite")
    written = F.array(*[F.lit(n).cast("long") for n in (n1, n2, n3)])
    return spark.read.parquet(path).withColumn("_rows_written", written)


@query("fact_layout")
def q_fact_layout(spark, sf_dir):
    """The fact written clustered (month directories, range-partitioned and sorted along a curve
    of date key and customer key), read back."""
    path = _fresh_dir(spark, "fact")
    SK.write_fact(P(spark, sf_dir).fact(), path, mode="overwrite", stored=True)
    # transaction_key (dense numbering) depends on the write's partitioning; checked in tests
    return spark.read.parquet(path).drop("transaction_key")


# --- monitoring runs over time ------------------------------------------------------------------
from ledgerflow.operators import panes as PN  # noqa: E402
from ledgerflow.sources import history as H  # noqa: E402

SLIDE, RUN_EVERY = datetime.timedelta(days=1), datetime.timedelta(days=15)


def _panes(spark, sf_dir):
    """The slices of the fact, stored by month, and a monitoring run every 15 days from its first
    row to as_of, each over the metric window (two runs see each row)."""
    root = _fresh_dir(spark, "panes")
    PN.update_panes(P(spark, sf_dir).fact(), root, SLIDE, METRIC_WINDOW, grain="month")
    tables = PN.read_panes(spark, root)
    first = tables["slices"].agg(F.min("pane")).first()[0]
    count = 1 if first is None else max(0, (A.TXN_AS_OF - datetime.datetime(1970, 1, 1)) // datetime.timedelta(microseconds=1) - first) // (
        RUN_EVERY // datetime.timedelta(microseconds=1)) + 1
    return tables, PN.Runs(spark, A.TXN_AS_OF, RUN_EVERY, count, METRIC_WINDOW, SLIDE)


@query("pane_quality_metrics")
def q_pane_quality_metrics(spark, sf_dir):
    """Quality metrics of every run, combined from slices: the fact is read once for all runs."""
    t, runs = _panes(spark, sf_dir)
    return runs.quality_metrics(t["slices"], t["firsts"])


@query("pane_sla_metrics")
def q_pane_sla_metrics(spark, sf_dir):
    t, runs = _panes(spark, sf_dir)
    return runs.sla_metrics(t["slices"])


@query("pane_latency_sketch")
def q_pane_latency_sketch(spark, sf_dir):
    """P95 of every run from merged KLL sketches, and whether its exact rank is within 1 % of the
    rows (the sketch's error is 0.35 % at 99 % confidence)."""
    t, runs = _panes(spark, sf_dir)
    ranked = runs.rank_range(runs.sketched_p95(t["sketches"]), t["slices"])
    close = (F.col("below") <= 0.96) & (F.col("upto") >= 0.94)
    return ranked.select(F.col("as_of").alias("metric_timestamp"), "sample_size", close.alias("rank_within_one_percent"))


def _history(spark, sf_dir):
    """Every run's quality metrics stored in the history; the newest three runs stored again."""
    t, runs = _panes(spark, sf_dir)
    table = _fresh_dir(spark, "metric-history")
    rows = runs.quality_metrics(t["slices"], t["firsts"])
    H.record_metrics(rows, table)
    H.record_metrics(rows.where(F.col("metric_timestamp") > F.lit(A.TXN_AS_OF - 3 * RUN_EVERY).cast("timestamp_ntz")), table)
    return H.read_metrics(spark, table)


@query("metric_history")
def q_metric_history(spark, sf_dir):
    """The metric table after its runs: each run once, also those stored twice."""
    return _history(spark, sf_dir)


@query("top_failed_history")
def q_top_failed_history(spark, sf_dir):
    """The report of the newest failed metrics, read from the stored history."""
    return MO.top_failed_metrics(_history(spark, sf_dir), 20)
