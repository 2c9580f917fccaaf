"""Slices, overlapping windows and the metric history."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import monitoring as MO
from ledgerflow.operators import panes as PN
from ledgerflow.session import scratch_path
from ledgerflow.sources import history as H

START = dt.datetime(2024, 3, 1)
SLIDE, LOOKBACK = dt.timedelta(minutes=15), dt.timedelta(minutes=30)
SCHEMA = ("transaction_id string, customer_key long, merchant_key long, amount decimal(18,2), amount_usd decimal(18,2), "
          "transaction_timestamp timestamp_ntz, processed_at timestamp_ntz, _batch_id string")


def fact(spark, n=4000):
    """Ids that repeat within and across slices, rows exactly at cuts, nulls in every column."""
    k = F.col("id")
    at = F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), (k * 7 % 300).cast("int"),
                                                                F.when(k % 3 == 0, 0).otherwise(k % 60).cast("decimal(18,6)"))
    late = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (k * k % 200).cast("decimal(18,6)"))
    price = (k * 37 % 1000 / 7).cast("decimal(18,2)")
    return spark.range(n).select(
        F.when(k % 41 != 0, F.concat(F.lit("T"), F.when(k % 3 == 1, 1).otherwise(k % 700))).alias("transaction_id"),
        F.when(k % 11 == 0, -1).when(k % 97 != 0, k % 50).alias("customer_key"), (k % 9).alias("merchant_key"),
        F.when(k % 13 != 0, price).alias("amount"), F.when(k % 17 != 0, price).alias("amount_usd"),
        F.when(k % 19 != 0, at - late).alias("transaction_timestamp"), F.when(k % 23 != 0, at).alias("processed_at"),
        F.when(k % 29 != 0, F.concat(F.lit("B"), F.lpad((k % 31).cast("string"), 3, "0"))).alias("_batch_id")).to(
            spark.createDataFrame([], SCHEMA).schema)


def stored(spark, rows, **kw):
    root = scratch_path(spark, f"panes-{uuid.uuid4().hex[:8]}")
    PN.update_panes(rows, root, SLIDE, LOOKBACK, **kw)
    return root


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_runs_equal_the_windows_read_one_by_one(spark):
    f = fact(spark).cache()
    t = PN.read_panes(spark, stored(spark, f))
    runs = PN.Runs(spark, START + dt.timedelta(hours=5, minutes=30), SLIDE, 24, LOOKBACK, SLIDE)
    quality = runs.quality_metrics(t["slices"], t["firsts"]).cache()
    sla = runs.sla_metrics(t["slices"]).cache()
    assert quality.count() == 24 * 5 and sla.count() == 24 * 3
    for k in range(0, 24, 3):
        as_of = START + dt.timedelta(hours=5, minutes=30) - k * SLIDE
        at = F.col("metric_timestamp") == F.lit(as_of).cast("timestamp_ntz")
        by_then = f.where(F.col("processed_at") <= F.lit(as_of).cast("timestamp_ntz"))
        assert rows_of(quality.where(at)) == rows_of(MO.quality_metrics(by_then, as_of, LOOKBACK))
        assert rows_of(sla.where(at)) == rows_of(MO.sla_metrics(f, as_of, LOOKBACK))


def test_sketches_merge_within_their_rank_error(spark):
    lat = (F.col("id") * 7919 % 100_000).cast("int")
    at = F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") % 120).cast("int"), F.lit(1).cast("decimal(18,6)"))
    zero = fact(spark, 1).drop("transaction_timestamp", "processed_at")
    rows = zero.crossJoin(spark.range(120_000).select(
        at.alias("processed_at"), (at - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), lat.cast("decimal(18,6)"))).alias("transaction_timestamp")))
    t = PN.read_panes(spark, stored(spark, rows))
    runs = PN.Runs(spark, START + dt.timedelta(hours=2), SLIDE, 4, dt.timedelta(hours=1), SLIDE)
    got = runs.rank_range(runs.sketched_p95(t["sketches"]), t["slices"]).collect()
    assert len(got) == 4 and all(r.sample_size == 60_000 for r in got)
    assert all(r.below <= 0.96 and r.upto >= 0.94 for r in got)
    widest = t["sketches"].agg(F.max(F.length("sketch"))).first()[0]
    assert widest < 40_000                       # bounded, whatever the number of rows


def test_an_update_reads_and_writes_from_its_day_on(spark):
    f = fact(spark).withColumn("processed_at", F.col("processed_at") + F.make_dt_interval((F.length("transaction_id") % 4).cast("int")))
    day2 = START + dt.timedelta(days=2)
    early = f.where(F.col("processed_at") < F.lit(day2 + dt.timedelta(hours=3)).cast("timestamp_ntz"))
    root = stored(spark, early)
    old = {p: os.path.getmtime(os.path.join(root, "slices", p)) for p in os.listdir(os.path.join(root, "slices")) if p.endswith(("0301", "0302"))}
    assert old
    for _ in range(2):
        PN.update_panes(f, root, SLIDE, LOOKBACK, since=day2 + dt.timedelta(hours=3))
    assert all(os.path.getmtime(os.path.join(root, "slices", p)) == m for p, m in old.items())
    whole = stored(spark, f)
    runs = PN.Runs(spark, START + dt.timedelta(days=4), SLIDE, 4 * 96, LOOKBACK, SLIDE)
    a, b = PN.read_panes(spark, root), PN.read_panes(spark, whole)
    assert rows_of(runs.quality_metrics(a["slices"], a["firsts"])) == rows_of(runs.quality_metrics(b["slices"], b["firsts"]))


def test_no_rows_and_windows_off_the_cuts(spark):
    t = PN.read_panes(spark, stored(spark, fact(spark, 0)))
    assert all(t[n].drop(PN.PART).dtypes == build(fact(spark, 0), SLIDE).dtypes for n, build in PN.BUILDERS.items())
    runs = PN.Runs(spark, START, SLIDE, 2, LOOKBACK, SLIDE)
    got = runs.quality_metrics(t["slices"], t["firsts"]).where("metric_name = 'row_count'").collect()
    assert [(r.metric_value, r.status) for r in got] == [(0, "WARNING")] * 2
    assert runs.sla_metrics(t["slices"]).count() == 6 and runs.sketched_p95(t["sketches"]).count() == 0
    with pytest.raises(ValueError):
        PN.Runs(spark, START + dt.timedelta(minutes=1), SLIDE, 2, LOOKBACK, SLIDE)


def test_history_holds_each_run_once(spark):
    f = fact(spark)
    table = scratch_path(spark, f"history-{uuid.uuid4().hex[:8]}")
    first, second = (MO.quality_metrics(f, START + dt.timedelta(hours=h), LOOKBACK) for h in (1, 2))
    assert H.record_metrics(first, table) == 5 and H.record_metrics(second, table) == 5
    kept = H.read_metrics(spark, table)
    assert H.record_metrics(second, table) == 5
    assert rows_of(H.read_metrics(spark, table)) == rows_of(first.union(second)) and kept.columns == first.columns
    newest = MO.top_failed_metrics(H.read_metrics(spark, table), 3).collect()
    assert newest and newest[0].metric_timestamp == START + dt.timedelta(hours=2)
