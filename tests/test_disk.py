"""What upserts leave on disk while they run: shuffle files, copies, landed text."""

import datetime as dt
import glob
import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerflow.functions import slices as SL
from ledgerflow.functions.keys import dense_keys
from ledgerflow.operators import staging as ST
from ledgerflow.plans import queries as QM
from ledgerflow.plans.layers import Layers
from ledgerflow.session import scratch_path, store
from ledgerflow.sources import adapters as A
from ledgerflow.sources import partitioned as PT
from ledgerflow.streaming import ingest as SI
from test_partitioned import at, staged_rows


@pytest.fixture
def small_slices(monkeypatch):
    """Every table has many slices; gives the number of rows of each slice as it is worked off."""
    seen, whole = [], SL.in_slices

    def counted(sides, *a):
        for parts in whole(sides, *a):
            seen.append(sum(p.count() for p in parts))
            yield parts

    monkeypatch.setattr(SL, "SLICE_BYTES", 200)
    monkeypatch.setattr(SL, "in_slices", counted)
    return seen


def shuffle_files(spark):
    root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {root.apply(i).getName() for i in range(root.size()) if root.apply(i).getName().startswith("shuffle")}


def folder(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")


def test_shuffle_files_go_with_the_write(spark):
    before = shuffle_files(spark)
    path = folder(spark, "released")
    store(spark.range(10_000).repartition(7, "id"), path)
    until = time.time() + 20  # the block manager removes them in the background
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.read.parquet(path).count() == 10_000


def test_rows_of_a_key_are_in_one_slice(spark, monkeypatch):
    monkeypatch.setattr(SL, "SLICE_BYTES", 500)
    root = folder(spark, "sliced")
    left, right = os.path.join(root, "l"), os.path.join(root, "r")
    spark.createDataFrame([(f"T{k % 40}" if k % 10 else None, k) for k in range(200)], "i string, v int").write.parquet(left)
    spark.createDataFrame([(f"T{k}", k) for k in range(20, 60)], "i string, w int").write.parquet(right)
    sides, keys, rows = [spark.read.parquet(left), spark.read.parquet(right)], [], [[], []]
    for parts in SL.in_slices(sides, "i", os.path.join(root, "s")):
        assert [p.columns for p in parts] == [["i", "v"], ["i", "w"]]
        got = [p.collect() for p in parts]
        keys.append({r.i for g in got for r in g})
        for all_rows, g in zip(rows, got, strict=True):
            all_rows += map(tuple, g)
    assert len(keys) > 3 and sum(map(len, keys)) == len(set().union(*keys))
    assert [sorted(map(str, r)) for r in rows] == [sorted(str(tuple(r)) for r in s.collect()) for s in sides]
    assert os.listdir(os.path.join(root, "s")) == []


def test_a_partition_merge_is_done_in_slices_and_moved(spark, small_slices):
    root = folder(spark, "merge")
    table, scratch = os.path.join(root, "t"), os.path.join(root, "s")
    target = staged_rows(spark, [(f"T{k}", at(k % 5), 1, at(20), at(20)) for k in range(100)]).drop("_loaded_at")
    PT.write_partitioned(target.withColumn("txn_day", SI.staging_day("day")), table, "txn_day", "transaction_id")
    # T0 .. T29 move to other days, day 3 loses all its rows, T40 is too old, N1 is new
    moved = [(f"T{k}", at(50), 2, at(30), at(31)) for k in range(100) if k < 30 or k % 5 == 3]
    batch = staged_rows(spark, [*moved, ("T40", at(0), 9, at(1), at(31)), ("N1", at(51), 3, at(30), at(31))])
    want = ST.upsert_staging(target, batch).select(*ST.STAGED_COLUMNS)
    days = SI.merge_staging_table(spark, table, batch, scratch)
    assert len(small_slices) > 3 and sum(small_slices) == 100 + batch.count()
    got = spark.read.parquet(table)
    assert got.select(*ST.STAGED_COLUMNS).exceptAll(want).count() == 0 and got.count() == want.count() == 101
    assert got.where(F.col("txn_day") != F.to_date("transaction_timestamp")).count() == 0
    left = sorted(str(d) for d in days if d != at(3).date())
    assert PT.partition_values(spark, table, "txn_day") == left == PT.partition_values(spark, PT.filters_path(table), "txn_day")
    assert os.listdir(scratch) == [] and sorted(os.listdir(root)) == ["s", "t", "t_filters"]


def test_stream_upsert_in_slices_keeps_the_newest(spark, small_slices):
    root = folder(spark, "newest")
    table, scratch = os.path.join(root, "t"), os.path.join(root, "s")
    first = staged_rows(spark, [(f"T{k}", at(k % 3), k, at(10), at(10)) for k in range(60)])
    SI.upsert_staging_table(spark, table, first, scratch)
    SI.upsert_staging_table(spark, table, staged_rows(spark, [(f"T{k}", at(k % 4), 500, at(9 + k % 3), at(20)) for k in range(30, 90)]), scratch)
    got = {r.transaction_id: (r.transaction_timestamp, int(r.amount)) for r in spark.read.parquet(table).collect()}
    new = {f"T{k}": (at(k % 4), 500) for k in range(30, 90) if k >= 60 or k % 3 == 2}
    tied = {f"T{k}": max((k, at(k % 3)), (500, at(k % 4)))[::-1] for k in range(30, 60) if k % 3 == 1}
    assert got == {**{f"T{k}": (at(k % 3), k) for k in range(60)}, **new, **tied}
    assert len(small_slices) > 6 and spark.read.parquet(table).count() == 90


def test_fact_upsert_in_slices_and_groups_of_months(spark, small_slices, monkeypatch):
    p, root = QM.P(spark, SF_SMALL), folder(spark, "fact")
    table, feed = os.path.join(root, "fact"), os.path.join(root, "feed")
    QM.SK.write_fact(p.fact_run1(), table, stored=True)
    before = {r.transaction_id: r for r in spark.read.parquet(table).collect()}
    changed = p.staged_run1().where(F.crc32("transaction_id") % 3 == 0).withColumn("_loaded_at", F.lit(A.TXN_AS_OF).cast("timestamp_ntz"))
    changed = changed.withColumn("transaction_timestamp", F.col("transaction_timestamp") + F.expr("INTERVAL 40 DAYS"))
    new = changed.withColumn("transaction_id", F.concat(F.lit("NEW_"), "transaction_id"))
    ST.staging_changes(p.staged_run1(), changed.unionByName(new)).write.parquet(feed)
    groups, store_of = [], PT.store
    monkeypatch.setattr(PT, "store", lambda df, path, **k: groups.append(path) or store_of(df, path, **k))
    PT.upsert_fact(spark, table, spark.read.parquet(feed), p.dim_customer(), p.dim_merchant_run1(), A.TXN_AS_OF, None, os.path.join(root, "s"))
    assert len(small_slices) > 3 and sum(g.startswith(f"{table}_fact-") for g in groups) > 3
    want = {r.transaction_id: r.transaction_timestamp for r in changed.unionByName(new).collect()}
    rows = spark.read.parquet(table).collect()
    after, fresh = {r.transaction_id: r for r in rows}, sorted(i for i in want if i.startswith("NEW_"))
    assert len(rows) == len(after) == len(before) + len(fresh) and len(want) == 2 * len(fresh) > 100
    assert all(after[i].transaction_key == r.transaction_key for i, r in before.items())
    top = max(r.transaction_key for r in before.values())
    assert sorted(after[i].transaction_key for i in fresh) == list(range(top + 1, top + 1 + len(fresh)))
    assert {i: after[i].transaction_timestamp for i in want} == want
    assert {i: r.asDict() for i, r in after.items() if i not in want} == {i: r.asDict() for i, r in before.items() if i not in want}
    assert all(r.date_month == r.transaction_date_key // 100 for r in rows)
    assert os.listdir(os.path.join(root, "s")) == [] and sorted(os.listdir(root)) == ["fact", "feed", "s"]


def test_no_changes_leave_the_fact(spark):
    p, root = QM.P(spark, SF_SMALL), folder(spark, "still")
    table, feed = os.path.join(root, "fact"), os.path.join(root, "feed")
    QM.SK.write_fact(p.fact_run1(), table, stored=True)
    want = sorted(map(str, spark.read.parquet(table).collect()))
    ST.staging_changes(p.staged_run1(), p.batch_run2().limit(0)).write.parquet(feed)
    assert PT.upsert_fact(spark, table, spark.read.parquet(feed), p.dim_customer(), p.dim_merchant_run1(), A.TXN_AS_OF, None,
                          os.path.join(root, "s")) == []
    assert sorted(map(str, spark.read.parquet(table).collect())) == want


def test_files_of_one_name_in_several_folders_are_numbered_apart(spark):
    path = folder(spark, "folders")
    spark.range(0, 300, 1, 3).withColumn("p", F.col("id") % 4).write.partitionBy("p").parquet(path)
    rows = dense_keys(spark.read.parquet(path).where("p > 0"), "k", 10, stored=True).collect()
    assert sorted(r.k for r in rows) == list(range(11, 11 + 225))


def test_staging_of_the_second_run_is_stored_in_slices(spark, monkeypatch):
    monkeypatch.setattr(SL, "SLICE_BYTES", 10_000)
    p = Layers(spark, SF_SMALL, run_id=f"slices-{uuid.uuid4().hex[:8]}")
    stored, whole = p.staged_run2(), p.build_staged_run2()
    assert stored.columns == whole.columns and stored.exceptAll(whole).count() == 0 and stored.count() == whole.count()
    jobs = {os.path.basename(f).split("-", 2)[2] for f in glob.glob(os.path.join(p._root(), "staged_run2", "part-*"))}
    assert len(jobs) > 1  # more than one write
    assert not os.path.exists(os.path.join(p._root(), "staged_run2.slices")) or os.listdir(os.path.join(p._root(), "staged_run2.slices")) == []


def test_deliveries_can_land_compressed(spark):
    src, n = folder(spark, "gz"), 50
    typed = [f"T{k}" for k in range(n)]
    raw = spark.createDataFrame([(i, dt.datetime(2024, 1, 2)) for i in typed], "transaction_id string, _loaded_at timestamp_ntz").select(
        "transaction_id", *[F.lit({"amount": "5", "transaction_timestamp": "2024-01-01"}.get(c, "x y")).alias(c)
                            for c in SI.L.RAW_TXN_FIELDS[1:]], "_loaded_at")
    SI.land_transactions_csv(raw, src, compression="gzip")
    assert all(f.endswith(".csv.gz") for f in os.listdir(src) if not f.startswith("."))
    table, scratch = os.path.join(src + "-out", "t"), os.path.join(src + "-out", "s")
    SI.stage_landing_stream(spark, src, table, os.path.join(src + "-out", "ck"), scratch, os.path.join(src + "-out", "rejects"),
                            dt.timedelta(days=30), as_of_of_batch="data", file_glob=f"{SI.L.TXN_CSV_GLOB}.gz")
    assert sorted(r.transaction_id for r in spark.read.parquet(table).collect()) == sorted(typed)
    assert os.listdir(scratch) == [] and not spark.sparkContext._jsc.getPersistentRDDs()
