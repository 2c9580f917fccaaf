"""Filters, partition rewrites, fact corrections and late snapshots."""

import datetime as dt
import itertools
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from ledgerflow.functions.filters import build_filters, probe
from ledgerflow.operators import scd2 as S
from ledgerflow.operators import staging as ST
from ledgerflow.plans import queries as QM
from ledgerflow.session import scratch_path
from ledgerflow.sources import adapters as A
from ledgerflow.sources import partitioned as PT
from ledgerflow.streaming import ingest as SI
from test_events_streaming import event, folders, land


def test_filters_never_miss(spark):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int"))
    rows = spark.range(50_000).select(F.concat(F.lit("T"), "id").alias("tid"), day.alias("day"))
    filters = build_filters(rows, "day", "tid")
    ids = spark.range(49_000, 52_000).select(F.concat(F.lit("T"), "id").alias("tid"))
    can = probe(ids, filters, "day", "tid")
    true = can.join(rows, ["tid", "day"]).count()
    assert true == 1000                       # each id is told in its own partition
    assert can.count() - true < 0.02 * (3000 * 4 - 1000)
    assert probe(ids, filters.limit(0), "day", "tid").count() == 0


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def staged_rows(spark, rows):
    """Staged rows (id, day, amount, loaded) with fixed other columns."""
    typed = {"transaction_id": "string", "transaction_timestamp": "timestamp_ntz", "amount": "decimal(18,2)", "is_international": "boolean",
             "_staged_at": "timestamp_ntz", "_loaded_at": "timestamp_ntz"}
    base = spark.createDataFrame([(i, d, str(a), ld, sg) for i, d, a, ld, sg in rows], "i string, d timestamp_ntz, a string, l timestamp_ntz, s timestamp_ntz")
    own = {"transaction_id": F.col("i"), "transaction_timestamp": F.col("d"), "amount": F.col("a"), "_loaded_at": F.col("l"), "_staged_at": F.col("s"),
           "is_international": F.lit(False), "currency": F.lit("USD"), "card_last_four": F.lit("1111")}
    return base.select(*[own.get(c, F.lit("x")).cast(typed.get(c, "string")).alias(c) for c in [*ST.STAGED_COLUMNS, "_loaded_at"]])


def at(day, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=day, hours=hour)


def test_untouched_partitions_keep_their_files(spark):
    root = scratch_path(spark, f"part-{uuid.uuid4().hex[:8]}")
    table, scratch = os.path.join(root, "t"), os.path.join(root, "s")
    rows = [(f"T{k}", at(k % 10), 1, at(20), at(20)) for k in range(200)]
    target = staged_rows(spark, rows).drop("_loaded_at")
    PT.write_partitioned(target.withColumn("txn_day", SI.staging_day("day")), table, "txn_day", "transaction_id")
    before = files(table)
    # T3 stays on day 3, T4 moves from day 4 to day 40, T5 is too old to replace, N1 is new on day 41
    batch = staged_rows(spark, [("T3", at(3), 7, at(30), at(31)), ("T4", at(40), 8, at(30), at(31)), ("T5", at(5), 9, at(10), at(31)),
                                ("N1", at(41), 10, at(30), at(31))])
    touched = SI.merge_staging_table(spark, table, batch, scratch)
    assert touched == [at(k).date() for k in (3, 4, 5, 40, 41)]
    after = files(table)
    same = {f: t for f, t in before.items() if not any(f"txn_day={d}" in f for d in touched)}
    assert same and all(after.get(f) == t for f, t in same.items())
    want = ST.upsert_staging(target, batch).select(*ST.STAGED_COLUMNS)
    got = spark.read.parquet(table).select(*ST.STAGED_COLUMNS)
    assert got.count() == 201 and got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
    # the same batch again finds T4 on its new day and changes nothing
    SI.merge_staging_table(spark, table, batch, scratch)
    again = spark.read.parquet(table).select(*ST.STAGED_COLUMNS)
    assert again.exceptAll(want).count() == 0 and again.count() == 201


def test_only_days_that_can_hold_an_id_are_read(spark):
    root = scratch_path(spark, f"read-{uuid.uuid4().hex[:8]}")
    table = os.path.join(root, "t")
    rows = staged_rows(spark, [(f"T{k}", at(k % 30), 1, at(40), at(40)) for k in range(3000)]).drop("_loaded_at")
    PT.write_partitioned(rows.withColumn("txn_day", SI.staging_day("day")), table, "txn_day", "transaction_id")
    ids = spark.createDataFrame([("T7",), ("T38",), ("none",)], "transaction_id string")
    assert PT.partitions_holding(spark, table, ids, "txn_day", "transaction_id") == [at(7).date(), at(8).date()]
    can = probe(ids, spark.read.parquet(PT.filters_path(table)), "txn_day", "transaction_id")
    assert can.select("txn_day").distinct().count() < 10


def test_dedup_finds_copies_older_than_its_state(spark):
    src, out, ck = folders(spark, "old")

    def run(lines, day):
        land(spark, lines, src, 2)
        SI.dedup_events(spark, src, out, ck, F.lit(at(day)).cast(T.TimestampNTZType()), horizon=dt.timedelta(days=2))

    run([event(k) for k in range(40)], 0)
    run([event(k) for k in range(30, 60)], 1)                      # copies that the state holds
    run([event(k) for k in range(60, 70)], 6)                      # the state forgets the first days
    run([event(k) for k in range(0, 90)] + ["{broken", "{broken"], 10)    # copies older than the state
    rows = spark.read.parquet(out)
    ids = [r.transaction_id for r in rows.select("transaction_id").collect()]
    assert sorted(ids) == sorted(f"TXN_{k}" for k in range(90))
    assert PT.partition_values(spark, PT.filters_path(out), "_day") == ["2024-01-01", "2024-01-02", "2024-01-07"]
    assert spark.read.parquet(f"{out}_rejects").count() == 2
    assert rows.where(F.col("_day") == F.lit(at(10).date())).count() == 20
    with pytest.raises(ValueError):
        SI.dedup_events(spark, src, out, ck, F.localtimestamp(), horizon=dt.timedelta(hours=1))


def test_fact_upsert_writes_only_affected_months(spark):
    p = QM.P(spark, SF_SMALL)
    root = scratch_path(spark, f"fact-{uuid.uuid4().hex[:8]}")
    table, feed = os.path.join(root, "fact"), os.path.join(root, "feed")
    QM.SK.write_fact(p.fact_run1(), table)
    before, keys = files(table), {r.transaction_id: r.transaction_key for r in spark.read.parquet(table).collect()}
    some = p.staged_run1().orderBy("transaction_id").limit(3).withColumn("_loaded_at", F.lit(A.TXN_AS_OF).cast("timestamp_ntz"))
    moved = some.withColumn("transaction_timestamp", F.col("transaction_timestamp") + F.expr("INTERVAL 400 DAYS")).withColumn("amount", F.col("amount") + 1)
    new = some.limit(1).withColumn("transaction_id", F.lit("NEW_1"))
    ST.staging_changes(p.staged_run1(), moved.unionByName(new)).write.parquet(feed)
    changes = spark.read.parquet(feed)
    assert sorted(r.change for r in changes.collect()) == ["insert", "update", "update", "update"]
    months = PT.upsert_fact(spark, table, changes, p.dim_customer(), p.dim_merchant_run1(), A.TXN_AS_OF, None, os.path.join(root, "s"))
    after = files(table)
    same = {f: t for f, t in before.items() if not any(f"date_month={m}" in f for m in months)}
    assert len(months) <= 7 and same and all(after.get(f) == t for f, t in same.items())
    rows = {r.transaction_id: r for r in spark.read.parquet(table).collect()}
    assert len(rows) == len(keys) + 1 == spark.read.parquet(table).count()
    assert all(rows[i].transaction_key == k for i, k in keys.items()) and rows["NEW_1"].transaction_key == max(keys.values()) + 1
    want = {r.transaction_id: r.transaction_timestamp for r in moved.collect()}
    assert {i: rows[i].transaction_timestamp for i in want} == want


def test_any_order_of_snapshots_gives_one_history(spark):
    rnd = random.Random(3)
    days = [dt.date(2024, 1, 1 + 5 * k) for k in range(4)]

    def snapshot(day):
        rows = [(f"C{c}", rnd.choice("ab"), dt.datetime.combine(day, dt.time())) for c in range(12) if rnd.random() < 0.8]
        base = spark.createDataFrame(rows, "customer_id string, email string, _loaded_at timestamp_ntz")
        return base.select("customer_id", *[F.col("email") if a == "email" else F.lit(dt.date(2020, 1, 1)).alias(a) if a == "account_open_date"
                                            else F.lit("x").alias(a) for a in S.CUSTOMER_ATTRIBUTES], "_loaded_at")

    def kept(df):
        path = scratch_path(spark, f"late-{uuid.uuid4().hex[:8]}")
        df.write.parquet(path)
        return spark.read.parquet(path)

    snaps = {d: snapshot(d) for d in days}
    history = S.empty_history(spark)
    for d in days:
        history = S.scd2_merge(history, snaps[d], d)
    want = sorted(map(str, history.select(*S.HISTORY_COLUMNS).collect()))
    for order in [days[::-1], *rnd.sample(list(itertools.permutations(days)), 2)]:
        seen = kept(S.observations(snaps[order[0]], order[0]))
        got = kept(S.history_of(seen))
        for d in order[1:]:
            got = kept(S.insert_snapshot(got, seen, snaps[d], d))
            seen = kept(seen.unionByName(S.observations(snaps[d], d)))
        assert sorted(map(str, got.collect())) == want, order


def test_a_large_batch_does_not_ask_every_filter(spark, monkeypatch):
    root = scratch_path(spark, f"large-{uuid.uuid4().hex[:8]}")
    table = os.path.join(root, "t")
    rows = staged_rows(spark, [(f"T{k}", at(k % 30), 1, at(40), at(40)) for k in range(300)]).drop("_loaded_at")
    PT.write_partitioned(rows.withColumn("txn_day", SI.staging_day("day")), table, "txn_day", "transaction_id")
    asked = []
    monkeypatch.setattr(PT, "probe", lambda *a: asked.append(a) or probe(*a))
    large = spark.range(100).select(F.concat(F.lit("T"), F.col("id") * 30).alias("transaction_id"))  # 100 ids x 30 filters
    assert PT.partitions_holding(spark, table, large, "txn_day", "transaction_id") == [at(0).date()] and not asked
    assert PT.partitions_holding(spark, table, large.limit(1), "txn_day", "transaction_id") == [at(0).date()] and len(asked) == 1


def test_a_batch_is_computed_once(spark):
    root = scratch_path(spark, f"once-{uuid.uuid4().hex[:8]}")
    table, seen = os.path.join(root, "t"), spark.sparkContext.accumulator(0)
    target = staged_rows(spark, [(f"T{k}", at(k % 4), 1, at(20), at(20)) for k in range(40)]).drop("_loaded_at")
    PT.write_partitioned(target.withColumn("txn_day", SI.staging_day("day")), table, "txn_day", "transaction_id")

    def count(parts):
        for b in parts:
            seen.add(b.num_rows)
            yield b

    batch = staged_rows(spark, [(f"T{k}", at(k % 4), 2, at(30), at(31)) for k in range(10)])
    SI.merge_staging_table(spark, table, batch.mapInArrow(count, batch.schema), os.path.join(root, "s"))
    assert seen.value == 10
    assert spark.read.parquet(table).where("amount = 2").count() == 10


def test_a_delivery_lands_in_a_bounded_number_of_files(spark):
    path = scratch_path(spark, f"delivery-{uuid.uuid4().hex[:8]}")
    raw = A.raw_transactions(spark, SF_SMALL)
    SI.land_transactions_csv(raw.repartition(30), path)
    assert 0 < len([f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".csv")]) <= 8


def test_keys_are_dense_across_files(spark):
    from ledgerflow.functions.keys import dense_keys
    keyed = dense_keys(spark.range(0, 1000, 1, 7).withColumn("v", F.col("id") * 2), "k", 5)
    assert keyed.columns == ["k", "id", "v"]
    assert [tuple(r) for r in keyed.orderBy("k").collect()] == [(i + 6, i, i * 2) for i in range(1000)]
    assert "ExistingRDD" not in keyed._jdf.queryExecution().toString()  # no row-wise checkpoint
