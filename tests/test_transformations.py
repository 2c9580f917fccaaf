"""Rule examples of the pipeline (currency, mask, group, date key, international flag),
dedup, SCD2 invariants and upsert idempotence."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.columns import (
    category_group, date_key, international_flag, mask_card, minutes_between, usd_amount,
)
from ledgerflow.operators import scd2 as S
from ledgerflow.operators import staging as ST
from ledgerflow.plans.layers import Layers
from ledgerflow.sources import adapters as A

from conftest import SF_SMALL


def one(spark, expr, schema="x string", value=("",)):
    return spark.createDataFrame([value], schema).select(expr.alias("r")).first()["r"]


def test_currency(spark):
    df = spark.createDataFrame([(Decimal("100.00"), "USD"), (Decimal("100.00"), "EUR"), (Decimal("2.675"), "XXX")],
                               "amount decimal(18,2), currency string")
    got = [r[0] for r in df.select(usd_amount(F.col("amount"), F.col("currency"))).collect()]
    assert got == [Decimal("100.00"), Decimal("108.00"), Decimal("2.68")]


def test_mask(spark):
    assert one(spark, mask_card(F.col("x")), value=("4111111111111111",)) == "****1111"
    assert one(spark, mask_card(F.col("x")), value=("41-1",)) == "****"
    assert one(spark, mask_card(F.col("x")), value=("4111-1111 1111-0042",)) == "****0042"


def test_group(spark):
    for cat, grp in [("grocery", "Grocery & Food"), ("supermarket", "Grocery & Food"), ("restaurant", "Dining"),
                     ("retail", "Retail"), ("travel", "Travel"), ("unknown", "Other"), (None, "Other")]:
        assert one(spark, category_group(F.col("x")), value=(cat,)) == grp


def test_date_key_and_flag(spark):
    ts = dt.datetime(2024, 3, 15, 14, 30)
    assert one(spark, date_key(F.col("x")), "x timestamp_ntz", (ts,)) == 20240315
    for c, flag in [("US", False), ("GB", True), ("CA", True), ("DE", True), (None, False), (" us", False)]:
        assert one(spark, international_flag(F.col("x")), value=(c,)) is flag


def test_minute_boundaries(spark):
    a, b = dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 1, 1)
    df = spark.createDataFrame([(a, b)], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(minutes_between(F.col("a"), F.col("b"))).first()[0] == 1


def test_dedup_latest(spark):
    df = spark.createDataFrame([("TXN_001", 100, dt.datetime(2024, 1, 1, 10)), ("TXN_001", 150, dt.datetime(2024, 1, 1, 11)),
                                ("TXN_002", 200, dt.datetime(2024, 1, 1, 10))],
                               "transaction_id string, amount int, loaded_at timestamp_ntz")
    out = {r[0]: r[1] for r in ST.latest_per_key(df, "transaction_id", [F.col("loaded_at").desc()]).collect()}
    assert out == {"TXN_001": 150, "TXN_002": 200}


def test_dedup_plans_group_limit(spark):
    p = Layers(spark, SF_SMALL)
    plan = p.build_clean()._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_scd2_invariants(spark):
    p = Layers(spark, SF_SMALL)
    hist = p.customer_history()
    cur = hist.where("is_current").groupBy("customer_id").count()
    assert cur.where("count > 1").count() == 0
    w = hist.alias("a").join(hist.alias("b"), (F.col("a.customer_id") == F.col("b.customer_id"))
                             & (F.col("a.customer_key") != F.col("b.customer_key"))
                             & (F.col("a.effective_date") <= F.col("b.expiry_date"))
                             & (F.col("b.effective_date") <= F.col("a.expiry_date")))
    assert w.count() == 0, "overlapping validity ranges"
    # re-applying the same snapshot changes nothing
    again = S.scd2_merge(hist, A.raw_customer_snapshot(spark, SF_SMALL, 2), A.CUSTOMER_SNAPSHOT_2)
    assert again.exceptAll(hist).count() == 0 and hist.exceptAll(again).count() == 0
    dim = p.dim_customer()
    assert dim.where("is_current").groupBy("customer_id").count().where("count > 1").count() == 0


def test_scd2_classes_golden(spark):
    p = Layers(spark, "/root/testdata/sf0.01")
    ch = S.classify_changes(p.customer_history_1(), A.raw_customer_snapshot(spark, "/root/testdata/sf0.01", 2))
    got = {r[0]: r[1] for r in ch.groupBy("change_type").count().collect()}
    assert got == {"INSERT": 77, "UPDATE": 390, "NO_CHANGE": 1003}


def test_upsert_idempotent(spark):
    p = Layers(spark, SF_SMALL)
    s2 = p.staged_run2()
    src, _ = ST.stage_transactions(p.clean_run2(), A.TXN_AS_OF, keep_load_time=True)
    again = ST.upsert_staging(s2, src)
    assert again.exceptAll(s2).count() == 0 and s2.exceptAll(again).count() == 0


def test_adapter_golden_sf001(spark):
    p = Layers(spark, "/root/testdata/sf0.01")
    raw = p.raw()
    assert raw.count() == 60000
    clean = p.clean()
    a = clean.agg(F.count(F.lit(1)), F.count("amount"), F.sum("amount"),
                  F.count(F.when(F.col("is_international"), 1))).first()
    assert (a[0], a[1], a[2], a[3]) == (45529, 45330, Decimal("2403385264.62"), 34168)
