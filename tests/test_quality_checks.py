"""The 15 checks on the reference's own test frames (expected values derived by
reading the check code, see FIXTURES.md 1.2-1.3)."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from ledgerflow.operators import quality as Q

AS_OF = dt.datetime(2024, 3, 15, 12, 0, 0)
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                       ["transaction_id", "customer_id", "merchant_id"]]
                      + [T.StructField("amount", T.DoubleType())]
                      + [T.StructField(c, T.StringType()) for c in
                         ["currency", "status", "channel", "transaction_timestamp", "card_number"]])


def _ts(delta):
    return (AS_OF + delta).isoformat()


def dirty(spark):
    h = dt.timedelta(hours=1)
    rows = [
        ("TXN_001", "CUST_01", "MERCH_01", 100.00, "USD", "approved", "online", _ts(-h), "4111111111111111"),
        ("TXN_001", "CUST_02", None, -50.00, "INVALID", "declined", "BAD_CHANNEL", _ts(dt.timedelta(days=5)),
         "****1234"),
        ("TXN_003", None, "MERCH_03", 2000000.00, "EUR", "INVALID_STATUS", "in_store", _ts(-2 * h),
         "XXXX-XXXX-XXXX-5678"),
        (None, "CUST_04", "MERCH_04", 0.00, "USD", "pending", "mobile", _ts(-3 * h), "****9999"),
        ("TXN_005", "CUST_05", "MERCH_05", 250.00, "XYZ", "approved", "online", _ts(-h / 2), "****0000"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def clean(spark, n=100):
    rnd = random.Random(7)
    rows = [(f"TXN_{i:06d}", f"CUST_{rnd.randint(1, 20):02d}", f"MERCH_{rnd.randint(1, 10):02d}",
             round(rnd.uniform(1, 5000), 2), rnd.choice(["USD", "EUR", "GBP", "CAD"]),
             rnd.choice(["approved", "declined", "pending"]), rnd.choice(["online", "in_store", "mobile"]),
             _ts(-dt.timedelta(minutes=rnd.randint(1, 54)))) for i in range(n)]
    return spark.createDataFrame(rows, T.StructType(SCHEMA.fields[:-1]))


def results(df):
    return {r["check_id"]: r for r in Q.run_checks(df, AS_OF).collect()}


def test_dirty_frame_golden(spark):
    r = results(dirty(spark))
    assert len(r) == 15
    expected = {1: (False, "0.8"), 2: (False, "0.6"), 3: (False, "0.4"), 4: (False, "0.8"), 5: (False, "0.6"),
                6: (False, "0.8"), 7: (False, "0"), 8: (False, "0.8"), 9: (False, "0.8"), 10: (True, "1"),
                11: (True, "1"), 12: (False, "5"), 13: (True, "1"), 14: (False, "0.8"), 15: (False, "0")}
    for cid, (ok, value) in expected.items():
        assert r[cid]["success"] is ok, (cid, r[cid])
        assert r[cid]["metric_value"] == Decimal(value), (cid, r[cid])
    assert sum(1 for x in r.values() if x["success"]) == 3


def test_clean_frame_all_pass(spark):
    r = results(clean(spark))
    assert len(r) == 15
    assert all(x["success"] for x in r.values()), [x for x in r.values() if not x["success"]]
    assert r[15]["details"] == "No card column - N/A"


def test_empty_frame_no_rows(spark):
    assert Q.run_checks(clean(spark).limit(0), AS_OF).count() == 0


def test_missing_columns(spark):
    r = results(clean(spark).select("transaction_id", "amount"))
    assert len(r) == 15
    assert r[11]["success"] is False and r[11]["metric_value"] == Decimal("0.285714")
    for cid in (5, 6, 7, 8, 9, 13, 14):
        assert r[cid]["success"] is False and r[cid]["metric_value"] == 0, r[cid]


def test_low_volume(spark):
    r = results(clean(spark).limit(1))
    assert r[12]["success"] is False and r[12]["metric_value"] == 1


def test_summary_and_score(spark):
    res = Q.run_checks(dirty(spark), AS_OF)
    s = Q.check_summary(res).first()
    assert (s["passed"], s["failed"], s["status"]) == (3, 12, "WARNING")
    assert s["failed_checks"] == sorted(s["failed_checks"])
    q = Q.quality_score(res).first()
    assert q["quality_score"] == Decimal("20.0000") and q["band"] == "red"


def test_checks_are_one_scan(spark):
    plan = Q.run_checks(clean(spark), AS_OF)._jdf.queryExecution().executedPlan().toString()
    # one narrow scan for each of the two distinct counts, one for all else, no tripled rows
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") <= 3 and "Expand" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


@pytest.mark.parametrize("value,expected", [("4111-1111-1111-1111", 1), ("****1111", 0), ("4111 1111 1111", 0),
                                            ("1234 5678 9012 3", 1)])
def test_card_rule(spark, value, expected):
    df = spark.createDataFrame([("T1", value)], "transaction_id string, card_number string")
    r = {x["check_id"]: x for x in Q.run_checks(df, AS_OF, [15]).collect()}
    assert r[15]["success"] is (expected == 0)
