"""What the layers shuffle, sort, copy and read twice."""

import datetime as dt
import glob
import os
import uuid

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from ledgerflow.functions.columns import mask_card, unmasked_card
from ledgerflow.functions.keys import dense_keys
from ledgerflow.operators import panes as PN
from ledgerflow.operators import staging as ST
from ledgerflow.plans.layers import Layers
from ledgerflow.session import HASHED_JOIN_PARTITION_BYTES, scratch_path
from ledgerflow.sources import adapters as A
from ledgerflow.sources import landing as L

from conftest import SF_SMALL

AS_OF, DAYS = dt.datetime(2024, 1, 10), dt.timedelta(days=30)


def _raw(spark, rows):
    """(id, amount, load day, card, country) as raw transactions."""
    fixed = {"customer_id": "C1", "merchant_id": "M1", "currency": "usd", "transaction_timestamp": "2024-01-01", "status": "Approved",
             "channel": "ATM"}
    data = [tuple({**fixed, "transaction_id": i, "amount": a, "card_number": card, "merchant_country": land}.get(c) for c in L.RAW_TXN_FIELDS)
            + (dt.datetime(2024, 1, day), "f.csv") for i, a, day, card, land in rows]
    return spark.createDataFrame(data, L.RAW_TXN_SCHEMA.simpleString()[7:-1].replace(":", " ") + ", _loaded_at timestamp_ntz, _source_file string")


def test_latest_rows_are_sorted_by_a_hash_of_the_key(spark):
    rows = [(f"TXN_{k % 40}", k) for k in range(120)] + [(None, 500), (None, 501)]
    out = ST.latest_per_key(spark.createDataFrame(rows, "id string, v int"), "id", [F.col("v").desc()])
    assert out.columns == ["id", "v"]
    sorts = [x for x in out._jdf.queryExecution().sparkPlan().toString().splitlines() if "Window [" in x or "WindowGroupLimit [" in x]
    assert sorts and all("_w" in x.split("[")[1].split(",")[0] for x in sorts)  # the hash, an attribute of its own
    assert sorted((r.id or "", r.v) for r in out.collect()) == sorted([(f"TXN_{k % 40}", k) for k in range(80, 120)] + [("", 501)])


def test_derived_columns_come_after_the_dedup(spark):
    raw = _raw(spark, [(" T1 ", "5", 1, "4111-1111-1111-1234", " us"), ("T1", "6", 2, "4111 1111 1111 9999 ", "de"),
                       ("T2", "x", 1, "****1", None), ("T3", None, 1, None, "US"), (None, "1", 1, None, "US")])
    clean = ST.clean_transactions(raw, AS_OF, DAYS)
    plan = clean._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" in plan.split("Window [")[0] and "RLIKE" not in plan.split("Window [")[1]
    got = {r.transaction_id: r for r in clean.collect()}
    assert sorted(got) == ["T1", "T2"] and clean.columns == ST.CLEAN_COLUMNS
    assert (float(got["T1"].amount), got["T1"].card_last_four, got["T1"].is_international, got["T1"].merchant_country) == (6.0, "9999", True, "DE")
    assert got["T1"].card_number.endswith("****9999") and "4111" not in got["T1"].card_number
    assert (got["T2"].amount, got["T2"].card_last_four, got["T2"].is_international, got["T2"].card_number) == (None, "***1"[-4:], False, "****1")


def test_staged_rows_are_not_stored_twice(spark):
    p = Layers(spark, SF_SMALL, run_id=f"costs-{uuid.uuid4().hex[:8]}")
    staged = p.staged()
    assert sorted(os.listdir(p._root())) == ["clean", "raw"]
    stored, refused = ST.stage_transactions(p.clean(), Layers(spark, SF_SMALL).staged().agg(F.max("_staged_at")).first()[0])
    assert staged.count() + refused.count() == p.clean().count()
    assert staged.exceptAll(stored).count() == 0 and stored.exceptAll(staged).count() == 0
    scan = staged.select("merchant_city")._jdf.queryExecution().sparkPlan().toString()
    assert "IsNotNull(amount)" in scan.split("PushedFilters")[1]


def test_merchants_are_aggregated_once(spark):
    p = Layers(spark, SF_SMALL, run_id=f"costs-{uuid.uuid4().hex[:8]}")
    plan = p.build_dim_merchant()._jdf.queryExecution().sparkPlan().toString()
    assert "HashAggregate" not in plan and "Window" not in plan


def test_columns_of_single_values_are_written_without_a_dictionary(spark):
    p = Layers(spark, SF_SMALL, run_id=f"costs-{uuid.uuid4().hex[:8]}")
    p.raw()
    group = pq.ParquetFile(glob.glob(os.path.join(p._root(), "raw", "part-*"))[0]).metadata.row_group(0)
    with_dictionary = {group.column(i).path_in_schema: group.column(i).has_dictionary_page for i in range(group.num_columns)}
    assert not with_dictionary["transaction_id"] and not with_dictionary["auth_code"] and with_dictionary["currency"]


def test_layers_are_stored_with_zstd(spark):
    p = Layers(spark, SF_SMALL, run_id=f"costs-{uuid.uuid4().hex[:8]}")
    p.clean()
    for name in ("raw", "clean"):
        group = pq.ParquetFile(glob.glob(os.path.join(p._root(), name, "part-*"))[0]).metadata.row_group(0)
        assert {group.column(i).compression for i in range(group.num_columns)} == {"ZSTD"}


def test_card_digits_are_taken_without_a_string_a_character(spark):
    cards = ["4111-1111-1111-1234", " 4111 1111 1111 9999 ", "-- 12", "", None, "4111\t111111111", "é-123 4", "----", "1234567890123"]
    df = spark.createDataFrame([(c,) for c in cards], "card string")
    old = F.translate("card", "- ", "")
    masked = (F.when(F.col("card").isNull(), F.lit(None).cast("string"))
              .when(F.length(old) >= 4, F.concat(F.lit("****"), F.right(old, F.lit(4)))).otherwise(F.lit("****")))
    out = df.select(unmasked_card(F.col("card")).alias("open"), mask_card(F.col("card")).alias("masked"))
    assert "translate" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.collect() == df.select(F.coalesce(old.rlike("^[0-9]{13,}$"), F.lit(False)).alias("open"), masked.alias("masked")).collect()


def test_load_times_are_added_without_decimals(spark, tmp_path):
    day = dt.datetime(1996, 2, 28, 23, 59)
    lines = [(1, p, 1, k, 10.5, "N", "O", d) for k, (p, d) in enumerate([(0, day), (86399, day), (200000, day), (None, day), (5, None)])]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_returnflag string, "
                          "l_linestatus string, l_shipdate timestamp_ntz").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, 1)], "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1, 1)], "s_suppkey long, s_nationkey int").write.parquet(str(tmp_path / "supplier.parquet"))
    raw = A.raw_transactions(spark, str(tmp_path))
    assert raw.schema["_loaded_at"].dataType.simpleString() == "timestamp_ntz"
    assert "make_dt_interval" not in raw._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r._loaded_at for r in raw.collect() if r._loaded_at), key=str)
    assert got == [day, day + dt.timedelta(seconds=86399), day + dt.timedelta(seconds=200000)] and raw.count() == 5


def test_ids_of_slices_are_sorted_by_their_hash(spark):
    at = [dt.datetime(2024, 1, d) for d in (1, 1, 2, 3, 2)]
    fact = spark.createDataFrame(list(zip(["T1", "T1", "T1", "T2", None], at)), "transaction_id string, processed_at timestamp_ntz")
    out = PN.build_firsts(fact, dt.timedelta(days=1))
    sorts = [x for x in out._jdf.queryExecution().sparkPlan().toString().splitlines() if "Window [" in x]
    assert sorts and all("_w" in x.split("windowspecdefinition(")[1].split(",")[0] for x in sorts)  # the hash, an attribute of its own
    day = 86_400_000_000
    first = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    assert sorted(tuple(r) for r in out.select("pane", "ids", F.coalesce("previous", F.lit(0))).collect()) == [
        (first, 1, 0), (first + day, 1, first), (first + 2 * day, 1, 0)]


def test_stored_rows_are_numbered_without_a_copy(spark):
    base = scratch_path(spark, f"numbered-{uuid.uuid4().hex[:8]}")
    spark.range(0, 1000, 1, 5).write.parquet(base)
    folders = lambda: {x for x in os.listdir(os.path.dirname(base)) if x.startswith("dense-keys-")}
    before = folders()
    keys = sorted(r.k for r in dense_keys(spark.read.parquet(base), "k", 7, stored=True).collect())
    assert keys == list(range(8, 1008)) and folders() == before


def test_small_join_sides_are_hashed(spark, tmp_path):
    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    try:
        spark.conf.set(key, "1")
        Layers(spark, str(tmp_path))
        assert spark.conf.get(key) == "1"
        spark.conf.unset(key)
        Layers(spark, str(tmp_path))
        assert int(spark.conf.get(key)) == HASHED_JOIN_PARTITION_BYTES
    finally:
        spark.conf.unset(key)
