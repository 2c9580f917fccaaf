"""How much a task holds, sorts and computes: splits of the layers, plans without sorts of all rows,
payloads and keys parsed once a row, compressed landing files."""

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from ledgerflow.operators import events as E
from ledgerflow.operators import panes as PN
from ledgerflow.plans.layers import Layers
from ledgerflow.session import LAYER_SPLIT_BYTES, scratch_path
from ledgerflow.sources import generators as G
from ledgerflow.sources import landing as L

SPLIT = "spark.sql.files.maxPartitionBytes"


def test_layers_are_read_in_small_splits_unless_the_job_says_otherwise(spark, tmp_path):
    before = spark.conf.get(SPLIT, None)
    try:
        spark.conf.unset(SPLIT)
        Layers(spark, str(tmp_path))
        assert spark.conf.get(SPLIT) == str(LAYER_SPLIT_BYTES)
        spark.conf.set(SPLIT, "1000000")
        Layers(spark, str(tmp_path))
        assert spark.conf.get(SPLIT) == "1000000"
    finally:
        spark.conf.set(SPLIT, before) if before else spark.conf.unset(SPLIT)


def test_slices_are_hashed_before_anything_is_sorted(spark):
    at = dt.datetime(2024, 1, 1, 5)
    fact = spark.range(6).select(
        F.lit(at).cast("timestamp_ntz").alias("processed_at"), F.lit(at).cast("timestamp_ntz").alias("transaction_timestamp"),
        F.lit(1).cast("long").alias("customer_key"), F.lit(1).cast("long").alias("merchant_key"),
        F.when(F.col("id") > 0, F.col("id")).cast("decimal(18,2)").alias("amount"),
        F.when(F.col("id") > 0, F.col("id")).cast("decimal(18,2)").alias("amount_usd"),
        F.when(F.col("id") > 1, F.concat(F.lit("b"), F.col("id") % 2)).alias("_batch_id"))
    out = PN.build_slices(fact, dt.timedelta(days=1))
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan.splitlines()[-3] and plan.count("HashAggregate") >= 2
    r = out.collect()
    assert len(r) == 1 and (r[0].n, r[0].null_amounts, r[0].batch_id, r[0].usd_rows, float(r[0].usd_sum)) == (6, 1, "b1", 5, 15.0)


def test_a_filter_on_the_outcome_does_not_parse_again(spark):
    lines = spark.createDataFrame([(1, '{"transaction_id":"T1"}')], "event_id int, line string")
    _, bad = E.split(E.validate(E.unwrap(lines)))
    plan = bad._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("$.amount") == 1 and plan.count("json_object_keys") <= 2
    assert bad.count() == 1


def test_generator_writes_the_key_text_once(spark):
    base = spark.createDataFrame([(1, 2, None)], "a int, b int, c int")
    out = G.generate_transactions(base, ["a", "b", "c"], dt.datetime(2024, 1, 1))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("coalesce(cast(a") == 1
    assert out.count() == 1


def test_json_landing_files_are_compressed(spark):
    path = scratch_path(spark, f"json-{uuid.uuid4().hex[:8]}")
    raw = spark.createDataFrame([tuple(f"{c}{k}" for c in L.RAW_TXN_FIELDS) for k in range(20)], L.RAW_TXN_SCHEMA)
    L.write_landing_json_array(raw, path, rows_per_array=7)
    names = [f for f in os.listdir(path) if f.startswith("part-")]
    assert names and all(f.endswith(".gz") for f in names)
    assert L.read_landing_json(spark, path).select(*L.RAW_TXN_FIELDS).exceptAll(raw).count() == 0
    assert L.read_landing_json(spark, path).count() == 20
