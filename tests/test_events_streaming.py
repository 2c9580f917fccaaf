"""Event path: the demo scenarios and hand-made envelopes; streaming equals batch;
rows-only keys checked against their batch counterparts."""

import json
import os
import uuid

from pyspark.sql import functions as F

from ledgerflow.operators import events as E
from ledgerflow.plans.queries import QUERIES
from ledgerflow.session import scratch_path
from ledgerflow.streaming import ingest as SI

from conftest import SF_SMALL

def now():
    return F.lit("2024-05-01 10:30:00").cast("timestamp_ntz")


def validated(spark, lines):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "event_id long, line string")
    return E.validate(E.unwrap(df))


def test_demo_scenarios(spark):
    card = {"transaction_id": "TXN_DEMO_1", "customer_id": "C1", "merchant_id": "M1", "amount": 42.5,
            "currency": "usd", "timestamp": "2024-01-01T00:00:00", "card_number": "4111 1111 1111 1234"}
    batch = [dict(card, transaction_id=f"TXN_B{i}") for i in range(50)]
    for b in batch:
        b.pop("card_number")
    lines = [json.dumps(card), json.dumps({"body": json.dumps(batch)}),
             json.dumps(dict(card, amount=-100)), json.dumps(dict(card, currency="FAKE"))]
    v = validated(spark, lines)
    errs = {r["event_id"]: r["_error"] for r in v.where("_error IS NOT NULL").collect()}
    assert v.where("_error IS NULL").count() == 51
    assert errs[2].startswith("Invalid amount: -100") and errs[3] == "Invalid currency: FAKE"
    acc, _ = E.split(v)
    en = E.enrich(acc, F.lit("2024-01-01").cast("timestamp_ntz"))
    b = en.where("event_id = 1").select("status", "channel").distinct().collect()
    assert [tuple(r) for r in b] == [("pending", "unknown")]
    assert en.where("event_id = 0").first()["card_number"] == "****1234"


def test_envelopes(spark):
    p = {"transaction_id": "TXN_1", "customer_id": "C", "merchant_id": "M", "amount": "12.50", "currency": "EUR",
         "timestamp": "t", "status": None}
    lines = [json.dumps(p),                                       # bare
             json.dumps({"body": p}),                             # body object
             json.dumps({"body": json.dumps(p)}),                 # body JSON text
             json.dumps({"body": [p, p]}),                        # body list
             json.dumps({"detail": p}),                           # detail
             json.dumps({"Records": [{"body": json.dumps(p)}, {"body": json.dumps([p, p])}]}),
             json.dumps([p, p]),                                  # bare list
             json.dumps({}),                                      # nothing
             "{not json"]                                         # malformed
    v = validated(spark, lines)
    per = {r[0]: r[1] for r in v.groupBy("event_id").count().collect()}
    assert per == {0: 1, 1: 1, 2: 1, 3: 2, 4: 1, 5: 3, 6: 2, 8: 1}
    bad = v.where("_error IS NOT NULL").collect()
    assert [r["event_id"] for r in bad] == [8]                    # present-but-null status passes
    missing = validated(spark, [json.dumps({"transaction_id": "TXN_9", "amount": 1})]).first()["_error"]
    assert missing == "Missing required fields: currency, customer_id, merchant_id, timestamp"


def test_summary_first_ten(spark):
    lines = [json.dumps({"transaction_id": "X", "customer_id": "C", "merchant_id": "M", "amount": 1,
                         "currency": "USD", "timestamp": "t"}) for _ in range(25)]
    s = E.batch_summary(validated(spark, lines), ["event_id", "event_pos"]).first()
    assert (s["processed"], s["failed"], len(s["first_errors"])) == (0, 25, 10)


def test_stream_equals_batch(spark):
    streamed = QUERIES["stream_incremental_ingest"](spark, SF_SMALL)
    batch = QUERIES["event_enrich"](spark, SF_SMALL)
    cols = ["transaction_id", "amount", "currency", "status", "channel", "card_number", "extra"]
    assert streamed.count() == batch.count()
    assert streamed.select(cols).exceptAll(batch.select(cols)).count() == 0


def test_stream_load_once(spark):
    root = scratch_path(spark, f"t-{uuid.uuid4().hex[:8]}")
    src, out, ck = (os.path.join(root, x) for x in ("in", "out", "ck"))
    from ledgerflow.sources import adapters as A
    lines = A.event_lines(spark, SF_SMALL)
    SI.land_messages(lines, src)
    SI.ingest_events(spark, src, out, ck, now())
    n1 = spark.read.parquet(os.path.join(out, "accepted")).count()
    SI.ingest_events(spark, src, out, ck, now())   # restart, no new files
    assert spark.read.parquet(os.path.join(out, "accepted")).count() == n1


def test_stream_volumes_equal_batch_and_count_a_repeated_batch_once(spark):
    from ledgerflow.plans.layers import Layers
    root = scratch_path(spark, f"t-{uuid.uuid4().hex[:8]}")
    src, out, ck, table = (os.path.join(root, x) for x in ("in", "out", "ck", "volumes"))
    assert SI.stream_volumes(spark, table).collect() == []
    SI.land_messages(Layers(spark, SF_SMALL).event_lines(), src)
    SI.ingest_events(spark, src, out, ck, now(), max_files_per_trigger=1, volumes=table)
    got = {r.layer: r.records for r in SI.stream_volumes(spark, table).groupBy("layer").agg(F.sum("records").alias("records")).collect()}
    kept = {x: spark.read.parquet(os.path.join(out, x)).count() for x in ("accepted", "rejects")}
    assert got == {"received": sum(kept.values()), "accepted": kept["accepted"], "rejected": kept["rejects"]}
    # a batch that is run again replaces its own counts
    before = sorted(map(tuple, SI.stream_volumes(spark, table).collect()))
    again = spark.read.parquet(os.path.join(table, "_batch=0"))
    SI._write_batch(spark.createDataFrame(again.collect(), again.schema), table, 0)
    assert sorted(map(tuple, SI.stream_volumes(spark, table).collect())) == before


def test_stream_dedup_matches_distinct(spark):
    deduped = QUERIES["stream_dedup"](spark, SF_SMALL)
    batch = QUERIES["event_enrich"](spark, SF_SMALL)
    assert deduped.count() == batch.select("transaction_id").distinct().count()
    assert deduped.groupBy("transaction_id").count().where("count > 1").count() == 0


def test_late_rows_side_table(spark):
    late = QUERIES["late_rows"](spark, SF_SMALL)
    assert late.count() > 0
    assert late.where(~F.col("transaction_id").startswith("LATE_")).count() == 0


def test_rows_only_keys(spark):
    from ledgerflow.plans.layers import Layers
    p = Layers(spark, SF_SMALL)
    n_raw = p.raw().count()
    csv = QUERIES["ingest_csv"](spark, SF_SMALL)
    assert csv.count() == n_raw and csv.where("_rejected").count() == 0
    assert QUERIES["ingest_json"](spark, SF_SMALL).count() == n_raw
    bl = QUERIES["bulk_load_modes"](spark, SF_SMALL)
    n = p.staged().count()
    assert bl.count() == n and bl.first()["_rows_written"] == [n, n, n]
    fl = QUERIES["fact_layout"](spark, SF_SMALL)
    assert fl.count() == p.fact().count()
    gt = QUERIES["generate_transactions"](spark, SF_SMALL)
    a = gt.agg(F.count(F.lit(1)), F.min(F.col("amount").cast("double")), F.max(F.col("amount").cast("double")),
               F.count_distinct("transaction_id")).first()
    assert a[0] == a[3] and a[1] >= 5.0 and a[2] <= 10000.0
    gc = QUERIES["generate_customers"](spark, SF_SMALL).toPandas()
    assert len(gc) > 0 and gc.customer_id.is_unique and gc.phone.str.fullmatch(r"\+1\d{10}").all()
    dq = QUERIES["dq_missing_columns"](spark, SF_SMALL)
    assert dq.where("success").count() < 15


def test_corrupt_csv_rows_are_kept(spark):
    from ledgerflow.sources import landing as L
    path = scratch_path(spark, f"csv-{uuid.uuid4().hex[:8]}")
    os.makedirs(path)
    header = ",".join(L.RAW_TXN_FIELDS)
    with open(os.path.join(path, "transactions_1.csv"), "w") as f:
        f.write(header + "\n")
        f.write(",".join(["T1", "C", "M", "1.00", "USD", "2024-01-01", "approved", "online", "visa", "****1",
                          "grocery", "X", "US", "00", "A1"]) + "\n")
        f.write(",".join(["T2", "NULL", "null", "", "USD"] + ["x"] * 10 + ["extra"]) + "\n")
    with open(os.path.join(path, "other.txt"), "w") as f:
        f.write("ignored\n")
    df = L.read_landing_csv(spark, path)
    good, bad = L.split_corrupt(df)
    assert good.count() == 1 and bad.count() == 1
    r = bad.first()
    assert r["customer_id"] is None and r["merchant_id"] is None and r["amount"] is None
    assert bad.select("_corrupt").first()[0].startswith("T2,NULL,null")


def test_fact_dense_keys_append(spark):
    from ledgerflow.plans.layers import Layers
    from ledgerflow.sources import sinks as SK
    fact = Layers(spark, SF_SMALL).fact()
    path = scratch_path(spark, f"fact-{uuid.uuid4().hex[:8]}")
    half1 = fact.where(F.col("transaction_date_key") < 19980101)
    half2 = fact.where(F.col("transaction_date_key") >= 19980101)
    n1 = SK.write_fact(half1, path, mode="append")
    n2 = SK.write_fact(half2, path, mode="append")
    t = spark.read.parquet(path)
    a = t.agg(F.min("transaction_key"), F.max("transaction_key"), F.count_distinct("transaction_key"),
              F.count(F.lit(1))).first()
    assert (a[0], a[1], a[2], a[3]) == (1, n1 + n2, n1 + n2, n1 + n2)
    assert t.where(F.col("transaction_date_key") >= 19980101).agg(F.min("transaction_key")).first()[0] == n1 + 1


def test_stream_sliding_windows_equal_batch(spark):
    from ledgerflow.plans.layers import Layers
    root = scratch_path(spark, f"win-{uuid.uuid4().hex[:8]}")
    src, out, ck = (os.path.join(root, x) for x in ("in", "out", "ck"))
    SI.land_messages(Layers(spark, SF_SMALL).event_lines(), src)
    SI.windowed_event_metrics(spark, src, out, ck, delay="4000 days")
    streamed, batch = SI.latest_windows(spark, out), QUERIES["sliding_metrics"](spark, SF_SMALL)
    assert streamed.count() == batch.count() > 0
    assert streamed.exceptAll(batch.select(streamed.columns)).count() == 0


# --- streams: no row lost, whatever the files ------------------------------------------------------

def event(k, **more):
    return json.dumps({"transaction_id": f"TXN_{k}", "customer_id": "C", "merchant_id": "M", "amount": "1.50", "currency": "usd",
                       "timestamp": f"2024-01-{1 + k % 28:02d}T00:00:00", "card_number": f"4111-1111-1111-{1000 + k}", **more})


def land(spark, lines, path, files):
    SI.land_messages(spark.createDataFrame([(x,) for x in lines], "line string").repartition(files), path)


def folders(spark, name):
    root = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")
    return [os.path.join(root, x) for x in ("in", "out", "ck")]


LINES = ([event(k) for k in range(60)] + [event(k, amount="2.00") for k in range(0, 60, 3)]
         + [event(99, timestamp=None), event(98, timestamp="soon"), event(97, currency="FAKE"), "{broken 4111 1111 1111 1234"])


def test_dedup_does_not_depend_on_files(spark):
    for files, per_trigger in ((1, None), (4, 1), (16, 3)):
        src, out, ck = folders(spark, "dedup")
        land(spark, LINES, src, files)
        SI.dedup_events(spark, src, out, ck, now(), per_trigger)
        land(spark, LINES[:20], src, files)   # late copies, weeks behind
        SI.dedup_events(spark, src, out, ck, now(), per_trigger)
        ids = sorted(r.transaction_id for r in spark.read.parquet(out).select("transaction_id").collect())
        assert ids == sorted({f"TXN_{k}" for k in [*range(60), 98, 99]})
        assert spark.read.parquet(f"{out}_rejects").count() == 2


def test_late_split_keeps_every_row(spark):
    import datetime as dt
    for files in (1, 4, 16):
        src, out, ck = folders(spark, "late")
        land(spark, [event(27)], src, 1)
        SI.late_event_split(spark, src, out, ck, dt.timedelta(days=5), now())
        land(spark, LINES, src, files)
        SI.late_event_split(spark, src, out, ck, dt.timedelta(days=5), now())
        late, fine = (spark.read.parquet(os.path.join(out, x)) for x in ("late", "on_time"))
        assert late.count() + fine.count() + spark.read.parquet(os.path.join(out, "rejects")).count() == len(LINES) + 1
        assert late.where("event_time IS NULL").count() == 0 and fine.where("event_time IS NULL").count() == 2
        assert late.agg(F.max("event_time")).first()[0] < dt.datetime(2024, 1, 23) <= fine.agg(F.min("event_time")).first()[0]


def test_batch_that_runs_twice_writes_the_same(spark):
    src, out, ck = folders(spark, "twice")
    land(spark, LINES, src, 1)
    SI.dedup_events(spark, src, out, ck, now())
    # a batch looks at earlier batches only, so its second attempt does not see its first
    assert SI.earlier_batches(spark, out, 0) is None
    assert SI.earlier_batches(spark, out, 1).count() == spark.read.parquet(out).count()


def test_no_card_number_is_stored(spark):
    src, out, ck = folders(spark, "cards")
    lines = LINES + [event(96, amount="abc", pan="4111111111111111"), event(95, note="paid with 5500 0000 0000 0004")]
    land(spark, lines, src, 2)
    SI.ingest_events(spark, src, out, ck, now())
    SI.dedup_events(spark, src, f"{out}-d", f"{ck}-d", now())
    from ledgerflow.plans.layers import Layers
    tables = [spark.read.parquet(os.path.join(out, x)) for x in ("accepted", "rejects")]
    tables += [spark.read.parquet(f"{out}-d"), spark.read.parquet(f"{out}-d_rejects"), Layers(spark, SF_SMALL).clean(),
               Layers(spark, SF_SMALL).staged(), Layers(spark, SF_SMALL).staging_rejects()]
    for t in tables:
        for c, kind in t.dtypes:
            if kind == "string" and c != "_request_id":
                assert t.where(F.regexp_replace(c, "[ -]", "").rlike(r"\d{13}")).count() == 0, c
    rejected = tables[1].where(F.col("event").contains("TXN_96")).first()
    assert "****1111" in rejected.event and rejected.timestamp is not None
    note = tables[0].where("transaction_id = 'TXN_95'").first()
    assert json.loads(note.extra) == {"note": "paid with ****0004"}


CSV_ROW = "{id},C1,M1,{amount},USD,{ts},approved,online,visa,4111111111111111,grocery,X,US,00,A1,{loaded}"


def stage(spark, rows, files, src, table, ck, **more):
    from ledgerflow.sources import landing as L
    os.makedirs(src, exist_ok=True)
    header = ",".join([*L.RAW_TXN_FIELDS, "_loaded_at"])
    for k in range(files):
        with open(os.path.join(src, f"transactions_{uuid.uuid4().hex[:6]}_{k}.csv"), "w") as f:
            f.write("\n".join([header, *rows[k::files]]) + "\n")
    import datetime as dt
    SI.stage_landing_stream(spark, src, table, ck, f"{table}-scratch", f"{table}-rejects", dt.timedelta(days=4000),
                            as_of_of_batch=lambda _: dt.datetime(2024, 6, 1), **more)


def test_staging_stream_does_not_depend_on_files(spark):
    rows = [CSV_ROW.format(id=f"T{k}", amount=amount, ts=f"2024-01-0{1 + k % 3}T00:00:00", loaded=f"2024-02-01T00:00:{load:02d}")
            for k in range(9) for load, amount in ((1, "1.00"), (3, "3.00"), (2, "2.00"), (4, "broken" if k == 4 else "4.00"))]
    rows.append("T9,too,few")
    for files, per_trigger in ((1, None), (4, 1), (6, 2)):
        src, table, ck = folders(spark, "stage")
        stage(spark, rows, files, src, table, ck, max_files_per_trigger=per_trigger)
        got = {r.transaction_id: float(r.amount) for r in spark.read.parquet(table).collect()}
        assert got == {f"T{k}": 3.0 if k == 4 else 4.0 for k in range(9)}
        refused = spark.read.parquet(f"{table}-rejects/staging")
        assert [r.transaction_id for r in refused.collect()] == ["T4"]
        assert spark.read.parquet(f"{table}-rejects/landing").count() == 1
        assert not os.path.exists(f"{table}-scratch") or os.listdir(f"{table}-scratch") == []


def test_staging_writes_only_touched_days(spark):
    row = lambda k, day, load: CSV_ROW.format(id=f"T{k}", amount="1.00", ts=f"2024-01-{day:02d}T00:00:00", loaded=f"2024-02-01T00:00:{load:02d}")
    src, table, ck = folders(spark, "days")
    stage(spark, [row(1, 1, 1), row(2, 2, 1), row(3, 3, 1)], 1, src, table, ck)
    files = lambda day: set(os.listdir(f"{table}/txn_day=2024-01-{day:02d}"))
    before = files(1), files(2)
    stage(spark, [row(3, 4, 2), row(4, 2, 2)], 1, src, table, ck)
    assert files(1) == before[0] and files(2) != before[1]
    assert not os.path.exists(f"{table}/txn_day=2024-01-03")   # its only id moved to another day
    got = {r.transaction_id: r.txn_day.day for r in spark.read.parquet(table).collect()}
    assert got == {"T1": 1, "T2": 2, "T3": 4, "T4": 2}


def test_landing_csv_cases(spark):
    from ledgerflow.sources import landing as L
    path = scratch_path(spark, f"csv-{uuid.uuid4().hex[:8]}")
    os.makedirs(path)
    cells = ["C", "M", "1.00", "USD", "2024-01-01", "approved", "online", "visa", "****1", "grocery"]
    with open(os.path.join(path, "daily_transactions_1.csv"), "w") as f:
        f.write("\ufeff" + ",".join(f'"{c}"' for c in L.RAW_TXN_FIELDS) + "\n")
        f.write(",".join(["T1", *cells, '"New\nYork"', "US", "00", "A1"]) + "\n")
    with open(os.path.join(path, "customers_1.csv"), "w") as f:
        f.write(",".join(L.CUSTOMER_FIELDS) + "\nC1,A,B,NULL,1,2,3,4,US,5,gold,2020-01-01\n")
    good, bad = L.split_corrupt(L.read_landing_csv(spark, path))
    assert [(r.transaction_id, r.merchant_city) for r in good.collect()] == [("T1", "New\nYork")] and bad.count() == 0
    c = L.read_landing_customers(spark, path).collect()
    assert [(r.customer_id, r.email, r.customer_tier) for r in c] == [("C1", None, "gold")]


def test_hot_hour_is_spread(spark):
    from ledgerflow.sources import sinks as SK
    hot = spark.range(60_000).select(F.concat(*[F.md5(F.concat(F.col("id").cast("string"), F.lit(str(k)))) for k in range(6)]).alias("v"),
                                     F.when(F.col("id") % 3 == 0, F.lit("2024-01-01 05:10:00")).otherwise(
                                         F.concat(F.lit("2024-01-02 "), F.lpad((F.col("id") % 24).cast("string"), 2, "0"), F.lit(":00:00")))
                                     .cast("timestamp_ntz").alias("_ingested_at"))
    path = scratch_path(spark, f"hot-{uuid.uuid4().hex[:8]}")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        SK.write_event_batches(hot, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    parts = [f for f in os.listdir(f"{path}/year=2024/month=1/day=1/hour=5") if f.startswith("part-")]
    assert len(parts) > 1 and SK.read_event_batches(spark, path).count() == 60_000


def test_retention_keeps_rows_without_a_load_time(spark):
    import datetime as dt
    from ledgerflow.sources import sinks as SK
    path = scratch_path(spark, f"ret-{uuid.uuid4().hex[:8]}")
    df = spark.createDataFrame([(1, dt.datetime(2020, 1, 1)), (2, None), (3, dt.datetime(2024, 1, 1))], "id int, t timestamp_ntz")
    SK.write_by_day(df, path, "t")
    assert SK.drop_partitions_before(spark, path, dt.date(2023, 1, 1)) == 1
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 3]


def test_generators_have_distinct_ids(spark):
    gc = QUERIES["generate_customers"](spark, "/root/testdata/sf0.1").toPandas()
    assert len(gc) == gc.customer_id.nunique() > 10_000 and gc.notna().all().all()
