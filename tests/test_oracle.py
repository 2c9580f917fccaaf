"""Every query with an oracle equals its DuckDB statement (rows, columns, values) on
the sf0.001 tables; the heavier pipeline keys also at sf0.01."""

import pytest

from conftest import SF_ORACLE, SF_SMALL
from oracle_harness import compare
from ledgerflow.plans.oracle import ORACLE
from ledgerflow.plans.queries import QUERIES

KEYS = sorted(ORACLE)
AT_SF001 = ["star_rollup", "stage_clean", "fact_load", "dim_customer_load", "stage_upsert", "dq_all",
            "event_validate", "quality_metrics", "sla_throughput", "fact_load_incremental", "dim_merchant_upsert"]


@pytest.mark.parametrize("key", KEYS)
def test_oracle_small(spark, duck_small, key):
    r = compare(QUERIES[key](spark, SF_SMALL), duck_small, ORACLE[key])
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


@pytest.mark.parametrize("key", AT_SF001)
def test_oracle_sf001(spark, duck_oracle, key):
    r = compare(QUERIES[key](spark, SF_ORACLE), duck_oracle, ORACLE[key])
    assert r["columns_match"] and r["values_match"] and r["spark_rows"] == r["oracle_rows"], r


def test_every_oracle_key_is_a_query():
    assert set(ORACLE) <= set(QUERIES)


SPARK_TO_DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "timestamp_ntz": "TIMESTAMP",
                 "date": "DATE", "boolean": "BOOLEAN", "double": "DOUBLE", "array<string>": "VARCHAR[]",
                 "array<bigint>": "BIGINT[]"}


@pytest.mark.parametrize("key", KEYS)
def test_oracle_types(spark, duck_small, key):
    df = QUERIES[key](spark, SF_SMALL)
    got = {f.name: (f.dataType.simpleString().upper() if f.dataType.simpleString().startswith("decimal")
                    else SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()))
           for f in df.schema.fields}
    rel = duck_small.sql(f"SELECT * FROM ({ORACLE[key]}) q LIMIT 0")
    want = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    assert got == want
