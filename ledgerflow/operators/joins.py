"""Lookup joins that stay balanced when one key holds a large share of the rows.

By default the lookup is one join, whose skewed partitions adaptive execution splits: the
fact side is evaluated once. Where adaptive skew handling is off, or the dimension side
of the join is itself aggregated in the same stage, a threshold turns on the split below.

A fact-to-dimension lookup on a natural key shuffles both sides by the key; a key with
a third of the facts would put a third of the data into one join task. The split
lookup first finds the hot keys with one aggregate (map-side partial counts; at most
``rows / hot_rows`` keys can pass, so the result is bounded), joins the facts of hot
keys to their (equally bounded) dimension rows by broadcast, with no shuffle of the hot
rows at all, and joins the remaining facts by the ordinary shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more rows than one healthy join task should receive.
HOT_KEY_ROWS = 5_000_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows (at most ``rows / hot_rows`` of them)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows).select(key)


def lookup_join(facts: DataFrame, dim: DataFrame, key: str, how: str = "left",
                hot_rows: int | None = None) -> DataFrame:
    """``facts.join(dim, key, how)`` for a dimension with one row per key, split by
    hot keys. ``hot_rows=None`` leaves the split to AQE's skew-join handling."""
    if hot_rows is None:
        return facts.join(dim, key, how)
    hot = F.broadcast(hot_keys(facts, key, hot_rows))
    hot_facts = facts.join(hot, key, "left_semi")
    cold_facts = facts.join(hot, key, "left_anti")
    hot_dim = F.broadcast(dim.join(hot, key, "left_semi"))
    return hot_facts.join(hot_dim, key, how).unionByName(cold_facts.join(dim, key, how))
