"""Metric rows kept over time: a table with one partition for each monitoring run.

A run that is repeated, after a failure or by hand, replaces its own partition and nothing else,
so the history never holds a run twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DAY, RUN = "metric_day", "run_id"


def record_metrics(metrics: DataFrame, table: str) -> int:
    """Append the metric rows of one or more runs, told apart by ``metric_timestamp``; a run that the
    table has already is replaced. Returns the rows written."""
    at = F.col("metric_timestamp")
    keyed = metrics.withColumns({DAY: F.date_format(at, "yyyyMMdd").cast("int"), RUN: F.date_format(at, "HHmmssSSSSSS")})
    written = Observation("metric_rows")
    (keyed.observe(written, F.count(F.lit(1)).alias("rows")).hint("rebalance", F.col(DAY))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, RUN).parquet(table))
    return int(written.get["rows"])


def read_metrics(spark: SparkSession, table: str) -> DataFrame:
    """The history without its partition columns; filters on ``metric_day`` belong before them."""
    return spark.read.parquet(table).drop(DAY, RUN)
