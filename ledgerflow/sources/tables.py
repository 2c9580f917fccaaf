"""Reading the input tables: Parquet directories, projected and filtered early so that
Catalyst pushes both into the scan."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan that arrives in fewer partitions than the cluster has cores (a
    small file with one row group is one split) before string-heavy projections.
    On real inputs the scan already has many splits and this adds nothing. Only for
    plain scans: asking an adaptive plan with shuffles for its partition count would
    run those shuffles."""
    par = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(par) if df.rdd.getNumPartitions() < par else df
