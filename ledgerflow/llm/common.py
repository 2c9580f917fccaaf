"""Helpers shared by the operators of this folder.

``cut`` writes a table to the shared folder and reads it back: lineage ends there, so a
lost executor costs at most the work since the last cut, and an adaptive plan is not run
twice. The shuffle files of the work go when the table is written, the tables when they are
discarded or the session ends.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import ensure_checkpoint_dir

#: Shuffle files of an execution are removed at its end; a stage that still asks for them runs again.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared checkpoint folder, removed when the session ends."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{spark.sparkContext.applicationId}"
    path = f"{base}/{label}-{uuid.uuid4().hex[:12]}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def cut(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    spark = df.sparkSession
    path = scratch(spark, label)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, df: DataFrame) -> None:
    """Remove the files of a ``cut`` table that no later step reads."""
    for f in {os.path.dirname(x) for x in df.inputFiles()}:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def texts(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text``; a null text counts as empty. Extra columns stay out,
    so their names cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def mix64(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit values (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a plain scan over the cluster's cores when the scan has fewer splits."""
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """Connected components of ``edges(a, b)``: rows ``(id, comp)`` for each id that has an
    edge, ``comp`` the smallest id reachable.

    Each round gives every id the smallest label among its neighbours' labels and then
    that label's own label (pointer jumping), until nothing changes; both group-bys take
    a minimum, so a hub is combined before the shuffle. The rounds grow with the
    logarithm of the longest path in practice.
    """
    spark = edges.sparkSession
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), f"{label}-edges")
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("comp"),
                                                          F.lit(True).alias("moved")), f"{label}-0")
    n = 0
    while labels.where("moved").limit(1).count():
        n += 1
        near = (both.join(labels.select(F.col("id").alias("b"), F.col("comp").alias("theirs")), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("theirs").alias("theirs")))
        best = labels.join(near, "id").select("id", "comp", F.least("comp", "theirs").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("comp").alias("up"))
        step = best.join(jump, "low").select("id", F.least("low", "up").alias("new"), "comp")
        after = cut(step.select("id", F.col("new").alias("comp"), (F.col("new") < F.col("comp")).alias("moved")),
                    f"{label}-{n}")
        discard(spark, labels)
        labels = after
    discard(spark, both)
    return labels.select("id", "comp")
