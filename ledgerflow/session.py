"""Spark session settings that the jobs rely on."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job assumes. On a cluster they come from the job submission;
# ``get_session`` only fills in what is unset.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast is decided by Spark from measured or estimated size, never by hint
    # on data that grows; 32 MB keeps broadcast tables well inside executor memory.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Stored layers are strings that Parquet packs some seventeen times smaller than Spark's rows: a
# split of the default 128 MB is more than 2 GB of rows, and a task that sorts or groups
# them spills. Splits and row groups of these sizes keep a task at some hundred MB.
LAYER_SPLIT_BYTES, LAYER_ROW_GROUP_BYTES = 24 * 1024 * 1024, 12 * 1024 * 1024


# Nearly every row has a value of its own in these columns: a dictionary of them is built, found too
# large and thrown away, row group after row group, at a third of the time of a layer's write.
NO_DICTIONARY = {f"parquet.enable.dictionary#{c}": "false"
                 for c in ("transaction_id", "customer_id", "amount", "auth_code", "_loaded_at")}

# Layers are mostly codes and ids that share their beginnings: zstd stores them in a quarter to a third
# fewer bytes than the default, in the same time.
LAYER_COMPRESSION = "zstd"

#: How transactions are stored, in layers, tables and scratch folders alike.
STORED = {"parquet.block.size": str(LAYER_ROW_GROUP_BYTES), "compression": LAYER_COMPRESSION, **NO_DICTIONARY}

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# A join side whose shuffle partitions are all at most this large is hashed, and the wide rows of the
# other side are not sorted for the join. (Not below the advisory partition size, 64 MB, as
# Spark then leaves it out.)
HASHED_JOIN_PARTITION_BYTES = 64 * 1024 * 1024


def use_layer_splits(spark: SparkSession) -> None:
    """Read in splits of ``LAYER_SPLIT_BYTES`` and hash small join sides where the job's submission
    sets no sizes."""
    for key, size in (("spark.sql.files.maxPartitionBytes", LAYER_SPLIT_BYTES),
                      ("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", HASHED_JOIN_PARTITION_BYTES)):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, str(size))


def get_session(master: str | None = None, app: str = "ledgerflow", shuffle_partitions: int | None = None,
                driver_memory: str | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if driver_memory:
        # only effective when this call starts the JVM (local runs, tests, bench)
        builder = builder.config("spark.driver.memory", driver_memory)
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; only when it is unset on a local master (tests)
    is a private scratch folder chosen. Executors on other machines could not see such a
    folder, so any other master without the setting is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="ledgerflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for intermediate tables, under the shared checkpoint folder; its first part is
    removed when the session ends."""
    base = ensure_checkpoint_dir(spark)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(base, name.split(os.sep)[0]))
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return os.path.join(base, name)


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query run inside are removed as it ends, not when the driver happens to
    collect garbage: rows take several times as much room there as in Parquet."""
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def store(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: tuple[str, ...] = ()) -> None:
    """Write ``df`` as Parquet the way layers are stored; its shuffle files go."""
    with released_shuffles(df.sparkSession):
        df.write.mode(mode).options(**STORED).partitionBy(*partition_by).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop file system of the path (local, HDFS, object
    stores alike), as a cluster job must not use the driver's local disk."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def path_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a folder, 0 where there is none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the Hadoop file system of its path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
