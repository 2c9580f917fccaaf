"""The batch pipeline over the adapted driver tables, layer by layer.

Like the warehouse it replaces, the pipeline keeps its layers as tables: raw, staging,
history, dimensions and fact are written once per session as Parquet under the shared
checkpoint folder and read back by every later step. A query then runs its own
operator over its input tables (``build_*``), not the whole lineage from the driver's
tables. Layer writes survive lost executors (they are files on shared storage) and cut
the lineage of later jobs.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os
import threading
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.columns import ts_lit
from ledgerflow.functions.slices import in_slices
from ledgerflow.operators import facts as FA
from ledgerflow.operators import merchant as M
from ledgerflow.operators import scd2 as S
from ledgerflow.operators import staging as ST
from ledgerflow.session import path_exists, scratch_path, store, use_layer_splits
from ledgerflow.sources import adapters as A

FULL = dt.timedelta(days=A.TXN_FULL_LOOKBACK_DAYS)
METRIC_WINDOW = dt.timedelta(days=A.TXN_METRIC_LOOKBACK_DAYS)

_LOCK = threading.RLock()
_SIGNATURES: dict = {}
_CODE_VERSION: str | None = None


def code_version() -> str:
    """Hash of the library source, so stored layers of an older version are not reused."""
    global _CODE_VERSION
    if _CODE_VERSION is None:
        h = hashlib.sha1()
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        for d, _, files in sorted(os.walk(root)):
            for f in sorted(files):
                if f.endswith(".py"):
                    with open(os.path.join(d, f), "rb") as fh:
                        h.update(fh.read())
        _CODE_VERSION = h.hexdigest()[:12]
    return _CODE_VERSION


def _publish(spark: SparkSession, tmp: str, path: str) -> None:
    sc = spark.sparkContext
    jp = sc._jvm.org.apache.hadoop.fs.Path
    src, dst = jp(tmp), jp(path)
    fs = dst.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(dst.getParent())
    if fs.exists(dst) or not fs.rename(src, dst):
        fs.delete(src, True)  # another builder published first


class Layers:
    """Layers of one scenario over ``sf_dir``; ``materialize=False`` keeps every layer a
    lazy plan (used by tests that inspect whole plans)."""

    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True, run_id: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialize = materialize
        # one folder per application: a session never reads layers that another one built
        self.run_id = run_id or spark.sparkContext.applicationId
        use_layer_splits(spark)

    # --- layer storage ------------------------------------------------------------------
    def _input_signature(self) -> str:
        """Path, size and modification time of every input file (Hadoop FS listing), so
        stored layers are reused only for unchanged inputs."""
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(self.sf_dir)
        fs = p.getFileSystem(sc._jsc.hadoopConfiguration())
        h = hashlib.sha1(self.sf_dir.encode())
        it = fs.listFiles(p, True)
        entries = []
        while it.hasNext():
            st = it.next()
            entries.append(f"{st.getPath().toString()}|{st.getLen()}|{st.getModificationTime()}")
        for e in sorted(entries):
            h.update(e.encode())
        return h.hexdigest()[:10]

    def _root(self) -> str:
        key = _SIGNATURES.get((self.sf_dir, id(self.spark)))
        if key is None:
            key = _SIGNATURES[(self.sf_dir, id(self.spark))] = self._input_signature()
        return scratch_path(self.spark, os.path.join(f"layers-{self.run_id}", f"{key}-{code_version()}"))

    def table(self, name: str, build: Callable[[], DataFrame | Iterable[DataFrame]]) -> DataFrame:
        """The layer ``name``; ``build`` gives its rows, or parts of them that are written in turn."""
        if not self.materialize:
            return build()
        path = os.path.join(self._root(), name)
        with _LOCK:
            if not path_exists(self.spark, os.path.join(path, "_SUCCESS")):
                rows = build()
                # write aside, then publish with one rename: a reader never sees a
                # half-written layer, and of two concurrent builders one wins
                tmp = f"{path}.tmp-{uuid.uuid4().hex[:12]}"
                for df in [rows] if isinstance(rows, DataFrame) else rows:
                    store(df, tmp, mode="append")
                _publish(self.spark, tmp, path)
        return self.spark.read.parquet(path)

    def layer_names(self) -> list[str]:
        return ["event_lines", "raw", "clean", "staged", "staging_rejects", "customer_history_1", "customer_history", "dim_customer_1", "dim_customer",
                "dim_merchant", "fact", "staged_run1", "batch_run2", "staged_run2", "dim_merchant_run1", "dim_merchant_run2",
                "fact_run1"]

    # --- event messages (the landing layer of the event path) -----------------------
    def event_lines(self) -> DataFrame:
        return self.table("event_lines", lambda: A.event_lines(self.spark, self.sf_dir))

    # --- transactions, single run ---------------------------------------------------
    def raw(self) -> DataFrame:
        return self.table("raw", lambda: A.raw_transactions(self.spark, self.sf_dir))

    def build_clean(self) -> DataFrame:
        return ST.clean_transactions(self.raw(), A.TXN_AS_OF, FULL)

    def clean(self) -> DataFrame:
        """The cleaned, deduplicated batch (with its raw card number) before the reject
        split: what the data-quality checks inspect."""
        return self.table("clean", self.build_clean)

    def staged_and_rejects(self):
        return ST.stage_transactions(self.clean(), A.TXN_AS_OF)

    def build_staged(self) -> DataFrame:
        return self.staged_and_rejects()[0]

    def staged(self) -> DataFrame:
        """A view of the cleaned rows, which are stored: a second copy of nearly all of them would be
        written and read for a filter and two fixed columns."""
        return self.build_staged()

    def staging_rejects(self) -> DataFrame:
        return self.table("staging_rejects", lambda: self.staged_and_rejects()[1])

    # --- customers ------------------------------------------------------------------
    def build_customer_history_1(self) -> DataFrame:
        return S.scd2_merge(S.empty_history(self.spark), A.raw_customer_snapshot(self.spark, self.sf_dir, 1),
                            A.CUSTOMER_SNAPSHOT_1)

    def customer_history_1(self) -> DataFrame:
        return self.table("customer_history_1", self.build_customer_history_1)

    def build_customer_history(self) -> DataFrame:
        return S.scd2_merge(self.customer_history_1(), A.raw_customer_snapshot(self.spark, self.sf_dir, 2),
                            A.CUSTOMER_SNAPSHOT_2)

    def customer_history(self) -> DataFrame:
        return self.table("customer_history", self.build_customer_history)

    def dim_customer_1(self) -> DataFrame:
        return self.table("dim_customer_1", lambda: S.load_dim_customer(
            FA.unknown_customer(self.spark), self.customer_history_1(), A.CUSTOMER_SNAPSHOT_1))

    def build_dim_customer(self) -> DataFrame:
        return S.load_dim_customer(self.dim_customer_1(), self.customer_history(), A.CUSTOMER_SNAPSHOT_2)

    def dim_customer(self) -> DataFrame:
        return self.table("dim_customer", self.build_dim_customer)

    # --- merchants, facts -----------------------------------------------------------
    def build_dim_merchant(self) -> DataFrame:
        # stored first: adding the unknown member looks for it among the merchants, and would
        # aggregate the staged rows a second time
        d = self.table("merchants", lambda: M.build_dim_merchant(self.staged(), A.TXN_AS_OF))
        return FA.ensure_unknown_member(d, FA.unknown_merchant(d), "merchant_key")

    def dim_merchant(self) -> DataFrame:
        return self.table("dim_merchant", self.build_dim_merchant)

    def build_fact(self) -> DataFrame:
        staged = self.staged()
        return FA.load_fact(staged, self.dim_customer(), self.dim_merchant(), A.TXN_AS_OF, FULL,
                            processed_at=A.simulated_processed_at(staged))

    def fact(self) -> DataFrame:
        return self.table("fact", self.build_fact)

    # --- transactions, two incremental runs ----------------------------------------
    def staged_run1(self) -> DataFrame:
        def build():
            raw1 = self.raw().where(F.col("_loaded_at") < ts_lit(A.TXN_RUN1_AS_OF))
            clean1 = ST.clean_transactions(raw1, A.TXN_RUN1_AS_OF, FULL)
            return ST.stage_transactions(clean1, A.TXN_RUN1_AS_OF)[0]
        return self.table("staged_run1", build)

    def clean_run2(self) -> DataFrame:
        return ST.clean_transactions(self.raw(), A.TXN_AS_OF, A.TXN_AS_OF - A.TXN_RUN1_AS_OF)

    def batch_run2(self) -> DataFrame:
        """Run 2's staged batch, with its load times: read by the upserts of staging and fact."""
        return self.table("batch_run2", lambda: ST.stage_transactions(self.clean_run2(), A.TXN_AS_OF, keep_load_time=True)[0])

    def build_staged_run2(self) -> DataFrame:
        """Staging after run 2: run-1 staging upserted with run 2's batch."""
        return ST.upsert_staging(self.staged_run1(), self.batch_run2())

    def staged_run2(self) -> DataFrame:
        if not self.materialize:
            return self.build_staged_run2()
        return self.table("staged_run2", lambda: (ST.upsert_staging(t, s) for t, s in in_slices(
            [self.staged_run1(), self.batch_run2()], "transaction_id", os.path.join(self._root(), "staged_run2.slices"))))

    def dim_merchant_run1(self) -> DataFrame:
        def build():
            d = self.table("merchants_run1", lambda: M.build_dim_merchant(self.staged_run1(), A.TXN_RUN1_AS_OF))
            return FA.ensure_unknown_member(d, FA.unknown_merchant(d), "merchant_key")
        return self.table("dim_merchant_run1", build)

    def build_dim_merchant_run2(self) -> DataFrame:
        stats = M.merchant_batch_stats(self.staged_run2(), since=A.TXN_RUN1_AS_OF)
        return M.upsert_dim_merchant(self.dim_merchant_run1(), stats, A.TXN_AS_OF)

    def dim_merchant_run2(self) -> DataFrame:
        return self.table("dim_merchant_run2", self.build_dim_merchant_run2)

    def fact_run1(self) -> DataFrame:
        def build():
            s1 = self.staged_run1()
            return FA.load_fact(s1, self.dim_customer(), self.dim_merchant_run1(), A.TXN_RUN1_AS_OF, FULL,
                                processed_at=A.simulated_processed_at(s1))
        return self.table("fact_run1", build)

    def fact_run2_new(self) -> DataFrame:
        """Run 2's fact load: rows staged in the window and not yet in the fact."""
        s2 = self.staged_run2()
        return FA.load_fact(s2, self.dim_customer(), self.dim_merchant_run2(), A.TXN_AS_OF,
                            A.TXN_AS_OF - A.TXN_RUN1_AS_OF, existing_fact=self.fact_run1(),
                            processed_at=A.simulated_processed_at(s2))
