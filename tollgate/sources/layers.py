"""The medallion over the driver's tables: bronze (derived) → silver → gold.

Built lazily per (session, sf_dir).  Each property is a DataFrame plan; the
whole chain is one Catalyst plan until a check runs.  For repeated gates over
the same data, ``on_demand()`` writes each table to the shared folder when it is
first asked for and re-reads it (lineage cut, scans prune and push down on
Parquet).
"""
from __future__ import annotations

import hashlib
import threading
from functools import cached_property
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..operators import transform as T
from . import fixtures
from ..session import shared_path

BRONZE = ("bronze_suppliers", "bronze_parts", "bronze_work_orders", "runs")


class Medallion:
    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = T.DEFAULT_AS_OF):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.as_of = as_of

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # bronze -----------------------------------------------------------------
    @cached_property
    def bronze_suppliers(self) -> DataFrame:
        return fixtures.bronze_suppliers(self.spark, self.sf_dir)

    @cached_property
    def bronze_parts(self) -> DataFrame:
        return fixtures.bronze_parts(self.spark, self.sf_dir)

    @cached_property
    def bronze_work_orders(self) -> DataFrame:
        return fixtures.bronze_work_orders(self.spark, self.sf_dir)

    # silver -----------------------------------------------------------------
    @cached_property
    def _suppliers(self) -> T.Promotion:
        return T.promote_suppliers(self.bronze_suppliers, self.as_of)

    @cached_property
    def _parts(self) -> T.Promotion:
        return T.promote_parts(self.bronze_parts, self.silver_suppliers, self.as_of)

    @cached_property
    def _work_orders(self) -> T.Promotion:
        return T.promote_work_orders(self.bronze_work_orders, self.silver_parts, self.as_of)

    @property
    def silver_suppliers(self) -> DataFrame:
        return self._suppliers.promoted

    @property
    def silver_parts(self) -> DataFrame:
        return self._parts.promoted

    @property
    def silver_work_orders(self) -> DataFrame:
        return self._work_orders.promoted

    @property
    def quarantine(self) -> DataFrame:
        """All rejected rows of the three promotions: (table_name, record_id, reject_reason)."""
        from pyspark.sql import functions as F


        q = [(self._suppliers.quarantine, "suppliers", "supplier_id"), (self._parts.quarantine, "parts", "part_id"),
             (self._work_orders.quarantine, "work_orders", "work_order_id")]
        out = None
        for df, name, key in q:
            part = df.select(F.lit(name).alias("table_name"), F.col(key).alias("record_id"), "reject_reason")
            out = part if out is None else out.unionByName(part)
        return out

    # gold -------------------------------------------------------------------
    @cached_property
    def gold_clean(self) -> DataFrame:
        return T.build_gold(self.silver_work_orders, self.silver_parts, self.silver_suppliers, self.as_of)

    @cached_property
    def gold(self) -> DataFrame:
        """The gold table as loaded (build_gold output with seeded drift)."""
        return fixtures.gold_with_drift(self.spark, self.gold_clean)

    @cached_property
    def runs(self) -> DataFrame:
        return fixtures.test_runs(self.spark, self.sf_dir)

    def fingerprint(self) -> str:
        """Identity of the derived layers: each entry of the source folder (name,
        mtime, and the files and bytes at any depth below it, from file-system
        metadata), the as-of date and the derivation code.  Same fingerprint →
        same tables."""
        jvm = self.spark._jvm
        top = jvm.org.apache.hadoop.fs.Path(self.sf_dir)
        fs = top.getFileSystem(self.spark._jsc.hadoopConfiguration())
        h = hashlib.sha1(f"{self.sf_dir.rstrip('/')}|{self.as_of}".encode())
        for entry in sorted(fs.listStatus(top), key=lambda e: e.getPath().getName()):
            below = fs.getContentSummary(entry.getPath())
            h.update(f"{entry.getPath().getName()}|{entry.getModificationTime()}|{below.getLength()}|{below.getFileCount()}".encode())
        here = Path(__file__).resolve().parent
        for src in (here / "fixtures.py", here / "layers.py", here.parent / "operators" / "transform.py",
                    here.parent / "operators" / "skew.py", here.parent / "functions" / "text.py"):
            h.update(src.read_bytes())
        return h.hexdigest()[:20]

    def on_demand(self, root: str | None = None) -> "WrittenMedallion":
        """This medallion served from Parquet tables (shared folder), each written when it is first asked for."""
        home = (root or shared_path(self.spark, "tollgate", "layers", self.fingerprint())).rstrip("/")
        return WrittenMedallion(self, home)

    def materialize(self, root: str | None = None) -> "WrittenMedallion":
        """``on_demand`` with every table written at once."""
        m = self.on_demand(root)
        for name in (*BRONZE, "_suppliers", "_parts", "_work_orders", "gold_clean", "gold"):
            getattr(m, name)
        return m


class WrittenMedallion(Medallion):
    """Every table as Parquet, written on first use from the tables that it is made of, which are written before it.

    Bronze is the landed table, silver and gold the promoted ones — as in production, checks then start from files:
    one scan per table with pushed filters and pruned columns, and a lost executor recomputes from the written layer
    instead of from the sources.  A check of suppliers does not wait for work orders or gold.  A table's marker names
    its finished folder, so other sessions and processes reuse it; each writing session has a folder of its own, so
    concurrent sessions never write into the same one.  Files are as large as the last step's tasks; no shuffle is
    made for their sizes."""

    def __init__(self, source: Medallion, home: str):
        super().__init__(source.spark, source.sf_dir, source.as_of)
        self._source, self._home, self._writing = source, home, threading.RLock()

    def _put(self, name: str, build) -> DataFrame:
        """The table of ``build()``, written once; a finished one is read without building the plan at all."""
        marker = f"{self._home}/{name}/_complete"
        with self._writing:  # concurrent callers wait for one writer
            at = self.spark._jvm.org.apache.hadoop.fs.Path(marker)
            if at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at.suffix("/_SUCCESS")):
                folder = self.spark.read.parquet(marker).first()["folder"]
            else:
                folder = f"{self._home}/{name}/{self.spark.sparkContext.applicationId}"
                build().write.mode("overwrite").parquet(folder)
                self.spark.createDataFrame([(self.sf_dir, folder)], "sf_dir string, folder string").coalesce(1) \
                    .write.mode("overwrite").parquet(marker)
            return self.spark.read.parquet(folder)

    @cached_property
    def bronze_suppliers(self) -> DataFrame:
        return self._put("bronze_suppliers", lambda: self._source.bronze_suppliers)

    @cached_property
    def bronze_parts(self) -> DataFrame:
        return self._put("bronze_parts", lambda: self._source.bronze_parts)

    @cached_property
    def bronze_work_orders(self) -> DataFrame:
        return self._put("bronze_work_orders", lambda: self._source.bronze_work_orders)

    @cached_property
    def runs(self) -> DataFrame:
        return self._put("runs", lambda: self._source.runs)

    @cached_property
    def _suppliers(self) -> T.Promotion:
        return T.Promotion.split(self._put(
            "suppliers_flagged", lambda: T.promote_suppliers(self.bronze_suppliers, self.as_of).flagged))

    @cached_property
    def _parts(self) -> T.Promotion:
        return T.Promotion.split(self._put(
            "parts_flagged", lambda: T.promote_parts(self.bronze_parts, self.silver_suppliers, self.as_of).flagged))

    @cached_property
    def _work_orders(self) -> T.Promotion:
        return T.Promotion.split(self._put(
            "work_orders_flagged", lambda: T.promote_work_orders(self.bronze_work_orders, self.silver_parts, self.as_of).flagged))

    @cached_property
    def gold_clean(self) -> DataFrame:
        return self._put("gold_clean", lambda: T.build_gold(
            self.silver_work_orders, self.silver_parts, self.silver_suppliers, self.as_of))

    @cached_property
    def gold(self) -> DataFrame:
        return self._put("gold_production_metrics", lambda: fixtures.gold_with_drift(self.spark, self.gold_clean))

    def from_landed_bronze(self) -> Medallion:
        """Silver and gold recomputed lazily from this medallion's bronze tables
        (as a promotion job reads the landed bronze in production)."""
        return _Recomputed(self)


class _Recomputed(Medallion):
    def __init__(self, landed: WrittenMedallion):
        super().__init__(landed.spark, landed.sf_dir, landed.as_of)
        self._landed = landed

    bronze_suppliers = property(lambda self: self._landed.bronze_suppliers)
    bronze_parts = property(lambda self: self._landed.bronze_parts)
    bronze_work_orders = property(lambda self: self._landed.bronze_work_orders)
    runs = property(lambda self: self._landed.runs)


_MATERIALIZED: dict[tuple[str, str, str], WrittenMedallion] = {}
_LOCK = threading.Lock()


def materialized(spark: SparkSession, sf_dir: str) -> WrittenMedallion:
    """The written medallion for ``sf_dir`` (each table built on first use, then reused by
    fingerprint, taken at every call — a changed input file or derivation code
    gives a new folder)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), Medallion(spark, sf_dir).fingerprint())
    with _LOCK:  # concurrent callers share one medallion, whose tables have one writer
        if key not in _MATERIALIZED:
            _MATERIALIZED[key] = Medallion(spark, sf_dir).on_demand()
        return _MATERIALIZED[key]
