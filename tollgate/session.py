"""Session helpers: sane defaults for local runs, shared checkpoint folder."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "tollgate", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench.  On a cluster, use the cluster's
    session as is: the library never sets cluster-level options itself."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TOLLGATE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_OWN_DIRS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    A cluster names a shared (distributed) folder in ``spark.checkpoint.dir``;
    that is used as is.  Only when it is unset (local tests) do we pick a folder
    of our own — through ``SparkContext.setCheckpointDir``, because the config
    itself cannot be changed on a running session.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    own = _OWN_DIRS.setdefault(sc.applicationId, tempfile.mkdtemp(prefix="tollgate-ckpt-", dir="/tmp"))
    sc.setCheckpointDir(own)
    return own


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (used for written tables that cut lineage)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])
