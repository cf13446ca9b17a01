"""Session helpers and the shared work folder.

Library code never builds its own session: every entry point takes the
caller's ``SparkSession``.  ``local_session`` exists for tests and the bench.

Scratch output (lake roots of the demo queries, checkpoints) always goes below
the folder the cluster names in ``spark.checkpoint.dir``: on a cluster that is
shared storage every executor can read.  Only when the setting is absent (unit
tests on a laptop) do we create a folder of our own and register it.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app_name: str = "lakezones") -> SparkSession:
    """A local session configured like a small cluster (AQE on, UI off)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; a local master without one gets its own, a cluster an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lakezones-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_root(spark: SparkSession) -> str:
    """Base of the shared folder (the configured value, not Spark's per-app subdir)."""
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    return ensure_checkpoint_dir(spark).rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder below the shared root."""
    return f"{shared_root(spark)}/lakezones/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_table(spark: SparkSession, label: str) -> Iterator[str]:
    """A fresh folder of ``scratch_dir`` that is deleted at the end."""
    ensure_checkpoint_dir(spark)
    path = scratch_dir(spark, label)
    try:
        yield path
    finally:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


_INSIDE: WeakKeyDictionary = WeakKeyDictionary()  # session: how many are inside, the caller's own setting
_LOCK = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of every query inside when it ends, as nothing reads them again.

    Several threads of a session may be inside; the caller's setting is back when the last one leaves.
    """
    with _LOCK:
        inside, own = _INSIDE.get(spark) or (0, spark.conf.get(CLEANUP_CONF, "false"))
        _INSIDE[spark] = inside + 1, own
        spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        with _LOCK:
            inside, own = _INSIDE[spark]
            _INSIDE[spark] = inside - 1, own
            if inside == 1:
                del _INSIDE[spark]
                spark.conf.set(CLEANUP_CONF, own)
