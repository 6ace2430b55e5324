"""Session settings and the shared scratch area.

Everything the library writes on its own account (stream feeds, checkpoints,
staging tables, keyed tables made by the registered queries) goes under one
shared folder. On a cluster that folder is the one named by
``spark.checkpoint.dir``; the library only picks its own (a fresh ``mktemp``
folder) when the session has none, as in local tests.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library relies on or recommends. Time handling assumes UTC
# (the test tables store naive UTC timestamps); AQE re-plans joins at run
# time, coalesces small shuffle partitions and splits skewed join partitions.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

MB = 1 << 20


def scale_conf(cores: int, shuffle_bytes: int, target_bytes: int = 256 * MB,
               scan_bytes: int = 256 * MB) -> dict[str, str]:
    """Partition sizing for a cluster of ``cores`` task slots whose largest
    shuffle (after map-side partial aggregation) is about ``shuffle_bytes``.

    * ``spark.sql.shuffle.partitions``: enough partitions that each holds
      about ``target_bytes`` (so a reducer's hash table or sort buffer fits
      in its share of executor memory without spilling much), and at least
      two waves of the cluster's slots. AQE coalesces the small ones of
      lighter stages, so over-provisioning costs little.
    * ``spark.sql.adaptive.advisoryPartitionSizeInBytes``: the same target
      for coalescing and for splitting skewed join partitions.
    * ``spark.sql.files.maxPartitionBytes``: scan splits of ``scan_bytes``;
      large parquet files are read by several tasks (one per row group range).
    * skew join: a partition 5× the median and over 2 × target is split.

    Example: 100 TB scanned, 20 TB shuffled, 8000 cores -> 81920 partitions
    of ~256 MB. Streaming state partitions are fixed separately, at a
    query's first start (see ``streaming.runner.start``).
    """
    n = max(2 * cores, math.ceil(shuffle_bytes / target_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.files.maxPartitionBytes": str(scan_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_bytes),
    }



def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tideline", extra: dict | None = None) -> SparkSession:
    """A session with the recommended settings (tests, bench, examples)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         .config("spark.sql.warehouse.dir", _local_scratch("warehouse")))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume (UTC session zone)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]):
    """Session settings for the duration of a block, restored after it.

    For settings a write depends on but a per-write option does not reach
    (e.g. ``insertInto`` ignores ``partitionOverwriteMode``), so the result
    does not depend on how the caller built the session. The setting is
    session-wide while the block runs: threads that write concurrently
    through ``insertInto`` should each use their own ``spark.newSession()``
    (path writes also pass the option, which takes precedence).
    """
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield spark
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# Overwrite modes are set per write (never left to the session): partition
# replacement is dynamic, full rebuilds and single-batch staging are static.
DYNAMIC_OVERWRITE = {"spark.sql.sources.partitionOverwriteMode": "dynamic"}


_LOCAL_ROOT: str | None = None


def _local_scratch(name: str) -> str:
    global _LOCAL_ROOT
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = tempfile.mkdtemp(prefix="tideline-")
    path = os.path.join(_LOCAL_ROOT, name)
    os.makedirs(path, exist_ok=True)
    return path


def shared_root(spark: SparkSession) -> str:
    """The shared folder for library-owned data: ``spark.checkpoint.dir``.

    Read from the session; when unset (local runs) a fresh local folder is
    created and registered as the checkpoint dir, so ``DataFrame.checkpoint``
    and our own staging agree.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext._jsc.sc()
    except Exception:  # remote session: no JVM context here
        pass
    if not root and sc is not None and sc.getCheckpointDir().isDefined():
        root = sc.getCheckpointDir().get()
    if not root:
        master = spark.conf.get("spark.master", "local")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_scratch("checkpoints")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and not sc.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def workdir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared root (never reused)."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"
