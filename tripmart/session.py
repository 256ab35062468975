"""Session construction and the shared work folder.

On a cluster the work folder is the shared checkpoint directory the cluster
names in ``spark.checkpoint.dir``; we only pick our own (a fresh temp folder)
when nothing is configured and the master is local (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(app: str = "tripmart", master: str | None = None,
                shuffle_partitions: int | None = None,
                driver_memory: str | None = None) -> SparkSession:
    """Session with AQE on and the UI off. ``master`` and ``driver_memory`` are
    only set when given (in local mode the driver heap is the executor heap)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(sc) -> bool:
    return sc.master == "local" or sc.master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    Order: the context's checkpoint folder, then ``spark.checkpoint.dir`` from
    the session conf, then - on a local master only - a fresh temp folder. On a
    cluster without a configured folder this raises: a machine-local one would
    be written by each executor on its own disk and read back short.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a remote session without a local context
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        if sc is not None:
            sc.setCheckpointDir(conf_dir)
            return sc.getCheckpointDir()
        return conf_dir
    if sc is None or not _is_local(sc):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tripmart-ckpt-"))
    return sc.getCheckpointDir()


def work_dir(spark: SparkSession, name: str = "work") -> str:
    """A fresh, uniquely named folder under the shared checkpoint folder.

    Stage tables, manifests and sink outputs go here, so every executor (and
    a re-run after executor loss) sees the same files. Created on whatever file
    system it lives on; without a local context the writers create it.
    """
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote session
        return path
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).mkdirs(p)
    return path


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds a table: any entry not starting with '_' or '.'."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return False
        return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p))
    except Exception:  # noqa: BLE001 - no local context
        local = path.replace("file:", "", 1)
        return os.path.isdir(local) and any(not n.startswith(("_", ".")) for n in os.listdir(local))


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, on whatever file system it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return sorted(st.getPath().toString() for st in found or [])
