"""Session helpers: a local session for tests/bench and the shared work folder.

Library code never creates a session; it takes the caller's.  Anything that must
be written (stream checkpoints, keyed tables, lineage cuts) goes under the
folder the cluster names in ``spark.checkpoint.dir``.  Only when that is unset
(local tests) do we pick one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sluice") -> SparkSession:
    """A local session configured the way the tests and bench expect."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.schemaInference", "false")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    dir).  If neither is set, a local session (tests) gets a fresh folder, registered so that
    ``DataFrame.checkpoint()`` uses it too; on a cluster this raises.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not configured:  # local tests only: executors elsewhere could not see this machine's folder
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            configured = tempfile.mkdtemp(prefix="sluice-ckpt-")
        sc.setCheckpointDir(configured)
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared folder (never reused, never cleared)."""
    return "/".join([checkpoint_root(spark), "sluice", *parts, uuid.uuid4().hex])


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme, for the few helpers that list local folders in tests."""
    return path[len("file:"):] if path.startswith("file:") else path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop filesystem, so it works on any store."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


__all__ = ["local_session", "checkpoint_root", "scratch_path", "path_exists", "local_path"]
