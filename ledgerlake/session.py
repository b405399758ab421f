"""Session construction and the shared scratch folder.

Library code never changes the caller's session beyond what is listed here;
``build_session`` is for tests, benches and command-line jobs.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python call-site capture costs several JVM round trips per Column function
    # call while a plan is being built; jobs here build large validation trees.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str = "local[8]", app: str = "ledgerlake",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared file system folder and
    is used as is. Only a local master (tests) gets a fresh temporary folder when
    it is unset: executors on other machines could not see one, so a cluster
    session without the setting raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def share_package(spark: SparkSession) -> None:
    """Send this package to the executors once per SparkContext, for the few jobs whose
    Python classes run there (stateful processors, data sources)."""
    sc = spark.sparkContext
    if getattr(sc, "_ledgerlake_shared", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerlake-pkg-"), "ledgerlake_shared.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("ledgerlake", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._ledgerlake_shared = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerlake-scratch/{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def open_writers(spark: SparkSession, n: int):
    """Within, a task that writes to at most ``n`` partition folders keeps a file open in each instead
    of sorting its rows by folder first (with more folders it sorts the rest). The session's own setting is put back."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def materialized(df, name: str):
    """``df`` written once as a Parquet table in the shared folder and read back:
    every consumer, and every re-run of a lost task, sees the same rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
