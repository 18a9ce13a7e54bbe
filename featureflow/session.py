"""Session helpers: one place for the settings every job relies on.

Cluster deployments pass their own settings through ``spark-submit``; the
builder below only fills in what a local run (tests, bench) needs.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library's plans are written against.  ANSI mode stays on
# (Spark 4 default): bad casts go through ``try_cast`` explicitly.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files of small intermediate tables are removed once unused
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app: str = "featureflow", master: str | None = None,
                shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` and ``shuffle_partitions`` are only applied when given; on a
    cluster they come from the submit command.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """``name`` set to ``value`` for the block, then as it was."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and points to shared storage.
    Only when it is unset (local tests) do we create one and register it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root and sc is not None and not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root:
        # spark.checkpoint.dir is a static setting: register the folder with
        # the context instead (tests and local runs only)
        root = tempfile.mkdtemp(prefix="featureflow-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    # make DataFrame.checkpoint() usable as well
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext of a classic session (None for a remote session)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions have no local context
        return None


_SCRATCH: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the shared checkpoint folder; removed when the application ends."""
    root = f"{checkpoint_root(spark)}/featureflow"
    sc = _context(spark)
    if sc is None:
        return root
    root = f"{root}/{sc.applicationId}"
    if root not in _SCRATCH:
        path = sc._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _SCRATCH.add(root)
    return root


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh path under the shared checkpoint folder (never a machine-local tmp).

    For what is read back within the application: it goes with the application.
    """
    root = scratch_root(spark)
    leaf = "/".join(p.strip("/") for p in parts if p)
    if unique:
        leaf = f"{leaf}-{uuid.uuid4().hex[:12]}" if leaf else uuid.uuid4().hex[:12]
    return f"{root}/{leaf}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
