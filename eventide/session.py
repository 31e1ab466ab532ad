"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from functools import lru_cache

from pyspark.sql import SparkSession

# Settings every analytic relies on: UTC so that TIMESTAMP <-> TIMESTAMP_NTZ
# casts are the identity on wall-clock values, AQE for runtime re-planning
# (partition coalescing, skew-join splitting, broadcast of small join sides
# measured at run time).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a batch's changes are written as they are, not as whole files of the store, and a write does not
    # look its key up only to count the store's rows
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.python.unix.domain.socket.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "eventide", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the cluster's
    session and call :func:`configure` on it."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the library depends on to an existing
    session (session time zone is required for exact NTZ round trips)."""
    ship_package(spark)
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.streaming.stateStore.providerClass",
              "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled",
              "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"):
        try:
            spark.conf.set(k, BASE_CONF[k])
        except Exception:  # noqa: BLE001 - a cluster may pin these
            pass
    return spark


@lru_cache(maxsize=1)
def _package_zip() -> str:
    """The package as a zip file that Spark hands to its Python workers."""
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="eventide-zip-"), "eventide.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    return path


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in Python workers that do not share the
    driver's path (once per application)."""
    sc = spark.sparkContext
    if _SHIPPED.get("app") != sc.applicationId:
        sc.addPyFile(_package_zip())
        _SHIPPED["app"] = sc.applicationId


_SHIPPED: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, streaming checkpoints and drained sink
    output: the cluster's ``spark.checkpoint.dir``.  Where it is unset, a local
    master gets a scratch folder; any other master an error, because its
    executors would each write to a disk of their own."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="eventide-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system that Spark reads exists."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that the library itself wrote below the shared root."""
    if not path.startswith(checkpoint_root(spark)):
        raise ValueError(f"{path} is not below the shared root")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
