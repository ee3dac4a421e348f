"""Session helpers: the local test session and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python state access and workers over Unix domain sockets, not TCP ports.
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # commit a per-batch changelog instead of a full state snapshot
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # delete a checkpointed intermediate once nothing references it
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "sensorium") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    b = b.config("spark.driver.memory", "16g")
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of this session.

    Uses ``spark.checkpoint.dir`` as the cluster names it. Only a local
    session without that setting gets a fresh temporary folder; a cluster
    session without it is an error, since executors must share the folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
    elif _is_local(spark):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="sensorium-ckpt-"))
    else:
        raise RuntimeError("spark.checkpoint.dir is not set; a cluster needs a shared folder")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/sensorium-{tag}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the Python workers of every executor,
    whatever their working directory: zip it once per application and add it
    with ``addPyFile`` (what ``--py-files`` does at submit time)."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    parent = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="sensorium-pyfiles-"), "sensorium.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, parent))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)
