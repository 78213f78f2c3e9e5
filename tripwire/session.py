"""Session set-up and the few settings the library reads from it."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library reads from the session (with their defaults).
ROWS_PER_BLOCK_CONF = "tripwire.rowsPerBlock"
DEFAULT_ROWS_PER_BLOCK = 1_000_000
STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
STATE_MEMORY_CONF = "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage"
STATE_MEMORY_MB = "256"  # of RocksDB in an executor, unless the session bounds it
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(cpus: str | int = "*", app: str = "tripwire", shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session with the settings the library expects (tests, bench, examples).

    On a cluster the same settings go into spark-defaults / spark-submit; nothing
    here is needed for correctness except the UTC session zone.
    """
    parts = shuffle_partitions or (8 if cpus == "*" else max(2, int(cpus)))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        # The stateful Python processor talks to the JVM over a socket; keep it a
        # unix socket so no TCP port is opened.
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config(STATE_STORE_CONF, ROCKSDB)
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state in RocksDB, whatever the session's store, in bounded memory for all partitions of an executor.

    ``transformWithStateInPandas`` needs it; Spark's default store has no column families. A query takes the
    session's settings when it starts, so they are put back at once.
    """
    settings = {STATE_STORE_CONF: ROCKSDB, STATE_MEMORY_CONF: "true", STATE_MEMORY_CONF.replace("boundedMemoryUsage", "maxMemoryUsageMB"): STATE_MEMORY_MB}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        if k == STATE_STORE_CONF or before[STATE_MEMORY_CONF] in (None, "false"):
            spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Of jobs within, Spark removes the shuffle files when they end, not when the driver's garbage is collected."""
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP_CONF)
        else:
            spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


def rows_per_block(spark: SparkSession, override: int | None = None) -> int:
    if override is not None:
        return int(override)
    return int(spark.conf.get(ROWS_PER_BLOCK_CONF, str(DEFAULT_ROWS_PER_BLOCK)))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own
    (tests); on a cluster the setting must name shared storage.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tripwire-ckpt-", dir=os.environ.get("TMPDIR", "/tmp")))
    return sc.getCheckpointDir()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, deleted when the driver's JVM ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(jvm_path)
    fs.deleteOnExit(jvm_path)
    return path
