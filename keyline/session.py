"""Session helpers: a local session for tests and benchmarks, and the checkpoint folder."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Byte bound under which a small side table (one row per input split, per file or
# per sorted partition) is broadcast; above it the join falls back to a shuffle.
BROADCAST_BYTES = 64 << 20


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "keyline") -> SparkSession:
    """A ``local[cores]`` session with AQE on and the UI off (tests, benchmarks)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Smaller input splits than the 128 MB default, so that a few GB spread
        # over every local core (several tasks per core for balance).
        .config("spark.sql.files.maxPartitionBytes", os.environ.get("KEYLINE_MAX_PARTITION_BYTES", "32m"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("KEYLINE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def conf_bytes(spark: SparkSession, key: str, default: int) -> int:
    """A byte-size setting (``134217728``, ``128m``, ``1g``) as an integer."""
    raw = spark.conf.get(key, None)
    if raw is None:
        return default
    try:
        return int(raw)
    except ValueError:
        units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
        s = raw.strip().lower().rstrip("b")
        return int(float(s[:-1]) * units[s[-1]]) if s and s[-1] in units else default


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A folder of our own is set only when the setting is unset *and* Spark runs in
    local mode (tests); on a cluster an unset folder is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or S3)")
        conf_dir = tempfile.mkdtemp(prefix="keyline-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in every executor's Python workers, once a context
    (the driver's own import path does not reach executors on other hosts)."""
    sc = spark.sparkContext
    if getattr(sc, "_keyline_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="keyline-package-")
    archive = shutil.make_archive(
        os.path.join(folder, "keyline_package"), "zip", os.path.dirname(package), os.path.basename(package)
    )
    sc.addPyFile(archive)
    sc._keyline_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the checkpoint folder for intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{os.getpid()}-{next(_counter)}"


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage by writing ``df`` to the shared checkpoint folder (eager)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
