"""Session helpers: building a local session for tests/bench and resolving the shared checkpoint dir."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session we build carries. On a cluster these come from spark-defaults; the values
# here are what the operators assume: UTC session zone, AQE on (runtime coalescing, skew-join
# splitting, broadcast conversion behind the measured-size threshold).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "murmur", cpus: str | int = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Local session used by tests and bench. Cluster jobs receive their session from the caller."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("MURMUR_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared (HDFS/object-store) folder and is used as is; without it a
    cluster session is an error, as executors would write where no one else reads. Only a local
    session (one machine) gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="murmur-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for a written intermediate table, under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


#: Bytes of an Arrow batch that Python stages over long texts ask for where the session has no setting of its own.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of bounded bytes for Python stages, so that long rows do not add up. Where the session has
    the default it is set to `BATCH_BYTES` and stays so, as a plan reads it when it runs; a session's own value is kept."""
    if spark.conf.get(BATCH) == "67108864b":  # the default
        spark.conf.set(BATCH, str(BATCH_BYTES))
