"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE sizes shuffles at run time, splits skewed join partitions and turns a sort-merge join into a broadcast join
# once a side is measured to be under the threshold, so no operator carries a broadcast hint of its own.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(name: str = "tapelake", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benches; on a cluster pass your own session to ``configure``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for a table a job writes for itself: in the shared folder of the cluster, or in local tests in
    the machine's temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        return tempfile.mkdtemp(prefix=f"tapelake-{name}-")
    return f"{shared.rstrip('/')}/tapelake/{name}-{uuid.uuid4().hex}"
