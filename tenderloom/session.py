"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Without it shuffle files stay until the driver happens to collect its garbage, those of all steps of a job together.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Adaptive execution sizes shuffle partitions from what the map side really wrote, so the initial
# number is only an upper limit: it is set by the cluster, not by the library.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    FREE_SHUFFLES: "true",
}


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "tenderloom") -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # A refresh compiles more stages than the default cache keeps; recompiled ones run cold.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="run-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
