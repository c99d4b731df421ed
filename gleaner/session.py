"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the operators rely on; everything else is the cluster's choice.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # JSON objects with a repeated key keep the last value instead of failing.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # A page may be about 1 MB, so Arrow batches are kept short.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
    # A listing of many folders is dealt over this many tasks at most; by default nearly every folder is a task of its own.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "96",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "gleaner") -> SparkSession:
    """A local session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="gleaner-"))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # Call-site capture multiplies the cost of building large expressions.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one named in ``spark.checkpoint.dir``.

    Where it is unset, a local master sets one for the session; any other is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local["):  # one process: its folder is shared by all its tasks
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gleaner-"))
        return scratch_dir(spark, label)
    raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
