"""Session set-up shared by jobs, tests and the bench."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings the plans rely on: skewed join partitions and skewed
# write partitions are split at run time, small ones are merged.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM never compiles methods above 8000 bytes of bytecode; wide
    # projections fused into one such method would run interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings; with ``shuffle_bytes``, size shuffles for it.

    The starting number of shuffle partitions aims at 128 MB each. Adaptive
    execution merges the surplus, so a generous estimate costs little, while
    too few partitions would spill.
    """
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    if shuffle_bytes:
        wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shuffle_bytes // (128 << 20))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return spark


def local_session(cores: int | str = "*", app: str = "wageledger", **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # skips recording a call site for every column expression
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="wageledger-"))
    )
    for key, value in {**ADAPTIVE, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
