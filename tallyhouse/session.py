"""Session settings the reports rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Runtime settings. Broadcasts are left to Catalyst and AQE, which compare a
# known size with the threshold and fall back to shuffled joins beyond it.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where a later step wants the same partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Long texts: what goes to Python at once is bounded by bytes and rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session the caller already has."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cpus: int | str = "*", app: str = "tallyhouse", memory: str | None = None, shared: str | None = None
) -> SparkSession:
    """A single-machine session for tests and the benchmark; ``shared`` is the folder for stages."""
    partitions = str(os.cpu_count() or 8) if cpus == "*" else str(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.session.timeZone", "UTC")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    return tune(builder.getOrCreate())
