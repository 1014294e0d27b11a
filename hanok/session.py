"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings. Shuffle width is left to the cluster: adaptive execution
# coalesces small shuffles and splits skewed ones, so no count is pinned here.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Writes replace only the partitions they carry.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MILLIS",
}

# Settings a session can only be started with.
START_SETTINGS = {
    "spark.ui.enabled": "false",
    # Every column call would otherwise send its call site to the JVM; plans here are long.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else started."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """Start (or reuse) a session; ``extra`` takes further settings with ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**START_SETTINGS, **RUNTIME_SETTINGS}.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("_", "."), value)
    return configure(builder.getOrCreate())


def shared_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The folder the cluster names for checkpoints; ``fallback`` only where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if fallback is None:
        raise ValueError("spark.checkpoint.dir is not set and no fallback was given")
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback
