"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings results depend on: naive times are UTC, a repeated JSON key keeps its last value.
SEMANTIC_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings only speed depends on. Hot keys are split by the adaptive skew join even where that
# costs one more exchange, and bounded dimensions are broadcast by their measured size.
PERFORMANCE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# Only read when a session starts: call sites of column expressions are for debugging, and slow.
STARTUP_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def start(builder: SparkSession.Builder) -> SparkSession:
    """Build a session with every setting of the engine."""
    settings = {**SEMANTIC_SETTINGS, **PERFORMANCE_SETTINGS, **STARTUP_SETTINGS}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built, and return it."""
    for key, value in {**SEMANTIC_SETTINGS, **PERFORMANCE_SETTINGS}.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession, fallback: str) -> str:
    """Shared folder for staged tables: the cluster's checkpoint folder, else `fallback`."""
    configured = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    return f"{configured or fallback}".rstrip("/")
