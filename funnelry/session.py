"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Joins against one-row-per-key tables may meet a key holding a large share of all
    # rows; AQE then splits that key's partition instead of giving it to one task.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles methods above 8000 bytes of bytecode; wide projections over
    # documents exceed that and run faster as several smaller generated methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Re-running a load replaces only the partitions it writes.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


#: Shuffled bytes per reduce task: what an executor core sorts with little spilling.
TASK_BYTES = 512 * 1024**2
#: Beyond this many reduce tasks, shuffle blocks get too small and too many.
MAX_SHUFFLE_PARTITIONS = 100_000


def shuffle_partitions(shuffled_bytes: int) -> int:
    """Reduce tasks for the largest shuffle of a run; AQE merges those that stay small.

    The default of 200 would give each task hundreds of gigabytes of a 100 TB shuffle.
    """
    return min(max(200, -(-shuffled_bytes // TASK_BYTES)), MAX_SHUFFLE_PARTITIONS)


def build_session(
    app: str = "funnelry",
    master: str | None = None,
    shuffled_bytes: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with the settings above; ``extra`` wins over them.

    Give ``shuffled_bytes``, about the size of a run's activities, on large data.
    """
    if shuffled_bytes is not None:
        partitions = str(shuffle_partitions(shuffled_bytes))
        extra = {"spark.sql.shuffle.partitions": partitions, **extra}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
