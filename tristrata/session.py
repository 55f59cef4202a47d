"""Session construction with the settings the package relies on."""

from pyspark.sql import SparkSession

# Results depend only on the time zone; the others are the engine's own skew and size handling.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}


def get_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    """Return the active session or build one.

    Cluster sizing (executors, memory, shuffle partitions, spark.checkpoint.dir) belongs to
    the deployment and is passed through ``extra`` or spark-defaults, never fixed here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
