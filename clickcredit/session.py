"""SparkSession with the settings the plans are designed for.

On a cluster the session usually exists already and is used as it is.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM never compiles a method of more than 8000 bytes, and the fused enrichment is one.
    # Above this limit Spark generates a method for each step instead, which is compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, app_name: str = "clickcredit",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build or reuse a session; local runs get the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
