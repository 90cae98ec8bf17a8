"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # tasks of 64 MB (the default) leave a little more than one round of long tasks at some sizes, and cores idle in the last round
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL options the operators rely on (all can change at run time)."""
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, or below the warehouse where that is unset.

    Both are folders that driver and executors share; the rule is the same for every master.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Ask for a collection of the driver's garbage, so that Spark removes the shuffle files of finished steps now.

    Spark's cleaner removes them once the driver has collected what refers to them; by itself it asks for that every half hour
    (``spark.cleaner.periodicGC.interval``). To be called after a large step whose result is a written table.
    """
    spark.sparkContext._jvm.System.gc()
