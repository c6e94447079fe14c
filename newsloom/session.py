"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SHARED = "spark.checkpoint.dir"

# Correctness: dates are UTC days.  Scale: adaptive execution coalesces small
# shuffle partitions and splits skewed ones in joins.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the SQL settings above on a session that somebody else made."""
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, name: str = "newsloom", **settings: str) -> SparkSession:
    """A single-machine session, for tests and the bench only.

    Where no shared folder is set it gets a temporary one: there is a single
    machine to see it.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**SQL_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get(SHARED, None):
        spark.conf.set(SHARED, tempfile.mkdtemp(prefix=f"{name}-"))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``."""
    configured = spark.conf.get(SHARED, None)
    if not configured:
        raise ValueError(f"set {SHARED} to a folder all executors share")
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/newsloom/{name}-{uuid.uuid4().hex}"
