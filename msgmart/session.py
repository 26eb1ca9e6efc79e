"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Wall-clock parsing happens in the session time zone; UTC has no gaps or overlaps.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: str | int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("msgmart")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set a session option for the duration of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """For a query whose answer is all that is needed of it: its shuffle files go when it ends.

    Else they stay until the driver happens to collect its garbage, beside those of the queries after it.
    """
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        yield


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder the cluster names in ``spark.checkpoint.dir``, or
    below the warehouse where that is not set. Both are shared between driver and executors."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
