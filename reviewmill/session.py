"""Session settings for tests and the local benchmark."""

from __future__ import annotations

from pyspark.sql import SparkSession

from reviewmill.scale import SCAN_PARTITIONS


def local_session(cpus: int = 8, partitions: int | None = None, memory: str = "12g") -> SparkSession:
    session = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("reviewmill")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set(SCAN_PARTITIONS, str(cpus))
    return session
