"""Prediction history: a table to which whole batches are added."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmill.sources import snapshots

SCHEMA = "timestamp STRING, text STRING, sentimen STRING, tingkat_keyakinan DOUBLE"


def append_history(df: DataFrame, path: str, batch: str | None = None) -> bool:
    """Add rows with the history columns; a batch whose id is already there adds nothing and gives False."""
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    return snapshots.append(df.select(*columns), path, batch)


def reset_history(spark: SparkSession, path: str) -> None:
    """Leave an empty table behind."""
    snapshots.clear(spark, path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches that were added as a whole."""
    folders = snapshots.batches(spark, path)
    return spark.read.schema(SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], SCHEMA)


def prediction_counts(df: DataFrame, label: str) -> DataFrame:
    """(label, n, share) by falling count."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))  # one row per label
    return counts.withColumn("share", F.round(F.col("n") / total, 6)).orderBy(F.desc("n"), "label")
