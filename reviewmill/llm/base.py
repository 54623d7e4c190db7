"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.scale import hot_cold_join, materialize

#: ASCII capitals and their small letters, for rules that lower-case A-Z and nothing else.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it from there."""
    return materialize(df)


def row_key(id_column: str, text_column: str) -> list[Column]:
    """``_id`` and ``_fp``: rows that agree in both are the same document written twice."""
    return [F.col(id_column).alias("_id"), F.xxhash64(F.col(text_column)).alias("_fp")]


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """The join condition on ``_id`` (which may be null) and ``_fp``."""
    return left["_id"].eqNullSafe(right["_id"]) & (left["_fp"] == right["_fp"])


def utf8(value: str | None) -> bytes:
    """UTF-8 bytes of a text; no bytes for a missing one."""
    return b"" if value is None else value.encode("utf-8", "surrogatepass")


def slices(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items of about ``most`` units each, at least one item long."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(lengths):
        yield start, len(lengths)


def weighted_rank(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Number the rows of ``df`` from 0 in the given order, without one task that sees them all.

    Rows are range-partitioned and written; a row's number is its place in its
    range plus the sizes of the ranges before. Only one count per range is
    broadcast.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(
        df.repartitionByRange(n, *[F.col(c).asc_nulls_last() for c in order]).withColumn("_range", F.spark_partition_id())
    )
    return number_within(ranged, "_range", order, name)


def number_within(df: DataFrame, bucket: str, order: list[str], name: str) -> DataFrame:
    """Number the rows over all buckets: bucket after bucket, in the given order inside each."""
    from pyspark.sql import Window

    sizes = df.groupBy(bucket).agg(F.count("*").alias("_n"))
    before = sizes.select(
        bucket, (F.sum("_n").over(Window.orderBy(bucket)) - F.col("_n")).alias("_before")
    )  # one row per range of the shuffle
    inside = Window.partitionBy(bucket).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return (
        df.withColumn("_place", F.row_number().over(inside) - 1)
        .join(F.broadcast(before), bucket)
        .withColumn(name, (F.col("_before") + F.col("_place")).cast("long"))
        .drop("_place", "_before", bucket)
    )


def named_by_smallest(placed: DataFrame) -> DataFrame:
    """``placed`` with ``first``, the smallest ``_id`` of each ``root``; a row without a root is named by itself.

    Rows without a root are not shuffled, and those of a root with many rows stay
    where they are. ``placed`` is a stored table.
    """
    linked = placed.filter("root IS NOT NULL")
    roots = stored(linked.groupBy("root").agg(F.min("_id").alias("first"), F.count("*").alias("rows")))
    named = hot_cold_join(linked, roots.select("root", "first"), "root", roots, "rows")
    return named.unionByName(placed.filter("root IS NULL").withColumn("first", F.col("_id")))


class Links(NamedTuple):
    """Column names of a table of links."""

    left: str = "a"
    right: str = "b"


def components(links: DataFrame, names: Links = Links()) -> DataFrame:
    """(node, root): the smallest node that each linked node can reach.

    Every round hooks each node to its smallest neighbour, follows the hooks to
    their ends, and contracts the links to those ends, until no link is left.
    Hooks only point to smaller nodes, so they hold no cycle and the smallest
    node of a component is never hooked. Each step is an aggregate or an
    equi-join on stored tables; nothing is collected. Loops, repeated links and
    either direction are fine; an empty table gives an empty result.
    """
    edges = stored(
        links.select(F.col(names.left).alias("a"), F.col(names.right).alias("b"))
        .filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = nodes.withColumn("root", F.col("node"))
    while not edges.isEmpty():
        hooks = _follow(stored(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up"))))
        up = hooks.select(F.col("node").alias("_node"), "up")
        labels = labels.join(up, labels["root"] == up["_node"], "left").select("node", F.coalesce("up", "root").alias("root"))
        left = edges.join(up, edges["a"] == up["_node"], "left").select(F.coalesce("up", "a").alias("a"), "b")
        edges = stored(
            left.join(up, left["b"] == up["_node"], "left")
            .select("a", F.coalesce("up", "b").alias("b"))
            .filter("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct()
        )
    return labels


def _follow(hooks: DataFrame) -> DataFrame:
    """Replace each node's hook by the end of its chain, doubling the step each time."""
    while True:
        upper = hooks.select(F.col("node").alias("_node"), F.col("up").alias("_up"))
        longer = hooks.join(upper, hooks["up"] == upper["_node"], "left")
        if longer.filter("_up IS NOT NULL").isEmpty():
            return hooks
        hooks = stored(longer.select("node", F.coalesce("_up", "up").alias("up")))
