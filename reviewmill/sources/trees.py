"""Digest trees: digests of parts of a table, and which rows of two tables differ.

A row's place is the SHA-256 of its key in hexadecimal digits, so places are
dealt evenly whatever the keys. A node holds the rows whose places begin with its
path; a leaf's path has ``depth`` digits, the root's none. A leaf's digest covers
the places and digests of its keys in their order, any other node's the paths and
digests of its up to sixteen children, so equal digests mean equal rows below.

Trees are stored as snapshots, sorted by path and place. A comparison begins at
the roots and goes on below differing nodes only; while these are few, their
paths are handed to the scan, which skips all other parts of the stored trees.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.scale import digest, materialize
from reviewmill.sources import snapshots

#: Keys of a leaf, on average, where no depth is given.
LEAF_KEYS = 1024
#: So many differing nodes are looked up by their paths; more of them by a join.
LOOKED_UP = 200


def key_digests(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(place, name, n, sha) for each key: the digest of all its rows, whatever their order.

    ``name`` is the key as a string; rows with a null key are one key, at the
    place of the empty string. The eight 32-bit words of the rows' digests are
    summed, so a key of many rows is added up before the shuffle.
    """
    hashed = df.select(F.col(key).cast("string").alias("name"), F.hex(digest(*(columns or df.columns))).alias("_h"))
    words = [F.sum(F.conv(F.substring("_h", 8 * i + 1, 8), 16, 10).cast("decimal(38,0)")).cast("string") for i in range(8)]
    summed = hashed.groupBy("name").agg(F.count("*").alias("n"), F.sha2(F.concat_ws("|", F.count("*").cast("string"), *words), 256).alias("sha"))
    return summed.select(F.sha2(F.coalesce("name", F.lit("")), 256).alias("place"), "name", "n", "sha")


def _nodes(keys: DataFrame, depth: int) -> DataFrame:
    """(level, path, n, sha) of all nodes: ``keys`` are summed up once, the rest comes from the leaves."""

    def summed(rows: DataFrame, path: Column, place: str) -> DataFrame:
        below = F.array_sort(F.collect_list(F.struct(F.col(place), F.col("sha"))))  # a leaf's keys or up to 16 nodes
        return rows.groupBy(path.alias("path")).agg(F.sum("n").alias("n"), F.sha2(F.array_join(F.transform(below, lambda b: F.concat(b[place], b["sha"])), "|"), 256).alias("sha"))

    # The null key and the empty string have one place, so the name decides between them.
    ordered = keys.withColumn("_place", F.concat("place", F.when(F.col("name").isNull(), "-").otherwise("")))
    level = materialize(summed(ordered, F.substring("place", 1, depth) if depth else F.lit(""), "_place"))
    nodes = level.withColumn("level", F.lit(depth))
    for at in range(depth - 1, -1, -1):
        level = summed(level, F.substring("path", 1, at) if at else F.lit(""), "path")
        nodes = nodes.unionByName(level.withColumn("level", F.lit(at)))
    return nodes.select("level", "path", "n", "sha")


def save_tree(df: DataFrame, key: str, path: str, columns: Sequence[str] | None = None, depth: int | None = None) -> None:
    """Replace the tree at ``path`` by that of ``df``; an empty table has a tree without nodes.

    Trees can be compared if their depth is the same; by default it follows the
    number of keys.
    """
    keys = materialize(key_digests(df, key, columns))
    if depth is None:
        depth = max(0, math.ceil(math.log(max(1, keys.count() / LEAF_KEYS), 16)))
    nodes = _nodes(keys, depth)
    settings = df.sparkSession.createDataFrame([(depth,)], "depth int")
    tables = {
        "keys": keys.repartitionByRange("place").sortWithinPartitions("place"),
        "nodes": nodes.repartitionByRange("level", "path").sortWithinPartitions("level", "path"),
        "settings": settings,
    }
    snapshots.replace(df.sparkSession, path, tables)


def part_digests(spark: SparkSession, path: str) -> DataFrame:
    """(level, path, n, sha): rows and digest of every part of the table, the whole at level 0."""
    return snapshots.read(spark, path)["nodes"]


def _below(table: DataFrame, column: str, open_: DataFrame, paths: list[str] | None, width: int) -> DataFrame:
    """Rows of ``table`` whose ``column`` begins with an open path, which has ``width`` digits."""
    if paths is None:
        at = table.withColumn("_cut", F.substring(column, 1, width))
        return at.join(open_.withColumnRenamed("_open", "_cut"), "_cut", "left_semi").drop("_cut")
    if paths == [""]:
        return table
    ranges = [F.col(column).between(one, one + "g") for one in paths]  # "g" comes after all digits; ranges reach the scan
    while len(ranges) > 1:  # in pairs, so that the condition isn't nested deeply
        ranges = [reduce(or_, ranges[i : i + 2]) for i in range(0, len(ranges), 2)]
    return table.filter(ranges[0])


def changed_keys(spark: SparkSession, stored: str, current: str) -> DataFrame:
    """(name, status): keys that are ``added``, ``removed`` or ``changed`` from the tree at ``stored`` to that at ``current``."""
    old, new = snapshots.read(spark, stored), snapshots.read(spark, current)
    depth, other = (tree["settings"].first().depth for tree in (old, new))
    if depth != other:
        raise ValueError(f"trees of depth {depth} and {other} can't be compared")
    open_ = spark.createDataFrame([("",)], "_open string")
    paths: list[str] | None = [""]
    for level in range(depth + 1):
        sides = [_below(t["nodes"].filter(F.col("level") == level), "path", open_, paths, max(0, level - 1)).select("path", "sha") for t in (old, new)]
        both = sides[0].join(sides[1].withColumnRenamed("sha", "_sha"), "path", "full_outer")
        open_ = materialize(both.filter(~F.col("sha").eqNullSafe(F.col("_sha"))).select(F.col("path").alias("_open")))
        few = [r[0] for r in open_.limit(LOOKED_UP + 1).collect()]
        paths = few if len(few) <= LOOKED_UP else None
        if not few:
            return spark.createDataFrame([], "name string, status string")
    left, right = (_below(t["keys"], "place", open_, paths, depth).select("name", "sha") for t in (old, new))
    joined = left.alias("l").join(right.alias("r"), F.col("l.name").eqNullSafe(F.col("r.name")), "full_outer")
    status = F.when(F.col("l.sha").isNull(), "added").when(F.col("r.sha").isNull(), "removed").otherwise("changed")
    return joined.filter(~F.col("l.sha").eqNullSafe(F.col("r.sha"))).select(F.coalesce("l.name", "r.name").alias("name"), status.alias("status"))
