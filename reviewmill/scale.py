"""Helpers that keep jobs even when a few keys hold most of the rows."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A key is hot when it holds more than this share of all rows, so at most
# 1 / HOT_SHARE keys can be hot whatever the size of the data.
HOT_SHARE = 0.001
# How many further frequent keys a join of tokens or terms broadcasts, at any size of the data.
HOT_KEYS = 100_000
# Bits of a filter for keys that another table lacks: 2^20 rows of one bigint at most, at any size of the data.
FILTER_BITS = 1 << 26
# A table of one number for each key is broadcast up to so many rows.
FEW_ROWS = 1 << 20
#: Session setting: how many tasks ``spread`` deals a scan out to.
SCAN_PARTITIONS = "reviewmill.scan.partitions"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a local one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="reviewmill-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table below the checkpoint folder."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


_scopes: list[list[str]] = []


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Remove the tables written inside the block when it ends; what reads them has to run inside, too."""
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for path in map(hadoop.Path, paths):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table below the checkpoint folder and read it from there.

    That cuts the lineage, survives lost executors and gives later joins true sizes.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def deal(df: DataFrame, key: str) -> DataFrame:
    """Hash rows that are about to grow a lot over all shuffle partitions.

    The number is given, so these small rows are not merged into few tasks again.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, key)


def spread(df: DataFrame) -> DataFrame:
    """Deal a scan out over ``SCAN_PARTITIONS`` tasks, if the session sets that.

    For tables in fewer files than there are task slots, as in tests and on one
    machine. By default a scan keeps the splits of its files.
    """
    n = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(n)) if n else df


def by_repeats(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows whose key no other row has, and the others if there are any; null is a key.

    Only keys are shuffled. Rows alone under their key need no grouping, so their
    texts stay where they are.
    """
    repeated = materialize(df.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("n")).filter("n > 1").select("_key"))
    if repeated.isEmpty():
        return df, None
    same = F.col(key).eqNullSafe(F.col("_key"))
    return df.join(repeated, same, "left_anti"), df.join(repeated, same, "left_semi")


def digest(*columns: str | Column) -> Column:
    """A 32-byte stand-in for wide grouping keys; nulls stay apart from empty strings."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    tagged = [
        F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
        for c in parts
    ]
    return F.unhex(F.sha2(F.concat(*tagged), 256))


def hot_keys(counts: DataFrame, key: str, n: str = "n", limit: int = 0) -> DataFrame:
    """The most frequent keys: all above ``HOT_SHARE`` of the rows and, down to a power of two, at most ``limit``.

    Keys are counted per power of two of their rows, so no key is ranked.
    """
    total = counts.agg(F.sum(n)).scalar()
    large = F.col(n) > F.lit(HOT_SHARE) * total
    if not limit:
        return counts.filter(large).select(key)
    size = F.ceil(F.log2(n))  # one row for each power of two below
    sizes = counts.filter(F.col(n) > 0).groupBy(size.alias("size")).agg(F.count("*").alias("keys"))
    upto = sizes.withColumn("upto", F.sum("keys").over(Window.partitionBy(F.lit(0)).orderBy(F.desc("size"))))
    least = upto.filter(F.col("upto") <= limit).agg(F.min("size")).scalar()
    return counts.filter(large | ((F.col(n) > 0) & F.coalesce(size >= least, F.lit(False)))).select(key)


def key_bits(keys: DataFrame, key: str) -> DataFrame:
    """(_part, _bits): a bit for the hash of each key, at most FILTER_BITS / 64 rows of one bigint."""
    place = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    places = keys.filter(F.col(key).isNotNull()).select(place.alias("_place"))
    return places.groupBy(F.expr("shiftright(_place, 6)").alias("_part")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(_place % 64))")).alias("_bits")
    )


def mark_possible(df: DataFrame, key: str, keys: DataFrame, name: str) -> DataFrame:
    """``df`` with a BOOLEAN ``name``: false only for rows whose ``key`` is not in ``keys``, so that they needn't be moved."""
    placed = df.withColumn("_place", F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))).withColumn("_part", F.expr("shiftright(_place, 6)"))
    holds = F.getbit(F.col("_bits"), F.col("_place") % 64) != 0
    marked = placed.join(F.broadcast(key_bits(keys, key)), "_part", "left").withColumn(name, F.coalesce(holds, F.lit(False)))
    return marked.drop("_place", "_part", "_bits")


def few(df: DataFrame) -> DataFrame:
    """A stored table of one number for each key, broadcast as long as it has at most ``FEW_ROWS`` rows."""
    return F.broadcast(df) if df.count() <= FEW_ROWS else df


def hot_cold_join(
    facts: DataFrame, dim: DataFrame, key: str, counts: DataFrame, n: str = "n", limit: int = 0, sparse: bool = False
) -> DataFrame:
    """Inner join of ``facts`` to ``dim`` (one row per key) in which hot keys aren't moved.

    ``counts`` gives the rows of ``facts`` per key. Keys above ``HOT_SHARE`` of
    all rows and the next most frequent ones, at most 1 / HOT_SHARE + ``limit``
    in all, are joined where their rows lie; only the rows of other keys are
    shuffled, so the largest key in a shuffle has ``HOT_SHARE`` of the rows.
    ``facts`` is read twice: hand over a stored table or a cheap expression of one.
    ``sparse``: ``dim`` lacks many keys, whose rows are mostly found by a filter of bits and not moved.
    """
    hot = F.broadcast(hot_keys(counts, key, n, limit))
    near = facts.join(F.broadcast(dim.join(hot, key, "left_semi")), key)
    cold = facts.join(hot, key, "left_anti")
    if sparse:
        cold = mark_possible(cold, key, dim.select(key), "_possible").filter("_possible").drop("_possible")
    far = cold.join(dim, key)
    return near.unionByName(far)
