"""Near-duplicate vectors: random-hyperplane signs in several tables, exact cosines, components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.base import components, named_by_smallest, stored

#: Signs of a second, independent set of planes, compared before the exact cosine.
SKETCH_BITS = 128
#: Standard deviations by which a pair may miss its expected number of equal sketch signs.
SLACK = 5.5


@dataclass(frozen=True)
class Tables:
    """How many tables and how many signs in each."""

    tables: int
    bits: int

    @classmethod
    def planned(cls, rows: int, threshold: float, recall: float) -> Tables:
        """One bit for each doubling of the rows, and the tables that ``recall`` at the threshold then takes.

        A plane leaves two vectors on one side with probability 1 - angle / pi.
        """
        bits = max(8, math.ceil(math.log2(max(rows, 1))))
        agree = (1 - math.acos(threshold) / math.pi) ** bits
        return cls(math.ceil(math.log(1 - recall) / math.log(1 - agree)), bits)


def _usable(vector: str) -> Column:
    """Not null or empty, no null or non-finite component, not all zero."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def _classes(vectors: DataFrame, vector: str) -> DataFrame:
    """(cls, vec, n): one row for each distinct usable vector, in double precision."""
    plain = vectors.filter(_usable(vector)).select(F.col(vector).cast("array<double>").alias("vec"))
    return plain.groupBy("vec").agg(F.count("*").alias("n")).select(F.xxhash64("vec").alias("cls"), "vec", "n")


def _signs(classes: DataFrame, plan: Tables, seed: int) -> DataFrame:
    """(cls, s1, s2, keys): the sketch and one bucket key for each table."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            ids, rows = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            sizes = rows.value_lengths().to_numpy(zero_copy_only=False)
            flat = rows.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                if size not in planes:
                    rng = np.random.default_rng([seed, int(size)])
                    planes[size] = rng.standard_normal((int(size), plan.tables * plan.bits + SKETCH_BITS))
                x = flat[(ends[at] - size)[:, None] + np.arange(size)]
                x = x / np.abs(x).max(axis=1, keepdims=True)
                side = (x @ planes[size]) >= 0
                sketch = np.packbits(side[:, -SKETCH_BITS:], axis=1).view(">i8").astype(np.int64)
                weight = np.left_shift(np.int64(1), np.arange(plan.bits, dtype=np.int64))
                keys = side[:, : plan.tables * plan.bits].reshape(len(at), plan.tables, plan.bits) @ weight
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, keys.size + 1, plan.tables, dtype=np.int32)), pa.array(keys.reshape(-1))
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(sketch[:, 0]), pa.array(sketch[:, 1]), pa.array(np.full(len(at), size, np.int32)), lists],
                    ["cls", "s1", "s2", "dim", "keys"],
                )

    return classes.select("cls", "vec").mapInArrow(sign, "cls long, s1 long, s2 long, dim int, keys array<long>")


def near_duplicates(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.9,
    recall: float = 0.98,
    seed: int = 17,
) -> DataFrame:
    """(key, n_links, component_id, kept) for every row of ``vectors``.

    Equal vectors are one class and are never paired with each other. Classes
    that share a bucket in a table and agree in enough signs of a second sketch
    are compared by the exact cosine in double precision; ``n_links`` counts the
    rows linked directly, copies of the row's own vector included, and
    ``component_id`` is the smallest key reachable by links.

    Null, empty or zero vectors, and vectors with null or non-finite components,
    link with nothing and stay as they are; vectors of different length never
    link. Null keys come after all others: a component without another key has a
    null id. Repeated rows count as separate vectors. An empty table gives an
    empty result; other columns are not looked at. ``recall`` is the share of
    pairs exactly at the threshold that meet in some table; closer pairs meet
    more often.
    """
    rows = vectors.select(F.col(key).alias("_id"), F.col(vector).alias("_vec"))
    classes = stored(_classes(rows, "_vec"))
    plan = Tables.planned(classes.count(), threshold, recall)
    links = stored(_links(classes, plan, threshold, seed))
    counts = (
        links.select(F.col("a").alias("cls"), F.col("nb").alias("m"))
        .union(links.select("b", "na"))
        .groupBy("cls")
        .agg(F.sum("m").alias("m"))
    )
    roots = components(links).withColumnRenamed("node", "cls")
    known = classes.select("cls", "n").join(counts, "cls", "left").join(roots, "cls", "left").select(
        "cls", (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("links"), F.coalesce("root", "cls").alias("root")
    )
    classed = rows.select("_id", F.when(_usable("_vec"), F.xxhash64(F.col("_vec").cast("array<double>"))).alias("cls"))
    linked = classed.filter("cls IS NOT NULL").join(known, "cls", "left")
    alone = classed.filter("cls IS NULL").selectExpr("cls", "_id", "0L AS links", "cls AS root")  # would meet in one task
    placed = stored(linked.unionByName(alone).drop("cls"))
    return named_by_smallest(placed).select(
        F.col("_id").alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.col("first").alias("component_id"),
        F.col("_id").eqNullSafe(F.col("first")).alias("kept"),
    )


def _links(classes: DataFrame, plan: Tables, threshold: float, seed: int) -> DataFrame:
    """(a, b, na, nb): classes whose cosine is at least the threshold."""
    agree = 1 - math.acos(threshold) / math.pi
    differ = SKETCH_BITS * (1 - agree) + SLACK * math.sqrt(SKETCH_BITS * agree * (1 - agree))
    signs = stored(_signs(classes, plan, seed))
    keyed = signs.select(
        "cls", "s1", "s2", F.posexplode(F.transform("keys", lambda k: F.xxhash64("dim", k))).alias("place", "key")
    )
    left, right = keyed.alias("l"), keyed.alias("r")
    pairs = (
        left.join(
            right,
            (F.col("l.place") == F.col("r.place"))
            & (F.col("l.key") == F.col("r.key"))
            & (F.col("l.cls") < F.col("r.cls"))
            & (
                F.bit_count(F.col("l.s1").bitwiseXOR(F.col("r.s1"))) + F.bit_count(F.col("l.s2").bitwiseXOR(F.col("r.s2")))
                <= math.floor(differ)
            ),
        )
        .select(F.col("l.cls").alias("a"), F.col("r.cls").alias("b"))
        .distinct()
    )
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda total, x: total + x * x))
    sides = classes.select("cls", "vec", "n", norm.alias("norm"))
    a = sides.select(F.col("cls").alias("a"), F.col("vec").alias("va"), F.col("n").alias("na"), F.col("norm").alias("la"))
    b = sides.select(F.col("cls").alias("b"), F.col("vec").alias("vb"), F.col("n").alias("nb"), F.col("norm").alias("lb"))
    dot = F.aggregate(F.zip_with("va", "vb", lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)
    return (
        pairs.join(a, "a").join(b, "b").filter(dot / (F.col("la") * F.col("lb")) >= threshold).select("a", "b", "na", "nb")
    )
