"""Shards as leaves of a k-d tree that is cut at weighted medians of the documents' metadata."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.base import stored

#: Bytes that a document takes besides its text.
OVERHEAD = 16
#: Bins of one counting round, as a power of two; a cut needs a few rounds.
BIN_BITS = 10
BINS = 1 << BIN_BITS
#: A cut is fine enough when the open bin weighs less than this share of a shard.
FINE = 0.0005
#: Equal texts that weigh more than this share of a shard are placed before the tree grows, so there are few of them.
HEAVY = 0.125
#: Rows that are numbered in one task, on average.
NUMBERED = 5_000
HASH_RANGE = 1 << 62


@dataclass
class Cut:
    """The search for the cut of one box: where it may still lie, and the weight before that."""

    box: int
    leaves: int
    dim: int
    goal: float
    low: int
    high: int  # last value of the range
    before: int = 0
    value: int | None = None  # fixed once the dimension is down to one value; then the hash is cut
    mark: int = 0

    @property
    def shift(self) -> int:
        """Bins of 2 ** shift values, so that there are at most ``BINS`` of them."""
        return max(0, (self.high - self.low).bit_length() - BIN_BITS)

    @property
    def right(self) -> int:
        """The first shard behind the cut, which names the box there."""
        return self.box + self.leaves // 2


def _ordinal(column: str, kind: str) -> Column:
    """A long for any plain column: numbers as they are, other values by their crc32; null is first."""
    plain = F.col(column)
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.coalesce(plain.cast("long"), F.lit(-(1 << 40)))
    if kind in ("float", "double") or kind.startswith("decimal"):
        return F.coalesce(F.floor(plain.cast("double")).cast("long"), F.lit(-(1 << 40)))
    return F.coalesce(F.crc32(plain.cast("string").cast("binary")), F.lit(-1)).cast("long")


def shard(
    docs: DataFrame,
    shards: int = 40,
    key: str = "doc_id",
    text: str = "text",
    dimensions: tuple[str, ...] = ("source", "lang"),
) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``.

    The law is ``bytes``: shards have nearly equal sums of ``size``, a text's
    UTF-8 bytes plus 16. Rows with equal texts are one point of the tree, so
    they share a shard, unless together they weigh more than an eighth of one;
    then they are split into parts of at most that weight. A point has its
    text's size and the smallest ``dimensions`` of its rows as coordinates. Each
    round cuts all boxes that hold several shards, each at the weighted quantile
    of the dimension in which it is widest; ties are ordered by hash. A cut is
    found by counting weights in bins and narrowing to one bin, so that only
    bin totals, at most ``BINS`` for each box, reach the driver.

    Null texts weigh 16 bytes and equal each other, null keys and dimensions are
    values like others, repeated rows take a place each. An empty table gives an
    empty result; with few points some shards stay empty. ``slot`` numbers the
    rows of each shard from 0; ``grown_shard`` is null under this law. Columns
    named like the results may exist in ``docs``; they are only read if listed.
    """
    kinds = dict(docs.dtypes)
    used = [d for d in dimensions if d in kinds]
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")
    slim = stored(
        docs.select(
            F.col(key).alias("_id"),
            F.xxhash64(text).alias("_group"),
            size.alias("size"),
            F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
            *[_ordinal(d, kinds[d]).alias(f"_dim{i}") for i, d in enumerate(used, 1)],
        )
    )
    dims = ["_dim0"] + [f"_dim{i}" for i in range(1, len(used) + 1)]
    total, rows = slim.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    target = total / shards
    most = max(1.0, target * HEAVY)
    heavy = {
        r["_group"]: r["_weight"]
        for r in slim.groupBy("_group").agg(F.sum("size").alias("_weight")).filter(F.col("_weight") > most).collect()
    }  # each holds more than HEAVY / shards of all bytes
    homes, room = place_whole(heavy, [target] * shards)
    plan = [(g, homes.get(g), math.ceil(w / most)) for g, w in heavy.items()]
    planned = slim.sparkSession.createDataFrame(plan, "_group long, _home int, _parts long")
    part = F.when(F.col("_home").isNull(), F.pmod(F.xxhash64("_id", "_group"), F.col("_parts")))
    pieces = slim.join(F.broadcast(planned), "_group", "left").withColumn("_part", F.coalesce(part, F.lit(0)).cast("long"))
    pieces = stored(pieces.drop("_parts"))
    points = stored(
        pieces.filter("_home IS NULL")
        .groupBy("_group", "_part")
        .agg(F.min("size").alias("_dim0"), *[F.min(d).alias(d) for d in dims[1:]], F.sum("size").alias("_weight"))
        .select("_group", "_part", "_weight", F.array(*dims).alias("_dims"))
        .withColumn("_mark", F.pmod(F.xxhash64("_group", "_part", F.lit(3)), F.lit(HASH_RANGE)))
    )
    placed = grow(points, len(dims), room, target).select("_group", "_part", F.col("_box").alias("shard"))
    assigned = pieces.filter("_home IS NULL").join(placed, ["_group", "_part"])
    at_home = pieces.filter("_home IS NOT NULL").withColumn("shard", F.col("_home"))
    assigned = assigned.unionByName(at_home).drop("_home")
    return _slots(assigned, rows, shards).select(
        F.col("_id").alias(key), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def place_whole(weights: dict[int, int], room: list[float]) -> tuple[dict[int, int], list[float]]:
    """(shard of each group that fits one as a whole, room left in each shard): the heaviest first, the first that has room."""
    left, homes = list(room), {}
    for group, weight in sorted(weights.items(), key=lambda x: (-x[1], x[0])):
        home = next((i for i, r in enumerate(left) if r >= weight), None)
        if home is not None:
            homes[group] = home
            left[home] -= weight
    return homes, left


def grow(points: DataFrame, n_dims: int, room: list[float], target: float) -> DataFrame:
    """``points`` with ``_box``, the shard: all boxes of a level are cut together, each on its widest dimension.

    The weight of a box is divided like the ``room`` of the shards on both sides.
    """
    shards = len(room)
    boxed = points.withColumn("_box", F.lit(0))
    leaves = {0: shards}
    widths: list[int] = []
    while open_ := {box: n for box, n in leaves.items() if n > 1}:
        dims = [F.element_at("_dims", k + 1) for k in range(n_dims)]
        ranges = {
            r["_box"]: r
            for r in boxed.groupBy("_box").agg(
                F.sum("_weight").alias("w"), F.array(*map(F.min, dims)).alias("lo"), F.array(*map(F.max, dims)).alias("hi")
            ).collect()  # one row for each box
        }
        if not widths:
            widths = [max(1, hi - lo) for r in ranges.values() for lo, hi in zip(r["lo"], r["hi"], strict=True)]
        cuts = []
        for box, n in open_.items():
            if r := ranges.get(box):
                dim = max(range(n_dims), key=lambda k: ((r["hi"][k] - r["lo"][k]) / widths[k], -k))  # noqa: B023
                share = sum(room[box : box + n // 2]) / (sum(room[box : box + n]) or 1.0)
                cuts.append(Cut(box, n, dim, r["w"] * share, r["lo"][dim], r["hi"][dim]))
        _search(boxed, cuts, target * FINE)
        if cuts:
            rows = [(c.box, c.dim + 1, c.value, c.mark, c.right) for c in cuts]
            table = boxed.sparkSession.createDataFrame(rows, "_box int, _dim int, _value long, _at long, _right int")
            behind = (F.col("_v") > F.col("_value")) | ((F.col("_v") == F.col("_value")) & (F.col("_mark") >= F.col("_at")))
            boxed = stored(
                boxed.join(F.broadcast(table), "_box", "left")
                .withColumn("_v", F.expr("element_at(_dims, _dim)"))
                .withColumn("_box", F.when(behind, F.col("_right")).otherwise(F.col("_box")))
                .drop("_dim", "_value", "_at", "_right", "_v")
            )
        leaves = {b: k for box, n in leaves.items() for b, k in ([(box, n // 2), (box + n // 2, n - n // 2)] if n > 1 else [(box, n)])}
    return boxed


def _search(boxed: DataFrame, cuts: list[Cut], fine: float) -> None:
    """Narrow all cuts of a level, a bin at a time, until each open bin is light or indivisible."""
    open_ = list(cuts)
    while open_:
        rows = [(c.box, c.dim + 1, c.value, c.low, c.high, c.shift) for c in open_]
        table = boxed.sparkSession.createDataFrame(rows, "_box int, _dim int, _value long, _low long, _high long, _shift int")
        dim = F.expr("element_at(_dims, _dim)")
        counted = (
            boxed.join(F.broadcast(table), "_box")
            .filter(F.col("_value").isNull() | (dim == F.col("_value")))
            .withColumn("_v", F.when(F.col("_value").isNull(), dim).otherwise(F.col("_mark")))
            .filter("_v BETWEEN _low AND _high")
            .groupBy("_box", F.expr("shiftright(_v - _low, _shift)").alias("_bin"))
            .agg(F.sum("_weight").alias("w"), F.count("*").alias("n"))
            .collect()  # at most BINS rows for each box
        )
        bins: dict[int, list[tuple[int, int, int]]] = {}
        for r in counted:
            bins.setdefault(r["_box"], []).append((r["_bin"], r["w"], r["n"]))
        open_ = [c for c in open_ if not _narrow(c, sorted(bins.get(c.box, [])), fine)]


def _narrow(c: Cut, bins: list[tuple[int, int, int]], fine: float) -> bool:
    """Go on in the bin where the goal lies; true when the cut is fixed."""
    for at, weight, points in bins:
        if c.before + weight >= c.goal or at == bins[-1][0]:
            low = c.low + (at << c.shift)
            high = min(c.high, low + (1 << c.shift) - 1)
            if weight > fine and points > 1 and high > low:
                c.low, c.high = low, high
                return False
            if weight > fine and points > 1 and c.value is None:
                c.value, c.low, c.high = low, 0, HASH_RANGE - 1
                return False
            # the nearer side of the bin
            edge = high + 1 if c.goal - c.before > weight / 2 else low
            if c.value is None:
                c.value = edge
            else:
                c.mark = edge
            return True
        c.before += weight
    c.value = c.high if c.value is None else c.value
    return True


def _slots(assigned: DataFrame, rows: int, shards: int) -> DataFrame:
    """Number the rows of each shard from 0, several tasks to a shard."""
    parts = max(1, -(-rows // (shards * NUMBERED)))
    split = stored(assigned.withColumn("_bucket", F.pmod(F.xxhash64("_id", "_group", F.lit(5)), F.lit(parts)).cast("int")))
    sizes = split.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    before = sizes.select(
        "shard", "_bucket", (F.sum("_n").over(Window.partitionBy("shard").orderBy("_bucket")) - F.col("_n")).alias("_before")
    )  # one row for NUMBERED documents
    inside = Window.partitionBy("shard", "_bucket").orderBy(F.xxhash64("_id", F.lit(7)), "_id", "_group")
    return (
        split.withColumn("_place", F.row_number().over(inside) - 1)
        .join(before, ["shard", "_bucket"])
        .withColumn("slot", (F.col("_before") + F.col("_place")).cast("long"))
    )
