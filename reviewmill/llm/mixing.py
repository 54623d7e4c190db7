"""Mixing sources to target weights by pivotal dependent rounding of fractional copies."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.base import stored, weighted_rank

#: Documents of a bucket, on average; a source has as many buckets as its own rows need.
BUCKET_ROWS = 2_000
#: The smallest documents of a bucket that are not paired but settle what stays open, up to the root of the tree.
RESERVE = 128
#: Equal rows that one task numbers at a time.
COPIES = 10_000
#: Open remainders that one node of the reduction tree combines, at most.
FAN_IN = 64
#: Shares closer than this to 0 or 1 are whole.
TINY = 1e-9


def word_count(text: str) -> Column:
    """Runs of anything but space and the control characters 9 to 13; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, source: str, size: str, weights: tuple[float, ...], share: float, most: float
) -> DataFrame:
    """(source, source_size, source_rows, target) for every source of ``sizes``, null included.

    Sources weigh ``weights``, repeating, by code point with null last, and share
    ``share`` times all sizes; a target stops at ``most`` times its source's size
    and the excess is shared again by weight until none is above.
    """
    totals = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"), F.count("*").alias("source_rows"))
    ranked = weighted_rank(totals, ["source"], "_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    open_ = stored(ranked.select("source", "source_size", "source_rows", weight.alias("weight"), F.lit(None).cast("double").alias("target")))
    cap = F.col("source_size") * F.lit(float(most))
    pot = float(open_.agg(F.sum("source_size")).first()[0] or 0) * share
    while True:
        left, parts = open_.agg(
            F.lit(pot) - F.coalesce(F.sum("target"), F.lit(0.0)),
            F.sum(F.when(F.col("target").isNull(), F.col("weight"))),
        ).first()
        if not parts:
            return open_.select("source", "source_size", "source_rows", F.coalesce("target", F.lit(0.0)).alias("target"))
        level = max(float(left), 0.0) / float(parts)
        offer = F.col("weight") * F.lit(level)
        capped = stored(
            open_.withColumn("target", F.when(F.col("target").isNull() & (offer > cap), cap).otherwise(F.col("target")))
        )
        if capped.filter("target IS NOT NULL").count() == open_.filter("target IS NOT NULL").count():
            return capped.select("source", "source_size", "source_rows", F.coalesce("target", offer).alias("target"))
        open_ = capped


def pivot(share: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Round the shares in turn; at most one stays between 0 and 1, the last open one.

    Two open documents trade mass, share times size, so that their sum of words
    stays and one share becomes 0 or 1. The direction is drawn so that each
    share keeps its expectation.
    """
    share = share.copy()
    draws = rng.random(len(share))
    i = -1
    for j in range(len(share)):
        if not TINY < share[j] < 1 - TINY:
            share[j] = round(share[j])
            continue
        if i < 0:
            i = j
            continue
        p, q, u, v = share[i], share[j], size[i], size[j]
        up = min((1 - p) * u, q * v)  # words that can move from j to i
        down = min(p * u, (1 - q) * v)
        if draws[j] * (up + down) < down:
            p, q = p + up / u, q - up / v
        else:
            p, q = p - down / u, q + down / v
        share[i] = round(p) if min(p, 1 - p) <= TINY else p
        share[j] = round(q) if min(q, 1 - q) <= TINY else q
        if 0 < share[j] < 1:
            i = j
        elif not 0 < share[i] < 1:
            i = -1
    return share


def settle(share: float, size: float, pool: np.ndarray, sizes: np.ndarray, rng: np.random.Generator) -> float:
    """Let one open document trade with all of ``pool`` at once, until it is whole or nothing can move; changes ``pool``.

    Every document of the pool takes part by p (1 - p) of its words, in both
    directions alike, so words and all expectations stay, and no share leaves 0 to 1.
    """
    while TINY < share < 1 - TINY:
        weight = pool * (1 - pool)
        room = float(weight @ sizes)
        if room * RESERVE < size * TINY:
            return share
        up, down = min((1 - share) * size, room), min(share * size, room)
        if rng.random() * (up + down) < down:
            share, moved = share + up / size, -up
        else:
            share, moved = share - down / size, down
        np.clip(pool + weight * (moved / room), 0.0, 1.0, out=pool)
        pool[pool < TINY] = 0.0
        pool[pool > 1 - TINY] = 1.0
    return float(round(share))


def exchange(share: np.ndarray, size: np.ndarray, missing: float) -> np.ndarray:
    """Turn whole shares round, one at a time, as long as that brings the words nearer to the ``missing`` ones."""
    share = share.copy()
    while len(share):
        left = np.abs(missing - np.where(share > 0, -size, size))
        best = int(left.argmin())
        if left[best] >= abs(missing):
            break
        missing -= -size[best] if share[best] > 0 else size[best]
        share[best] = 1 - share[best]
    return share


def _round(rows: DataFrame, group: list[str], seed: int, last: bool = False) -> DataFrame:
    """Pivot inside each group, large documents first, in an order that only depends on the documents.

    The ``RESERVE`` smallest documents of the group stay out of the pairs. The one
    document that the pairs leave open settles against them, and they go on to
    the next level. At the root of a source there is no next level: the
    reserve settles as well, each document against all smaller ones, and the
    smallest goes to the nearer side.
    """

    def one(part: pa.Table) -> pa.Table:
        part = part.take(pc.sort_indices(part, [("size", "descending"), ("_order", "ascending"), ("_fp", "ascending")]))
        rng = np.random.default_rng([seed, part["_order"][0].as_py() & (2**63 - 1), len(part)])
        share = part["share"].to_numpy().copy()
        size = np.maximum(part["size"].to_numpy().astype(float), 1)
        open_ = np.flatnonzero((share > TINY) & (share < 1 - TINY))
        paired, held = open_[: max(0, len(open_) - RESERVE)], open_[max(0, len(open_) - RESERVE) :]
        share[paired] = pivot(share[paired], size[paired], rng)
        pool = share[held]
        for i in paired[(share[paired] > 0) & (share[paired] < 1)]:
            share[i] = settle(share[i], size[i], pool, size[held], rng)
        if last:
            for k in range(len(held)):
                pool[k] = settle(pool[k], size[held[k]], pool[k + 1 :], size[held[k + 1 :]], rng)
        share[held] = pool
        if last:
            goal = float(part["share"].to_numpy() @ size)
            share = np.rint(share)
            share[open_] = exchange(share[open_], size[open_], goal - float(share @ size))
        return part.set_column(part.schema.get_field_index("share"), "share", pa.array(share))

    return rows.groupBy(*group).applyInArrow(one, rows.schema)


def numbered_copies(slim: DataFrame) -> DataFrame:
    """``slim`` with ``_copy``, which counts the rows that are equal in all columns from 0.

    Equal rows are counted on the map side and written out again, so a row that
    fills a third of the table is no group of one task but a number.
    """
    counted = slim.groupBy(*slim.columns).agg(F.count("*").alias("_n"))
    starts = F.explode(F.expr(f"sequence(0L, _n - 1, {COPIES}L)")).alias("_start")
    blocks = counted.select("*", starts)
    copy = F.explode(F.expr(f"sequence(_start, least(_start + {COPIES}L, _n) - 1)")).alias("_copy")
    return blocks.select(*slim.columns, copy)


def mix(
    docs: DataFrame,
    source: str = "source",
    text: str = "text",
    key: str = "doc_id",
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 11,
) -> DataFrame:
    """(key, _fp, size, source_size, target, copies) for every row of ``docs``.

    Every document of a source starts with target / source_size copies; whole
    copies are certain, the fractions are rounded by pivoting. Documents of a
    source are dealt over buckets by hash, as many as its rows need, so a source
    with most of the rows is no larger task than another and a small one has few
    groups. A bucket pairs all but its smallest documents; what these pairs leave
    open trades with the smallest ones, which are combined with those of other
    buckets, ``FAN_IN`` at a time, in a reduction tree that keeps the
    ``RESERVE`` smallest. Words stay exact at every step but the last, which
    rounds the last open document, as a rule the smallest of its source. Where the
    small documents of a source have too few words to make up for a large one,
    that one is rounded, and documents at the root are turned round as long as
    that brings the source nearer to its target; only there expectations give way.

    Sizes are words; null and empty texts have size 0 and get no copy. A null
    source is a source of its own, null keys are allowed, repeated rows are
    rounded one by one. Sources without words have target 0. Reruns over the
    same rows agree, whatever the partitions. ``_fp`` is ``xxhash64`` of the text.
    """
    slim = docs.select(
        F.col(key).alias("_id"), F.xxhash64(text).alias("_fp"), F.col(source).alias("source"), word_count(text).alias("size")
    )
    sizes = stored(numbered_copies(slim))
    targets = source_targets(sizes, "source", "size", weights, share, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    known = targets.select(
        F.col("source").alias("_source"), "source_size", "target", F.coalesce(rate, F.lit(0.0)).alias("_rate"),
        F.ceil(F.col("source_rows") / BUCKET_ROWS).cast("long").alias("_buckets"),
    )
    # a source's figures are joined map-side: hot sources are not moved
    joined = sizes.join(known, sizes["source"].eqNullSafe(known["_source"])).drop("_source")
    order = F.xxhash64(F.lit(seed), "_id", "_fp", "_copy")
    start = joined.select(
        "_id", "_fp", "source", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.floor("_rate")).otherwise(F.lit(0)).cast("long").alias("whole"),
        F.when(F.col("size") > 0, F.col("_rate") - F.floor("_rate")).otherwise(F.lit(0.0)).alias("share"),
        order.alias("_order"),
        F.pmod(order, F.col("_buckets")).cast("long").alias("_bucket"),
    )
    buckets = int(targets.agg(F.coalesce(F.max(F.ceil(F.col("source_rows") / BUCKET_ROWS)), F.lit(1))).first()[0])
    done = stored(_round(start, ["source", "_bucket"], seed, last=buckets == 1))
    open_ = done.filter("share > 0 AND share < 1")
    settled = done.filter("NOT (share > 0 AND share < 1)")
    while buckets > 1:
        buckets = -(-buckets // FAN_IN)
        dealt = open_.withColumn("_bucket", F.floor(F.col("_bucket") / FAN_IN))
        level = stored(_round(dealt, ["source", "_bucket"], seed, last=buckets == 1))
        settled = settled.unionByName(level.filter("NOT (share > 0 AND share < 1)"))
        open_ = level.filter("share > 0 AND share < 1")
    return settled.select(
        F.col("_id").alias(key), "_fp", "size", "source_size", "target",
        (F.col("whole") + F.round("share").cast("long")).cast("long").alias("copies"),
    )


def mixed_documents(docs: DataFrame, plan: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` as the mix takes them: left out, once, or as often as ``copies`` says.

    Rows that agree in key and text share their copies as evenly as whole copies go.
    """
    dealt = (
        plan.groupBy(F.xxhash64(key).alias("_mix_key"), F.col("_fp").alias("_mix_fp"))
        .agg(F.sum("copies").alias("_mix_copies"), F.count("*").alias("_mix_rows"))
        .filter("_mix_copies > 0")
    )
    named = docs.withColumns({"_mix_key": F.xxhash64(key), "_mix_fp": F.xxhash64(text)})
    place = F.row_number().over(Window.partitionBy("_mix_key", "_mix_fp").orderBy(F.lit(0)))
    copies = F.floor(F.col("_mix_copies") / F.col("_mix_rows")) + (
        place <= F.col("_mix_copies") % F.col("_mix_rows")
    ).cast("int")
    taken = named.join(dealt, ["_mix_key", "_mix_fp"]).withColumn("_mix_copies", copies).filter("_mix_copies > 0")
    return taken.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int")))).select(*docs.columns)
