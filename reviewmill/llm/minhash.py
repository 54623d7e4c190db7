"""Near-duplicate texts: b-bit MinHash signatures joined by a multi-index, confirmed on full sets."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from reviewmill.llm.base import components, named_by_smallest, row_key, stored, utf8

#: Classes that a task compares with as many others, all with all, and the bytes of their texts.
BLOCK = 2000
BLOCK_BYTES = 8 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Signature:
    """``chunks`` chunks of ``width`` b-bit values; a chunk may differ in ``errors`` of them.

    By the pigeonhole principle two signatures that differ in at most ``distance``
    values agree in some chunk up to ``errors`` values. With the errors of each
    chunk enumerated, that is an equal key: the chunk, the places left out, and
    the other values.
    """

    chunks: int = 10
    width: int = 5
    errors: int = 1
    bits: int = 16

    @property
    def size(self) -> int:
        return self.chunks * self.width

    @property
    def distance(self) -> int:
        return self.chunks * (self.errors + 1) - 1

    def kept(self) -> list[tuple[int, ...]]:
        return list(combinations(range(self.width), self.width - self.errors))


def shingle_codes(raw: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit codes of the word shingles; the whole sequence if it is shorter."""
    from xxhash import xxh3_64_intdigest

    found = raw.lower().split()  # bytes: A-Z only, and exactly the blanks 9 to 13 and 32
    n = len(found)
    if not n:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(xxh3_64_intdigest, found), np.uint64, n)
    width = min(words, n)
    out = np.full(n - width + 1, width, np.uint64)
    for at in range(width):
        out = (out ^ codes[at : at + len(out)]) * _MIX
        out ^= out >> np.uint64(32)
    return np.unique(out)


class Hasher:
    """The least hash of a shingle set under each of ``n`` functions."""

    def __init__(self, n: int, seed: int):
        rng = np.random.default_rng(seed)
        self.odd = rng.integers(0, 1 << 62, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = rng.integers(0, 1 << 62, n, dtype=np.uint64)

    def minima(self, codes: np.ndarray) -> np.ndarray:
        low = np.full(len(self.odd), np.iinfo(np.uint64).max, np.uint64)
        step = max(1, 100_000 // len(self.odd))  # as many at a time as stay in the processor's cache
        for start in range(0, len(codes), step):
            h = codes[start : start + step, None] * self.odd[None, :]
            h += self.add[None, :]
            h ^= h >> np.uint64(29)
            low = np.minimum(low, h.min(axis=0))
        return low


def join_keys(low: np.ndarray, signature: Signature) -> np.ndarray:
    """The keys of many signatures (rows): one for each chunk and choice of errors."""
    value = (low * _MIX) >> np.uint64(64 - signature.bits)
    value = value.reshape(len(low), signature.chunks, signature.width)
    keys = []
    for chunk in range(signature.chunks):
        for place, kept in enumerate(signature.kept()):
            h = np.full(len(low), chunk * 1000 + place + 1, np.uint64)
            for k in kept:
                h = (h ^ value[:, chunk, k]) * _MIX
                h ^= h >> np.uint64(31)
            keys.append(h)
    return np.stack(keys, 1).astype(np.int64)


def signatures(docs: DataFrame, key: str, text: str, words: int, signature: Signature, seed: int) -> DataFrame:
    """(_id, _fp, cls, n, keys) for every row; ``cls`` names the shingle set, null if it is empty."""
    hasher = Hasher(signature.size, seed)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        for batch in batches:
            sizes, classes, lows = [], [], []
            for value in batch.column("_text"):
                codes = shingle_codes(utf8(value.as_py()), words)
                sizes.append(len(codes))
                if len(codes):
                    classes.append(xxh3_64_intdigest(codes.tobytes()) - (1 << 63))
                    lows.append(hasher.minima(codes))
                else:
                    classes.append(None)
            full = np.array(sizes) > 0
            width = signature.chunks * len(signature.kept())
            keys = join_keys(np.stack(lows), signature) if lows else np.zeros((0, width), np.int64)
            offsets = np.concatenate([[0], np.cumsum(full) * width]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_fp"), pa.array(classes, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1)))],
                ["_id", "_fp", "cls", "n", "keys"],
            )

    rows = docs.select(*row_key(key, text), F.col(text).alias("_text"))
    kind = dict(rows.dtypes)["_id"]
    return rows.mapInArrow(sign, f"_id {kind}, _fp long, cls long, n long, keys array<long>")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
    signature: Signature = Signature(),
    seed: int = 5,
) -> DataFrame:
    """(key, _fp, n_shingles, component_id, kept) for every row of ``docs``.

    A text's set are its distinct shingles of ``words`` words, lower-cased in A-Z
    only; a text with fewer words has its whole sequence as its one shingle, a
    null text or one without words has no set and links with nothing. Texts link
    if 100 * intersection >= percent * union. Texts with equal sets are one class;
    classes that share a key of the multi-index are compared on their full sets
    until every such pair is confirmed, refused, or already connected: first each
    class with one hub, the member of its buckets that shares most keys with others,
    then what isn't connected yet all with all, in blocks of bounded size. ``component_id`` is the smallest key reachable by links.

    Null keys come after all others; repeated rows are rows of one class; other
    columns are not looked at; an empty table gives an empty result. ``_fp`` is
    ``xxhash64`` of the text. Two sets are taken as equal when a 64-bit digest of
    their sorted shingle codes agrees.
    """
    signs = stored(signatures(docs, key, text, words, signature, seed))
    roots = _roots(docs, signs, key, text, words, percent)
    rows = signs.select("_id", "_fp", "n", "cls")
    with_set = rows.filter("cls IS NOT NULL").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    columns = ["_id", "_fp", "n", F.coalesce("root", "cls").alias("root")]
    without = rows.filter("cls IS NULL").withColumn("root", F.col("cls"))  # all of them would meet in one task
    placed = stored(with_set.select(*columns).unionByName(without.select(*columns)))
    return named_by_smallest(placed).select(
        F.col("_id").alias(key), "_fp", F.col("n").alias("n_shingles"), F.col("first").alias("component_id"),
        F.col("_id").eqNullSafe(F.col("first")).alias("kept"),
    )


def keep_first(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest key of their component, one of them if several are; columns as they were."""
    gone = found.filter(~F.col("kept")).select(F.xxhash64(key).alias("_near_key"), F.col("_fp").alias("_near_fp")).distinct()
    named = docs.withColumns({"_near_key": F.xxhash64(key), "_near_fp": F.xxhash64(text)})
    rest = named.join(gone, ["_near_key", "_near_fp"], "left_anti")
    # a key that occurs in several rows may have been kept more than once
    twice = docs.groupBy(F.xxhash64(key).alias("_near_key")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_near_key")
    if twice.isEmpty():
        return rest.select(*docs.columns)
    groups = found.filter("kept AND n_shingles > 0").select(
        F.xxhash64(key).alias("_near_key"), F.col("_fp").alias("_near_fp"), F.xxhash64("component_id").alias("_near_group")
    ).distinct()
    place = F.row_number().over(Window.partitionBy("_near_group").orderBy("_near_fp"))
    marked = rest.join(twice, "_near_key", "left_semi").join(groups, ["_near_key", "_near_fp"], "left")
    chosen = marked.withColumn("_place", place).filter("_near_group IS NULL OR _place = 1")
    return rest.join(twice, "_near_key", "left_anti").select(*docs.columns).unionByName(chosen.select(*docs.columns))


def _roots(docs: DataFrame, signs: DataFrame, key: str, text: str, words: int, percent: int) -> DataFrame:
    """(node, root) over classes: links confirmed on full sets."""
    reps = stored(
        signs.filter("cls IS NOT NULL").groupBy("cls", "keys").agg(F.min(F.xxhash64("_id", "_fp")).alias("row"))
    )
    keyed = reps.select("cls", F.explode("keys").alias("key"))
    crowds = stored(keyed.groupBy("key").agg(F.count("*").alias("crowd")).filter("crowd > 1"))
    members = stored(keyed.join(crowds, "key"))
    weights = members.groupBy("cls").agg(F.sum("crowd").alias("degree"))
    members = stored(members.drop("crowd").join(stored(weights), "cls"))
    texts = stored(_texts(docs, reps, members, key, text))

    # first, each class with the best hub of its keys: one pair for a class
    pairs = stored(_hub_pairs(members))
    links = stored(_judged(pairs, texts, words, percent).filter("linked"))
    roots = _rooted(members, links)
    open_ = _open(members, roots)
    if open_ is None:
        return roots
    more = stored(_left_over(open_, texts, words, percent))
    return roots if more.isEmpty() else _rooted(members, links.unionByName(more))


def _rooted(members: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) for every member, linked or not."""
    found = components(links)
    nodes = members.select(F.col("cls").alias("node")).distinct()
    return stored(nodes.join(found, "node", "left").select("node", F.coalesce("root", "node").alias("root")))


def _open(members: DataFrame, roots: DataFrame) -> DataFrame | None:
    """(key, cls, degree, root): the members of keys whose members aren't all connected, if there are such keys."""
    rooted = stored(members.join(roots, members["cls"] == roots["node"]).select("key", "cls", "degree", "root"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("_first"), F.max("root").alias("_last")).filter("_first < _last")
    mixed = stored(mixed.select("key"))
    return None if mixed.isEmpty() else stored(rooted.join(mixed, "key"))


def _hub_pairs(members: DataFrame) -> DataFrame:
    """(a, b): each class with the hub of its keys of the highest degree; a key's hub is its member of the highest."""
    best = F.max(F.struct("degree", "cls"))
    hubs = stored(members.groupBy("key").agg(best.alias("hub")))
    chosen = (
        members.select("key", "cls").join(hubs, "key").filter("cls <> hub.cls").groupBy("cls").agg(F.max("hub").alias("hub"))
    )
    return chosen.select(F.least("cls", "hub.cls").alias("a"), F.greatest("cls", "hub.cls").alias("b")).distinct()


def _left_over(open_: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b, linked): links that connect what the hubs left apart, found by comparing all with all.

    Classes that are joined by shared keys are one crowd. Its classes are dealt
    into blocks, and each pair of blocks is one task, which counts the shingles
    that each class shares with all others and returns a spanning set of the
    links it finds. The number of blocks follows the classes and the bytes of
    their texts, so a block of long texts has fewer of them; a crowd of any size
    takes tasks of bounded size, and no pair becomes a row.
    """
    first = stored(open_.groupBy("key").agg(F.min("cls").alias("first")))
    crowds = components(open_.join(first, "key").select(F.col("cls").alias("a"), F.col("first").alias("b")))
    classes = open_.select("cls", "root").distinct()
    placed = stored(classes.join(crowds, classes["cls"] == crowds["node"]).select("cls", classes["root"], crowds["root"].alias("crowd")))
    weighed = placed.join(texts.select("cls", "bytes"), "cls")
    needed = F.ceil(F.greatest(F.count("*") / F.lit(BLOCK), F.sum("bytes") / F.lit(BLOCK_BYTES))).cast("int")
    sizes = weighed.groupBy("crowd").agg(needed.alias("blocks"))
    dealt = placed.join(sizes, "crowd").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    sent = dealt.join(texts, "cls").withColumn("other", other).select(
        "crowd", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "cls", "root", "text"
    )

    def compare(part: pa.Table) -> pa.Table:
        sets = [shingle_codes(utf8(t), words) for t in part["text"].to_pylist()]
        block, cls, root = (part[c].to_numpy() for c in ("block", "cls", "root"))
        a, b = _spanning(sets, block == part["low"][0].as_py(), block == part["high"][0].as_py(), root, percent)
        return pa.table({"a": pa.array(cls[a], pa.int64()), "b": pa.array(cls[b], pa.int64()), "linked": pa.array(np.ones(len(a), bool))})

    return sent.groupBy("crowd", "low", "high").applyInArrow(compare, "a long, b long, linked boolean")


def _spanning(
    sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, root: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links between ``left`` and ``right`` members that connect different roots, as many as that takes."""
    sizes = np.array([len(s) for s in sets], np.int64)
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(code, kind="stable")
    posting, starts = owner[order], np.concatenate([[0], np.cumsum(np.bincount(code))])
    ends = np.cumsum(sizes)
    names, root = np.unique(root, return_inverse=True)
    up = list(range(len(names)))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    found_a, found_b = [], []
    for i in np.flatnonzero(left).tolist():
        mine = code[ends[i] - sizes[i] : ends[i]]
        low, n = starts[mine], starts[mine + 1] - starts[mine]
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        both = np.bincount(posting[at], minlength=len(sets))
        close = right & (root != root[i]) & (100 * both >= percent * (sizes[i] + sizes - both))
        for j in np.flatnonzero(close).tolist():
            x, y = top(int(root[i])), top(int(root[j]))
            if x != y:
                up[y] = x
                found_a.append(i)
                found_b.append(j)
    return np.array(found_a, np.int64), np.array(found_b, np.int64)


def _texts(docs: DataFrame, reps: DataFrame, members: DataFrame, key: str, text: str) -> DataFrame:
    """(cls, text, bytes) of every class that shares a key with another."""
    wanted = reps.select("cls", "row").join(members.select("cls").distinct(), "cls", "left_semi")
    rows = docs.select(F.xxhash64(F.col(key), F.xxhash64(F.col(text))).alias("row"), F.col(text).alias("text"))
    return rows.join(wanted, "row").select("cls", "text", F.octet_length("text").alias("bytes")).dropDuplicates(["cls"])


def _judged(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b, linked): whether the full sets of each pair are similar enough."""

    @pandas_udf("boolean")
    def similar(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            last, own = None, None
            out = []
            for a, b in zip(left, right, strict=True):
                if a != last:
                    last, own = a, shingle_codes(utf8(a), words)
                other = shingle_codes(utf8(b), words)
                both = len(np.intersect1d(own, other, assume_unique=True))
                out.append(100 * both >= percent * (len(own) + len(other) - both))
            yield pd.Series(out, dtype=bool)

    b = texts.select(F.col("cls").alias("b"), F.col("text").alias("_tb"))
    a = texts.select(F.col("cls").alias("a"), F.col("text").alias("_ta"))
    return pairs.select("a", "b").join(b, "b").join(a, "a").select("a", "b", similar("_ta", "_tb").alias("linked"))
