"""Ranked lexical search over posting lists that are blocked by the similarity of their documents.

Documents become vectors over the terms of a query set and are dealt into shards
in the order of a random-projection key, so that similar documents lie together.
Inside a shard the posting list of every term is clustered by document similarity;
each block keeps the largest value that its documents have at every coordinate.
The weighted sum of these maxima over a query's terms bounds every score in the
block. A block is skipped only if that bound is below the score of the k-th best
document known so far, so the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.base import slices, stored, utf8

#: Bytes of query text that are looked for together.
QUERY_BYTES = 2 << 20
BATCH_BYTES = 4_000_000
#: Documents times terms of a shard, and its most documents.
CELLS, DOCUMENTS = 8 << 20, 4096
#: Documents of a block; lists of up to ``SHORT`` are read without a summary.
BLOCK, SHORT = 128, 32
#: Summaries hold values in units of this, rounded up, so that a byte is enough.
UNIT = 1 << 12
DIRECTIONS = 32
#: Blocks of a query that are read for a first threshold.
SEEDS = 2

_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Maximal stretches of ASCII letters, digits and all characters beyond ASCII; only A-Z lower-cased."""
    return utf8(text).translate(_TERM_BYTES).split()


class Corpus(NamedTuple):
    """Documents with at least one term, and all their terms with repeats."""

    documents: int
    terms: int

    def weight(self, df: np.ndarray) -> np.ndarray:
        """The whole-numbered weight of terms that ``df`` documents hold."""
        return np.array([math.floor(1000 * math.log((2 * self.documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)

    def values(self, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What one occurrence list adds to a score for each unit of weight; ``n`` is the document's terms."""
        m = 100 - 90 + (90 * n * self.documents) // max(1, self.terms)
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


@dataclass(frozen=True)
class Queries:
    """A bounded part of the query set: its rows, its terms, and the terms of each row."""

    items: list
    terms: list[bytes]
    of_item: list[np.ndarray]

    @classmethod
    def of(cls, rows: list[tuple[object, str]]) -> Queries:
        lists = [sorted(set(terms_of(text))) for _, text in rows]
        terms = sorted(set().union(*lists))
        place = {t: i for i, t in enumerate(terms)}
        return cls([i for i, _ in rows], terms, [np.array([place[t] for t in x], np.int64) for x in lists])


def query_parts(queries: DataFrame, item: str, text: str) -> Iterator[Queries]:
    """The query set in parts of about ``QUERY_BYTES``; each is read from the table by itself."""
    rows = queries.select(F.col(item).alias("item"), F.col(text).alias("text")).filter("text IS NOT NULL")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-int(size) // QUERY_BYTES))
    for k in range(parts):
        part = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == k)
        yield Queries.of([(r["item"], r["text"]) for r in part.collect()])


def vectors(docs: DataFrame, terms: list[bytes], key: str, text: str) -> DataFrame:
    """(_id, n, terms, tfs) for every row with a term: its occurrences of the given terms, by their places in the list."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)  # of at most QUERY_BYTES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {t: i for i, t in enumerate(shared.value)}
        wide = max(1, len(place))
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            for a, b in slices(np.array([len(t or "") for t in texts]), BATCH_BYTES):
                lists = [terms_of(t) for t in texts[a:b]]
                n = np.array([len(x) for x in lists], np.int64)
                ids = np.concatenate([np.fromiter(map(place.get, x, repeat(-1)), np.int64, len(x)) for x in lists])
                owner = np.repeat(np.arange(len(lists)), n)
                cells, tf = np.unique(owner[ids >= 0] * wide + ids[ids >= 0], return_counts=True)
                offsets = np.searchsorted(cells, np.arange(len(lists) + 1) * wide).astype(np.int32)
                rows = pa.RecordBatch.from_arrays(
                    [batch.column("_id").slice(a, b - a), pa.array(n),
                     pa.ListArray.from_arrays(offsets, pa.array((cells % wide).astype(np.int32))),
                     pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int32)))],
                    ["_id", "n", "terms", "tfs"],
                )
                yield rows.filter(pa.array(n > 0))

    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    return rows.mapInArrow(cut, f"_id {dict(rows.dtypes)['_id']}, n long, terms array<int>, tfs array<int>")


class Lists(NamedTuple):
    """List columns of a batch as flat arrays."""

    first: np.ndarray
    terms: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch, corpus: Corpus) -> Lists:
        sizes = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        terms = batch.column("terms").flatten().to_numpy().astype(np.int64)
        tf = batch.column("tfs").flatten().to_numpy().astype(np.int64)
        n = np.repeat(batch.column("n").to_numpy(), sizes)
        return cls(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), terms, corpus.values(tf, n))

    def projected(self, weight: np.ndarray) -> np.ndarray:
        """Each document's weighted vector on some random directions."""
        rays = np.random.default_rng(11).standard_normal((len(weight), DIRECTIONS), np.float32)
        out = np.zeros((len(self.first) - 1, DIRECTIONS), np.float32)
        full = np.flatnonzero(np.diff(self.first))
        for some in np.array_split(full, max(1, len(self.terms) >> 18)):
            if len(some):
                a, b = self.first[some[0]], self.first[some[-1] + 1]
                scaled = rays[self.terms[a:b]] * (weight[self.terms[a:b]] * self.values[a:b]).astype(np.float32)[:, None]
                out[some] = np.add.reduceat(scaled, self.first[some] - a)
        return out


@dataclass
class Shard:
    """Some documents, the blocks of their posting lists, and the summaries of the blocks."""

    keys: list
    first: np.ndarray
    terms: np.ndarray
    values: np.ndarray
    #: per block: its term, where its members begin, its row in the summaries or -1
    block_term: np.ndarray
    block_first: np.ndarray
    block_row: np.ndarray
    members: np.ndarray
    #: the coordinates of the summaries
    local: np.ndarray
    summary: np.ndarray

    SCHEMA = (
        "keys array<{kind}>, first array<int>, terms array<int>, values array<int>, block_term array<int>, "
        "block_first array<int>, block_row array<int>, members array<int>, local array<int>, summary binary"
    )

    @classmethod
    def build(cls, keys: list, lists: Lists, weight: np.ndarray) -> Shard:
        first, terms, values = lists
        local, column = np.unique(terms, return_inverse=True)
        owner = np.repeat(np.arange(len(keys)), np.diff(first))
        units = np.zeros((len(keys), len(local)), np.uint8)
        units[owner, column] = -(-values // UNIT)
        rays = lists.projected(weight)
        rays /= np.maximum(np.linalg.norm(rays, axis=1, keepdims=True), 1e-9)
        by_term = np.argsort(column, kind="stable")
        list_first = np.searchsorted(column[by_term], np.arange(len(local) + 1))
        block_term, block_row, sizes, members, summary = [], [], [], [], []
        for t, (a, b) in enumerate(zip(list_first[:-1].tolist(), list_first[1:].tolist(), strict=True)):
            docs = owner[by_term[a:b]]
            for block in _clusters(docs, rays):
                block_term.append(local[t])
                sizes.append(len(block))
                members.append(block)
                block_row.append(len(summary) if len(docs) > SHORT else -1)
                if len(docs) > SHORT:
                    summary.append(units[block].max(axis=0))
        return cls(
            keys, first, terms, values, np.array(block_term), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
            np.array(block_row), np.concatenate(members), local, np.array(summary, np.uint8).reshape(-1, len(local)),
        )

    def row(self, kind: pa.DataType) -> pa.RecordBatch:
        ints = [np.asarray(x, np.int32) for x in (self.first, self.terms, self.values, self.block_term,
                                                  self.block_first, self.block_row, self.members, self.local)]
        arrays = [pa.array([self.keys], pa.list_(kind)), *(pa.array([x], pa.list_(pa.int32())) for x in ints)]
        names = ["keys", "first", "terms", "values", "block_term", "block_first", "block_row", "members", "local", "summary"]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([self.summary.tobytes()], pa.binary())], names)

    @classmethod
    def rows(cls, batch: pa.RecordBatch) -> Iterator[Shard]:
        for i in range(batch.num_rows):
            ints = {
                name: batch.column(name)[i].values.to_numpy().astype(np.int64)
                for name in ("first", "terms", "values", "block_term", "block_first", "block_row", "members", "local")
            }
            flat = np.frombuffer(batch.column("summary")[i].as_py(), np.uint8)
            yield cls(keys=batch.column("keys")[i].as_py(), summary=flat.reshape(-1, len(ints["local"])), **ints)

    def open(self) -> Shard:
        """Make what all queries read: values by document and coordinate, maxima, and the blocks of each coordinate."""
        column = np.searchsorted(self.local, self.terms)
        self.table = np.zeros((len(self.keys), len(self.local)), np.int32)
        self.table[np.repeat(np.arange(len(self.keys)), np.diff(self.first)), column] = self.values
        self.highest = self.table.max(axis=0).astype(np.int64)
        self.first_block = np.searchsorted(self.block_term, np.append(self.local, self.local[-1] + 1))
        return self

    def candidates(self, columns: np.ndarray, weight: np.ndarray, least: int, few: bool) -> np.ndarray:
        """The documents whose score can reach ``least``; with ``few`` only the most promising of them."""
        best = weight * self.highest[columns]
        order = np.argsort(-best, kind="stable")
        # a document in none of the lists before holds no more than what the lists from here on can give
        rest = np.cumsum(best[order][::-1])[::-1]
        lists = columns[order[(rest >= least) & (rest > 0)]]
        blocks = np.concatenate([np.arange(self.first_block[c], self.first_block[c + 1]) for c in lists] or [np.zeros(0, np.int64)])
        row = self.block_row[blocks]
        bounds = (self.summary[np.ix_(row[row >= 0], columns)] * (weight * UNIT)).sum(axis=1)
        known = blocks[row >= 0]
        kept = known[np.argsort(-bounds, kind="stable")[:SEEDS]] if few else known[bounds >= least]
        chosen = np.concatenate([blocks[row < 0], kept])
        parts = [self.members[self.block_first[b] : self.block_first[b + 1]] for b in chosen.tolist()]
        return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.int64)


def _clusters(docs: np.ndarray, rays: np.ndarray) -> list[np.ndarray]:
    """A posting list by similarity to evenly spaced documents of it; one block if it is short."""
    if len(docs) <= BLOCK:
        return [docs]
    pivots = docs[np.linspace(0, len(docs) - 1, -(-len(docs) // BLOCK)).astype(np.int64)]
    nearest = np.argmax(rays[docs] @ rays[pivots].T, axis=1)
    return [docs[nearest == p] for p in range(len(pivots)) if (nearest == p).any()]


class Best:
    """The ``k`` best documents of every query so far: highest score first, then the smallest key, null last."""

    def __init__(self, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.rows: list[list[tuple]] = [[] for _ in least]

    def add(self, query: int, scores: np.ndarray, docs: np.ndarray, keys: list) -> None:
        if len(scores) > self.k:
            bar = max(self.least[query], np.partition(scores, -self.k)[-self.k])
            docs, scores = docs[scores >= bar], scores[scores >= bar]
        good = (scores > 0) & (scores >= self.least[query])
        if good.any():
            more = [(-s, keys[d] is None, keys[d]) for s, d in zip(scores[good].tolist(), docs[good].tolist(), strict=True)]
            self.rows[query] = sorted(self.rows[query] + more, key=lambda r: (r[0], r[1], 0 if r[1] else r[2]))[: self.k]
            if len(self.rows[query]) == self.k:
                self.least[query] = max(self.least[query], -self.rows[query][-1][0])


def build_index(found: DataFrame, corpus: Corpus, weight: np.ndarray) -> DataFrame:
    """One row for each shard: documents, blocks and summaries."""
    spark = found.sparkSession
    shared = spark.sparkContext.broadcast(weight)  # one number for each term of the query part
    kind = dict(found.dtypes)["_id"]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = Lists.of(batch, corpus).projected(shared.value) > 0
            place = (signs << np.arange(DIRECTIONS)[::-1]).sum(axis=1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, "place"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _regrouped(batches, DOCUMENTS):
            while batch.num_rows:
                n = batch.num_rows
                while n > 1 and n * len(np.unique(batch.column("terms").slice(0, n).flatten().to_numpy())) > CELLS:
                    n = -(-n // 2)
                part, batch = batch.slice(0, n), batch.slice(n)
                shard = Shard.build(part.column("_id").to_pylist(), Lists.of(part, corpus), shared.value)
                yield shard.row(part.schema.field("_id").type)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = (
        found.filter(F.size("terms") > 0)
        .mapInArrow(keyed, f"_id {kind}, n long, terms array<int>, tfs array<int>, place long")
        .repartitionByRange(parts, "place", F.xxhash64("_id", "terms"))
        .sortWithinPartitions("place")
    )
    return stored(near.mapInArrow(build, Shard.SCHEMA.format(kind=kind)))


def _regrouped(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The rows of a stream of batches in batches of ``rows``."""
    waiting: list[pa.RecordBatch] = []
    have = 0
    for batch in batches:
        waiting.append(batch)
        have += batch.num_rows
        while have >= rows:
            whole = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            yield whole.slice(0, rows)
            waiting, have = [whole.slice(rows)], have - rows
    if have:
        yield pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]


def _search(index: DataFrame, queries: Queries, weight: np.ndarray, k: int, least: np.ndarray, few: bool) -> DataFrame:
    """(query, key, score): for every task of the index, its ``k`` best documents of each query that reach ``least``."""
    shared = index.sparkSession.sparkContext.broadcast((queries.of_item, weight, least))  # of the size of a query part
    kind = dict(index.dtypes)["keys"].removeprefix("array<").removesuffix(">")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_item, weight, least = shared.value
        best, keys = Best(k, least), pa.null()
        for batch in batches:
            keys = batch.schema.field("keys").type.value_type
            for shard in Shard.rows(batch):
                shard.open()
                for query, terms in enumerate(of_item):
                    columns = np.searchsorted(shard.local, terms)
                    here = np.minimum(columns, len(shard.local) - 1)
                    held = shard.local[here] == terms
                    columns, w = here[held], weight[terms[held]]
                    docs = shard.candidates(columns, w, best.least[query], few)
                    if len(docs):
                        best.add(query, (shard.table[np.ix_(docs, columns)] * w).sum(axis=1), docs, shard.keys)
        rows = [(q, r[2], -r[0]) for q, found in enumerate(best.rows) for r in found]
        if rows:
            q, key, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int32()), pa.array(key, keys), pa.array(score, pa.int64())], ["query", "key", "score"]
            )

    return index.mapInArrow(look, f"query int, key {kind}, score long")


def rank(
    docs: DataFrame, queries: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text",
    item: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(item, rank, key, score): the ``k`` documents with the highest scores above 0 for every row of ``queries``.

    A score is the sum, over a query's distinct terms, of the term's whole-numbered
    weight times a saturated frequency in the document (``Corpus``); equal scores
    go by ascending key, null last. The result is exact. Whole texts are read; a
    null text, or one without a term, is found by nothing and finds nothing. Each
    row of either table counts by itself, also if it is repeated; other columns are
    not looked at. Empty tables give an empty result.

    The query set is looked for in parts of ``QUERY_BYTES``, each with an index of
    its own terms over all documents, which is read twice: a few blocks of each
    shard give the first thresholds, then all blocks that can still matter are
    scored. Only weights, queries and thresholds are broadcast; a task hands on at
    most ``k`` rows for a query.
    """
    kind = dict(queries.dtypes)[item]
    parts = [_rank_part(docs, part, k, key, text, kind) for part in query_parts(queries, item, item_text)]
    ranked = reduce(DataFrame.unionByName, parts)
    return ranked.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")


def _rank_part(docs: DataFrame, part: Queries, k: int, key: str, text: str, kind: str) -> DataFrame:
    spark = docs.sparkSession
    found = stored(vectors(docs, part.terms, key, text))
    counted = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    corpus = Corpus(int(counted[0]), int(counted[1]))
    df = np.zeros(len(part.terms), np.int64)
    for r in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # terms of one query part
        df[r["t"]] = r["count"]
    weight = corpus.weight(df)
    index = build_index(found, corpus, weight)
    least = np.zeros(len(part.items), np.int64)
    order = [F.desc("score"), F.asc_nulls_last("key")]
    place = Window.partitionBy("query")
    seeds = _search(index, part, weight, k, least, few=True)
    nth = seeds.withColumn("rank", F.row_number().over(place.orderBy(F.desc("score")))).filter(F.col("rank") == k)
    for r in nth.select("query", "score").collect():  # one row for a query
        least[r["query"]] = r["score"]
    best = stored(_search(index, part, weight, k, least, few=False))
    best = best.withColumn("rank", F.row_number().over(place.orderBy(*order))).filter(F.col("rank") <= k)
    items = spark.createDataFrame(list(enumerate(part.items)), f"query int, item {kind}")
    return best.join(F.broadcast(items), "query").select("item", "rank", "key", "score")
