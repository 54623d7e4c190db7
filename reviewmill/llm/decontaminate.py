"""Benchmark passages in documents, found by seeds that every overlap holds and checked along the diagonal."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from reviewmill.llm.base import slices, stored

#: Bytes of benchmark text that are compared in one pass over the documents.
PASS_BYTES = 16 << 20
BATCH_BYTES = 2_000_000
#: Shared seeds that are looked at together.
HITS = 1 << 15
#: Words that a mask spans at most.
SPAN = 8
COUNTS = ("n_equal", "n_span", "first_word", "item_first_word", "item_words")
_SPLIT = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Rules:
    """What counts as an overlap: so many equal words, and their share of the aligned span."""

    words: int = 13
    share: float = 0.8

    @property
    def parts(self) -> tuple[int, int]:
        """``share`` as two whole numbers, so that sums of it are exact."""
        return Fraction(self.share).limit_denominator(1_000_000).as_integer_ratio()

    @property
    def reach(self) -> int:
        """Every overlap holds one of at most so many words.

        One of 2 * ``words`` equal words or more can be cut after its first
        ``words`` equal ones, and one side of the cut keeps the share.
        """
        return int((2 * self.words - 1) / self.share) + 1


def covers(family: tuple[str, ...], rules: Rules) -> bool:
    """Whether every overlap holds a mask of the family, at whatever places its words differ.

    Overlaps are built word by word, equal (1) or differing (0), never completing
    a mask. Of all that end alike and have as many equal words, the one with the
    most to spare of the share stands for the others. The family covers if none of
    them ever is an overlap.
    """
    up, down = rules.parts
    span = max(map(len, family))
    least = -max(2 * up * span, rules.words * (down - up))
    spare = {("1", 1): down - up} if "1" not in family else {}
    todo = dict(spare)
    while todo:
        new: dict[tuple[str, int], int] = {}
        for (ending, n), left in todo.items():
            if n == rules.words and left >= 0:
                return False
            for word, more, change in (("1", 1, down - up), ("0", 0, -up)):
                tail = ending + word
                if not any(len(m) <= len(tail) and all(k == "0" or t == "1" for k, t in zip(m, tail[-len(m) :], strict=True)) for m in family):
                    state = (tail[-max(1, span - 1) :], min(rules.words, n + more))
                    # what makes up for less than this is an overlap by itself
                    if left + change > max(spare.get(state, least), new.get(state, least)):
                        new[state] = left + change
        spare.update(new)
        todo = new
    return True


@lru_cache
def masks(rules: Rules) -> tuple[str, ...]:
    """A mask with ignored positions and its mirror image of which every overlap holds one.

    Of all up to ``SPAN`` words long, the pair that keeps most positions. A plain run
    of words where no such pair covers the rules: ``d`` differing words need a number
    of equal ones to keep the share and cut them into d + 1 runs at most, and the
    longest run is no shorter than the mean.
    """
    up, down = rules.parts
    longest = rules.words
    if up < down:
        for d in range(rules.words + 1):
            equal = max(rules.words, -(-d * up // (down - up)))
            longest = min(longest, -(-equal // (d + 1)))
    for kept in range(min(SPAN - 1, rules.words), 1, -1):
        for size in range(kept + 1, min(SPAN, rules.words) + 1):
            for zeros in combinations(range(1, size - 1), size - kept):
                mask = "".join("0" if k in zeros else "1" for k in range(size))
                family = tuple(dict.fromkeys((mask, mask[::-1])))
                if covers(family, rules):
                    return family
    return ("1" * longest,)


MASKS = masks(Rules())


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words; ASCII punctuation separates."""
    return text.lower().encode("utf-8", "replace").translate(_SPLIT).split() if text else []


def codes_of(lists: list[list[bytes]]) -> np.ndarray:
    """A 64-bit code for every word of the lists, one after the other."""
    from xxhash import xxh3_64_intdigest

    total = sum(map(len, lists))
    return np.fromiter((xxh3_64_intdigest(w) for words in lists for w in words), np.uint64, total)


def seeded(codes: np.ndarray, mask: str) -> np.ndarray:
    """The hash of the kept positions of ``mask`` at every place where the whole mask fits."""
    n = len(codes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, len(mask), np.uint64)
    for at, keep in enumerate(mask):
        if keep == "1":
            out = (out ^ codes[at : at + n]) * _MIX
            out ^= out >> np.uint64(29)
    return out


class Index:
    """The seeds of some benchmark items, sorted, with a filter of bits in front."""

    BITS = 22

    def __init__(self, items: list[tuple[object, str]], rules: Rules = Rules()):
        lists = [words_of(text) for _, text in items]
        keep = [i for i, words in enumerate(lists) if words]
        self.ids = [items[i][0] for i in keep]
        lists = [lists[i] for i in keep]
        self.sizes = np.array([len(w) for w in lists], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.codes = codes_of(lists)
        seeds = masks(rules)
        span = len(seeds[0])
        # items too short for a seed are looked for as a whole
        short = sorted({int(n) for n in self.sizes if n < span})
        self.masks = list(dict.fromkeys([*seeds, *("1" * n for n in short)]))
        hashes, where = [], []
        for mask in self.masks:
            for i, n in enumerate(self.sizes.tolist()):
                if mask == "1" * n if n < span else mask in seeds:
                    h = seeded(self.codes[self.first[i] : self.first[i + 1]], mask)
                    hashes.append(h)
                    where.append(self.first[i] + np.arange(len(h)))
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        w = np.concatenate(where) if where else np.zeros(0, np.int64)
        order = np.argsort(h, kind="stable")
        self.hashes, self.where = h[order], w[order]
        self.filter = np.zeros(1 << self.BITS, bool)
        self.filter[(self.hashes >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    def hits(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places in ``codes`` and in the items' codes that share a seed, at most ``HITS`` at a time."""
        for mask in self.masks:
            h = seeded(codes, mask)
            maybe = np.flatnonzero(self.filter[(h >> np.uint64(64 - self.BITS)).astype(np.int64)])
            low = np.searchsorted(self.hashes, h[maybe], "left")
            ends = np.cumsum(np.searchsorted(self.hashes, h[maybe], "right") - low)
            for begin in range(0, int(ends[-1]) if len(ends) else 0, HITS):
                k = np.arange(begin, min(begin + HITS, int(ends[-1])))
                of = np.searchsorted(ends, k, "right")
                yield maybe[of], self.where[low[of] + ends[of] - 1 - k]


def best_stretch(equal: np.ndarray, rules: Rules) -> tuple[int, int, int]:
    """(equal words, begin, end) of the stretch with the most equal words that keeps the share, the shortest of these."""
    up, down = rules.parts
    ends = np.flatnonzero(equal) + 1
    if not len(ends):
        return 0, 0, 0
    score = np.concatenate([[0], np.cumsum(np.where(equal, down - up, -up))])
    count = np.concatenate([[0], np.cumsum(equal)])
    # the first place from which the score up to an end isn't negative is where the lowest score so far gets there
    start = np.searchsorted(-np.minimum.accumulate(score), -score[ends], "left")
    n = count[ends] - count[start]
    start = np.searchsorted(count, count[start], "right") - 1  # begin with an equal word
    best = np.lexsort((start, ends - start, -n))[0]
    return int(n[best]), int(start[best]), int(ends[best])


def diagonals(codes: np.ndarray, first: np.ndarray, index: Index, rules: Rules) -> set[tuple[int, int, int]]:
    """(document, item, shift) where enough words near a shared seed are equal."""
    out: set[tuple[int, int, int]] = set()
    sizes = np.diff(first)
    need = np.minimum(rules.words, index.sizes)
    for at, there in index.hits(codes):
        doc = np.searchsorted(first, at, "right") - 1
        item = np.searchsorted(index.first, there, "right") - 1
        p, q = at - first[doc], there - index.first[item]
        # a seed stands for those close behind it on the same diagonal
        _, one = np.unique(np.stack([doc, item, p - q, p // rules.reach], 1), axis=0, return_index=True)
        at, there, doc, item, p, q = (x[one] for x in (at, there, doc, item, p, q))
        if not len(at):
            continue
        # a short overlap that holds one of these seeds lies within its reach on both sides
        low = -np.minimum(rules.reach, np.minimum(p, q))
        high = np.minimum(rules.words + 2 * rules.reach, np.minimum(sizes[doc] - p, index.sizes[item] - q))
        begin = np.concatenate([[0], np.cumsum(high - low)])
        step = np.arange(begin[-1]) - np.repeat(begin[:-1] - low, high - low)
        equal = codes[np.repeat(at, high - low) + step] == index.codes[np.repeat(there, high - low) + step]
        near = np.add.reduceat(equal, begin[:-1], dtype=np.int64) >= need[item]
        out.update(zip(doc[near].tolist(), item[near].tolist(), (p - q)[near].tolist(), strict=True))
    return out


def overlaps(texts: list[str | None], index: Index, rules: Rules) -> list[list[dict]]:
    """For every text, its best overlap with each item, by place in the text."""
    out: list[list[dict]] = [[] for _ in texts]
    if not len(index.sizes):
        return out
    lists = [words_of(t) for t in texts]
    sizes = np.array([len(w) for w in lists], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    codes = codes_of(lists)
    found: dict[tuple[int, int], tuple] = {}
    for d, i, s in sorted(diagonals(codes, first, index, rules)):
        begin, end = max(0, s), min(int(sizes[d]), s + int(index.sizes[i]))
        a = codes[first[d] + begin : first[d] + end]
        b = index.codes[index.first[i] + begin - s : index.first[i] + end - s]
        n, left, right = best_stretch(a == b, rules)
        if n >= min(rules.words, int(index.sizes[i])):
            best = (-n, right - left, begin + left, begin + left - s)
            if (d, i) not in found or best < found[d, i]:
                found[d, i] = best
    for (d, i), (n, span, start, item_start) in sorted(found.items(), key=lambda x: (x[0][0], x[1][2], x[0][1])):
        out[d].append({"item_id": index.ids[i], "n_equal": -n, "n_span": span, "first_word": start,
                       "item_first_word": item_start, "item_words": int(index.sizes[i])})
    return out


def passes(benchmark: DataFrame, item: str, text: str) -> list[Callable[[], list[tuple[object, str]]]]:
    """The benchmark in parts of about ``PASS_BYTES``; each is read from the table when it is called for."""
    rows = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).filter("text IS NOT NULL")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-int(size) // PASS_BYTES))

    def read(k: int) -> list[tuple[object, str]]:
        part = rows.filter(F.pmod(F.xxhash64("text", "item"), F.lit(parts)) == k)
        return sorted(((r["item"], r["text"]) for r in part.collect()), key=lambda r: (r[0] is None, r[0], r[1]))

    return [lambda k=k: read(k) for k in range(parts)]


def find_overlaps(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", rules: Rules = Rules(),
) -> DataFrame:
    """(key, item_id, n_equal, n_span, first_word, item_first_word, item_words): the overlaps of texts with the benchmark.

    One row for each row of ``docs`` and each item with which its text shares an
    aligned stretch of words, the longest one. A stretch counts if at least
    ``rules.words`` words are equal (or all of a shorter item) and at least
    ``rules.share`` of it. Candidates come from the hashes of two masks that ignore
    one or more positions and of which every such stretch holds one (``covers``),
    so no placing of substituted words hides a passage; items too short for a mask
    are found whole. Whole texts are read. Null or empty texts and items overlap
    with nothing; equal items are all named; documents don't depend on each other.

    The benchmark is compared in passes of about ``PASS_BYTES``: each is a scan of
    the documents by itself with its own index, and where there are several, its
    rows are written before the next begins. Documents are not moved.
    """
    searches = _passes(docs, benchmark, text, item, item_text, rules)
    parts = []
    for search in searches:
        found = docs.select(F.col(key).alias("_key"), F.explode(search()).alias("o"))
        parts.append(found if len(searches) == 1 else stored(found))
    whole = reduce(DataFrame.unionByName, parts)
    return whole.select(F.col("_key").alias(key), F.col("o.item_id").alias(item), *[f"o.{c}" for c in COUNTS])


def _passes(
    docs: DataFrame, benchmark: DataFrame, text: str, item: str, item_text: str, rules: Rules
) -> list[Callable[[], Column]]:
    """For each part of the benchmark, what gives the column of the overlaps with it."""
    kind = dict(benchmark.dtypes)[item]
    fields = f"array<struct<item_id:{kind},{','.join(f'{c}:int' for c in COUNTS)}>>"
    return [lambda part=part: _search(docs, part(), fields, rules)(F.col(text)) for part in passes(benchmark, item, item_text)]


def _search(docs: DataFrame, part: list[tuple[object, str]], fields: str, rules: Rules):
    """The function that compares texts with one part of the benchmark."""
    shared = docs.sparkSession.sparkContext.broadcast(part)  # about PASS_BYTES

    @pandas_udf(fields)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(shared.value, rules)
        for batch in batches:
            texts = list(batch)
            cuts = slices(np.array([len(t or "") for t in texts]), BATCH_BYTES)
            yield pd.Series([x for a, b in cuts for x in overlaps(texts[a:b], index, rules)], dtype=object)

    return search


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    rules: Rules = Rules(),
) -> DataFrame:
    """The rows of ``docs`` that overlap with no benchmark item, columns as they were.

    One pass of the benchmark is a filter. Of several, each drops rows from what
    the one before has kept and written.
    """
    searches = _passes(docs, benchmark, text, item, item_text, rules)
    for k, search in enumerate(searches, 1):
        docs = docs.filter(F.size(search()) == 0)
        docs = docs if k == len(searches) else stored(docs)
    return docs
