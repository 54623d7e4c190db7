"""Periodic runs of words, from a dictionary of basic factors.

A basic factor is a stretch of 2^k words. At every level k the factors of a text
get names, equal factors the same one, from the pair of names of their halves.
A run with a period from 2^k to below 2^(k+1) holds the same factor twice, one
period apart, so less than twice the factor's length. Occurrences of a factor
that overlap by half or more form an arithmetic progression; two progressions
close to each other propose the distances between their members as periods. A
proposal is extended to both sides by comparing names from the longest factors
down, and the extended stretches that are long enough, each with its smallest
period, are the runs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from reviewmill.llm.base import slices, utf8

BATCH_BYTES = 2_000_000
FIELDS = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


@dataclass(frozen=True)
class Rules:
    """A run has at least ``words`` words and at least ``turns`` periods; ``turns`` is 2 or more."""

    words: int = 12
    turns: int = 2


class Runs(NamedTuple):
    """Runs of a batch of texts that lie one after the other; by start, then period."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def basic_factors(codes: np.ndarray) -> list[np.ndarray]:
    """Names of the factors of 2^k symbols at every place, for all k at which a factor repeats.

    A factor that occurs once is named -1, as is the place behind the end.
    """
    levels = [_names(codes, np.arange(len(codes)), len(codes))]
    while (levels[-1] >= 0).any():
        half, names = 1 << (len(levels) - 1), levels[-1]
        at = np.flatnonzero(names[: max(0, len(codes) - half)] >= 0)
        at = at[names[at + half] >= 0]
        pairs = names[at].astype(np.int64) * (int(names.max()) + 1) + names[at + half]
        levels.append(_names(pairs, at, len(codes)))
    return levels[:-1]


def _names(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Number the values that repeat; place ``n`` stands for what lies outside."""
    names = np.full(n + 1, -1, np.int32)
    if len(values):
        _, which, count = np.unique(values, return_inverse=True, return_counts=True)
        again = count[which] > 1
        names[at[again]] = which[again]
    return names


def proposals(names: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) pairs with size <= period < 2 * size where a factor of ``size`` occurs again.

    For every run with such a period there is at least one pair inside it.
    """
    at = np.flatnonzero(names >= 0)
    at = at[np.argsort(names[at], kind="stable")]
    name = names[at]
    # progressions: occurrences of one factor whose steps are at most half of it
    fresh = np.ones(len(at), bool)
    fresh[1:] = (name[1:] != name[:-1]) | (2 * (at[1:] - at[:-1]) > size)
    head = np.flatnonzero(fresh)
    tail = np.append(head[1:], len(at)) - 1
    first, last, name, more = at[head], at[tail], name[head], tail - head
    step = np.where(more > 0, at[np.minimum(head + 1, len(at) - 1)] - first, 0)
    places, periods = [], []
    for ahead in (1, 2, 3):  # more than half a factor lies between neighbours, so a fourth is too far
        left = np.flatnonzero(name[ahead:] == name[:-ahead])
        right = left + ahead
        by = np.maximum(np.maximum(step[left], step[right]), 1)
        nearest = first[right] - last[left]
        low = np.maximum(0, -(-(size - nearest) // by))
        high = np.minimum(more[left] + more[right], (2 * size - 1 - nearest) // by)
        many = np.maximum(high - low + 1, 0)
        pair = np.repeat(np.arange(len(left)), many)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many) + low[pair]
        back = np.minimum(k, more[left[pair]])
        places.append(last[left[pair]] - back * by[pair])
        periods.append(nearest[pair] + k * by[pair])
    return np.concatenate(places), np.concatenate(periods)


def extend(levels: list[np.ndarray], place: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of the longest stretch around each place that keeps the period."""
    n = len(levels[0]) - 1
    ahead, behind = np.zeros_like(place), np.zeros_like(place)
    for k in reversed(range(len(levels))):
        names = levels[k]
        here, there = np.minimum(place + ahead, n), np.minimum(place + ahead + period, n)
        ahead += ((names[here] >= 0) & (names[here] == names[there])).astype(np.int64) << k
        here = place - behind - (1 << k)
        here, there = np.where(here < 0, n, here), np.where(here < 0, n, here + period)
        behind += ((names[here] >= 0) & (names[here] == names[there])).astype(np.int64) << k
    return place - behind, behind + ahead + period


def find_runs(codes: np.ndarray, rules: Rules = Rules()) -> Runs:
    """All runs of a sequence of numbers."""
    levels = basic_factors(codes)
    found = [np.zeros((0, 3), np.int64)]
    for k, names in enumerate(levels):
        place, period = proposals(names, 1 << k)
        start, length = extend(levels, place, period)
        kept = (length >= rules.words) & (length >= rules.turns * period)
        found.append(np.unique(np.stack([start[kept], length[kept], period[kept]], 1), axis=0))
    start, length, period = np.concatenate(found).T
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    smallest = np.ones(len(start), bool)  # a multiple of the period covers the same stretch
    smallest[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    order = np.lexsort((period[smallest], start[smallest]))
    return Runs(*(x[smallest][order] for x in (start, length, period)))


def runs_of_texts(texts: list[str | None], rules: Rules = Rules()) -> pd.DataFrame:
    """n_words, runs and collapsed text of each text; see ``periodic_runs``."""
    lists = [utf8(t).split() for t in texts]  # bytes are split at ASCII blanks only
    sizes = np.array([len(words) for words in lists], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for words in lists for w in words), np.int64, int(first[-1]))
    # equal words of two texts are told apart, so that nothing repeats across texts
    found = find_runs(ids + np.repeat(np.arange(len(lists)), sizes) * max(1, len(known)), rules)
    owner = np.searchsorted(first, found.start, "right") - 1
    depth = np.zeros(int(first[-1]) + 1, np.int32)
    np.add.at(depth, found.start + found.period, 1)
    np.add.at(depth, found.start + found.length, -1)
    gone = np.cumsum(depth) > 0
    runs: list[list[dict]] = [[] for _ in lists]
    for text, start, length, period in zip(owner.tolist(), *(x.tolist() for x in found), strict=True):
        runs[text].append({"start": start - int(first[text]), "length": length, "period": period})
    kept = [
        [w for w, g in zip(words, gone[a : a + len(words)].tolist(), strict=True) if not g] if mine else words
        for words, a, mine in zip(lists, first.tolist(), runs, strict=False)
    ]
    collapsed = [b" ".join(words).decode("utf-8", "surrogatepass") for words in kept]
    return pd.DataFrame({"n_words": sizes, "runs": pd.Series(runs, dtype=object), "collapsed": pd.Series(collapsed, dtype=object)})


def periodic_runs(text: str | Column = "text", rules: Rules = Rules()) -> Column:
    """A struct column for a column of texts: n_words, runs, collapsed.

    Words are what stands between ASCII blanks, numbered from 0. A run is a
    stretch of words with smallest period q (words q apart are equal) that is at
    least ``rules.words`` words and ``rules.turns`` periods long and that no
    neighbouring word extends. ``runs`` lists (start, length, period) by start,
    then period; runs may overlap or hold others. ``collapsed`` is the text
    without the words that lie behind the first period of a run, joined by single
    blanks.

    Whole texts are read and documents don't depend on each other, so nothing is
    moved. A null, empty or blank text has no words, no runs and an empty collapsed
    text. Repeated rows get equal results. Memory is some levels of 4 bytes a word
    of about 2 MB of text, or of one longer text, one level for each doubling of
    its longest repeat.
    """

    @pandas_udf(FIELDS)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = list(batch)
            cuts = slices(np.array([len(t or "") for t in texts]), BATCH_BYTES)
            parts = [runs_of_texts(texts[a:b], rules) for a, b in cuts]
            yield pd.concat(parts, ignore_index=True) if parts else runs_of_texts([], rules)

    return search(F.col(text) if isinstance(text, str) else text)
