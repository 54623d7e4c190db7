"""URL rules and wildcards, all of them run together as one bit-parallel automaton."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from reviewmill.llm.base import ASCII_LOWER, ASCII_UPPER, slices, utf8

#: URLs whose states are held at once, in bytes of text and of state words.
BATCH_BYTES = 4_000_000


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains, and the start of a path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> tuple[str, str]:
        return f"{self.host}{self.path}**", f"*.{self.host}{self.path}**"


@dataclass(frozen=True)
class Glob:
    """A wildcard over host + path: ``*`` is any run without ``/``, ``**`` any run, ``?`` one byte."""

    pattern: str
    verdict: str


class ShiftAnd:
    """All patterns as one set of state bits, spread over as many 64-bit words as they need.

    A pattern of m symbols owns m + 1 bits; bit j means that the first j symbols
    have matched. A step moves every bit up by one where the next symbol accepts
    the byte, and keeps bits that stand on a star. Both are masks looked up by
    byte, so one step costs a few operations on each word for all patterns and
    for all URLs of a batch.
    """

    def __init__(self, patterns: Sequence[str]):
        accept: list[tuple[int, int]] = []  # (bit, byte), -1 for any byte
        stay: list[tuple[int, bool]] = []  # (bit, whether "/" is allowed)
        self.starts: list[int] = []
        self.ends: list[int] = []
        bit = 0
        for pattern in patterns:
            raw = utf8(pattern)
            self.starts.append(bit)
            i = 0
            while i < len(raw):
                if raw[i] == ord("*"):
                    wide = raw[i : i + 2] == b"**"
                    stay.append((bit, wide))
                    i += 1 + wide
                else:
                    bit += 1
                    accept.append((bit, -1 if raw[i] == ord("?") else raw[i]))
                    i += 1
            self.ends.append(bit)
            bit += 1
        self.words = max(1, -(-bit // 64))
        self.accept = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        for at, byte in accept:
            self.accept[slice(None) if byte < 0 else byte, at // 64] |= np.uint64(1 << (at % 64))
        for at, wide in stay:
            mask = np.uint64(1 << (at % 64))
            self.stay[:, at // 64] |= mask
            if not wide:
                free = any(b == at and w for b, w in stay)
                if not free:
                    self.stay[ord("/"), at // 64] &= ~mask
        self.first = np.zeros(self.words, np.uint64)
        for at in self.starts:
            self.first[at // 64] |= np.uint64(1 << (at % 64))

    def matches(self, texts: Sequence[bytes]) -> np.ndarray:
        """Whether each pattern matches each whole text: (texts, patterns)."""
        lengths = np.array([len(t) for t in texts], np.int64)
        out = np.zeros((len(texts), len(self.ends)), bool)
        order = np.argsort(-lengths, kind="stable")
        buffer = np.frombuffer(b"".join(texts) + b"\0", np.uint8)
        offsets = np.concatenate([[0], np.cumsum(lengths)])[:-1][order]
        lengths = lengths[order]
        state = np.tile(self.first, (len(texts), 1))
        active = len(texts)
        for at in range(int(lengths[0]) if len(texts) else 0):
            active = int(np.searchsorted(-lengths[:active], -at, side="left"))  # texts longer than `at`
            byte = buffer[offsets[:active] + at]
            now = state[:active]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:active] = (moved & self.accept[byte]) | (now & self.stay[byte])
        for k, at in enumerate(self.ends):
            out[order, k] = (state[:, at // 64] >> np.uint64(at % 64)) & np.uint64(1) != 0
        return out


def host_column(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, ASCII_UPPER, ASCII_LOWER), F.lit(""))


def path_column(url: str) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def filter_urls(
    pages: DataFrame, url: str, rules: Sequence[Rule], globs: Sequence[Glob], default: str = "allow"
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row of ``pages``.

    The longest fitting rule decides; where none fits, the first fitting glob;
    else ``default`` with a null rule. A missing url, or one without ``://``,
    has an empty host and path. Rules and globs are parameters, so the automaton
    has a fixed size; rows are independent, so repeated rows, ties and very long
    urls need no care beyond time in proportion to their length. Columns of
    ``pages`` with the four names are replaced, all others stay as they are.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.name))
    patterns = [g for r in ranked for g in r.globs()] + [g.pattern for g in globs]
    automaton = ShiftAnd(patterns)
    verdicts = [r.verdict for r in ranked for _ in range(2)] + [g.verdict for g in globs] + [default]
    names = [r.name for r in ranked for _ in range(2)] + [None] * (len(globs) + 1)

    @pandas_udf("rule string, verdict string")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [utf8(t) for t in batch]
            picks = np.full(len(texts), len(patterns), np.int64)
            cost = np.array([len(t) + 8 * automaton.words * 3 for t in texts], np.int64)
            for start, end in slices(cost, BATCH_BYTES):
                hit = automaton.matches(texts[start:end])
                if hit.shape[1]:
                    picks[start:end] = np.where(hit.any(axis=1), hit.argmax(axis=1), len(patterns))
            yield pd.DataFrame({"rule": [names[i] for i in picks], "verdict": [verdicts[i] for i in picks]})

    parts = pages.withColumns({"host": host_column(url), "path": path_column(url)})
    judged = parts.withColumn("_judged", judge(F.concat("host", "path")))
    return judged.withColumns({"rule": F.col("_judged.rule"), "verdict": F.col("_judged.verdict")}).drop("_judged")
