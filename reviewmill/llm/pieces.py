"""SentencePiece texts to ids and back, for models of the merge type.

Merging takes the adjacent pair whose joined piece scores highest, again and
again. The same ids follow without merging a text: a sequence of pieces is the
merged one exactly if every two neighbours stay two pieces when their characters
are merged again. So a text is covered from the left by the longest piece that
an Aho-Corasick automaton found at each place; a piece that cannot follow the one
before gives way to its longest prefix that is a piece; where none is left, the
place is marked in a bitfield of failed positions and the piece before gives way.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from reviewmill.llm.base import slices

SPACE = "▁"
#: Words, parts of words and pairs of pieces that a worker remembers (of words and parts up to twice as many).
WORDS, PARTS, PAIRS = 300_000, 100_000, 400_000
#: Longer ones aren't remembered.
LONG = 64
BATCH_BYTES = 2_000_000


@dataclass(frozen=True)
class Vocabulary:
    """The pieces of a model by id, as plain values that travel with a job.

    ``pieces`` are the ordinary pieces; other ids have an empty string there.
    ``order`` is the rank of a piece's score (equal scores share one), ``bytes``
    maps byte values to ids, ``names`` are the texts of ids outside of both.
    """

    pieces: tuple[str, ...]
    order: tuple[int, ...]
    bytes: tuple[int, ...]
    unknown: int
    names: tuple[str, ...]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a model file on the driver; it must merge, fall back to bytes and leave texts as they are."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        probe = "  ﬁ½  é́\tA\n "
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("the model changes texts before it cuts them")
        if any(model.is_unused(i) for i in ids):
            raise ValueError("the model has unused pieces")
        plain = [not (model.is_byte(i) or model.is_unknown(i) or model.is_control(i)) for i in ids]
        values = {int(model.id_to_piece(i)[3:-1], 16): i for i in ids if model.is_byte(i)}
        if len(values) != 256:
            raise ValueError("the model has no byte pieces")
        pieces = tuple(model.id_to_piece(i) if plain[i] else "" for i in ids)
        scores = sorted({model.get_score(i) for i in ids if plain[i]}, reverse=True)
        rank = {score: r for r, score in enumerate(scores)}
        if not {c for p in pieces for c in p} <= set(pieces):
            raise ValueError("a piece holds a character that is not a piece")
        return cls(
            pieces,
            tuple(rank[model.get_score(i)] if plain[i] else -1 for i in ids),
            tuple(values[b] for b in range(256)),
            model.unk_id(),
            tuple("" if plain[i] or model.is_control(i) else model.decode([i]) if model.is_unknown(i) else "" for i in ids),
        )


class Encoder:
    """Ids of texts by backtracking. It travels with a job: everything here has the size of the vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.pieces = vocabulary.pieces
        self.order = vocabulary.order
        self.bytes = vocabulary.bytes
        self.id_of = {p: i for i, p in enumerate(self.pieces) if p}
        self.sizes = [len(p) for p in self.pieces]
        self.joined = {
            (self.id_of[p[:k]], self.id_of[p[k:]]): i
            for p, i in self.id_of.items()
            for k in range(1, len(p))
            if p[:k] in self.id_of and p[k:] in self.id_of
        }
        self.halves: dict[int, tuple[int, int]] = {}
        for piece, i in self.id_of.items():
            ids, last = self.merge(piece)
            if ids == [i]:
                self.halves[i] = last
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i in self.halves:
            self.automaton.add_word(self.pieces[i], i)
        self.automaton.make_automaton()
        # the longest piece that a piece starts with, or -1
        self.shorter = [-1] * len(self.pieces)
        for i in self.halves:
            starts = (self.id_of.get(self.pieces[i][:k], -1) for k in range(self.sizes[i] - 1, 0, -1))
            self.shorter[i] = next((j for j in starts if j in self.halves), -1)
        # pieces that are merged from better ones at every step; their merges happen in the order of their ranks
        self.graded: set[int] = set()
        for i in sorted(self.halves, key=self.sizes.__getitem__):
            parts = self.halves[i]
            if not parts or all(j in self.graded and (not self.halves[j] or self.order[j] < self.order[i]) for j in parts):
                self.graded.add(i)
        # without a piece that goes on with a blank, no merge crosses the place before a blank
        self.parted = not any(SPACE in p.lstrip(SPACE) for p in self.id_of)
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if self.parted else ".+", re.DOTALL)
        # likewise between two characters that no piece holds side by side
        self.beside = {p[k : k + 2] for p in self.id_of for k in range(len(p) - 1)}
        self.edges: dict[tuple[int, int], list[int]] = {}
        self.picks: dict[tuple[int, int], int] = {}
        self.parts = Remembered(self.covered, PARTS)
        self.known = Remembered(self.spelt, WORDS)

    def merge(self, text: str) -> tuple[list[int], tuple[int, ...]]:
        """The ids of a few known characters by merging, highest score first, then the leftmost; and the last pair."""
        ids, last = [self.id_of[c] for c in text], ()
        while True:
            pairs = [self.joined.get(p) for p in zip(ids, ids[1:])]
            ranks = [self.order[j] for j in pairs if j is not None]
            if not ranks:
                return ids, last
            best = min(ranks)
            at = next(k for k, j in enumerate(pairs) if j is not None and self.order[j] == best)
            last = (ids[at], ids[at + 1])
            ids[at : at + 2] = [pairs[at]]

    def edge(self, piece: int, side: int) -> list[int]:
        """What stands at one end of a piece while it is merged: a character first, the piece itself last."""
        known = self.edges.get((piece, side))
        if known is None:
            parts = [piece]
            while self.halves[parts[-1]]:
                parts.append(self.halves[parts[-1]][side])
            known = self.edges[piece, side] = parts[::-1]
        return known

    def can_follow(self, left: int, right: int) -> bool:
        """Whether two neighbouring pieces are still these two when their characters are merged again.

        Merging again can only go wrong where the pieces touch. So only what
        stands there is followed: it is joined across the border if that ranks
        before the next merge on either side.
        """
        if left not in self.graded or right not in self.graded:
            return self.merge(self.pieces[left] + self.pieces[right])[0] == [left, right]
        before, after, order, never = self.edge(left, 1), self.edge(right, 0), self.order, len(self.pieces)
        i = j = 0
        while True:
            next_left = order[before[i + 1]] if i + 1 < len(before) else never
            next_right = order[after[j + 1]] if j + 1 < len(after) else never
            across = self.joined.get((before[i], after[j]))
            if across is not None and order[across] < next_left and order[across] <= next_right:
                return False  # of equal ranks the leftmost is merged first
            if next_left == next_right == never:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1

    def pick(self, left: int, piece: int) -> int:
        """The longest of a piece and the pieces it starts with that can follow ``left``, or -1; remembered."""
        known = self.picks.get((left, piece))
        if known is None:
            if len(self.picks) >= PAIRS:
                self.picks.clear()
            known = piece
            while known >= 0 and left >= 0 and not self.can_follow(left, known):
                known = self.shorter[known]
            self.picks[left, piece] = known
        return known

    def cover(self, word: str) -> list[int]:
        """The ids of a text that merging would give; time and memory grow with its length only."""
        sizes, shorter, pick, longest = self.sizes, self.shorter, self.pick, self.automaton.iter_long
        # the longest pieces from the left, as far as each can follow the one before
        ids = [piece for _, piece in longest(word)]
        n, at = len(word), sum(map(sizes.__getitem__, ids))
        if at != n:  # some characters aren't in the vocabulary
            ids = []
        else:
            picked = list(map(self.picks.get, zip(ids, ids[1:])))
            if picked == ids[1:]:
                return ids
            del ids[next(k for k, found in enumerate(picked) if found != ids[k + 1]) + 1 :]
        at, last = sum(map(sizes.__getitem__, ids)), ids[-1] if ids else -1
        failed = bytearray((n >> 3) + 1)
        ahead = longest(word, at)
        while at < n:
            end, first = next(ahead, (n, -1))
            if first < 0 or end - sizes[first] + 1 != at:
                # a character outside the vocabulary, to which nothing is ever joined
                ids.append(-1 - at)
                at, last = at + 1, -1
                ahead = longest(word, at) if at < n else ahead
                continue
            piece = pick(last, first) if last >= 0 else first
            while True:
                if piece < 0:  # no piece is left for this place: the one before gives way
                    failed[at >> 3] |= 1 << (at & 7)
                    gone = ids.pop()
                    at -= sizes[gone]
                    last, first, piece = ids[-1] if ids else -1, -1, shorter[gone]
                else:
                    end = at + sizes[piece]
                    if not failed[end >> 3] >> (end & 7) & 1:
                        break
                    piece = shorter[piece]
                if piece >= 0 and last >= 0:
                    piece = pick(last, piece)
            ids.append(piece)
            at, last = end, piece
            if piece != first and at < n:
                ahead = longest(word, at)
        return self.spelled(word, ids) if min(ids) < 0 else ids

    def spelled(self, word: str, ids: list[int]) -> list[int]:
        """Bytes for the characters outside the vocabulary, which ``cover`` gives as -1 - place."""
        out: list[int] = []
        for i in ids:
            out.extend([i] if i >= 0 else (self.bytes[b] for b in word[-1 - i].encode("utf-8", "surrogatepass")))
        return out

    def covered(self, part: str) -> bytes:
        return array("i", self.cover(part)).tobytes()

    def spelt(self, rest: str) -> bytes:
        """The ids, as bytes, of a blank and what follows it up to the next one, put together from its parts."""
        word = SPACE + rest
        cuts = [k for k, pair in enumerate(map(add, word, rest), 1) if pair not in self.beside]
        return b"".join([self.parts[word[a:b]] for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True)])

    def encoded(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        for text in texts:
            if not text:
                words = []
            elif self.parted and SPACE not in text and "  " not in text and text[0] != " ":
                words = text.split(" ")
            else:
                words = [w[1:] for w in self.words.findall(SPACE + text.replace(" ", SPACE))]
            yield np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.intc)


class Remembered(dict):
    """Values of strings, found when they are asked for.

    The strings asked for last stay: when there are ``most`` of them, those of the
    time before are forgotten.
    """

    def __init__(self, find: Callable[[str], bytes], most: int):
        super().__init__()
        self.find, self.most = find, most
        self.old: dict[str, bytes] = {}

    def __missing__(self, name: str) -> bytes:
        value = self.old.get(name)
        if value is None:
            value = self.find(name)
        if len(name) <= LONG:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[name] = value
        return value


class Decoder:
    """Texts of ids."""

    def __init__(self, vocabulary: Vocabulary):
        values = {i: bytes([b]) for b, i in enumerate(vocabulary.bytes)}
        self.pieces = vocabulary.pieces
        self.texts = [
            values.get(i) or (piece.replace(SPACE, " ") or vocabulary.names[i]).encode("utf-8")
            for i, piece in enumerate(vocabulary.pieces)
        ]

    def decode(self, ids: Iterable[int]) -> str:
        """Pieces joined; the blank before the first piece goes, bytes that are no UTF-8 become U+FFFD each."""
        parts = list(map(self.texts.__getitem__, ids))
        text = b"".join(parts)
        first = next((i for i in ids if self.texts[i]), None) if parts else None
        blank = int(first is not None and self.pieces[first].startswith(SPACE))
        if b"" in parts:
            return self._parted(parts)[blank:]
        return text[blank:].decode("utf-8", _EACH_BYTE)

    def _parted(self, parts: list[bytes]) -> str:
        """Ids without a text, as those of begin and end, part the bytes beside them."""
        out, run = [], []
        for part in [*parts, b""]:
            if part:
                run.append(part)
            else:
                out.append(b"".join(run).decode("utf-8", _EACH_BYTE))
                run = []
        return "".join(out)


def _replace_byte(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


_EACH_BYTE = "reviewmill-each-byte"


def encode(spark: SparkSession, vocabulary: Vocabulary, text: str | Column = "text") -> Column:
    """The ids of each text as an array, exactly as the library encodes it; no begin or end ids.

    A null or empty text has no ids. Whole texts are read, of any length and also
    without blanks; documents don't depend on each other and are not moved. The
    vocabulary, some 10,000 pieces, is broadcast; a task remembers at most
    twice ``WORDS`` words and ``PARTS`` parts, and ``PAIRS`` pairs of pieces, of some 200 bytes each.
    """
    shared = spark.sparkContext.broadcast(Encoder(vocabulary))

    @pandas_udf("array<int>")
    def to_ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(list(shared.value.encoded(batch)), dtype=object)

    return to_ids(F.col(text) if isinstance(text, str) else text)


def round_trip(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded) for every row: what ``encode`` gives for its text, and what ``decode`` makes of that.

    One worker does both, some 2 MB of texts (or one longer text) at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast((Encoder(vocabulary), vocabulary))

    def there_and_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codecs.register_error(_EACH_BYTE, _replace_byte)
        encoder, decoder = shared.value[0], Decoder(shared.value[1])
        for batch in batches:
            column = batch.column("_text")
            sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
            for a, b in slices(sizes, BATCH_BYTES):
                ids = list(encoder.encoded(column.slice(a, b - a).to_pylist()))
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).slice(a, b - a), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids))),
                     pa.array([decoder.decode(x.tolist()) for x in ids], pa.string())],
                    [key, "ids", "decoded"],
                )

    rows = docs.select(F.col(key), F.col(text).alias("_text"))
    return rows.mapInArrow(there_and_back, f"{key} {dict(rows.dtypes)[key]}, ids array<int>, decoded string")


def decode(spark: SparkSession, vocabulary: Vocabulary, ids: str | Column) -> Column:
    """The text of each array of ids, as the library decodes it; a null array gives an empty text."""
    shared = spark.sparkContext.broadcast(vocabulary)

    @pandas_udf("string")
    def to_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codecs.register_error(_EACH_BYTE, _replace_byte)
        decoder = Decoder(shared.value)
        for batch in batches:
            yield pd.Series(["" if x is None else decoder.decode(x.tolist()) for x in batch], dtype=object)

    return to_text(F.col(ids) if isinstance(ids, str) else ids)
