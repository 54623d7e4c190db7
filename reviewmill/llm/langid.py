"""Language spans: scripts narrow the candidates, Viterbi over word scores picks among them."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from reviewmill.llm.base import slices

# The first and last code point of the main block of each script.
SCRIPTS = {
    "latin": (0x0041, 0x024F),
    "greek": (0x0370, 0x03FF),
    "cyrillic": (0x0400, 0x052F),
    "armenian": (0x0530, 0x058F),
    "hebrew": (0x0590, 0x05FF),
    "arabic": (0x0600, 0x077F),
    "devanagari": (0x0900, 0x097F),
    "bengali": (0x0980, 0x09FF),
    "tamil": (0x0B80, 0x0BFF),
    "thai": (0x0E00, 0x0E7F),
    "georgian": (0x10A0, 0x10FF),
    "kana": (0x3040, 0x30FF),
    "han": (0x3400, 0x9FFF),
    "hangul": (0xAC00, 0xD7AF),
}
OTHER = len(SCRIPTS)
#: Byte trigrams are counted in so many slots.
SLOTS = 1 << 17
#: Letters of a language in another script below this share don't make that script one of its own.
SCRIPT_SHARE = 0.005
SWITCH = 8.0
#: Bytes of words that are scored at once.
BATCH_BYTES = 2_000_000
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Words:
    """The letter runs of some texts, each between two spaces in one buffer."""

    buffer: np.ndarray
    starts: np.ndarray  # of each word's leading space
    owner: np.ndarray  # text of each word
    sizes: np.ndarray  # bytes of each word

    @classmethod
    def of(cls, texts: list[str | None]) -> Words:
        found = [WORD.findall(t.lower()) if t else [] for t in texts]
        counts = np.array([len(w) for w in found], np.int64)
        raw = [" ".join(w).encode("utf-8", "surrogatepass") for w in found if w]
        buffer = np.frombuffer(b" " + b" ".join(raw) + b"  ", np.uint8)
        spaces = np.flatnonzero(buffer == 32)
        n = int(counts.sum())
        return cls(buffer, spaces[:n], np.repeat(np.arange(len(texts)), counts), np.diff(spaces[: n + 1]) - 1)

    def trigrams(self) -> np.ndarray:
        """A slot for the three bytes around every byte; a word's grams are those from its leading space on."""
        b = self.buffer.astype(np.uint32)
        code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        return ((code * np.uint32(2654435761)) >> np.uint32(15)).astype(np.int32)

    def scripts(self) -> np.ndarray:
        """The script of each word's first letter."""
        at = self.starts + 1
        b = self.buffer.astype(np.int64)
        last = len(b) - 1
        b0, b1, b2 = b[at], b[np.minimum(at + 1, last)] & 63, b[np.minimum(at + 2, last)] & 63
        point = np.where(
            b0 < 0x80, b0, np.where(b0 < 0xE0, (b0 & 31) << 6 | b1, np.where(b0 < 0xF0, (b0 & 15) << 12 | b1 << 6 | b2, 1 << 20))
        )
        out = np.full(len(at), OTHER, np.int64)
        for k, (first, end) in enumerate(SCRIPTS.values()):
            out[(point >= first) & (point <= end)] = k
        return out


@dataclass(frozen=True)
class Model:
    languages: list[str]
    gram: np.ndarray  # (slots, languages), log share of each trigram
    script: np.ndarray  # (scripts + 1, languages), whether the language is written in it


def count_grams(texts: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, kind, slot, n): trigram and script counts by language, over all rows of ``texts``.

    Each task sends one row for each slot that occurs in it, whatever the number
    of its documents, so what is shuffled and what is kept stays bounded.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            frame = batch.to_pydict()
            by: dict[str, list[str]] = {}
            for t, name in zip(frame["text"], frame["lang"], strict=True):
                by.setdefault(name, []).append(t)
            for name, own in by.items():
                g = grams.setdefault(name, np.zeros(SLOTS, np.int64))
                s = scripts.setdefault(name, np.zeros(OTHER + 1, np.int64))
                for start, end in slices(np.array([len(t) for t in own]), BATCH_BYTES):
                    words = Words.of(own[start:end])
                    if len(words.starts):
                        g += np.bincount(words.trigrams(), minlength=SLOTS)
                        s += np.bincount(words.scripts(), weights=words.sizes, minlength=OTHER + 1).astype(np.int64)
        for name in grams:
            for kind, counts in (("gram", grams[name]), ("script", scripts[name])):
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array([name] * len(at), pa.string()), "kind": pa.array([kind] * len(at), pa.string()),
                     "slot": pa.array(at.astype(np.int32)), "n": pa.array(counts[at])}
                )

    rows = texts.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    return (
        rows.mapInArrow(count, "lang string, kind string, slot int, n long")
        .groupBy("lang", "kind", "slot")
        .agg(F.sum("n").alias("n"))
    )


def train(texts: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Fit the word scores on all rows of ``texts`` with a text and a language.

    What reaches the driver is at most ``SLOTS`` counts for each language. With
    no such row the model knows no language and every prediction is ``und``.
    """
    counts = count_grams(texts, text, lang).toPandas()
    languages = sorted(counts["lang"].unique())
    gram = np.full((SLOTS, len(languages)), 0.5)
    script = np.zeros((OTHER + 1, len(languages)))
    for k, name in enumerate(languages):
        own = counts[counts["lang"] == name]
        for kind, into in (("gram", gram), ("script", script)):
            part = own[own["kind"] == kind]
            np.add.at(into[:, k], part["slot"].to_numpy(), part["n"].to_numpy(float))
    if languages:
        gram = np.log(gram / gram.sum(axis=0))
        script = script / np.maximum(script.sum(axis=0), 1)
    return Model(languages, gram.astype(np.float32), script >= SCRIPT_SHARE)


def word_scores(words: Words, model: Model) -> np.ndarray:
    """Log scores (words, languages), 0 for the best; languages not written in a word's script are out."""
    slots = words.trigrams()
    scores = np.empty((len(words.starts), len(model.languages)), np.float32)
    grams = (words.sizes + 1).astype(np.int64)
    ends = words.starts + grams
    for k in range(len(model.languages)):
        total = np.concatenate([[0.0], np.cumsum(model.gram[slots, k], dtype=np.float64)])
        scores[:, k] = total[np.minimum(ends, len(slots))] - total[words.starts]
    allowed = model.script[words.scripts()]
    allowed |= ~allowed.any(axis=1, keepdims=True)
    scores[~allowed] = -np.inf
    scores -= scores.max(axis=1, keepdims=True)
    return np.maximum(scores, -50)


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best path of languages for each text, all texts stepped together.

    ``scores`` holds the words of the texts one after the other, ``lengths`` the
    words of each. Staying is free, every change of language costs ``switch``.
    """
    n_lang = scores.shape[1]
    order = np.argsort(-lengths, kind="stable")
    first = np.concatenate([[0], np.cumsum(lengths)])[:-1][order]
    size = lengths[order]
    came = np.empty(scores.shape, np.int16)
    total = np.zeros((len(lengths), n_lang))
    own = np.arange(n_lang)
    active = [int(np.searchsorted(-size, -at, side="left")) for at in range(int(size[0]) if len(size) else 0)]
    for at, n in enumerate(active):
        row = first[:n] + at
        best = total[:n].argmax(axis=1)
        jump = total[np.arange(n), best] - switch
        stay = total[:n] >= jump[:, None]
        came[row] = np.where(stay, own, best[:, None])
        total[:n] = np.where(stay, total[:n], jump[:, None]) + scores[row]
    path = np.zeros(len(scores), np.int64)
    now = total.argmax(axis=1)
    for at in range(len(active) - 1, -1, -1):
        n = active[at]
        row = first[:n] + at
        path[row] = now[:n]
        now[:n] = came[row, now[:n]]
    return path


def label_languages(docs: DataFrame, model: Model, text: str | Column = "text", switch: float = SWITCH) -> Column:
    """A column (lang, score, spans) for the rows of ``docs``.

    ``spans`` are the runs of words of one language: (lang, first word, words).
    ``lang`` is the language of most letters of the text, the first by name on a
    tie; ``score`` its share of the letters times the mean certainty of the
    words in its spans, so 0 to 1. A text that is null or has no letter gets
    ``und``, score 0 and no span, as does every text if the model knows no
    language. Whole texts are read, however long; rows don't depend on each
    other, so repeated rows agree.
    """
    parts = (model.languages, model.gram, model.script)
    shared = docs.sparkSession.sparkContext.broadcast(parts)  # SLOTS figures for each language
    kind = "struct<lang:string,score:double,spans:array<struct<lang:string,first:int,words:int>>>"

    @pandas_udf(kind)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Model(*shared.value)
        for batch in batches:
            texts = list(batch)
            parts = [_predict(texts[a:b], known, switch) for a, b in slices(np.array([len(t or "") for t in texts]), BATCH_BYTES)]
            yield pd.concat(parts) if parts else pd.DataFrame({"lang": [], "score": [], "spans": []})

    return predict(F.col(text) if isinstance(text, str) else text)


def _predict(texts: list[str | None], model: Model, switch: float) -> pd.DataFrame:
    n = len(texts)
    words = Words.of(texts)
    if not model.languages or not len(words.starts):
        return pd.DataFrame({"lang": ["und"] * n, "score": [0.0] * n, "spans": [[] for _ in range(n)]})
    scores = word_scores(words, model)
    lengths = np.bincount(words.owner, minlength=n)
    path = viterbi(scores, lengths, switch)
    chance = np.exp(scores.astype(np.float64))
    certain = chance[np.arange(len(path)), path] / chance.sum(axis=1)
    n_lang = len(model.languages)
    cell = words.owner * n_lang + path
    letters = np.bincount(cell, weights=words.sizes, minlength=n * n_lang).reshape(n, n_lang)
    sure = np.bincount(cell, weights=words.sizes * certain, minlength=n * n_lang).reshape(n, n_lang)
    best = letters.argmax(axis=1)
    total = letters.sum(axis=1)
    score = np.where(total > 0, sure[np.arange(n), best] / np.maximum(total, 1), 0.0)
    change = np.concatenate([[True], (np.diff(path) != 0) | (np.diff(words.owner) != 0)])
    at = np.flatnonzero(change)
    runs = np.diff(np.concatenate([at, [len(path)]]))
    first_word = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    spans: list[list[dict]] = [[] for _ in range(n)]
    for i, run in zip(at.tolist(), runs.tolist(), strict=True):
        owner = int(words.owner[i])
        spans[owner].append({"lang": model.languages[path[i]], "first": int(i - first_word[owner]), "words": int(run)})
    return pd.DataFrame(
        {"lang": np.where(total > 0, np.array(model.languages, object)[best], "und"), "score": score.clip(0, 1), "spans": spans}
    )
