"""Toxicity by compression: which of two zstandard dictionaries makes a text's windows shorter."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

WORD = re.compile(rb"[a-z\x80-\xff]+")
#: Bytes that no window holds. Each dictionary ends in them and each window too, because the
#: compressor looks for no match in the last bytes of its input and stores very short inputs raw.
TAIL = bytes(range(1, 32)) + b"\x7f"
FEATURES = 7


@dataclass(frozen=True)
class Bounds:
    """What is fitted on: the most labelled documents and windows of each class, and dictionary bytes.

    Documents and windows are the first by hash of their id, so they don't
    depend on the order or the number of partitions.
    """

    dictionary_documents: int = 4000
    calibration_documents: int = 4000
    windows: int = 40_000
    ordinary_bytes: int = 64 * 1024
    toxic_bytes: int = 64 * 1024
    level: int = 6
    #: Words of a window.
    width: int = 1
    #: Compressed windows a task remembers.
    remembered: int = 200_000


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray  # intercept, then one for each feature
    middle: np.ndarray
    spread: np.ndarray
    bounds: Bounds

    @property
    def trained(self) -> bool:
        return bool(self.ordinary and self.toxic)


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall(text.lower().encode("utf-8", "replace")) if text else []


class Lengths:
    """Compressed lengths of windows under one dictionary."""

    def __init__(self, dictionary: bytes, level: int):
        data = zstandard.ZstdCompressionDict(dictionary + TAIL)
        data.precompute_compress(level=level)
        self.compressor = zstandard.ZstdCompressor(
            level=level, dict_data=data, write_checksum=False, write_content_size=False, write_dict_id=False
        )

    def __call__(self, window: bytes) -> int:
        return len(self.compressor.compress(b" " + window + b" " + TAIL))


class Distance:
    """How many bytes shorter each window gets with the toxic dictionary than with the ordinary one."""

    def __init__(self, ordinary: bytes, toxic: bytes, bounds: Bounds):
        self.ordinary = Lengths(ordinary, bounds.level)
        self.toxic = Lengths(toxic, bounds.level)
        self.bounds = bounds
        self.known: dict[bytes, int] = {}

    def __call__(self, window: bytes) -> int:
        gain = self.known.get(window)
        if gain is None:
            if len(self.known) >= self.bounds.remembered:
                self.known.clear()
            gain = self.ordinary(window) - self.toxic(window)
            if len(window) < 64:
                self.known[window] = gain
        return gain

    def features(self, text: str | None) -> list[float]:
        """What the calibration sees of a text; zeros for an empty one."""
        words = words_of(text)
        n = self.bounds.width
        windows = words if n == 1 else [b" ".join(words[i : i + n]) for i in range(0, len(words), n)]
        if not windows:
            return [0.0] * FEATURES
        gains = np.fromiter(map(self, windows), np.int32, len(windows))
        top = np.sort(np.partition(gains, -3)[-3:] if len(gains) > 3 else gains)[::-1]
        over = [float((gains >= k).sum()) for k in (2, 3, 4, 5)]
        return [float(top[0]), float(top.mean()), *np.log1p(over).tolist(), 100 * over[1] / len(gains)]


def _labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, toxic: str, bounds: Bounds) -> DataFrame:
    """(text, toxic, part) of the bounded sample: part 0 trains dictionaries, part 1 calibrates."""
    from pyspark.sql import Window

    per_class = bounds.dictionary_documents + bounds.calibration_documents
    ids = (
        labels.filter(F.col(key).isNotNull() & F.col(toxic).isNotNull())
        .groupBy(F.col(key).alias("_label_id"))
        .agg(F.max(F.col(toxic).cast("int")).alias("_toxic"))
        .withColumn("_order", F.xxhash64("_label_id"))
    )
    picked = None
    for value in (0, 1):
        own = ids.filter(F.col("_toxic") == value).orderBy("_order", "_label_id").limit(per_class)
        picked = own if picked is None else picked.union(own)
    # at most 2 * per_class rows by now, so one small window and a broadcast are bounded
    place = F.row_number().over(Window.partitionBy("_toxic").orderBy("_order", "_label_id"))
    share = bounds.dictionary_documents / per_class
    size = F.count("*").over(Window.partitionBy("_toxic"))
    picked = picked.withColumn(
        "_part", (place > F.least(F.lit(bounds.dictionary_documents), F.ceil(size * F.lit(share)))).cast("int")
    )
    return docs.select(F.col(key).alias("_label_id"), F.col(text).alias("_text")).join(
        F.broadcast(picked), "_label_id"
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    bounds: Bounds = Bounds(),
) -> Model:
    """Train both dictionaries and the calibration on a bounded sample of labelled rows.

    The ordinary dictionary is trained on runs of words of ordinary documents,
    the toxic one on those of toxic documents, none left out for its words or its
    length. Other documents, labelled too, give the logistic calibration; its
    classes are weighted by how frequent they are among all labels. Without
    usable labels of both classes the model is untrained and scores everything
    by the share of toxic labels (0 if there are none).
    """
    sample = _labelled(docs, labels, key, text, toxic, bounds)
    counts = {
        r["v"]: r["n"]
        for r in labels.filter(F.col(key).isNotNull() & F.col(toxic).isNotNull())
        .groupBy((F.col(toxic).cast("int") > 0).cast("int").alias("v"))
        .agg(F.count("*").alias("n"))
        .collect()
    }
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    none = Model(b"", b"", np.array([_logit(share)] + [0.0] * FEATURES), np.zeros(FEATURES), np.ones(FEATURES), bounds)

    windows = _windows(sample.filter("_part = 0"), bounds)
    ordinary = _dictionary(windows.get(0, []), bounds.ordinary_bytes)
    if not ordinary:
        return none
    learnt = _dictionary(windows.get(1, []), bounds.toxic_bytes, 16)
    if not learnt:
        return none
    model = Model(ordinary, learnt, none.weights, none.middle, none.spread, bounds)

    rows = sample.filter("_part = 1").select("_toxic", features_column(model, docs, "_text").alias("f")).collect()
    x = np.array([r["f"] for r in rows], float).reshape(len(rows), FEATURES)
    y = np.array([r["_toxic"] > 0 for r in rows], float)
    if not len(y) or y.min() == y.max():
        return none
    weight = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean()))
    middle, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    return Model(ordinary, learnt, _logistic((x - middle) / spread, y, weight), middle, spread, bounds)


def _windows(sample: DataFrame, bounds: Bounds) -> dict[int, list[bytes]]:
    """Runs of 64 words from everywhere in the sample's whole texts, by class, the first by hash.

    Runs above 4096 bytes are cut into several, so the driver gets a bounded number of bytes.
    """

    def runs(text: str | None) -> list[bytes]:
        words = words_of(text)
        found = [b" ".join(words[i : i + 64]) for i in range(0, len(words), 64)]
        return [run[i : i + 4096] for run in found for i in range(0, len(run), 4096)]

    @pandas_udf("array<binary>")
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(runs)

    rows = sample.select("_toxic", F.explode(cut("_text")).alias("w"))
    out = {}
    for value in (0, 1):
        own = rows.filter(F.col("_toxic") == value).orderBy(F.xxhash64("w"), "w").limit(bounds.windows // 2)
        out[value] = [bytes(r["w"]) for r in own.select("w").collect()]
    return out


def _dictionary(samples: list[bytes], size: int, segment: int = 32) -> bytes:
    """A trained dictionary, or nothing if there is too little to train on."""
    total = sum(map(len, samples))
    if len(samples) < 8 or total < 2048:
        return b""
    try:
        return zstandard.train_dictionary(min(size, max(1024, total // 8)), samples, k=segment, d=6).as_bytes()
    except zstandard.ZstdError:
        return b""


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return float(np.log(p / (1 - p)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method; the intercept is first."""
    a = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(a.shape[1])
    penalty = np.diag([0.0] + [ridge] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (weight * (p - y)) + penalty @ w
        curve = (a * (weight * p * (1 - p))[:, None]).T @ a + penalty + 1e-6 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def features_column(model: Model, docs: DataFrame, text: str | Column = "text") -> Column:
    """array<double>: what the calibration sees of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast((model.ordinary, model.toxic))  # of fixed size
    bounds = model.bounds

    @pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        distance = Distance(*shared.value, bounds)
        for batch in batches:
            yield batch.map(distance.features, na_action=None)

    return features(F.col(text) if isinstance(text, str) else text)


def score_toxicity(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A double from 0 to 1 for every row of ``docs``, higher for likelier toxic.

    Null and empty texts, and texts without a letter, get the score of a text in
    which no window gains. Rows are scored alone, so ties, repeated rows and
    further columns don't matter; an empty table stays empty.
    """
    if not model.trained:
        return F.lit(float(1 / (1 + np.exp(-model.weights[0]))))
    found = features_column(model, docs, text)
    line = F.aggregate(
        F.zip_with(
            found,
            F.array(*[F.lit(float(w / s)) for w, s in zip(model.weights[1:], model.spread, strict=True)]),
            lambda f, w: f * w,
        ),
        F.lit(float(model.weights[0] - (model.weights[1:] * model.middle / model.spread).sum())),
        lambda total, part: total + part,
    )
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-line))
