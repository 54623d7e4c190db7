"""Repeated sentences, lines or paragraphs: the earliest occurrence of each stays."""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.base import row_key, same_row, slices, stored

LINE = re.compile(r"[^\n]+")
PARAGRAPH = re.compile(r"[^\n]+(?:\n(?!\s*\n)[^\n]+)*")
SENTENCE = re.compile(r"[^\n.!?]+[.!?]*")
_PLAIN = str.maketrans(dict.fromkeys(string.punctuation, " "))
BATCH_BYTES = 4_000_000


def normalised(unit: str) -> str:
    """Lower case, without ASCII punctuation, single spaces."""
    return " ".join(unit.lower().translate(_PLAIN).split())


def _units(rows: DataFrame, pattern: re.Pattern) -> DataFrame:
    """(_id, _fp, unit, start, stop, words, d1, d2) for every unit that isn't blank; offsets are in characters.

    Units are numbered without the blank ones.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            texts = batch.column("_text").to_pylist()
            for a, b in slices(np.array([len(t or "") for t in texts]), BATCH_BYTES):
                owner, unit, start, stop, words, digests = [], [], [], [], [], []
                for row in range(a, b):
                    k = 0
                    for found in pattern.finditer(texts[row] or ""):
                        plain = normalised(found.group())
                        if plain:
                            owner.append(row)
                            unit.append(k)
                            k += 1
                            start.append(found.start())
                            stop.append(found.end())
                            words.append(plain.count(" ") + 1)
                            digests.append(xxh3_128_digest(plain.encode("utf-8", "replace")))
                both = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
                own = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id").take(own), batch.column("_fp").take(own), pa.array(unit, pa.int32()),
                     pa.array(start, pa.int32()), pa.array(stop, pa.int32()), pa.array(words, pa.int32()),
                     pa.array(both[:, 0]), pa.array(both[:, 1])],
                    ["_id", "_fp", "unit", "start", "stop", "words", "d1", "d2"],
                )

    kind = dict(rows.dtypes)["_id"]
    return rows.mapInArrow(cut, f"_id {kind}, _fp long, unit int, start int, stop int, words int, d1 long, d2 long")


def remove_repeated_units(
    docs: DataFrame, key: str = "doc_id", text: str = "text", pattern: re.Pattern = LINE, least_words: int = 1
) -> DataFrame:
    """(key, n_units, n_removed, n_repeated, removed, kept_text) for every row of ``docs``.

    Units are what ``pattern`` finds: lines, paragraphs between blank lines, or
    sentences, which also show a passage inside a longer line. Two units are equal
    if they agree in lower case without ASCII punctuation and extra blanks; units
    with nothing left are not judged. Of equal units the first by key, text hash
    and place stays, also inside one document; the others go, if they stand in a
    stretch of neighbours that go with at least ``least_words`` words in all (so a
    short stock line by itself stays where it is). ``removed`` lists (start, stop,
    first_key, first_unit): the offsets of each removed unit in the original text,
    in characters, and where the kept one is; ``kept_text`` is the text without
    the removed units, of whole lines with the line break after them. ``n_repeated``
    counts the words of units that occur again anywhere, the kept first ones
    included, in such stretches: it is above 0 for every document of a repeated
    passage, ``n_removed`` for all but the first.

    A null or empty text has no units and is kept as it is; null keys come last.
    Rows that agree in key and text are one document and get the same result.
    Other columns are not looked at. Units are grouped by 128-bit digests, each
    task sends one row for a digest; the join back is of two written tables, in
    which Spark splits a digest with many occurrences.
    """
    rows = docs.select(*row_key(key, text), F.col(text).alias("_text"))
    units = stored(_units(rows, pattern))
    rank = F.struct(F.col("_id").isNull().alias("_none"), "_id", "_fp", "unit")
    first = stored(
        units.groupBy("d1", "d2")
        .agg(F.count("*").alias("_n"), F.min(rank).alias("_first"))
        .filter("_n > 1")
        .select(
            "d1", "d2",
            F.col("_first._id").alias("first_key"), F.col("_first._fp").alias("_first_fp"), F.col("_first.unit").alias("first_unit"),
        )
    )
    is_first = (
        F.col("_id").eqNullSafe(F.col("first_key")) & (F.col("_fp") == F.col("_first_fp")) & (F.col("unit") == F.col("first_unit"))
    )
    entry = F.struct("unit", "start", "stop", "words", is_first.alias("stays"), "first_key", "first_unit")
    again = units.join(first, ["d1", "d2"]).groupBy("_id", "_fp").agg(F.sort_array(F.collect_set(entry)).alias("again"))
    whole = rows.join(again, same_row(rows, again), "left").select(
        rows["_id"].alias(key), "_text", F.coalesce("again", F.array().cast(again.schema["again"].dataType)).alias("again")
    )
    return _without(whole, key, pattern, least_words)


def _stretches(units: list[dict], least_words: int) -> list[dict]:
    """The units in stretches of neighbours with enough words."""
    out: list[dict] = []
    begin = 0
    for k in range(1, len(units) + 1):
        if k == len(units) or units[k]["unit"] != units[k - 1]["unit"] + 1:
            if sum(u["words"] for u in units[begin:k]) >= least_words:
                out += units[begin:k]
            begin = k
    return out


def _without(whole: DataFrame, key: str, pattern: re.Pattern, least_words: int) -> DataFrame:
    """Cut the units that go out of the texts."""
    kind = dict(whole.dtypes)[key]
    span = f"struct<start:int,stop:int,first_key:{kind},first_unit:int>"
    names = ["start", "stop", "first_key", "first_unit"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_units, n_repeated, removed, kept = [], [], [], []
            for text, again in zip(batch.column("_text").to_pylist(), batch.column("again").to_pylist(), strict=True):
                n_units.append(sum(1 for u in pattern.finditer(text or "") if normalised(u.group())))
                n_repeated.append(sum(u["words"] for u in _stretches(again, least_words)))
                gone = _stretches([u for u in again if not u["stays"]], least_words)
                removed.append([{n: u[n] for n in names} for u in gone])
                parts, at = [], 0
                for unit in gone:
                    begin, end = unit["start"], unit["stop"]
                    parts.append(text[at:begin])
                    whole_line = begin == 0 or text[begin - 1] == "\n"
                    at = end + (whole_line and text.startswith("\n", end))
                kept.append("".join([*parts, text[at:]]) if gone else text)
            ids = batch.column(key)
            spans = pa.list_(pa.struct([(n, ids.type if n == "first_key" else pa.int32()) for n in names]))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n_units, pa.int32()), pa.array([len(s) for s in removed], pa.int32()),
                 pa.array(n_repeated, pa.int64()), pa.array(removed, spans), pa.array(kept, pa.string())],
                [key, "n_units", "n_removed", "n_repeated", "removed", "kept_text"],
            )

    return whole.mapInArrow(
        cut, f"{key} {kind}, n_units int, n_removed int, n_repeated long, removed array<{span}>, kept_text string"
    )
