"""Records of CSV files whose quoted fields may hold line breaks, read by many tasks for a file.

A line either begins a record or goes on inside a quoted field; which of the two
is known only from all lines before it. But each line maps the two cases to the
two cases behind it, and such maps can be composed in any grouping. So every
byte range reports the map of its lines and, for both cases, how many records end
in it; running over these few rows gives the true case and the first record number
of every range; then the ranges are cut into records by themselves. Only pieces
of records that cross a range's end are moved.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmill.scale import materialize

WHOLE, HEAD, MIDDLE, TAIL = range(4)
_FLAGS = ("_opened", "_kept", "_blank")


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Each line with its file, the byte where its range begins, and what it does to an open quote."""
    lines = spark.read.option("lineSep", "\n").text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("part"), F.col("_metadata.file_block_start").alias("at")
    )
    plain = F.when(F.col("at") == 0, F.regexp_replace("value", "^﻿", "")).otherwise(F.col("value"))
    # a doubled quote changes nothing; of the others, one opens a field if nothing of the field
    # stands before it, one inside an open field closes it, any other is an ordinary character
    pieces = F.split(F.replace(plain, F.lit('""'), F.lit("")), '"')
    may_open = F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda piece, i: piece.endswith(",") | ((i == 0) & (piece == "")),
    )
    quoted = F.contains("value", F.lit('"'))

    def after(entered: bool) -> Column:
        walked = F.aggregate(may_open, F.lit(entered), lambda is_open, may: may & ~is_open)
        return F.when(quoted, walked).otherwise(F.lit(entered))

    return lines.select(
        "value", "part", "at", F.xxhash64("part").alias("file"),
        after(False).alias("_opened"), after(True).alias("_kept"), F.col("value").isin("", "\r").alias("_blank"),
    )


def _states(entered: bool, opened: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Whether a quoted field is open behind each line, if it is so before the first."""
    fixed = opened == kept
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(opened)), -1))
    swaps = np.cumsum(opened & ~kept)
    since = swaps - np.where(last >= 0, swaps[last], 0)
    return np.where(last >= 0, opened[last], entered) ^ (since % 2 == 1)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, int]]:
    """(file, range) and the rows of each stretch of a batch that lies in one range."""
    file, at = (batch.column(c).to_numpy() for c in ("file", "at"))
    cuts = np.flatnonzero((file[1:] != file[:-1]) | (at[1:] != at[:-1])) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(file)], strict=True):
        if a < b:
            yield (int(file[a]), int(at[a])), a, b


def _flag(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(bool)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each range: where both cases lead, and the records that end in it in both cases."""
    found: dict[tuple[int, int], list] = {}
    for batch in batches:
        opened, kept, blank = (_flag(batch, c) for c in _FLAGS)
        for key, a, b in _runs(batch):
            now = found.setdefault(key, [False, True, 0, 0])
            for case in (0, 1):
                behind = _states(now[case], opened[a:b], kept[a:b])
                now[2 + case] += int((~behind & ~blank[a:b]).sum())
                now[case] = bool(behind[-1])
    if found:
        columns = [*zip(*found, strict=True), *zip(*found.values(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["file", "at", *"abcd"])


def ranges(lines: DataFrame) -> DataFrame:
    """(file, at, entered, first): whether a quoted field is open where a range begins, and how many records end before."""
    kinds = "file long, at long, a boolean, b boolean, c long, d long"
    each = materialize(lines.select("file", "at", *_FLAGS).mapInArrow(_summaries, kinds))
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("a") == F.col("b")
    swap = F.sum((F.col("a") & ~F.col("b")).cast("int"))
    upto = Window.partitionBy("file").orderBy("at")
    known = each.withColumn("_swaps", swap.over(upto)).withColumn("_fixed", F.when(fixed, F.struct("a", "_swaps")))
    known = known.withColumn("_last", F.last("_fixed", ignorenulls=True).over(before))
    since = F.coalesce(F.lag("_swaps").over(upto), F.lit(0)) - F.coalesce("_last._swaps", F.lit(0))
    known = known.withColumn("entered", F.coalesce("_last.a", F.lit(False)) != (since % 2 == 1))
    ended = F.sum(F.when(F.col("entered"), F.col("d")).otherwise(F.col("c")))
    return known.withColumn("first", F.coalesce(ended.over(before), F.lit(0))).select("file", "at", "entered", "first")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the ranges, and pieces of those that don't lie in one range."""
    names = ["part", "file", "at", "n", "kind", "record"]
    here, inside, number, open_lines, begun = None, False, 0, [], False

    def piece(kind: int) -> pa.RecordBatch:
        values = [[here[2]], [here[0]], [here[1]], [number], [kind], ["\n".join(open_lines)]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], names)

    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
    for batch in batches:
        opened, kept, blank = (_flag(batch, c) for c in _FLAGS)
        value = batch.column("value")
        for key, a, b in _runs(batch):
            if here is None or key != here[:2]:
                if open_lines:
                    yield piece(HEAD if begun else MIDDLE)
                here = (*key, batch.column("part")[a].as_py())
                inside = batch.column("entered")[a].as_py()
                number, open_lines, begun = batch.column("first")[a].as_py(), [], not inside
            behind = _states(inside, opened[a:b], kept[a:b])
            before = np.concatenate([[inside], behind[:-1]])
            inside = bool(behind[-1])
            ends = ~behind & ~blank[a:b]
            n = number + np.cumsum(ends) - 1
            alone = ends & ~before
            at = np.flatnonzero(alone)
            yield pa.RecordBatch.from_arrays(
                [batch.column("part").slice(a, b - a).take(pa.array(at)), pa.array(np.full(len(at), here[0])),
                 pa.array(np.full(len(at), here[1])), pa.array(n[at]), pa.array(np.zeros(len(at), np.int32)),
                 value.slice(a, b - a).take(pa.array(at))], names,
            )
            number = int(n[-1]) + 1
            for i in np.flatnonzero(before | behind).tolist():
                open_lines.append(value[a + i].as_py())
                if not behind[i]:
                    number, last = int(n[i]), number
                    yield piece(WHOLE if begun else TAIL)
                    number, open_lines, begun = last, [], True
    if open_lines:
        yield piece(HEAD if begun else MIDDLE)


def records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(part, n, record): every record of the CSV files with its number in the file, from 0; blank lines are no records.

    Lines end with a line feed. A quote opens a field only where the field begins;
    inside, two quotes stand for one. What follows a closing quote up to the comma
    belongs to the field. A field that is still open at the end of a file ends there.
    Files may be of any size: a file is read by as many tasks as it has splits, three
    times: for the ranges' maps, for whole records, and for pieces.
    """
    lines = _lines(spark, paths)
    entry = materialize(ranges(lines)).select(F.col("file").alias("_file"), F.col("at").alias("_at"), "entered", "first")
    placed = lines.join(entry, (F.col("file") == F.col("_file")) & (F.col("at") == F.col("_at")), "left")
    # both passes must cut the files at the same bytes
    same = F.when(F.col("first").isNull(), F.raise_error("the splits of the files have changed")).otherwise(F.col("first"))
    placed = placed.select("value", "part", "file", "at", *_FLAGS, "entered", same.cast("long").alias("first"))
    found = placed.mapInArrow(_cut, "part string, file long, at long, n long, kind int, record string")
    pieces = found.filter(F.col("kind") != WHOLE)
    # a file's pieces by range: a tail ends the record that the head before it begins
    order = Window.partitionBy("file").orderBy("at", F.col("kind") == HEAD)
    numbered = pieces.withColumn("_open", F.sum((F.col("kind") == HEAD).cast("int")).over(order))
    in_order = F.sort_array(F.collect_list(F.struct("at", "record")))  # the pieces of one record
    joined = numbered.groupBy("part", "_open").agg(
        F.max("n").alias("n"), F.array_join(F.transform(in_order, lambda r: r["record"]), "\n").alias("record")
    )
    every = found.filter(F.col("kind") == WHOLE).select("part", "n", "record").unionByName(joined.select("part", "n", "record"))
    return every.withColumn("record", F.regexp_replace("record", "\r$", ""))
