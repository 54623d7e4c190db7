"""Repeated byte strings, found by building a collection's BWT order and common prefixes by columns.

A text is compared at every byte, but not every pair of places has to meet. A
string of ``LENGTH`` bytes holds a place of least hash among its short grams; two
equal strings hold it at the same offset. So each string belongs to one anchor
and, by its offset, to one cell of ``CELL`` offsets; all strings of a cell share
the bytes in its middle, the core. Equal strings lie in cells with equal cores,
and only such cells are compared: each is a short document, left edge, core,
right edge, aligned with the others of its core.

Over the cells of a core the column-wise construction runs: columns are inserted
from the last to the first, one symbol of each document a round. The order of
the suffixes of the column before is sorted stably by the new symbols, which
gives the order of the longer suffixes, and the common prefix of neighbours is
one more than the least one between them, or nothing. The columns lie one after
the other in files, and each round reads the next one. A string that starts at
the column is repeated if its suffix shares ``LENGTH`` bytes with a neighbour.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.base import row_key, same_row, slices, stored

LENGTH = 400
#: Bytes of a gram whose hash may make it an anchor.
GRAM = 64
#: Offsets of one cell.
CELL = 169
#: Bytes of text that are hashed at once; longer texts are hashed in overlapping parts.
PART = 1 << 20
#: Cells of one core that are ordered together; cores with more of them are divided by longer cores.
TOGETHER = 512
#: Cells that a task orders at once, of many cores.
BATCH_CELLS = 8192

_rng = np.random.default_rng(20240229)
_SYMBOL = _rng.integers(1, 1 << 63, (2, 256), dtype=np.uint64)
_BASE = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_WORD = (1 << 64) - 1


class Powers:
    """Powers of an odd base and of its inverse, modulo 2 ** 64, for positions up to ``n``."""

    def __init__(self, n: int, which: int):
        self.up, self.down = np.full((2, n + 1), _BASE[which], np.uint64)
        self.down[:] = pow(_BASE[which], -1, 1 << 64)
        for factors in (self.up, self.down):
            factors[0] = 1
            np.cumprod(factors, out=factors)


_powers: dict[tuple[int, int], Powers] = {}


def prefix_hash(raw: np.ndarray, which: int) -> tuple[np.ndarray, Powers]:
    """Sums whose differences, shifted back, are a hash of any stretch of ``raw``."""
    size = 1 << max(16, int(len(raw)).bit_length())
    powers = _powers.get((size, which))
    if powers is None:
        powers = _powers.setdefault((size, which), Powers(size, which))
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_SYMBOL[which][raw] * powers.up[: len(raw)], dtype=np.uint64, out=sums[1:])
    return sums, powers


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def stretch(sums: np.ndarray, powers: Powers, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return mixed((sums[stop] - sums[start]) * powers.down[start])


def cells_of(raw: np.ndarray, length: int, gram: int, cell: int) -> tuple[np.ndarray, ...]:
    """(first, count, core, core hash) of every cell of ``raw``: its first string, how many, and where its core is.

    ``raw`` has at least ``length`` bytes; strings start at 0 to len(raw) - length.
    """
    sums, powers = prefix_hash(raw, 0)
    n_gram = len(raw) - gram + 1
    at = np.arange(n_gram)
    h = mixed((sums[gram:] - sums[:-gram]) * powers.down[:n_gram])
    # the least hash of each window, the leftmost on a tie: the place fills the low bits
    bits = np.uint64(int(n_gram).bit_length())
    h = (h >> bits << bits) | at.astype(np.uint64)
    width = length - gram + 1
    n = len(raw) - length + 1
    padded = np.full(-(-n_gram // width) * width, _WORD, np.uint64)
    padded[:n_gram] = h
    block = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(block, axis=1).reshape(-1)
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    low = np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])
    anchor = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    place = (anchor - np.arange(n)) // cell
    key = anchor * (width // cell + 1) + place
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.concatenate([first, [n]]))
    core = anchor[first] - place[first] * cell
    return first, count, core, stretch(sums, powers, core, core + length + 1 - cell)


def parts_of(raw: bytes, length: int) -> Iterator[tuple[int, np.ndarray]]:
    """(offset, bytes) of parts whose strings are all the strings of ``raw``, once each."""
    whole = np.frombuffer(raw, np.uint8)
    for start in range(0, len(raw) - length + 1, PART):
        yield start, whole[start : start + PART + length - 1]


def _find_cells(rows: DataFrame, length: int, gram: int, cell: int) -> DataFrame:
    """(_id, _fp, first, count, core): every cell of every text of at least ``length`` bytes."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text")
            sizes = np.array([len(t.as_buffer() or b"") if t.is_valid else 0 for t in texts], np.int64)
            for a, b in slices(sizes, 4 * PART):
                found: list[list[np.ndarray]] = [[], [], [], []]
                for row in range(a, b):
                    if sizes[row] < length:
                        continue
                    for start, raw in parts_of(texts[row].as_py(), length):
                        first, count, _, core = cells_of(raw, length, gram, cell)
                        for into, what in zip(found, (np.full(len(first), row), first + start, count, core), strict=True):
                            into.append(what)
                if found[0]:
                    owner, first, count, core = (np.concatenate(x) for x in found)
                    own = pa.array(owner)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("_id").take(own), batch.column("_fp").take(own), pa.array(first.astype(np.int32)),
                         pa.array(count.astype(np.int16)), pa.array(core.astype(np.int64))],
                        ["_id", "_fp", "first", "count", "core"],
                    )

    kind = dict(rows.dtypes)["_id"]
    return rows.mapInArrow(find, f"_id {kind}, _fp long, first int, count short, core long")


def _cut_cells(marked: DataFrame, length: int, gram: int, cell: int) -> DataFrame:
    """(_id, _fp, first, c1, c2, l, r): the marked cells with their edges, each of the bytes its strings cover.

    ``marked`` has (_id, _fp, _text, marks): the first strings of the repeated
    cells. The cells are computed anew, so nothing but their places was moved.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, marks = batch.column("_text"), batch.column("marks")
            out: list[list] = [[], [], [], [], [], []]
            for row in range(len(texts)):
                raw, mine = texts[row].as_py(), np.unique(np.array(marks[row].as_py(), np.int64))
                for start, part in parts_of(raw, length):
                    low, high = np.searchsorted(mine, [start, start + len(part) - length + 1])
                    if low == high:
                        continue
                    first, count, core, c1 = cells_of(part, length, gram, cell)
                    pick = np.searchsorted(first, mine[low:high] - start)
                    first, count, core, c1 = first[pick], count[pick], core[pick], c1[pick]
                    sums, powers = prefix_hash(part, 1)
                    c2 = stretch(sums, powers, core, core + length + 1 - cell)
                    for f, n, c in zip((first + start).tolist(), count.tolist(), (core + start).tolist(), strict=True):
                        out[1].append(f)
                        out[2].append(raw[f:c])
                        out[3].append(raw[c + length + 1 - cell : f + n - 1 + length])
                    out[0].extend([row] * len(first))
                    out[4].append(c1)
                    out[5].append(c2)
                if len(out[0]) > 20_000:
                    yield _cell_batch(batch, out)
                    out = [[], [], [], [], [], []]
            if out[0]:
                yield _cell_batch(batch, out)

    kind = dict(marked.dtypes)["_id"]
    return marked.mapInArrow(cut, f"_id {kind}, _fp long, first int, c1 long, c2 long, l binary, r binary")


def _cell_batch(batch: pa.RecordBatch, out: list[list]) -> pa.RecordBatch:
    own = pa.array(out[0], pa.int64())
    c1, c2 = (np.concatenate(x).astype(np.int64) for x in out[4:])
    return pa.RecordBatch.from_arrays(
        [batch.column("_id").take(own), batch.column("_fp").take(own), pa.array(out[1], pa.int32()), pa.array(c1),
         pa.array(c2), pa.array(out[2], pa.binary()), pa.array(out[3], pa.binary())],
        ["_id", "_fp", "first", "c1", "c2", "l", "r"],
    )


class Columns:
    """The columns of many aligned cells, written to a file one after the other, last first."""

    def __init__(self, left: list[bytes], right: list[bytes], width: int):
        n = len(left)
        self.width = width
        text = np.zeros((n, 2 * (width - 1)), np.uint16)
        for side, edges in enumerate((left, right)):
            sizes = np.fromiter(map(len, edges), np.int64, n)
            flat = np.frombuffer(b"".join(edges), np.uint8)
            row = np.repeat(np.arange(n), sizes)
            column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            if side == 0:  # the left edge ends at the core
                column += np.repeat(width - 1 - sizes, sizes)
            else:
                column += width - 1
            text[row, column] = flat.astype(np.uint16) + 1  # 0: no byte
        self.file = tempfile.TemporaryFile()
        self.n = n
        np.ascontiguousarray(text.T[::-1]).tofile(self.file)
        self.file.seek(0)

    def __iter__(self) -> Iterator[np.ndarray]:
        """Column by column from the last to the first; None stands for the core."""
        for k in range(2 * (self.width - 1)):
            if k == self.width - 1:
                yield None
            yield np.fromfile(self.file, np.uint16, self.n)
        if self.width == 1:
            yield None

    def close(self) -> None:
        self.file.close()


def least_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of values[low + 1 .. high] for every pair low < high."""
    out = np.empty(len(low), values.dtype)
    span = high - low
    level, width = values, 1
    todo = np.arange(len(low))
    while len(todo):
        now = span[todo] < 2 * width
        pick = todo[now]
        out[pick] = np.minimum(level[low[pick] + 1], level[high[pick] - width + 1])
        todo = todo[~now]
        if len(todo):
            level = np.minimum(level[:-width], level[width:])
            width *= 2
    return out


def repeated_starts(group: np.ndarray, left: list[bytes], right: list[bytes], width: int, core: int, length: int) -> np.ndarray:
    """For cells that lie group after group: whether the string that starts at each column is repeated.

    The result is (cells, width), a flag for each start from the first column of
    the left edge to the core. ``core`` is the number of bytes of the core.
    """
    n = len(group)
    order = np.arange(n)
    prefix = np.zeros(n, np.int64)  # common with the suffix before, in the order
    fresh = np.concatenate([[True], group[1:] != group[:-1]])
    place = np.cumsum(fresh) - 1  # number of the group, in the order: it never changes
    out = np.zeros((n, width), bool)
    columns = Columns(left, right, width)
    start = 2 * (width - 1)
    for symbols in columns:
        if symbols is None:
            prefix = np.where(fresh, 0, prefix + core)
            column = width - 1
        else:
            start -= 1
            column = start
            own = symbols[order].astype(np.int64)
            key = place * 257 + own
            turn = np.argsort(key, kind="stable")
            now = key[turn]
            same = np.concatenate([[False], (now[1:] == now[:-1]) & (own[turn][1:] > 0)])
            longer = np.zeros(n, np.int64)
            at = np.flatnonzero(same)
            if len(at):
                longer[at] = least_between(prefix, turn[at - 1], turn[at]) + 1
            order, prefix = order[turn], longer
        if column < width:
            far = prefix >= length
            out[order, column] = far | np.concatenate([far[1:], [False]])
    columns.close()
    return out


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, count) of the runs of true flags."""
    edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1] - first


def _order_cells(cells: DataFrame, width: int, core: int, length: int) -> DataFrame:
    """(p1, p2, runs): for each cell that shares its core with others, the repeated stretches of its strings.

    ``cells`` holds (k1, k2, p1, p2, at, l, r). Tasks hold whole cores, each with
    at most ``TOGETHER`` cells. Places count like ``at``, the cell's first string.
    """

    def construct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= BATCH_CELLS:
                ready, held = _whole_cores(held)
                rows = sum(b.num_rows for b in held)
                if ready is not None:
                    yield _ordered(ready, width, core, length)
        if rows:
            yield _ordered(pa.Table.from_batches(held), width, core, length)

    n = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        cells.select("k1", "k2", "p1", "p2", "at", "l", "r")
        .repartition(n, "k1", "k2")
        .sortWithinPartitions("k1", "k2")
        .mapInArrow(construct, "p1 long, p2 long, at int, n int")
    )


def _whole_cores(held: list[pa.RecordBatch]) -> tuple[pa.Table | None, list[pa.RecordBatch]]:
    """Split what has come so far before its last core, which may go on."""
    rows = pa.Table.from_batches(held)
    k1, k2 = rows["k1"].to_numpy(), rows["k2"].to_numpy()
    last = np.flatnonzero((k1 != k1[-1]) | (k2 != k2[-1]))
    cut = int(last[-1]) + 1 if len(last) else 0
    return (rows.slice(0, cut) if cut else None), rows.slice(cut).to_batches()


def _ordered(rows: pa.Table, width: int, core: int, length: int) -> pa.RecordBatch:
    k1, k2 = rows["k1"].to_numpy(), rows["k2"].to_numpy()
    group = np.cumsum(np.concatenate([[0], ((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])).astype(np.int64)]))
    left, right = rows["l"].to_pylist(), rows["r"].to_pylist()
    flags = repeated_starts(group, left, right, width, core, length)
    row, first, count = _runs(flags)
    first = first - (width - 1 - np.fromiter(map(len, left), np.int64, len(left)))[row] + rows["at"].to_numpy()[row]
    own = pa.array(row)
    return pa.RecordBatch.from_arrays(
        [rows["p1"].combine_chunks().take(own), rows["p2"].combine_chunks().take(own),
         pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32))],
        ["p1", "p2", "at", "n"],
    )


def _divide(cells: DataFrame, width: int, narrow: int) -> DataFrame:
    """Cells of ``narrow`` offsets out of cells of ``width``, both (k1, k2, p1, p2, at, l, r).

    The bytes that all strings of a narrower cell share join the core, so its
    key is made of the old key and those bytes. ``p1, p2`` and the places stay
    those of the outermost cell. The last narrow cell may overlap the one before.
    """
    begins = [*range(0, width - narrow, narrow), width - narrow]

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            owner, keys, at, lefts, rights = [], [], [], [], []
            names = np.stack([batch.column("k1").to_numpy(), batch.column("k2").to_numpy()], 1)
            places = batch.column("at").to_pylist()
            for row, (l, r) in enumerate(zip(batch.column("l").to_pylist(), batch.column("r").to_pylist(), strict=True)):
                skip = width - 1 - len(l)  # the first start with all its bytes; the last is len(r)
                for begin in begins:
                    end = begin + narrow - 1
                    one, other = max(begin, skip), min(end, len(r))
                    if one > other:
                        continue
                    # shared by the strings from begin to end: the left bytes from end, the right ones up to begin
                    shared = l[end - skip :] + b"|" + r[:begin]
                    keys.append(xxh3_128_digest(names[row].tobytes() + begin.to_bytes(2, "big") + shared))
                    owner.append(row)
                    at.append(places[row] + one - skip)
                    lefts.append(l[one - skip : end - skip])
                    rights.append(r[begin:other])
            both = np.frombuffer(b"".join(keys), ">i8").astype(np.int64).reshape(-1, 2)
            own = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0]), pa.array(both[:, 1]), batch.column("p1").take(own), batch.column("p2").take(own),
                 pa.array(at, pa.int32()), pa.array(lefts, pa.binary()), pa.array(rights, pa.binary())],
                ["k1", "k2", "p1", "p2", "at", "l", "r"],
            )

    return cells.select("k1", "k2", "p1", "p2", "at", "l", "r").mapInArrow(
        divide, "k1 long, k2 long, p1 long, p2 long, at int, l binary, r binary"
    )


def _starts(width: int) -> Column:
    """How many strings a cell with the edges l and r has."""
    return (F.least(F.length("r"), F.lit(width - 1)) - F.lit(width - 1) + F.length("l") + 1).cast("int")


def _repeated(cells: DataFrame, cell: int, length: int) -> DataFrame:
    """(p1, p2, at, n): the repeated strings of all cells (k1, k2, p1, p2, at, l, r), in runs.

    Cells that agree in core and edges are one document of the collection; its
    strings are all repeated if it stands for two. Cores with more documents than
    ``TOGETHER`` are divided into narrower cells with longer cores, down to
    single strings, so that no task orders an unbounded group.
    """
    found: DataFrame | None = None
    width, level = cell, cells
    while True:
        documents = stored(
            level.groupBy("k1", "k2", "l", "r").agg(
                F.count("*").alias("m"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("at").alias("at")
            )
        )
        if width == cell:  # p1, p2 name core and edges here
            copies = documents.filter("m > 1").select("p1", "p2", "at", _starts(width).alias("n"))
        else:
            name = [F.xxhash64(F.lit(k), "k1", "k2", "l", "r").alias(f"q{k}") for k in (1, 2)]
            several = documents.filter("m > 1").select(*name)
            copies = level.select("p1", "p2", "at", _starts(width).alias("n"), *name).join(several, ["q1", "q2"])
            copies = copies.select("p1", "p2", "at", "n")
        sizes = stored(documents.groupBy("k1", "k2").agg(F.count("*").alias("_size")).filter("_size > 1"))
        # a document that stands for several is done with, but others may match it
        alone = [F.when(F.col("m") == 1, F.col(c)).alias(c) for c in ("p1", "p2", "at")]
        shared = documents.select("k1", "k2", "l", "r", *alone).join(sizes, ["k1", "k2"])
        shared = shared.withColumn("at", F.coalesce("at", F.lit(0)))
        ordered = _order_cells(shared.filter(F.col("_size") <= TOGETHER), width, length + 1 - width, length)
        part = stored(copies.unionByName(ordered))
        found = part if found is None else found.unionByName(part)
        if width == 1 or sizes.filter(F.col("_size") > TOGETHER).isEmpty():
            return found
        narrow = -(-width // 2)
        # a core's documents are many here, but each row is divided by itself
        level = stored(_divide(shared.filter(F.col("_size") > TOGETHER), width, narrow))
        width = narrow


def remove_repeated(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, cell: int = CELL
) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, spans, kept) for every row of ``docs``.

    Every byte goes that is covered by a string of ``length`` bytes that also
    starts anywhere else in the collection, in the same text too; overlapping
    occurrences count, and all is judged on the texts as they come. ``spans`` are
    the maximal removed runs (start, stop) in bytes, ``kept`` the other bytes.

    Texts are UTF-8 bytes, a null text is empty; shorter texts are kept as they
    are; null keys are allowed. Rows that agree in key and text are occurrences
    of their own, so both are removed. Whole texts are read, long ones in
    overlapping parts. Other columns are not looked at; an empty table gives an
    empty result. Equal cores are recognised by 128 bits of hash, anchors by
    hash order alone, so no string is overlooked.
    """
    if not 0 < cell <= length - gram + 1:
        raise ValueError("a cell holds at most length - gram + 1 offsets")
    rows = docs.select(*row_key(key, text), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("_text"))
    cells = stored(_find_cells(rows, length, gram, cell))
    cores = cells.groupBy("core").agg(F.count("*").alias("_n")).filter("_n > 1").select("core")
    marks = cells.select("_id", "_fp", "first", "core").join(stored(cores), "core").groupBy("_id", "_fp").agg(
        F.collect_set("first").alias("marks")
    )
    marked = rows.join(marks, same_row(rows, marks)).select(rows["_id"], rows["_fp"], "_text", "marks")
    cut = stored(
        _cut_cells(marked, length, gram, cell).select(
            "_id", "_fp", "first", F.col("c1").alias("k1"), F.col("c2").alias("k2"), "l", "r",
            *[F.xxhash64(F.lit(k), "c1", "c2", "l", "r").alias(f"p{k}") for k in (1, 2)], F.lit(0).alias("at"),
        )
    )
    found = _repeated(cut.drop("_id", "_fp", "first"), cell, length)
    spans = (
        cut.select("_id", "_fp", "first", "p1", "p2")
        .join(found, ["p1", "p2"])
        .groupBy("_id", "_fp")
        .agg(F.collect_set(F.struct((F.col("first") + F.col("at")).alias("start"), "n")).alias("found"))
    )
    whole = rows.join(spans, same_row(rows, spans), "left").select(rows["_id"].alias(key), "_text", "found")
    return _removed(whole, key, length)


def _removed(whole: DataFrame, key: str, length: int) -> DataFrame:
    """Merge the repeated strings of each text and take their bytes out."""

    def take_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for raw, found in zip(batch.column("_text").to_pylist(), batch.column("found").to_pylist(), strict=True):
                spans: list[list[int]] = []
                for start, n in sorted((f["start"], f["n"]) for f in found or ()):
                    stop = start + n - 1 + length
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], stop)
                    else:
                        spans.append([start, stop])
                edges = [0, *(x for s in spans for x in s), len(raw)]
                kept = b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if spans else raw
                values = (len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
                for into, value in zip(out, (*values, [{"start": a, "stop": b} for a, b in spans], kept), strict=True):
                    into.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct({"start": pa.int32(), "stop": pa.int32()})), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True))],
                [key, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"],
            )

    return whole.mapInArrow(
        take_out,
        f"{key} {dict(whole.dtypes)[key]}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "spans array<struct<start:int,stop:int>>, kept binary",
    )
