"""Review files: find, read, union, write."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.config import NA_TOKENS
from reviewmill.sources import csv_records


def scan_files(spark: SparkSession, folder: str, regex: str = r"^data\d+\.csv$") -> DataFrame:
    """(file, path, size, file_no) of the files whose whole name matches ``regex``.

    Only the listing is read, never the content.
    """
    files = spark.read.format("binaryFile").load(folder).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    return (
        files.withColumn("file", name)
        .filter(F.col("file").rlike(regex))
        .select(
            "file",
            "path",
            F.col("length").alias("size"),
            F.regexp_extract("file", r"(\d+)", 1).try_cast("int").alias("file_no"),
        )
        .orderBy("file_no", "file")
    )


def find_files(spark: SparkSession, folder: str, regex: str = r"^data\d+\.csv$") -> list[str]:
    """Paths in natural-number order; fails when nothing matches."""
    paths = [r.path for r in scan_files(spark, folder, regex).collect()]
    if not paths:
        raise FileNotFoundError(f"no file in {folder} matches {regex}")
    return paths


def file_headers(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, place, header) for every path: the column names of its first record, null for an empty file.

    A path is a file or a folder of part files, which counts as one file with one
    header. Only the beginning of one file is read for a path.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    names = [(_plain(p), i, [re.sub("^\ufeff", "", c).strip() for c in reader.csv(p).columns] or None) for i, p in enumerate(paths)]
    return spark.createDataFrame(names, "path string, place int, header array<string>")


def _plain(path: str) -> str:
    return re.sub("/+$", "", re.sub("^file:/*", "/", path))


def _plain_column(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/*", "/")


def file_columns(headers: DataFrame) -> DataFrame:
    """(file, column): one row for each column that a file's header names."""
    name = F.element_at(F.split("path", "/"), -1)
    return headers.filter("header IS NOT NULL").select(name.alias("file"), F.explode("header").alias("column"))


def read_reviews(
    spark: SparkSession,
    paths: Sequence[str],
    required: Sequence[str] = ("text", "sentiment"),
    na_tokens: Sequence[str] = NA_TOKENS,
) -> DataFrame:
    """CSV files with a header as strings, plus ``file`` and ``row_id``.

    Values that spell "missing" become null. Files without a required column or
    without rows are an error that names them. A path may be a folder of part
    files, each with the header. Quoted fields may hold line breaks, and files may
    be of any size: every split of a file is a task (``csv_records``). ``row_id``
    is made of the number of the part file (by place of its path, then by name)
    and the row's number in it, so it is unique, keeps file order, then row order,
    and doesn't depend on the splits.
    """
    headers = file_headers(spark, paths).orderBy("place").collect()  # one row for a path, as the list of paths
    lacking = [r["path"] for r in headers if not set(required) <= set(r["header"] or ())]
    if lacking:
        raise ValueError(f"columns of {list(required)} are missing in {lacking}")
    filled = [r["path"] for r in headers if r["header"]]
    found = csv_records.records(spark, filled).filter("n > 0") if filled else None  # record 0 is the header
    places = {r["path"]: r["place"] for r in headers}
    parts = [_plain(p) for p in spark.read.text(filled).inputFiles()] if filled else []
    owner = {p: p if p in places else p.rsplit("/", 1)[0] for p in parts}
    numbered = [(p, owner[p], i) for i, p in enumerate(sorted(parts, key=lambda p: (places[owner[p]], p)))]
    names = spark.createDataFrame(numbered, "_part string, _path string, _place long")
    found = found.join(F.broadcast(names), _plain_column(F.col("part")) == F.col("_part"))  # one row for a part
    same: dict[tuple[str, ...], list[str]] = {}
    for r in headers:
        same.setdefault(tuple(r["header"] or ()), []).append(r["path"])
    tables = []
    for header, group in same.items():
        schema = ", ".join(f"`c{i}` string" for i in range(len(header)))
        fields = F.from_csv("record", schema, {"quote": '"', "escape": '"', "nullValue": "", "multiLine": "true", "maxCharsPerColumn": "-1"})
        values = [F.col(f"_fields.c{i}") for i in range(len(header))]
        tables.append(
            found.filter(F.col("_path").isin(group))
            .select("_path", (F.col("_place") * (1 << 33) + F.col("n") - 1).alias("row_id"), fields.alias("_fields"))
            .select(
                F.element_at(F.split("_path", "/"), -1).alias("file"), "row_id",
                *[F.when(~v.isin(*na_tokens), v).alias(c) for c, v in zip(header, values, strict=True)],
            )
        )
    empty = {r["path"] for r in headers} - {r["_path"] for r in found.select("_path").distinct().collect()}
    if empty:
        raise ValueError(f"no rows in {sorted(empty, key=places.__getitem__)}")
    return union_datasets(*tables)


def union_datasets(*frames: DataFrame) -> DataFrame:
    """All rows by column name; columns a table lacks become null."""
    if not frames:
        raise ValueError("there is no dataset to combine")
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def write_predictions(df: DataFrame, path: str) -> None:
    """CSV with a header, one file per partition."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option(
        "escapeQuotes", True
    ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
