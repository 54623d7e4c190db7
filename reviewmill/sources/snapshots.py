"""Tables that change as a whole: new files first, then one small file that names them.

A snapshot is a set of tables. Its data are written to a folder that nothing
refers to yet; the manifest that names the folder appears by one rename. Readers
take the manifest with the highest number, so a job that stops in between leaves
the snapshot before untouched. Batches are appended in the same way: a batch
counts once its mark is there, and the first mark of a batch id stays.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Snapshots whose data stay when a new one is committed.
KEPT = 2


def _files(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return hadoop, where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    _, where, files = _files(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def _text(spark: SparkSession, path: str) -> str:
    return spark.read.option("wholetext", True).text(path).first()[0]


def put_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its whole content by one rename; False if there already is one."""
    hadoop, where, files = _files(spark, path)
    draft = hadoop.Path(f"{path}.{uuid.uuid4().hex}.draft")
    out = files.create(draft)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    context = hadoop.FileContext.getFileContext(where.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(where), options)
    except Exception as error:
        files.delete(draft, False)
        if "FileAlreadyExists" in str(error):
            return False
        raise
    return True


def _manifests(spark: SparkSession, path: str) -> list[str]:
    """File names by number, the newest last."""
    return [n for n in _names(spark, f"{path}/_manifests") if re.fullmatch(r"\d{12}\.json", n)]


def replace(spark: SparkSession, path: str, tables: dict[str, DataFrame]) -> None:
    """Make ``tables`` the snapshot at ``path``; data of all but the last ``KEPT`` snapshots are removed."""
    data = f"{path}/data/{uuid.uuid4().hex}"
    for name, table in tables.items():
        table.write.parquet(f"{data}/{name}")
    manifest = json.dumps({"data": data, "tables": sorted(tables)})
    while True:
        known = _manifests(spark, path)
        number = int(known[-1][:12]) + 1 if known else 0
        if put_once(spark, f"{path}/_manifests/{number:012d}.json", manifest):
            break  # else another writer took the number
    for name in known[: max(0, len(known) + 1 - KEPT)]:
        old = json.loads(_text(spark, f"{path}/_manifests/{name}"))["data"]
        for gone in (f"{path}/_manifests/{name}", old):
            _, where, files = _files(spark, gone)
            files.delete(where, True)


def read(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of the newest snapshot at ``path``."""
    known = _manifests(spark, path)
    if not known:
        raise FileNotFoundError(f"no snapshot at {path}")
    manifest = json.loads(_text(spark, f"{path}/_manifests/{known[-1]}"))
    return {name: spark.read.parquet(f"{manifest['data']}/{name}") for name in manifest["tables"]}


def append(df: DataFrame, path: str, batch: str | None = None) -> bool:
    """Add a batch of rows; False, and nothing is added, if a batch of that id is already there."""
    spark = df.sparkSession
    batch = uuid.uuid4().hex if batch is None else batch
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"a batch id is made of letters, digits, dots and dashes, not {batch!r}")
    if f"{batch}.batch" in _names(spark, f"{path}/_batches"):
        return False
    data = f"{path}/batches/{batch}-{uuid.uuid4().hex}"
    df.write.parquet(data)
    done = put_once(spark, f"{path}/_batches/{batch}.batch", data)
    if not done:  # another attempt was faster
        _, where, files = _files(spark, data)
        files.delete(where, True)
    return done


def batches(spark: SparkSession, path: str) -> list[str]:
    """The folders of all batches that count."""
    names = [n for n in _names(spark, f"{path}/_batches") if n.endswith(".batch")]
    if not names:
        return []
    marks = spark.read.option("wholetext", True).text([f"{path}/_batches/{n}" for n in names])
    return sorted(r[0] for r in marks.collect())  # one short row for a batch


def clear(spark: SparkSession, path: str) -> None:
    """Leave no batch behind: the marks go first."""
    for folder in (f"{path}/_batches", f"{path}/batches"):
        _, where, files = _files(spark, folder)
        files.delete(where, True)
