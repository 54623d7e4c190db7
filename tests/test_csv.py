import csv
import io
import random

import pytest

from reviewmill.sources import csv_records, reviews


@pytest.fixture
def small_splits(spark):
    """split(n): files are cut into ranges of n bytes."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def split(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", str(n))

    yield split
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_of(data):
    return [r for r in csv.reader(io.StringIO(data, newline=""))]


def random_field(own):
    kind = own.randrange(6)
    if kind == 0:
        return own.choice(["", "plain", "a b", "1", '""', 'mid"quote', "é"])
    inner = "".join(own.choice(['""', "\n", ",", "x", "y z", '"",""', "\n\n", ',""\n']) for _ in range(own.randrange(8)))
    return f'"{inner}"' + (own.choice(["", "", "", "tail", 't"u']))


@pytest.mark.parametrize(("seed", "size"), [(1, 11), (2, 40), (3, 200)])
def test_records_on_adversarial_quotes(spark, tmp_path, small_splits, seed, size):
    own = random.Random(seed)
    files = {}
    for k in range(3):
        lines = [",".join(random_field(own) for _ in range(3)) for _ in range(own.randrange(1, 9))]
        if k == 1:
            lines = [line for pair in zip(lines, [""] * len(lines), strict=True) for line in pair]  # blank lines
        files[f"data{k}.csv"] = "\n".join(lines) + "\n" * (k % 2)
        (tmp_path / f"data{k}.csv").write_text(files[f"data{k}.csv"], encoding="utf-8", newline="")
    small_splits(size)
    found = csv_records.records(spark, [str(tmp_path / name) for name in files]).collect()
    for name, data in files.items():
        mine = sorted((r.n, r.record) for r in found if r.part.endswith(name))
        assert [n for n, _ in mine] == list(range(len(mine)))
        assert [rows_of(r)[0] if r else [] for _, r in mine] == [r for r in rows_of(data) if r], data


def test_one_file_read_by_many_tasks_equals_one_task(spark, tmp_path, small_splits):
    own = random.Random(9)
    texts = ["".join(own.choice(['"', "\n", ",", "word ", "é", '""', "\n\n"]) for _ in range(own.randrange(1, 30))) for _ in range(120)]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(["text", "sentiment"])
    writer.writerows([t, i % 2] for i, t in enumerate(texts))
    path = tmp_path / "data1.csv"
    path.write_text(out.getvalue(), encoding="utf-8", newline="")
    columns = ["file", "row_id", "text", "sentiment"]
    one = reviews.read_reviews(spark, [str(path)]).select(columns)
    expected = one.orderBy("row_id").collect()
    assert [r.row_id for r in expected] == list(range(120))
    whole = spark.read.csv(str(path), header=True, multiLine=True, quote='"', escape='"').collect()
    assert [r.text for r in expected] == [r.text for r in whole] == texts
    small_splits(150)
    many = reviews.read_reviews(spark, [str(path)]).select(columns)
    assert many.orderBy("row_id").collect() == expected
    assert csv_records._lines(spark, [str(path)]).rdd.getNumPartitions() > 10


def test_a_record_longer_than_many_ranges_and_a_field_left_open(spark, tmp_path, small_splits):
    small_splits(50)
    (tmp_path / "data1.csv").write_text('a,b\r\n"' + "long\n" * 80 + '",1\r\nx,2\r\n"open\nto the end', encoding="utf-8", newline="")
    found = {r.n: r.record for r in csv_records.records(spark, [str(tmp_path / "data1.csv")]).collect()}
    assert found == {0: "a,b", 1: '"' + "long\n" * 80 + '",1', 2: "x,2", 3: '"open\nto the end'}


def test_byte_order_mark_blank_lines_and_empty_files(spark, tmp_path):
    (tmp_path / "data1.csv").write_text('﻿"text",sentiment\n\n"a\nb",1\n\n\nc,0', encoding="utf-8", newline="")
    (tmp_path / "data2.csv").write_text("text,sentiment\n", encoding="utf-8")
    (tmp_path / "data3.csv").write_text("", encoding="utf-8")
    path = str(tmp_path / "data1.csv")
    found = reviews.read_reviews(spark, [path]).orderBy("row_id").collect()
    assert [(r.row_id, r.text, r.sentiment) for r in found] == [(0, "a\nb", "1"), (1, "c", "0")]
    with pytest.raises(ValueError, match="no rows in .*data2.csv"):
        reviews.read_reviews(spark, [path, str(tmp_path / "data2.csv")])
    with pytest.raises(ValueError, match="missing in .*data3.csv"):
        reviews.read_reviews(spark, [str(tmp_path / "data3.csv")])
