import pytest

from reviewmill.sources import snapshots, trees

SCHEMA = "id int, text string, sha string, _h int"  # names that clash with inner ones


def rows(n):
    return [(i, f"text {i}", "s", i) for i in range(n)]


def differences(spark, folder, old, new, depth=2):
    paths = [f"{folder}/{name}" for name in ("old", "new")]
    for path, data in zip(paths, (old, new), strict=True):
        trees.save_tree(spark.createDataFrame(data, SCHEMA), "id", path, ["id", "text"], depth=depth)
    return {(r.name, r.status) for r in trees.changed_keys(spark, *paths).collect()}


def test_differences_are_named(spark, tmp_path):
    old = [*rows(300), (None, "x", "s", 0), (7, "twice", "s", 0), (8, None, "s", 0)]
    new = [*rows(299)[1:], (None, "y", "s", 0), (7, "other", "s", 0), (8, None, "s", 0), (900, "", "s", 0)]
    found = differences(spark, tmp_path, old, new)
    assert found == {("0", "removed"), ("299", "removed"), (None, "changed"), ("7", "changed"), ("900", "added")}
    assert differences(spark, tmp_path, old, list(reversed(old))) == set()


def test_a_renamed_key_counts(spark, tmp_path):
    for name, key in (("a", 1), ("b", 2)):
        trees.save_tree(spark.createDataFrame([(key, "same", "s", 0)], SCHEMA), "id", f"{tmp_path}/{name}", ["text"])
    found = trees.changed_keys(spark, f"{tmp_path}/a", f"{tmp_path}/b").collect()
    assert {(r.name, r.status) for r in found} == {("1", "removed"), ("2", "added")}


def test_empty_tables(spark, tmp_path):
    assert differences(spark, tmp_path, [], []) == set()
    assert differences(spark, tmp_path, [], rows(2), depth=0) == {("0", "added"), ("1", "added")}


def test_many_differences_are_joined(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trees, "LOOKED_UP", 3)
    found = differences(spark, tmp_path, rows(200), [(i, t.upper(), s, h) for i, t, s, h in rows(200)])
    assert found == {(str(i), "changed") for i in range(200)}


def test_one_changed_row_is_found_by_its_path(spark, tmp_path, monkeypatch):
    read = []
    real = trees._below

    def seen(table, column, *rest):
        part = real(table, column, *rest)
        read.append((column, part.count()))
        return part

    monkeypatch.setattr(trees, "_below", seen)
    new = rows(2000)
    new[77] = (77, "changed", "s", 0)
    assert differences(spark, tmp_path, rows(2000), new) == {("77", "changed")}
    assert [n for c, n in read if c == "path"] == [1, 1, 16, 16, 16, 16]
    assert all(n < 40 for c, n in read if c == "place")  # one leaf of 256
    plan = trees.snapshots.read(spark, f"{tmp_path}/old")["keys"].filter("place BETWEEN 'a1' AND 'a1g'")
    assert "GreaterThanOrEqual(place,a1)" in plan._jdf.queryExecution().toString()


def test_depth_follows_the_keys_and_has_to_agree(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trees, "LEAF_KEYS", 10)
    for name, n, depth in (("a", 10, 0), ("b", 100, 1), ("c", 200, 2)):
        trees.save_tree(spark.createDataFrame(rows(n), SCHEMA), "id", f"{tmp_path}/{name}")
        assert snapshots.read(spark, f"{tmp_path}/{name}")["settings"].first().depth == depth
    with pytest.raises(ValueError, match="can't be compared"):
        trees.changed_keys(spark, f"{tmp_path}/a", f"{tmp_path}/b")
