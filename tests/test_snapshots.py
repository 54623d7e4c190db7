import pytest

from reviewmill.operators.bayes import train_model
from reviewmill.sources import history, models, snapshots


def terms(model):
    return sorted((str(r.label), r.term, r.log_prob) for r in model.theta.collect())


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([("t", "a", "positif", 90.0), ("t", "b", "negatif", None)], history.SCHEMA)


def test_a_save_that_stops_leaves_the_old_model_whole(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "model")
    texts = spark.createDataFrame([(i, w, y) for i, (w, y) in enumerate([("good fine", "1"), ("bad poor", "0")] * 3)], "id int, text string, label string")
    first = train_model(texts, "id", "text", "label")
    models.save_model(first, path)
    before = models.load_model(spark, path)
    kept = terms(before)
    second = train_model(texts.filter("id < 4"), "id", "text", "label")

    def stop(*_):
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(snapshots, "put_once", stop)  # all data are written, the manifest isn't
    with pytest.raises(RuntimeError):
        models.save_model(second, path)
    monkeypatch.undo()
    assert terms(models.load_model(spark, path)) == kept
    models.save_model(second, path)
    models.save_model(second, path)
    assert terms(models.load_model(spark, path)) == terms(second)
    assert len(snapshots._manifests(spark, path)) == snapshots.KEPT
    with pytest.raises(FileNotFoundError, match="train one first"):
        models.load_model(spark, str(tmp_path / "none"))


def test_a_retried_batch_adds_nothing(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "history")
    assert history.read_history(spark, path).count() == 0
    assert history.append_history(rows, path, "job-1") and not history.append_history(rows, path, "job-1")
    assert history.append_history(rows, path, "job-2") and history.append_history(rows, path)
    assert history.read_history(spark, path).count() == 6

    def stop(*_):
        raise RuntimeError("lost the driver")

    monkeypatch.setattr(snapshots, "put_once", stop)
    with pytest.raises(RuntimeError):
        history.append_history(rows, path, "job-3")
    monkeypatch.undo()
    assert history.read_history(spark, path).count() == 6  # half a batch doesn't count
    assert history.append_history(rows, path, "job-3")
    assert history.read_history(spark, path).count() == 8
    monkeypatch.setattr(snapshots, "_names", lambda *_: [])  # two attempts at the same time
    assert not history.append_history(rows, path, "job-3")
    monkeypatch.undo()
    assert history.read_history(spark, path).count() == 8
    history.reset_history(spark, path)
    assert history.read_history(spark, path).count() == 0
    with pytest.raises(ValueError, match="batch id"):
        history.append_history(rows, path, "a/b")


def test_a_file_is_put_once(spark, tmp_path):
    path = str(tmp_path / "folder" / "x.json")
    assert snapshots.put_once(spark, path, "one") and not snapshots.put_once(spark, path, "two")
    assert snapshots._text(spark, path) == "one"
    assert [n for n in snapshots._names(spark, str(tmp_path / "folder")) if not n.startswith(".")] == ["x.json"]
