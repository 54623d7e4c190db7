"""Training rules, model files, streaming, skewed keys, errors and golden values."""

import hashlib

import pytest
from pyspark.sql import functions as F

from reviewmill import scale
from reviewmill.config import ReviewConfig
from reviewmill.functions.labels import label_value
from reviewmill.operators import bayes, evaluation, features, profiling, quality
from reviewmill.operators.vocabulary import Lexicons
from reviewmill.plans import queries, training
from reviewmill.plans.scoring import batch_score
from reviewmill.sources import lexicons, models, reviews
from reviewmill.streaming.scoring import score_stream

GOLDEN = {"accuracy": 0.9256107171000788, "precision": 0.9119981325863679, "recall": 0.9762618690654673, "f1": 0.9430364470190683}


def test_published_metrics(spark):
    counts = [(0, 0, 1966), (0, 1, 377), (1, 0, 95), (1, 1, 3907)]
    pairs = spark.createDataFrame(counts, "y int, p int, n int").select("y", "p", F.explode(F.sequence(F.lit(1), "n")))
    row = evaluation.binary_metrics(pairs, "y", "p").first()
    for name, value in GOLDEN.items():
        assert row[name] == pytest.approx(value, abs=1e-15)
    matrix = evaluation.confusion_matrix(pairs, "y", "p").collect()
    assert sorted((r.actual, r.predicted, r.n) for r in matrix) == counts


def test_split_sizes_of_the_published_data(spark):
    rows = spark.range(31721).select("id", F.when(F.col("id") < 11716, 0).otherwise(1).alias("label"))
    tests = features.stratified_split(rows, "label", "id").filter("is_test").groupBy("label").count().collect()
    assert {r.label: r["count"] for r in tests} == {0: 2343, 1: 4002}


def test_no_metrics_without_rows(spark):
    assert set(evaluation.binary_metrics(spark.createDataFrame([], "y int, p int"), "y", "p").first()) == {0.0}


def _table(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id bigint, text string, sentiment string")


def test_conflicts_are_rejected(spark):
    with pytest.raises(ValueError, match="conflicting"):
        training.prepare_reviews(_table(spark, [("bagus", "1"), ("bagus", "0"), ("buruk", "0")]))


def test_conflicts_are_kept_once_for_each_label_unless_strict(spark):
    table = _table(spark, [("bagus", "1"), ("bagus", "0"), ("bagus", "0"), ("buruk", "0")])
    with pytest.warns(UserWarning, match="1 texts carry conflicting labels"):
        rows = training.prepare_reviews(table, strict=False)
    assert {(r.row_id, r.sentiment) for r in rows.collect()} == {(0, 1), (1, 0), (3, 0)}


@pytest.mark.filterwarnings("ignore:1 texts carry conflicting labels")
def test_the_whole_run_ends_on_conflicting_labels(spark, tmp_path):
    """Text 0 carries both labels: a row for each, as in the SQL of the query."""
    texts = ["good fast nice"] * 2 + [f"good fast nice thing {w}" for w in ("a", "b", "c", "d")] + [f"bad slow broken thing {w}" for w in ("a", "b", "c", "d")]
    labels = [1, 0, 1, 1, 1, 1, 0, 0, 0, 0]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("bigint")}).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, q, 0) for i, q in enumerate(labels)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = {r.id: r.label for r in queries.train_and_evaluate(spark, str(tmp_path)).collect()}
    assert found == {i: labels[i] for label in (0, 1) for i in sorted((i for i in range(10) if labels[i] == label), key=lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest())[:1]}


@pytest.mark.parametrize("rows, message", [
    ([("a", "x"), ("b", "1")], "not_integer"),
    ([("a", "7"), ("b", "1"), ("c", "0")], "not_allowed"),
    ([("a", "1"), ("b", "1")], "too_few_classes"),
    ([(" ", "1")], "no rows"),
])
def test_bad_datasets_are_rejected(spark, rows, message):
    with pytest.raises(ValueError, match=message):
        training.prepare_reviews(_table(spark, rows))


def test_label_forms(spark):
    rows = spark.createDataFrame([(" 1 ",), ("+1",), ("1.0",), ("1_0",), (None,)], "l string")
    both = rows.select(label_value(F.col("l")).alias("s"), label_value(F.col("l"), strict=False).alias("f")).collect()
    assert [r.s for r in both] == [1, 1, None, None, None]
    assert [r.f for r in both] == [1, 1, 1, None, None]


def test_recorded_conflict_audit(spark):
    recorded = {"a": (8, 2), "b": (2, 2), "c": (3, 2)}
    rows = [(t, str(label)) for t, (ones, zeros) in recorded.items() for label, n in ((1, ones), (0, zeros)) for _ in range(n)]
    table = _table(spark, rows)
    audit = {r.text: (r.counts, r.removed, r.action) for r in quality.conflict_audit(table, "text", "sentiment").collect()}
    assert audit["a"] == ({"1": 8, "0": 2}, 2, "drop_minority_keep_1")
    assert audit["b"] == ({"1": 2, "0": 2}, 4, "drop_all_tie")
    assert audit["c"] == ({"1": 3, "0": 2}, 2, "drop_minority_keep_1")
    kept = quality.resolve_conflicts(table, "text", "sentiment").count()
    assert kept + sum(removed for _, removed, _ in audit.values()) == len(rows)


def test_hot_cold_join_is_the_plain_join(spark):
    """A key with a third of the rows is joined where it lies: only the others are shuffled."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000)
    facts = spark.range(60_000).select("id", key.alias("key"))
    facts = scale.materialize(facts)
    dim = scale.materialize(spark.range(0, 5000, 2).select(F.col("id").alias("key"), (F.col("id") * 7).alias("value")))
    counts = scale.materialize(facts.groupBy("key").agg(F.count("*").alias("n")))
    plain = facts.join(dim, "key").select("id", "key", "value")
    joined = scale.hot_cold_join(facts, dim, "key", counts).select("id", "key", "value")
    assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
    hot = counts.filter("key = 0").first().n
    assert hot > 0.3 * facts.count()
    far = facts.join(counts.filter(F.col("n") > 60), "key", "left_anti")
    assert far.filter("key = 0").isEmpty()


def test_temporary_tables_go_when_their_block_ends(spark):
    outer = scale.materialize(spark.range(3))
    with scale.temporary_tables(spark):
        inner = scale.materialize(outer)
        path = inner.inputFiles()[0].rsplit("/", 1)[0]
        assert inner.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    assert outer.count() == 3


def test_scoring_refuses_other_resources(spark, trained):
    lexicon, model, _ = trained
    rows = spark.createDataFrame([(1, "buruk")], "id bigint, text string")
    with pytest.raises(RuntimeError, match="settings"):
        batch_score(rows, "id", "text", model, lexicon, ReviewConfig(min_df=2))


def test_strict_validation_raises(spark):
    quality.require_valid(spark.createDataFrame([("a", "1")], "text string, sentiment string"), "text", "sentiment")
    with pytest.raises(ValueError, match="1 blank values in text"):
        quality.require_valid(spark.createDataFrame([(" ", "1")], "text string, sentiment string"), "text", "sentiment")


def test_files_report_their_own_columns(spark, tmp_path):
    (tmp_path / "data1.csv").write_text("text,sentiment\na,1\nb,\n", encoding="utf-8")
    (tmp_path / "data2.csv").write_text("text,lang,more\na,en,x\n", encoding="utf-8")
    (tmp_path / "data3.csv").write_text("", encoding="utf-8")
    paths = [str(tmp_path / f"data{i}.csv") for i in (1, 2, 3)]
    with pytest.raises(ValueError, match="data2.csv.*data3.csv"):
        reviews.read_reviews(spark, paths)
    columns = reviews.file_columns(reviews.file_headers(spark, paths))
    rows = reviews.read_reviews(spark, paths[:2], required=())
    found = {r.file: r for r in quality.file_report(rows, "file", "sentiment", "text", columns).collect()}
    assert (found["data1.csv"].n_columns, found["data1.csv"].n_missing, found["data1.csv"].status) == (2, 1, "valid")
    assert (found["data2.csv"].n_columns, found["data2.csv"].issues) == (3, "missing column sentiment")
    missing = quality.required_columns_check(columns, ["text", "sentiment", "more"]).collect()
    assert sorted((r.file, r.missing_column) for r in missing) == [("data1.csv", "more"), ("data2.csv", "sentiment")]
    many = [str(tmp_path / f"data{i}.csv") for i in range(10, 40)]
    for path in many:
        (tmp_path / path).write_text("text,sentiment\nx,1\ny,0\n", encoding="utf-8")
    ids = [r.row_id for r in reviews.read_reviews(spark, many).collect()]
    assert len(set(ids)) == 60


def test_folders_of_part_files_get_ids_of_their_own(spark, tmp_path):
    texts = spark.range(0, 60, 1, 6).selectExpr("concat('text ', id % 30) text", "CAST(id % 2 AS string) sentiment")
    paths = [str(tmp_path / name) for name in ("data1.csv", "data2.csv", "data3.csv")]
    reviews.write_predictions(texts, paths[0])
    reviews.write_predictions(texts.selectExpr("*", "'x' more"), paths[1])
    (tmp_path / "data3.csv").write_text("text,sentiment\nlast,1\nof all,0\n", encoding="utf-8")
    rows = reviews.read_reviews(spark, paths)
    found = rows.orderBy("row_id").collect()
    assert len({r.row_id for r in found}) == len(found) == 122
    assert [r.file for r in found] == ["data1.csv"] * 60 + ["data2.csv"] * 60 + ["data3.csv"] * 2
    assert [r.text for r in found] == [f"text {i % 30}" for i in range(60)] * 2 + ["last", "of all"]
    kept = quality.drop_exact_duplicates(rows, "text", "sentiment", "row_id").collect()
    assert len(kept) == len({r.text for r in kept}) == 32


def test_exact_quantiles_of_skewed_values(spark):
    values = spark.range(3001).select(F.lit("c").alias("g"), F.when(F.col("id") < 1000, 5).otherwise(F.col("id") ** 2).cast("double").alias("v"))
    expected = values.agg(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).first()[0]
    found = {r.p: r.q for r in profiling.exact_quantiles(values, "g", "v", [0.25, 0.5, 0.75]).collect()}
    assert [found[p] for p in (0.25, 0.5, 0.75)] == pytest.approx(expected)


def test_review_files(spark, tmp_path):
    for name in ("data1.csv", "data10.csv", "data2.csv"):
        (tmp_path / name).write_text('text,sentiment\n"a, ""b""\nc",1\nNA,0\n', encoding="utf-8")
    for name in ("data_backup.csv", "database.csv", "dataset.csv"):
        (tmp_path / name).write_text("text,sentiment\ncontoh,1\n", encoding="utf-8")
    paths = reviews.find_files(spark, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["data1.csv", "data2.csv", "data10.csv"]
    rows = reviews.read_reviews(spark, paths).orderBy("row_id").collect()
    assert [r.text for r in rows] == ['a, "b"\nc', None] * 3
    (tmp_path / "data3.csv").write_text("text,label\na,1\n", encoding="utf-8")
    with pytest.raises(ValueError, match="data3.csv"):
        reviews.read_reviews(spark, reviews.find_files(spark, str(tmp_path)))


def test_lexicon_files(spark, tmp_path):
    (tmp_path / "slang.json").write_text('{"slang": {"GA": "Tidak"}}', encoding="utf-8")
    (tmp_path / "leet.json").write_text('{"substitutions": {"1": ["I", "l"]}}', encoding="utf-8")
    (tmp_path / "emoticons.csv").write_text('emoticon,meaning,sentiment\n:),x,netral\n"(-""-)",y,netral\n:),z,positif\n', encoding="utf-8")
    assert [tuple(r) for r in lexicons.read_slang(spark, str(tmp_path / "slang.json")).collect()] == [("ga", "tidak")]
    assert [tuple(r) for r in lexicons.read_leet(spark, str(tmp_path / "leet.json")).collect()] == [("1", ["i", "l"])]
    emoticons = lexicons.read_emoticons(spark, str(tmp_path / "emoticons.csv"))
    assert lexicons.lexicon_map(emoticons, "emoticon", "sentiment") == {":)": "positif", '(-"-)': "netral"}


@pytest.fixture(scope="module")
def trained(spark):
    good = ["bagus sekali", "bagus cepat", "mantap bagus", "cepat mantap", "bagus mantap sekali"]
    bad = ["buruk lambat", "buruk rusak", "rusak lambat", "lambat sekali buruk", "rusak buruk parah"]
    rows = _table(spark, [(t, "1") for t in good] + [(t, "0") for t in bad])
    words = spark.createDataFrame([(w,) for t in good + bad for w in t.split()], "word string").distinct()
    lexicon = Lexicons(words, spark.createDataFrame([("di",)], "word string"), spark.createDataFrame([("bgs", "bagus")], "token string, target string"))
    model, result = training.train_and_evaluate(rows, lexicon, ReviewConfig(min_df=1))
    return lexicon, model, result


def test_training_run(trained):
    _, _, result = trained
    assert tuple(result.sizes.first()) == (8, 2)
    assert result.matrix.agg(F.sum("n")).first()[0] == 2


def test_scoring_keeps_every_row(spark, trained):
    lexicon, model, _ = trained
    rows = spark.createDataFrame([(1, "bgs!"), (2, "  "), (3, None), (4, "buruk"), (5, "zzz")], "id bigint, text string")
    scored = {r.id: r for r in batch_score(rows, "id", "text", model, lexicon, ReviewConfig(min_df=1)).collect()}
    assert scored[1].sentimen == "Positif" and scored[4].sentimen == "Negatif"
    assert scored[2].sentimen is None and scored[3].status == "Teks kosong, tidak diprediksi"
    assert scored[5].tingkat_keyakinan == pytest.approx(0.5)  # no known word: priors only, ties to label 0
    assert scored[5].sentimen == "Negatif"


def test_probabilities_sum_to_one(spark, trained):
    _, model, _ = trained
    docs = spark.createDataFrame([(1, "bagus buruk"), (2, "")], "id bigint, t string")
    for r in bayes.nb_predict_proba(docs, "id", "t", model).groupBy("id").agg(F.sum("proba").alias("s")).collect():
        assert r.s == pytest.approx(1.0)


def test_model_round_trip(spark, trained, tmp_path):
    _, model, _ = trained
    models.save_model(model, str(tmp_path / "m"))
    loaded = models.load_model(spark, str(tmp_path / "m"))
    assert loaded.labels == model.labels
    assert loaded.theta.exceptAll(model.theta).isEmpty()
    with pytest.raises(FileNotFoundError):
        models.load_model(spark, str(tmp_path / "none"))


def test_changed_resources_need_training(spark):
    stored = spark.createDataFrame([("a", "1"), ("b", "2")], "name string, sha string")
    models.require_compatible(stored, stored)
    with pytest.raises(RuntimeError, match="b"):
        models.require_compatible(stored, stored.filter("name = 'a'"))


def test_stream_scores_arriving_files(spark, trained, tmp_path):
    lexicon, model, _ = trained
    source = str(tmp_path / "in")
    spark.createDataFrame([(1, "bagus"), (2, "")], "id bigint, text string").write.parquet(source)
    stream = spark.readStream.schema("id bigint, text string").parquet(source)
    query = score_stream(stream, "id", "text", model, lexicon, str(tmp_path / "out"), str(tmp_path / "c"), ReviewConfig(min_df=1))
    query.awaitTermination(120)
    rows = {r.id: r.sentimen for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows == {1: "Positif", 2: None}


def test_documents_without_language_are_in_a_file(spark, tmp_path):
    documents = [(i, f"text {i}", lang, "s", 6) for i, lang in enumerate(["en", "fr", "de", None, None])]
    spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(5)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert queries.read_reviews(spark, str(tmp_path)).filter("lang IS NULL").count() == 2
    assert queries._mixed_files(spark, str(tmp_path))[0].count() == 5
