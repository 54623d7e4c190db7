import numpy as np
from pyspark.sql import functions as F

from reviewmill.llm import langid, toxicity
from reviewmill.llm.base import table
from reviewmill.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(np.argsort(score, kind="stable")) + 1
    positive = label == 1
    n, m = positive.sum(), (~positive).sum()
    return (order[positive].sum() - n * (n + 1) / 2) / (n * m)


def test_toxicity_on_held_out_documents(spark):
    found = QUERIES["op8_toxicity"](spark, FOLDER)
    rows = found.filter("held_out").join(table(spark, FOLDER, "labels"), "doc_id").select("score", "predicted", "toxic").toPandas()
    assert found.count() == 10_000
    assert auc(rows["score"].to_numpy(), rows["toxic"].to_numpy()) > 0.75
    hit = rows[rows["predicted"] == 1]
    assert len(hit) > 0.4 * rows["toxic"].sum() and hit["toxic"].mean() > 0.9


def test_toxicity_of_odd_texts(spark, documents):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (1, 0)], "doc_id long, toxic int")
    docs = documents([(1, None, "s"), (2, "", "s"), (2, "123 !", "s"), (3, "word " * 30_000, "s"), (None, "a b", None)])
    model = toxicity.train(docs, labels)
    assert not model.trained
    scores = [r[0] for r in docs.select(toxicity.score_toxicity(docs, model)).collect()]
    assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)
    assert documents([]).select(toxicity.score_toxicity(documents([]), model)).count() == 0
    trained = toxicity.train(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    assert trained.trained
    got = [r[0] for r in docs.select(toxicity.score_toxicity(docs, trained)).collect()]
    assert len(got) == 5 and all(0 <= s < 0.5 for s in got) and got[0] == got[1] == got[2]


def test_toxic_words_of_few_texts_are_learnt(spark, documents, prose):
    ordinary = [(i, prose(30, seed=i), "s") for i in range(900)]
    toxic = [(1000 + i, f"{prose(20, seed=5000 + i)} grobzeug{'abcdefghij'[i // 300]}{i // 3:04d}x", "s") for i in range(900)]
    docs = documents(ordinary + toxic)
    labels = docs.select("doc_id", (F.col("doc_id") >= 1000).cast("int").alias("toxic"))
    model = toxicity.train(docs, labels, bounds=toxicity.Bounds(dictionary_documents=30, calibration_documents=870))
    assert model.trained
    found = documents([(1, "grobzeug", "s"), (2, prose(30, seed=7777), "s")])
    scores = {r.doc_id: r.s for r in found.select("doc_id", toxicity.score_toxicity(found, model).alias("s")).collect()}
    assert scores[1] > 0.5 > scores[2]


def test_long_runs_of_words_are_cut_not_left_out(spark):
    sample = spark.createDataFrame([("x" * 10_000, 1), ("ab", 1), (None, 1), ("", 0)], "_text string, _toxic int")
    windows = toxicity._windows(sample, toxicity.Bounds())
    assert sorted(map(len, windows[1])) == [2, 1808, 4096, 4096] and windows[0] == []


def test_languages_on_held_out_documents(spark):
    found = QUERIES["op9_language"](spark, FOLDER)
    rows = found.filter("held_out").join(table(spark, FOLDER, "documents").select("doc_id", "lang"), "doc_id").toPandas()
    assert found.count() == 10_000 and rows["score"].between(0, 1).all()
    assert (rows["lang_pred"] == rows["lang"]).mean() > 0.97


def test_spans_scripts_and_odd_texts(spark, documents):
    train = spark.createDataFrame(
        [("the cat and the dog went out " * 5, "en"), ("le chat et le chien sont sortis " * 5, "fr"), ("кошка и собака вышли " * 5, "ru"),
         (None, "en"), ("no language", None), ("", "de")],
        "text string, lang string",
    )
    model = langid.train(train)
    assert model.languages == ["en", "fr", "ru"]
    docs = documents([
        (1, "the dog and the cat went out. Le chien et le chat sont sortis", "s"), (2, "Собака", "s"), (3, None, "s"), (4, "12 -- !", "s"),
        (5, "", "s"), (6, "the cat " * 20_000, "s"), (6, "漢字", "s"),
    ])
    found = {}
    for r in docs.select("doc_id", langid.label_languages(docs, model).alias("f")).collect():
        found.setdefault(r.doc_id, []).append(r.f)
    assert [(s.lang, s.first, s.words) for s in found[1][0].spans] == [("en", 0, 7), ("fr", 7, 7)]
    assert found[2][0].lang == "ru"
    assert [(found[k][0].lang, found[k][0].score, found[k][0].spans) for k in (3, 4, 5)] == [("und", 0.0, [])] * 3
    assert {f.lang for f in found[6]} <= {"en", "fr", "ru"} and any(f.lang == "en" and f.spans[0].words == 40_000 for f in found[6])
    nothing = langid.train(train.limit(0))
    assert {r[0].lang for r in docs.select(langid.label_languages(docs, nothing)).collect()} == {"und"}


def test_viterbi_against_all_paths():
    from itertools import product

    rng = np.random.default_rng(0)
    for _ in range(30):
        n, k = int(rng.integers(1, 6)), 3
        scores = rng.standard_normal((n, k)) * 3
        path = langid.viterbi(scores, np.array([n]), 2.0)

        def value(p):
            return sum(scores[i, x] for i, x in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))

        assert np.isclose(value(path.tolist()), max(value(p) for p in product(range(k), repeat=n)))
