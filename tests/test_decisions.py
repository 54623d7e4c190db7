"""Decisions kept between batches against deciding everything at once."""

from dataclasses import replace

import pytest

from reviewmill.operators import vocabulary
from reviewmill.operators.vocabulary import Lexicons
from reviewmill.plans import cleaning, decisions


@pytest.fixture(scope="module")
def lexicon(spark):
    return Lexicons(
        dictionary=spark.createDataFrame([("bagus",), ("barang",), ("kirim",)], "word string"),
        stopwords=spark.createDataFrame([("ini",)], "word string"),
        slang=spark.createDataFrame([("bgs", "bagus")], "token string, target string"),
    )


def counts(spark, **n):
    return spark.createDataFrame(sorted(n.items()), "token string, n long")


def rows(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=str)


def test_second_batch_decides_only_new_tokens(spark, lexicon, tmp_path):
    path = str(tmp_path / "memory")
    one, two = counts(spark, bgs=2, barangg=1, ini=4), counts(spark, bgs=5, kirimm=3, b4gus=1)
    decisions.decide_remembered(one, lexicon, path, batch="one")
    found = decisions.decide_remembered(two, lexicon, path, batch="two")
    assert {r.token: r.fresh for r in found.collect()} == {"bgs": False, "kirimm": True, "b4gus": True}
    assert rows(found.drop("fresh")) == rows(decisions.decide_tokens(two, lexicon))
    stats = {r.stat: r.n for r in vocabulary.normalization_stats(two, found).collect()}
    assert (stats["tokens_checked"], stats["cache_miss"], stats["cache_hit"]) == (9, 2, 7)
    kept = decisions.remembered(one, decisions.decisions_home(lexicon, path))
    assert {r.token: r.batch for r in kept.collect()} == {"bgs": "one", "barangg": "one", "ini": "one", "kirimm": "two", "b4gus": "two"}


def test_a_retried_batch_adds_nothing_and_agrees(spark, lexicon, tmp_path):
    path, batch = str(tmp_path / "memory"), counts(spark, bgs=2, barangg=1)
    first = rows(decisions.decide_remembered(batch, lexicon, path, batch="one"))
    assert rows(decisions.decide_remembered(batch, lexicon, path, batch="one")) == first
    further = decisions.decide_remembered(counts(spark, kirimm=1, bgs=1), lexicon, path, batch="one")
    assert {r.token: (r.normalized, r.fresh) for r in further.collect()} == {"kirimm": ("kirim", True), "bgs": ("bagus", True)}
    assert decisions.remembered(batch, decisions.decisions_home(lexicon, path)).count() == 2


def test_other_lexicons_and_settings_have_their_own_decisions(spark, lexicon, tmp_path):
    path, batch = str(tmp_path / "memory"), counts(spark, bgs=2)
    decisions.decide_remembered(batch, lexicon, path)
    other = replace(lexicon, slang=spark.createDataFrame([("bgs", "barang")], "token string, target string"))
    found = decisions.decide_remembered(batch, other, path).collect()
    assert [(r.normalized, r.fresh) for r in found] == [("barang", True)]
    assert [r.fresh for r in decisions.decide_remembered(batch, lexicon, path, fuzzy=False).collect()] == [True]
    assert [r.fresh for r in decisions.decide_remembered(batch, lexicon, path).collect()] == [False]


def test_no_tokens(spark, lexicon, tmp_path):
    path = str(tmp_path / "memory")
    assert decisions.decide_remembered(counts(spark, bgs=1).limit(0), lexicon, path).count() == 0
    assert decisions.remembered(counts(spark, bgs=1), decisions.decisions_home(lexicon, path)) is None


def test_cleaning_with_a_memory(spark, lexicon, tmp_path):
    path = str(tmp_path / "memory")
    texts = spark.createDataFrame([(1, "barangg ini bgs"), (2, "kirimm bgs"), (3, None)], "id long, text string")
    want = rows(cleaning.clean_text(texts, "id", "text", lexicon))
    for _ in range(2):
        assert rows(cleaning.clean_text(texts, "id", "text", lexicon, memory=path)) == want
