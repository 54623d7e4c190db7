"""What is shuffled: frequent keys and texts that are alone under their id stay where they are."""

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewmill import scale
from reviewmill.operators import bayes, features, tokens
from reviewmill.operators.vocabulary import Lexicons
from reviewmill.plans.cleaning import clean_text
from reviewmill.sources.models import Model

DOCS = [(1, "no good no bad"), (2, "good good"), (2, "no bad"), (None, "x no"), (None, "good"), (3, None), (4, "..."), (5, "not_x no")]


def _docs(spark, rows=DOCS):
    return spark.createDataFrame(rows, "id long, text string")


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_hot_keys_are_as_many_as_allowed(spark):
    counts = spark.createDataFrame([(f"k{i}", n) for i, n in enumerate([5000, 64, 63, 40, 8, 7, 1, 1])], "key string, n long")
    hot = lambda limit: sorted(r.key for r in scale.hot_keys(counts, "key", limit=limit).collect())
    assert hot(0) == ["k0", "k1", "k2", "k3", "k4", "k5"]  # above a thousandth of the rows
    assert hot(7) == ["k0", "k1", "k2", "k3", "k4", "k5"]
    assert len(hot(8)) == 8
    even = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"), F.lit(3).cast("bigint").alias("n"))
    assert scale.hot_keys(even, "key", limit=4999).count() == 0
    assert scale.hot_keys(even, "key", limit=5000).count() == 5000
    assert scale.hot_keys(counts.limit(0), "key", limit=9).count() == 0


def test_hot_cold_join_with_a_limit_gives_the_same_rows(spark):
    facts = spark.range(3000).select((F.col("id") % 1200).cast("string").alias("key"), "id")
    facts = facts.unionByName(spark.createDataFrame([(None, -1), ("none", -2)], "key string, id long"))
    dim = spark.range(1200).select(F.col("id").cast("string").alias("key"), (F.col("id") * 2).alias("v"))
    counts = facts.groupBy("key").agg(F.count("*").alias("n"))
    rows = [sorted(map(tuple, scale.hot_cold_join(facts, dim, "key", counts, limit=k).collect())) for k in (0, 700, 100_000)]
    assert len(rows[0]) == 3000 and rows[0] == rows[1] == rows[2]


def test_frequencies_count_an_id_once_for_a_token(spark):
    found = {r.token: (r.df, r.n) for r in tokens.token_frequencies(_docs(spark), "id", "text").collect()}
    assert found == {"no": (4, 5), "good": (3, 4), "bad": (2, 2), "x": (1, 1), "not_x": (1, 1)}


def test_frequencies_shuffle_no_pairs_of_id_and_token(spark):
    plan = _plan(tokens.token_frequencies(_docs(spark, [(1, "a b a"), (2, "b")]), "id", "text"))
    assert plan.count("Aggregate") == 1


def test_listed_tokens_combine_like_single_ones(spark):
    listed = tokens.combine_negations(tokens.tokenize(_docs(spark), "id", "text", listed=True), ["no"])
    single = tokens.combine_negations(tokens.tokenize(_docs(spark), "id", "text"), ["no"])
    key = lambda df: sorted(map(str, df.collect()))
    assert key(listed) == key(single) and listed.columns == single.columns
    assert [r.token for r in listed.filter("id = 1").orderBy("pos").collect()] == ["no_good", "no_bad"]


def test_listed_tokens_of_single_ids_are_not_grouped(spark):
    table = tokens.tokenize(_docs(spark, [(1, "no good"), (2, "bad")]), "id", "text", listed=True)
    assert "Aggregate" not in _plan(tokens.combine_negations(table, ["no"]))


def test_possible_keys_are_never_ruled_out(spark):
    rows = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"), "id").unionByName(spark.createDataFrame([(None, -1)], "key string, id long"))
    marked = scale.mark_possible(rows, "key", rows.filter("id % 2 = 0 or id = -1").select("key"), "may")
    assert marked.columns == ["key", "id", "may"] and marked.count() == 4001
    assert marked.filter("id % 2 = 0 and id >= 0 and not may").isEmpty()
    assert marked.filter("id % 2 = 1 and may").count() < 10
    assert scale.mark_possible(rows, "key", rows.limit(0).select("key"), "may").filter("may").isEmpty()


@pytest.mark.parametrize("limit", [0, 700])
def test_scores_of_frequent_and_rare_terms(spark, monkeypatch, limit):
    """Two frequent terms, 2,000 rare ones and unknown words; term counts are not stored."""
    known = {f"w{i}": (3000 if i < 2 else 2 + i % 3, 1.0 + i / 1000, [-1.0 - i / 500, -2.0 + i / 900]) for i in range(2002)}
    terms = spark.createDataFrame([(t, *v) for t, v in known.items()], "term string, df long, idf double, log_probs array<double>")
    model = Model(terms, spark.createDataFrame([(0, -0.5), (1, -0.9)], "label int, log_prior double"), (0, 1))
    texts = {1: "w0 w1 w700 w700 zz", 2: "w0 w0 w0", 3: "w1500 w2001 qq", 4: "unknown only", 5: "", 6: None}
    monkeypatch.setattr(bayes, "HOT_KEYS", limit)
    monkeypatch.setattr(bayes, "materialize", None)
    docs = spark.createDataFrame(list(texts.items()), "id long, text string")
    found = {r.id: r.scores for r in bayes.joint_scores(docs, "id", "text", model).collect()}
    assert set(found) == set(texts)
    for i, text in texts.items():
        words = [w for w in (text or "").split() if w in known]
        raw = {w: words.count(w) * known[w][1] for w in words}
        length = math.sqrt(sum(x * x for x in raw.values())) or 1.0
        for label, prior in ((0, -0.5), (1, -0.9)):
            assert found[i][label] == pytest.approx(prior + sum(x * known[w][2][label] for w, x in raw.items()) / length)


def test_texts_alone_under_their_id_are_counted_without_grouping(spark):
    alone = [(1, 0, "aa bb aa aa bb"), (2, 1, ""), (3, 1, None), (None, 0, "aa"), (4, 1, "bb ää ää"), (5, 0, "x")]
    several = [(7, 0, "aa bb"), (7, 0, "bb aa bb"), (7, 1, "aa bb"), (None, 1, "aa")]

    def expected(rows):
        counts = Counter()
        for key, label, text in rows:
            words = [w for w in (text or "").split() if len(w) > 1]
            counts.update((key, label, t) for t in [*words, *map(" ".join, zip(words, words[1:], strict=False))])
        return dict(counts)

    for rows in (alone, [*alone, *several], [(1, 0, "")]):
        counts = features.term_counts(spark.createDataFrame(rows, "k long, label int, text string"), "k", "text", keep=("label",))
        assert counts.columns == ["id", "label", "term", "tf"] and counts.schema["tf"].dataType.simpleString() == "bigint"
        found = counts.collect()
        assert {(r.id, r.label, r.term): r.tf for r in found} == expected(rows) and len(found) == len(expected(rows))
        assert ("Aggregate" in _plan(counts)) == (len(rows) == 10)


def test_rows_of_keys_that_the_other_table_lacks_are_not_moved(spark):
    facts = scale.materialize(spark.range(20_000).select(F.concat(F.lit("k"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id"))).alias("key"), "id"))
    dim = scale.materialize(spark.range(0, 2000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") * 7).alias("value")))
    counts = facts.join(dim, "key").groupBy("key").agg(F.count("*").alias("n"))
    joined = scale.hot_cold_join(facts, dim, "key", counts, sparse=True)
    assert joined.columns == ["key", "id", "value"]
    assert sorted(joined.collect()) == sorted(facts.join(dim, "key").collect())
    assert "_possible" in joined._jdf.queryExecution().analyzed().toString()


def test_few_lengths_move_to_the_weights(spark):
    counts = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "a", 1)], "id long, term string, tf long")
    vocab = spark.createDataFrame([("a", 2, 1.0), ("b", 1, 2.0)], "term string, df long, idf double")
    weights = features.tfidf_l2(counts, vocab)
    assert {(r.id, r.term): round(r.weight, 6) for r in weights.collect()} == {(1, "a"): 0.707107, (1, "b"): 0.707107, (2, "a"): 1.0}
    assert "Aggregate" not in _plan(weights)


def test_lengths_are_broadcast_by_their_number(spark, monkeypatch):
    """Not by the size of their files: above Spark's own limit the weights would be moved."""
    counts = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "a", 1)], "id long, term string, tf long")
    vocab = spark.createDataFrame([("a", 2, 1.0), ("b", 1, 2.0)], "term string, df long, idf double")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lambda: features.tfidf_l2(counts, vocab)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan()
        monkeypatch.setattr(scale, "FEW_ROWS", 1)
        assert "SortMergeJoin" in plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_cleaning_moves_words_without_flags(spark):
    words = spark.createDataFrame([("good",), ("bad",)], "word string")
    slang = spark.createDataFrame([("gd", "good")], "token string, target string")
    lexicon = Lexicons(words, spark.createDataFrame([("the",)], "word string"), slang, negations=("no",), affixes=("^un", "s$"))
    cleaned = clean_text(_docs(spark, [(1, "no gd the goods"), (2, None), (3, "bad no no bad")]), "id", "text", lexicon, fuzzy=False)
    assert {r.id: r.clean_text for r in cleaned.collect()} == {1: "no_good good", 2: "", 3: "bad no no_bad"}
    moved = re.findall(r"collect_list\(struct\((.*?)\)", _plan(cleaned)) or re.findall(r"collect_list\((.*)", _plan(cleaned))
    assert moved and not any("is_negation" in fields.split("), ")[0] for fields in moved), moved
