"""Multinomial Naive Bayes as aggregates and one join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.config import ReviewConfig
from reviewmill.operators.features import (
    document_frequency,
    idf_smooth,
    term_counts,
    tfidf_l2,
)
from reviewmill.scale import HOT_KEYS, hot_keys, mark_possible, materialize
from reviewmill.sources.models import Model


def nb_priors(df: DataFrame, label: str) -> DataFrame:
    """(label, log_prior) with unsmoothed class shares."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))  # one row per class
    return counts.select("label", F.log(F.col("n") / total).alias("log_prior"))


def nb_fit(weights: DataFrame, label: str, vocab: DataFrame, labels: Sequence[int], alpha: float = 1.0) -> DataFrame:
    """(term, df, idf, log_probs): smoothed log share of each term per label, in label order.

    One conditional sum per label keeps a single row per term, zero counts included.
    """
    sums = [
        F.coalesce(F.sum(F.when(F.col(label) == value, F.col("weight"))), F.lit(0.0)).alias(f"s{i}")
        for i, value in enumerate(labels)
    ]
    by_term = materialize(weights.groupBy("term").agg(*sums))  # read twice: totals, then logs
    totals = by_term.agg(
        F.struct(F.count("*").alias("size"), *[F.sum(f"s{i}").alias(f"t{i}") for i in range(len(labels))])
    ).scalar()
    logs = [
        F.log((F.col(f"s{i}") + alpha) / (F.col(f"m.t{i}") + F.lit(alpha) * F.col("m.size"))) for i in range(len(labels))
    ]
    return (
        by_term.withColumn("m", totals)
        .select("term", F.array(*logs).alias("log_probs"))
        .join(vocab.select("term", "df", "idf"), "term")
        .select("term", "df", "idf", "log_probs")
    )


def train_model(docs: DataFrame, row_id: str, text: str, label: str, cfg: ReviewConfig = ReviewConfig()) -> Model:
    """Fit TF-IDF and Naive Bayes on cleaned training texts.

    Every term of the vocabulary occurs in some training document, so the term
    sums cover the whole vocabulary.
    """
    counts = materialize(term_counts(docs, row_id, text, cfg.ngram_min, cfg.ngram_max, keep=(label,)))
    n_docs = docs.count()
    vocab = materialize(idf_smooth(document_frequency(counts, n_docs, cfg.min_df, cfg.max_df), n_docs))
    weights = tfidf_l2(counts, vocab, keep=(label,))
    terms = nb_fit(weights, label, vocab, cfg.labels, cfg.alpha)
    return Model(materialize(terms), nb_priors(docs, label), tuple(cfg.labels))


def _score_columns(model: Model) -> Column:
    """Joint log-likelihood per label: prior plus the normalised dot product."""
    length = F.sqrt(F.col("square"))
    prior = lambda i: F.col("priors")[F.lit(i)]
    return F.array(
        *[
            prior(i) + F.when(F.col("square") > 0, F.col(f"dot{i}") / length).otherwise(F.lit(0.0))
            for i in range(len(model.labels))
        ]
    )


def _hits(counts: DataFrame, model: Model, dots: Sequence[str]) -> DataFrame:
    """(id, square, *dots): what known terms add to a document, in one pass over ``counts``, which are not stored.

    Frequent terms are broadcast and summed to one row per document where they lie.
    That row travels with the document's other terms under a key no term has (terms
    hold word characters and spaces only), so that it needs no pass of its own.
    Most terms that the model lacks are found by a filter of bits and dropped before any other join.
    """
    hot = F.broadcast(hot_keys(model.terms, "term", "df", HOT_KEYS))
    columns = [F.col("term").alias("_term"), "idf", "log_probs"]
    near = model.terms.join(hot, "term", "left_semi").select(*columns)
    far = model.terms.join(hot, "term", "left_anti").select(*columns)
    known = F.col("_term").isNotNull()
    raw = F.col("tf") * F.col("idf")
    adds = {"square": raw * raw, **{c: raw * F.col("log_probs")[i] for i, c in enumerate(dots)}}

    local = mark_possible(counts, "term", model.terms.select("term"), "_possible").filter("_possible")
    local = local.join(F.broadcast(near), F.col("term") == F.col("_term"), "left")
    own = F.concat(F.lit("\0"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    moved = local.select("id", F.when(known, own).otherwise(F.col("term")).alias("term"), F.when(~known, F.col("tf")).alias("tf"), *[F.when(known, v).alias(c) for c, v in adds.items()])
    moved = moved.groupBy("id", "term").agg(F.max("tf").alias("tf"), *[F.sum(c).alias(c) for c in adds])
    met = moved.join(far, F.col("term") == F.col("_term"), "left")
    return met.select("id", *[F.when(known, v).otherwise(F.col(c)).alias(c) for c, v in adds.items()])


def joint_scores(docs: DataFrame, row_id: str, text: str, model: Model, cfg: ReviewConfig = ReviewConfig()) -> DataFrame:
    """(id, scores): one score per label for every document, those without known terms included."""
    dots = [f"dot{i}" for i in range(len(model.labels))]
    found = _hits(term_counts(docs, row_id, text, cfg.ngram_min, cfg.ngram_max), model, dots)
    sums = found.groupBy("id").agg(*[F.sum(c).alias(c) for c in ("square", *dots)])
    priors = model.priors.agg(
        F.array(*[F.max(F.when(F.col("label") == value, F.col("log_prior"))) for value in model.labels])
    ).scalar()
    zero = F.lit(0.0)
    return (
        docs.select(F.col(row_id).alias("id"))
        .join(sums, "id", "left")
        .withColumn("priors", priors)
        .withColumns({c: F.coalesce(c, zero) for c in ["square", *dots]})
        .select("id", _score_columns(model).alias("scores"))
    )


def _best(labels: Sequence[int]) -> Column:
    """Label of the highest score; ties go to the lowest label."""
    ranked = F.array(
        *[F.struct(F.col("scores")[i].alias("score"), F.lit(-label).alias("order")) for i, label in enumerate(labels)]
    )
    return (-F.array_max(ranked)["order"]).cast("int")


def _probabilities(labels: Sequence[int]) -> list[Column]:
    """Softmax, shifted by the largest score."""
    top = F.array_max("scores")
    exps = [F.exp(F.col("scores")[i] - top) for i in range(len(labels))]
    return [e / sum(exps[1:], exps[0]) for e in exps]


def nb_predict(docs: DataFrame, row_id: str, text: str, model: Model, cfg: ReviewConfig = ReviewConfig()) -> DataFrame:
    """(id, prediction, confidence)"""
    scores = joint_scores(docs, row_id, text, model, cfg)
    confidence = F.array_max(F.array(*_probabilities(model.labels)))
    return scores.select("id", _best(model.labels).alias("prediction"), confidence.alias("confidence"))


def nb_predict_proba(docs: DataFrame, row_id: str, text: str, model: Model, cfg: ReviewConfig = ReviewConfig()) -> DataFrame:
    """(id, label, proba)"""
    scores = joint_scores(docs, row_id, text, model, cfg)
    pairs = [
        F.struct(F.lit(label).alias("label"), p.alias("proba"))
        for label, p in zip(model.labels, _probabilities(model.labels), strict=True)
    ]
    return scores.select("id", F.explode(F.array(*pairs)).alias("x")).select("id", "x.label", "x.proba")
