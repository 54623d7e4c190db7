"""Prepare, train and evaluate."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.config import ReviewConfig
from reviewmill.operators import quality
from reviewmill.operators.bayes import nb_predict, train_model
from reviewmill.operators.evaluation import binary_metrics, classification_report, confusion_matrix
from reviewmill.operators.features import stratified_split
from reviewmill.operators.vocabulary import Lexicons, resource_fingerprints
from reviewmill.plans.cleaning import clean_text
from reviewmill.scale import materialize
from reviewmill.sources.models import Model, model_metadata, save_model, write_metadata


@dataclass(frozen=True)
class Evaluation:
    predictions: DataFrame  # (id, label, prediction, confidence)
    metrics: DataFrame
    matrix: DataFrame
    report: DataFrame
    sizes: DataFrame  # (train_size, test_size)


def prepare_reviews(reviews: DataFrame, cfg: ReviewConfig = ReviewConfig(), strict: bool = True) -> DataFrame:
    """Rows fit for training; bad labels and conflicting labels are errors.

    Unless ``strict``, texts with conflicting labels are only warned of and keep one row for each label.
    """
    rows = quality.drop_missing_required(reviews, [cfg.text, cfg.label])
    quality.require_rows(rows, "the dataset without blank rows")
    bad = quality.label_violations(rows, cfg.label, cfg.labels)
    values = bad.count()
    if values:
        first = [(r.problem, r.value, r.n) for r in bad.orderBy("problem", "value").limit(20).collect()]
        raise ValueError(f"{values} label problems, the first are: {first}")
    rows = quality.normalize_labels(rows, cfg.label, cfg.labels)
    conflicts = quality.conflict_texts(rows, cfg.text, cfg.label).count()
    if conflicts:
        problem = f"{conflicts} texts carry conflicting labels"
        if strict:
            raise ValueError(f"{problem}; correct the dataset before training")
        warnings.warn(f"{problem}; they are kept once for each label", stacklevel=2)
    return quality.drop_exact_duplicates(rows, cfg.text, cfg.label, cfg.row_id)


def clean_reviews(rows: DataFrame, lexicons: Lexicons, cfg: ReviewConfig = ReviewConfig(), fuzzy: bool = True) -> DataFrame:
    """The rows (id, label, is_test, …) with ``clean_text``; written once, as training reads it several times."""
    cleaned = clean_text(rows, cfg.row_id, cfg.text, lexicons, cfg, fuzzy)
    keep = [F.col(cfg.row_id).alias("id"), *[F.col(c) for c in rows.columns if c not in (cfg.row_id, cfg.text)]]
    return materialize(rows.select(*keep).join(cleaned, "id"))


def split_reviews(rows: DataFrame, cfg: ReviewConfig = ReviewConfig()) -> DataFrame:
    """Split on the raw row key, so cleaning before or after gives the same test rows."""
    return stratified_split(rows, cfg.label, cfg.row_id, cfg.test_size, cfg.seed)


def evaluate_model(tests: DataFrame, sizes: DataFrame, model: Model, cfg: ReviewConfig = ReviewConfig()) -> Evaluation:
    """Predict cleaned test rows (id, label, clean_text) and derive every metric."""
    predicted = materialize(
        tests.select("id", F.col(cfg.label).alias("label"))
        .join(nb_predict(tests, "id", "clean_text", model, cfg), "id")
        .select("id", "label", "prediction", "confidence")
    )
    matrix = confusion_matrix(predicted, "label", "prediction", cfg.labels)
    return Evaluation(
        predicted,
        binary_metrics(predicted, "label", "prediction"),
        matrix,
        classification_report(matrix, cfg.labels),
        sizes,
    )


def train_and_evaluate(
    reviews: DataFrame,
    lexicons: Lexicons,
    cfg: ReviewConfig = ReviewConfig(),
    fuzzy: bool = True,
    path: str | None = None,
    strict: bool = True,
) -> tuple[Model, Evaluation]:
    """The whole training run: check, split, clean, fit on the training rows, evaluate on the rest.

    Row ids and labels of the kept rows are written once and split; the texts
    are joined back once. With a ``path`` the model is saved there, with the
    record of its training. ``strict`` as in ``prepare_reviews``.
    """
    kept = materialize(prepare_reviews(reviews, cfg, strict).select(cfg.row_id, cfg.label))
    rows = reviews.drop(cfg.label).join(split_reviews(kept, cfg), cfg.row_id)
    cleaned = clean_reviews(rows, lexicons, cfg, fuzzy)
    model = train_model(cleaned.filter(~F.col("is_test")), "id", "clean_text", cfg.label, cfg)
    model = replace(model, fingerprints=materialize(resource_fingerprints(lexicons, cfg)))
    sizes = cleaned.agg(
        F.count_if(~F.col("is_test")).alias("train_size"), F.count_if("is_test").alias("test_size")
    )
    result = evaluate_model(cleaned.filter("is_test"), sizes, model, cfg)
    if path:
        save_model(model, path)
        record = model_metadata(cleaned, cfg.label, result.metrics, model.fingerprints, cfg.model_version)
        write_metadata(record, f"{path}/metadata")
    return model, result
