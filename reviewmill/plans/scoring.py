"""Batch prediction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.config import ReviewConfig
from reviewmill.functions.labels import display_label, invalid_text_mask, prediction_status
from reviewmill.operators.bayes import nb_predict
from reviewmill.operators.vocabulary import Lexicons, resource_fingerprints
from reviewmill.plans.cleaning import clean_text
from reviewmill.sources.models import Model, require_compatible


def batch_score(
    df: DataFrame,
    row_id: str,
    text: str,
    model: Model,
    lexicons: Lexicons,
    cfg: ReviewConfig = ReviewConfig(),
    fuzzy: bool = True,
) -> DataFrame:
    """Every input row and column plus ``sentimen``, ``tingkat_keyakinan`` and ``status``.

    Blank texts keep null predictions. Cleaning is the one used for training: a
    model that knows what it was trained with refuses other settings and lexicons.
    """
    if model.fingerprints is not None:
        require_compatible(model.fingerprints, resource_fingerprints(lexicons, cfg))
    if text not in df.columns:
        raise ValueError(f"the required column {text} is missing")
    valid = df.filter(~invalid_text_mask(F.col(text)))
    cleaned = clean_text(valid, row_id, text, lexicons, cfg, fuzzy)
    predicted = nb_predict(cleaned, "id", "clean_text", model, cfg).select(
        F.col("id").alias(row_id),
        display_label(F.col("prediction"), cfg.display).alias("sentimen"),
        F.col("confidence").alias("tingkat_keyakinan"),
    )
    return df.join(predicted, row_id, "left").withColumn("status", prediction_status(F.col(text)))
