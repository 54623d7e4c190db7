"""Batch prediction on arriving files: each micro-batch is scored and added to the history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewmill.config import ReviewConfig
from reviewmill.operators.vocabulary import Lexicons
from reviewmill.plans.scoring import batch_score
from reviewmill.scale import temporary_tables
from reviewmill.sources.models import Model


def score_stream(
    stream: DataFrame,
    row_id: str,
    text: str,
    model: Model,
    lexicons: Lexicons,
    path: str,
    checkpoint: str,
    cfg: ReviewConfig = ReviewConfig(),
    fuzzy: bool = True,
) -> StreamingQuery:
    """Score what has arrived and stop.

    Rows carry their batch number as a partition folder; a batch that is run
    again after a failure replaces its own folder, so no row is written twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        with temporary_tables(batch.sparkSession):
            scored = batch_score(batch, row_id, text, model, lexicons, cfg, fuzzy)
            scored.withColumn("scored_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")).write.mode(
                "overwrite"
            ).parquet(f"{path}/batch={number}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
