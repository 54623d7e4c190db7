"""Metrics from (actual, predicted) pairs; everything derives from the small count table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(top / F.nullif(bottom, F.lit(0)), F.lit(0.0))


def binary_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Accuracy, and precision, recall and F1 of class 1; 0 where a ratio is undefined."""
    y, p = F.col(actual), F.col(predicted)
    counts = df.filter(y.isNotNull() & p.isNotNull()).agg(
        F.count("*").alias("n"),
        F.count_if(y == p).alias("right"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if(p == 1).alias("predicted"),
        F.count_if(y == 1).alias("actual"),
    )
    return counts.select(
        _ratio(F.col("right"), F.col("n")).alias("accuracy"),
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("actual")).alias("recall"),
        _ratio(F.col("tp") * 2, F.col("predicted") + F.col("actual")).alias("f1"),
    )


def confusion_matrix(df: DataFrame, actual: str, predicted: str, labels: Sequence[int] = (0, 1)) -> DataFrame:
    """(actual, predicted, n) for every pair of labels, zeros kept.

    One conditional count per cell: the label list is small and fixed.
    """
    cells = [(a, p) for a in labels for p in labels]
    counts = df.agg(
        *[F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).alias(f"c{i}") for i, (a, p) in enumerate(cells)]
    )
    rows = [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"c{i}").alias("n"))
        for i, (a, p) in enumerate(cells)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def classification_report(matrix: DataFrame, labels: Sequence[int] = (0, 1), decimals: int = 4) -> DataFrame:
    """Per class, accuracy, macro and weighted rows of (row, precision, recall, f1, support)."""
    per = []
    for label in labels:
        hit = F.sum(F.when((F.col("actual") == label) & (F.col("predicted") == label), F.col("n")).otherwise(0))
        guessed = F.sum(F.when(F.col("predicted") == label, F.col("n")).otherwise(0))
        support = F.sum(F.when(F.col("actual") == label, F.col("n")).otherwise(0))
        per += [hit.alias(f"h{label}"), guessed.alias(f"g{label}"), support.alias(f"s{label}")]
    totals = matrix.agg(*per, F.sum("n").alias("n"), F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)).alias("right"))

    def scores(label: int) -> list[Column]:
        hit, guessed, support = F.col(f"h{label}"), F.col(f"g{label}"), F.col(f"s{label}")
        return [_ratio(hit, guessed), _ratio(hit, support), _ratio(hit * 2, guessed + support)]

    def mean(weights: list[Column], total: Column) -> list[Column]:
        columns = zip(*[scores(label) for label in labels], strict=True)
        return [_ratio(sum((w * c for w, c in zip(weights, column, strict=True)), F.lit(0.0)), total) for column in columns]

    def row(name: str, values: Sequence[Column], support: Column) -> Column:
        precision, recall, f1 = (F.round(v, decimals) for v in values)
        return F.struct(
            F.lit(name).alias("row"), precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
            support.cast("bigint").alias("support"),
        )

    accuracy = _ratio(F.col("right"), F.col("n"))
    supports = [F.col(f"s{label}") for label in labels]
    rows = [row(str(label), scores(label), F.col(f"s{label}")) for label in labels]
    rows.append(row("accuracy", [accuracy] * 3, F.col("n")))
    rows.append(row("macro avg", mean([F.lit(1.0)] * len(labels), F.lit(float(len(labels)))), F.col("n")))
    rows.append(row("weighted avg", mean(supports, F.col("n")), F.col("n")))
    return totals.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
