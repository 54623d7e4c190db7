"""The tables behind the charts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill import config
from reviewmill.functions.labels import display_label
from reviewmill.functions.text import word_count
from reviewmill.operators.tokens import kept_words


def chart_label_distribution(df: DataFrame, label: str, order: Sequence[str] = config.CHART_LABEL_ORDER) -> DataFrame:
    """Rows per display label in a fixed order, zeros kept, other labels left out."""
    name = F.coalesce(display_label(F.col(label), default=F.lit(config.UNKNOWN_LABEL)), F.lit(config.UNKNOWN_LABEL))
    totals = df.agg(*[F.count_if(name == lab).alias(lab) for lab in order])
    return totals.select(
        F.explode(
            F.array(*[F.struct(F.lit(i).cast("bigint").alias("place"), F.lit(lab).alias("label"), F.col(lab).alias("n")) for i, lab in enumerate(order)])
        ).alias("r")
    ).select("r.*")


def _length_counts(df: DataFrame, text: str) -> DataFrame:
    """(x, n) rows per word count: one row per distinct length, however many texts there are."""
    return (
        df.filter(F.col(text).isNotNull())
        .groupBy(word_count(F.col(text)).cast("bigint").alias("x"))
        .agg(F.count("*").alias("n"))
    )


def chart_histogram(df: DataFrame, text: str, bins: int = 40) -> DataFrame:
    """Word counts in equal-width bins, last bin closed.

    Integer arithmetic places each length, so a value on a bin edge always goes
    to the upper bin. Equal lengths everywhere widen the range by a half each way.
    """
    all_lengths = Window.partitionBy(F.lit(0))
    lengths = _length_counts(df, text).select(
        "x", "n", F.min("x").over(all_lengths).alias("low"), F.max("x").over(all_lengths).alias("high")
    )
    spread = F.nullif(F.col("high") - F.col("low"), F.lit(0))
    place = F.least(F.lit(bins - 1), F.floor((F.col("x") - F.col("low")) * bins / spread))
    filled = (
        lengths.groupBy("low", "high", F.coalesce(place, F.lit(bins // 2)).cast("bigint").alias("bin"))
        .agg(F.sum("n").alias("n"))
        .groupBy("low", "high")
        .agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("counts"))
    )
    edge = F.when(spread.isNull(), F.col("low") - 0.5).otherwise(F.col("low").cast("double"))
    width = F.coalesce(spread.cast("double"), F.lit(1.0)) / bins
    return filled.select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1)).cast("array<bigint>")).alias("bin"), "counts", edge.alias("edge"), width.alias("width")
    ).select(
        "bin",
        F.round(F.col("edge") + F.col("bin") * F.col("width"), 6).alias("lo"),
        F.round(F.col("edge") + (F.col("bin") + 1) * F.col("width"), 6).alias("hi"),
        F.coalesce(F.try_element_at("counts", F.col("bin")), F.lit(0).cast("bigint")).alias("n"),
    )


def chart_boxplot(df: DataFrame, text: str) -> DataFrame:
    """Quartiles, whiskers (furthest value within 1.5 IQR) and number of outliers."""
    all_lengths = Window.partitionBy(F.lit(0))
    # The percentile reads the counts as weights.
    quartiles = F.percentile("x", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).over(all_lengths)
    boxed = _length_counts(df, text).withColumn("q", quartiles)
    iqr = F.col("q")[2] - F.col("q")[0]
    inside = (F.col("x") >= F.col("q")[0] - 1.5 * iqr) & (F.col("x") <= F.col("q")[2] + 1.5 * iqr)
    return boxed.agg(
        F.round(F.max(F.col("q")[0]), 6).alias("q1"),
        F.round(F.max(F.col("q")[1]), 6).alias("median"),
        F.round(F.max(F.col("q")[2]), 6).alias("q3"),
        F.min(F.when(inside, F.col("x"))).alias("lo"),
        F.max(F.when(inside, F.col("x"))).alias("hi"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0).cast("bigint")).alias("n_outliers"),
    )


def chart_top_words(tokens: DataFrame, k: int = 20, row_id: str = "id", stopwords: DataFrame | None = None) -> DataFrame:
    """The ``k`` most frequent tokens; ties go to the earlier first occurrence.

    Short tokens and ``stopwords`` are taken out of the counts, one row per word.
    """
    counts = tokens.groupBy("token").agg(F.count("*").alias("n"), F.min(F.struct(row_id, "pos")).alias("first"))
    if stopwords is not None:
        counts = kept_words(counts, stopwords)
    counts = counts.withColumnRenamed("token", "word")
    return counts.orderBy(F.desc("n"), "first").limit(k).select("word", "n")


def chart_confusion(matrix: DataFrame, names: Mapping[int, str] | None = None) -> DataFrame:
    return matrix.select(
        display_label(F.col("actual"), names).alias("actual"), display_label(F.col("predicted"), names).alias("predicted"), "n"
    )


def chart_metrics(metrics: DataFrame, decimals: int = 3) -> DataFrame:
    names = ["accuracy", "precision", "recall", "f1"]
    return metrics.unpivot([], names, "metric", "value").select("metric", F.round("value", decimals).alias("value"))
