"""Dataset profile: sizes, missing values, duplicates, lengths, label balance, description."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.functions.labels import display_label
from reviewmill.functions.text import word_count
from reviewmill.scale import digest


def dataset_shape(df: DataFrame, file: str) -> DataFrame:
    return df.agg(
        F.count_distinct(file).alias("n_files"),
        F.count("*").alias("n_rows"),
        F.lit(len([c for c in df.columns if c != file])).cast("bigint").alias("n_columns"),
    )


def payload_bytes(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """UTF-8 bytes of the printed values of a row."""
    parts = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in columns or df.columns]
    return sum(parts[1:], parts[0]).cast("bigint")


def data_size(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    kb = F.coalesce(F.sum(payload_bytes(df, columns)), F.lit(0)) / F.lit(1024)
    return df.agg(F.round(kb, 6).alias("kb"), F.round(kb / 1024, 6).alias("mb"))


def missing_values(df: DataFrame) -> DataFrame:
    """Null count and percentage of every column."""
    totals = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return totals.unpivot(["_rows"], list(df.columns), "column", "n").select(
        "column", "n", F.coalesce(F.round(F.col("n") * 100 / F.nullif("_rows", F.lit(0)), 2), F.lit(0.0)).alias("pct")
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows."""
    groups = df.groupBy(digest(*df.columns).alias("_row")).agg(F.count("*").alias("n"))
    extra = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    return groups.agg(
        extra.alias("n"),
        F.coalesce(F.round(extra * 100 / F.nullif(F.sum("n"), F.lit(0)), 2), F.lit(0.0)).alias("pct"),
    )


def duplicate_examples(df: DataFrame, row_id: str, k: int = 10) -> DataFrame:
    """The first ``k`` rows, by id, that have an equal row somewhere.

    Only the ``k + 1`` first copies of a group can matter. The rank filter runs
    before the shuffle too, so a huge group never reaches one task.
    """
    columns = [c for c in df.columns if c != row_id]
    keyed = df.withColumn("_row", digest(*columns))
    copies = Window.partitionBy("_row")
    return (
        keyed.withColumn("_rank", F.row_number().over(copies.orderBy(row_id)))
        .filter(F.col("_rank") <= max(k, 2))
        .withColumn("_copies", F.max("_rank").over(copies))
        .filter("_copies > 1")
        .drop("_row", "_rank", "_copies")
        .orderBy(row_id)
        .limit(k)
    )


def _length_stats(df: DataFrame, length: Column) -> DataFrame:
    # The exact median keeps one counter per distinct length, not per row.
    return df.select(length.alias("x")).agg(
        F.min("x").cast("bigint").alias("min"),
        F.max("x").cast("bigint").alias("max"),
        F.round(F.avg("x"), 6).alias("mean"),
        F.round(F.median("x"), 6).alias("median"),
    )


def char_length_stats(df: DataFrame, text: str) -> DataFrame:
    return _length_stats(df, F.length(text))


def word_count_stats(df: DataFrame, text: str) -> DataFrame:
    return _length_stats(df, word_count(F.col(text)))


def unique_texts(df: DataFrame, text: str) -> DataFrame:
    groups = df.groupBy(digest(text).alias("_text")).agg(F.count("*").alias("n"))
    return groups.agg(
        F.count("*").alias("n_unique"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicate")
    )


def longest_reviews(df: DataFrame, text: str, row_id: str, k: int = 3) -> DataFrame:
    sized = df.select(F.col(row_id).alias("row_id"), F.col(text).alias("text"), F.length(text).cast("bigint").alias("n_chars"))
    return sized.orderBy(F.desc("n_chars"), "row_id").limit(k)


def shortest_reviews(df: DataFrame, text: str, row_id: str, k: int = 3) -> DataFrame:
    sized = df.select(F.col(row_id).alias("row_id"), F.col(text).alias("text"), F.length(text).cast("bigint").alias("n_chars"))
    return sized.orderBy(F.asc_nulls_last("n_chars"), "row_id").limit(k)


def label_balance(df: DataFrame, label: str) -> DataFrame:
    """Counts and shares of both classes, their ratio, and how many labels occur."""
    name = display_label(F.col(label))
    totals = df.agg(
        F.count_if(name == "Negatif").alias("n_negative"),
        F.count_if(name == "Positif").alias("n_positive"),
        F.count_distinct(F.coalesce(name, F.lit("nan"))).alias("n_labels"),
    )
    total = F.nullif(F.col("n_negative") + F.col("n_positive"), F.lit(0))
    smaller = F.nullif(F.least("n_negative", "n_positive"), F.lit(0))
    return totals.select(
        "n_negative",
        "n_positive",
        F.round(F.coalesce(F.col("n_negative") * 100 / total, F.lit(0.0)), 6).alias("pct_negative"),
        F.round(F.coalesce(F.col("n_positive") * 100 / total, F.lit(0.0)), 6).alias("pct_positive"),
        F.coalesce(
            F.round(F.greatest("n_negative", "n_positive") / smaller, 6), F.lit(float("inf"))
        ).alias("imbalance"),
        "n_labels",
        (F.col("n_negative") == F.col("n_positive")).alias("balanced"),
    )


def dataset_sample(df: DataFrame, row_id: str, k: int = 10) -> DataFrame:
    return df.orderBy(row_id).limit(k)


def exact_quantiles(values: DataFrame, group: str, value: str, probs: Sequence[float]) -> DataFrame:
    """Exact linear-interpolated quantiles of ``value`` per ``group``: (group, p, q).

    A fine sketch brackets each quantile. Rows below a bracket are only counted
    and the few rows inside it are ranked, so no task holds a whole column.
    ``group`` must have few values (column names).
    """
    width = 3e-6
    edges = [min(1.0, max(0.0, p + d)) for p in probs for d in (-width, width)]
    sketch = values.groupBy(group).agg(
        F.percentile_approx(value, F.array(*[F.lit(e) for e in edges]), 1_000_000).alias("edges")
    )
    bracket = F.array(
        *[
            F.struct(
                F.lit(float(p)).alias("p"), F.col("edges")[2 * i].alias("lo"), F.col("edges")[2 * i + 1].alias("hi")
            )
            for i, p in enumerate(probs)
        ]
    )
    brackets = sketch.select(group, F.explode(bracket).alias("b")).select(group, "b.*")  # columns x probs rows
    counted = values.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("n"))
    joined = counted.join(F.broadcast(brackets), group)
    side = F.when(F.col(value) < F.col("lo"), -1).when(F.col(value) > F.col("hi"), 1).otherwise(0)
    # Outside the bracket one row per side is enough: how many, and the nearest value.
    sides = joined.withColumn("_side", side)
    inside = sides.filter("_side = 0").select(group, "p", F.col(value).alias("v"), "n")
    outside = (
        sides.filter("_side <> 0")
        .groupBy(group, "p", "_side")
        .agg(F.sum("n").alias("n"), F.max(value).alias("top"), F.min(value).alias("bottom"))
        .select(group, "p", F.when(F.col("_side") < 0, F.col("top")).otherwise(F.col("bottom")).alias("v"), "n")
    )
    ranked = inside.unionByName(outside)
    w = Window.partitionBy(group, "p")
    placed = (
        ranked.withColumn("upto", F.sum("n").over(w.orderBy("v")))
        .withColumn("total", F.sum("n").over(w))
        .withColumn("at", F.col("p") * (F.col("total") - 1))
    )
    covers = lambda rank: (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
    return (
        placed.groupBy(group, "p")
        .agg(
            F.max(F.when(covers(F.floor("at")), F.col("v"))).alias("below"),
            F.max(F.when(covers(F.ceil("at")), F.col("v"))).alias("above"),
            F.max("at").alias("at"),
        )
        .select(
            group,
            "p",
            (F.col("below") + (F.col("above") - F.col("below")) * (F.col("at") - F.floor("at"))).alias("q"),
        )
    )


def _is_numeric(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def describe_all(df: DataFrame) -> DataFrame:
    """One row per column: count, unique, top, freq, mean, std, min, quartiles, max.

    Text columns fill the first four, numeric columns the rest; ties for ``top``
    go to the smallest value.
    """
    numeric = [f.name for f in df.schema.fields if _is_numeric(f.dataType)]
    other = [f.name for f in df.schema.fields if not _is_numeric(f.dataType)]
    names = ["column", "count", "unique", "top", "freq", "mean", "std", "min", "q25", "q50", "q75", "max"]
    parts = []
    if other:
        values = df.select(*[F.col(c).cast("string").alias(c) for c in other])
        long = values.unpivot([], other, "column", "v").withColumn("h", F.when(F.col("v").isNotNull(), digest("v")))
        counts = long.groupBy("column", "h").agg(F.count("h").alias("n"))
        totals = counts.groupBy("column").agg(F.sum("n").alias("count"), F.count("h").alias("unique"), F.max("n").alias("freq"))
        # the most frequent values are few digests; only theirs are looked up, the smallest one wins
        leaders = counts.join(F.broadcast(totals.select("column", F.col("freq").alias("n"))), ["column", "n"]).filter("n > 0")
        top = long.join(leaders.select("column", "h"), ["column", "h"], "left_semi").groupBy("column").agg(F.min("v").alias("top"))
        parts.append(
            totals.join(top, "column", "left").select(
                "column", "count", "unique", "top", F.when(F.col("freq") > 0, F.col("freq")).alias("freq"),
                *[F.lit(None).cast("double").alias(c) for c in names[5:]],
            )
        )
    if numeric:
        long = df.select(*[F.col(c).cast("double").alias(c) for c in numeric]).unpivot([], numeric, "column", "v")
        moments = long.groupBy("column").agg(
            F.count("v").alias("count"),
            F.round(F.avg("v"), 6).alias("mean"),
            F.round(F.stddev_samp("v"), 6).alias("std"),
            F.min("v").alias("min"),
            F.max("v").alias("max"),
        )
        probs = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
        quartiles = exact_quantiles(long, "column", "v", list(probs)).groupBy("column").agg(
            *[F.round(F.max(F.when(F.col("p") == p, F.col("q"))), 6).alias(name) for p, name in probs.items()]
        )
        parts.append(
            moments.join(quartiles, "column", "left")
            .withColumns({"unique": F.lit(None).cast("bigint"), "top": F.lit(None).cast("string"), "freq": F.lit(None).cast("bigint")})
            .select(*names)
        )
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def dataset_info(df: DataFrame) -> DataFrame:
    """Non-null count, type and kind of every column."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], list(df.columns), "column", "non_null")
    types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    kinds = F.create_map(
        *[F.lit(x) for f in df.schema.fields for x in (f.name, "numeric" if _is_numeric(f.dataType) else "categorical")]
    )
    return counts.select("column", types[F.col("column")].alias("type"), kinds[F.col("column")].alias("kind"), "non_null")


def dataset_summary(df: DataFrame, label: str) -> DataFrame:
    """Total, class, missing and duplicate counts and size, in one aggregation over equal rows."""
    name = display_label(F.col(label))
    missing = sum((F.col(c).isNull().cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
    rows = df.select(
        digest(*df.columns).alias("_row"),
        (name == "Positif").alias("positive"),
        (name == "Negatif").alias("negative"),
        missing.alias("missing"),
        payload_bytes(df).alias("bytes"),
    )
    groups = rows.groupBy("_row").agg(
        F.count("*").alias("n"),
        F.count_if("positive").alias("positive"),
        F.count_if("negative").alias("negative"),
        F.sum("missing").alias("missing"),
        F.sum("bytes").alias("bytes"),
    )
    zero = F.lit(0).cast("bigint")
    return groups.agg(
        F.coalesce(F.sum("n"), zero).alias("total"),
        F.coalesce(F.sum("positive"), zero).alias("positive"),
        F.coalesce(F.sum("negative"), zero).alias("negative"),
        F.coalesce(F.sum("missing"), zero).alias("missing"),
        F.coalesce(F.sum(F.col("n") - 1), zero).alias("duplicate"),
        F.round(F.coalesce(F.sum("bytes"), zero) / F.lit(1024 * 1024), 6).alias("size_mb"),
    )
