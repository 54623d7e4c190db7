"""Model tables, fingerprints and model metadata."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.scale import digest
from reviewmill.sources import snapshots


@dataclass(frozen=True)
class Model:
    """A trained classifier.

    ``terms``: (term, df, idf, log_probs ARRAY in label order) and
    ``priors``: (label, log_prior). The label list is small and fixed.
    ``fingerprints``: (name, sha) of the settings and lexicons it was trained with.
    """

    terms: DataFrame
    priors: DataFrame
    labels: tuple[int, ...]
    fingerprints: DataFrame | None = None

    @property
    def vocab(self) -> DataFrame:
        return self.terms.select("term", "df", "idf")

    @property
    def theta(self) -> DataFrame:
        """(label, term, log_prob)"""
        names = F.array(*[F.lit(label) for label in self.labels])
        return self.terms.select(
            "term", F.explode(F.arrays_zip(names.alias("label"), F.col("log_probs").alias("log_prob"))).alias("x")
        ).select("x.label", "term", "x.log_prob")


def save_model(model: Model, path: str) -> None:
    """Replace the model at ``path`` as a whole; a job that stops in between leaves the old one."""
    spark = model.priors.sparkSession
    prints = model.fingerprints
    if prints is None:
        prints = spark.createDataFrame([], "name string, sha string")
    snapshots.replace(spark, path, {"terms": model.terms, "priors": model.priors, "fingerprints": prints})


def load_model(spark: SparkSession, path: str) -> Model:
    """The tables saved last; a missing model is an error."""
    try:
        tables = snapshots.read(spark, path)
    except FileNotFoundError as error:
        raise FileNotFoundError(f"no model at {path}; train one first") from error
    priors, prints = tables["priors"], tables["fingerprints"]
    labels = tuple(r.label for r in priors.select("label").distinct().orderBy("label").collect())
    return Model(tables["terms"], priors, labels, None if prints.isEmpty() else prints)


def row_fingerprints(df: DataFrame, key: str, column: str) -> DataFrame:
    """(name, sha) of one text column per row."""
    return df.select(F.col(key).cast("string").alias("name"), F.sha2(column, 256).alias("sha"))


def table_fingerprint(df: DataFrame, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One (name, sha) row for a whole table, whatever the order of its rows.

    Each row's 256-bit digest is cut into eight 32-bit numbers that are summed,
    so only sums meet in one place.
    """
    hashed = df.select(F.hex(digest(*(columns or df.columns))).alias("h"))
    words = [F.conv(F.substring("h", 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(8)]
    sums = [F.coalesce(F.sum(w.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string") for w in words]
    return hashed.agg(F.sha2(F.concat_ws("|", F.count("*").cast("string"), *sums), 256).alias("sha")).select(
        F.lit(name).alias("name"), "sha"
    )


def compatibility_check(stored: DataFrame, current: DataFrame) -> DataFrame:
    """(name, stored, current, status): any difference means the model must be trained again."""
    joined = stored.select("name", F.col("sha").alias("stored")).join(
        current.select("name", F.col("sha").alias("current")), "name", "full_outer"
    )
    same = F.col("stored").eqNullSafe(F.col("current"))
    return joined.select("name", "stored", "current", F.when(same, "ok").otherwise("retrain").alias("status"))


def require_compatible(stored: DataFrame, current: DataFrame) -> None:
    changed = compatibility_check(stored, current).filter("status <> 'ok'")
    if not changed.isEmpty():
        names = sorted(r.name for r in changed.select("name").limit(20).collect())
        raise RuntimeError(f"settings or resources changed, train the model again: {names}")


def model_metadata(
    train: DataFrame,
    label: str,
    metrics: DataFrame,
    fingerprints: DataFrame,
    version: str = "1.0.0",
    steps: Sequence[str] = ("tfidf", "naive_bayes"),
    trained_at: str | None = None,
) -> DataFrame:
    """One row: version, rows, label distribution, file checksums, metrics, steps.

    ``fingerprints`` has one row per input file and resource.
    """
    counts = train.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    distribution = counts.agg(
        F.sum("n").alias("data_count"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("label").cast("string"), "n")))).alias(
            "label_distribution"
        ),
    )
    checksums = fingerprints.agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "sha")))).alias("checksums")
    )
    names = ["accuracy", "precision", "recall", "f1"]
    scores = metrics.agg(
        F.map_from_arrays(F.array(*[F.lit(m) for m in names]), F.array(*[F.max(m) for m in names])).alias(
            "evaluation_metrics"
        )
    )
    return distribution.select(
        F.lit(version).alias("model_version"),
        F.lit(trained_at).cast("string").alias("timestamp"),
        "data_count",
        "label_distribution",
        checksums.scalar().alias("checksums"),
        scores.scalar().alias("evaluation_metrics"),
        F.array(*[F.lit(s) for s in steps]).alias("pipeline_steps"),
    )


def write_metadata(metadata: DataFrame, path: str) -> None:
    metadata.write.mode("overwrite").json(path)


def read_metadata(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).json(path)
