"""Row filters, label rules, duplicate and conflict handling, table checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill import config
from reviewmill.functions.labels import label_value
from reviewmill.functions.text import is_blank, strip_ws
from reviewmill.scale import digest


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail when a table has no rows; reads at most one row."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df


def drop_missing_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(reduce(Column.__and__, [~is_blank(F.col(c)) for c in columns]))


def normalize_labels(df: DataFrame, label: str, allowed: Sequence[int] = (0, 1), strict: bool = True) -> DataFrame:
    """Rows whose label parses to an allowed INT."""
    return df.withColumn(label, label_value(F.col(label), strict)).filter(F.col(label).isin(*allowed))


def label_violations(df: DataFrame, label: str, allowed: Sequence[int] = (0, 1), strict: bool = True) -> DataFrame:
    """Rejected label values with their counts, plus one row when fewer than two classes remain."""
    parsed = label_value(F.col(label), strict)
    checked = (
        df.groupBy(F.col(label).cast("string").alias("value"), parsed.alias("parsed"))
        .agg(F.count("*").alias("n"))
        .withColumn(
            "problem",
            F.when(F.col("parsed").isNull(), "not_integer").when(~F.col("parsed").isin(*allowed), "not_allowed"),
        )
    )
    bad = checked.filter("problem IS NOT NULL").select("problem", "value", "n")
    classes = checked.filter("problem IS NULL").agg(F.count_distinct("parsed").alias("n"))
    few = classes.filter("n < 2").select(F.lit("too_few_classes").alias("problem"), F.lit(None).cast("string").alias("value"), "n")
    return bad.unionByName(few)


def label_distribution_raw(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n")).orderBy("label")


def conflict_texts(df: DataFrame, text: str, label: str) -> DataFrame:
    """Texts that carry more than one label.

    Counts per (text digest, label) first, so copies combine early; the texts
    themselves are only fetched for the digests that are reported.
    """
    rows = df.filter(F.col(text).isNotNull() & F.col(label).isNotNull())
    pairs = rows.groupBy(digest(text).alias("_text"), label).agg(F.lit(1).alias("one"))
    found = pairs.groupBy("_text").agg(F.count("*").alias("n_labels")).filter("n_labels > 1")
    return _with_text(found, rows, F.col(text), "text").select("text", "n_labels")


def _with_text(found: DataFrame, rows: DataFrame, value: Column, name: str) -> DataFrame:
    """``found`` with the value behind each digest ``_text``, taken from the rows that have it."""
    wanted = found.select("_text")
    texts = (
        rows.select(digest(value).alias("_text"), value.alias(name))
        .join(wanted, "_text", "left_semi")
        .groupBy("_text")
        .agg(F.first(name).alias(name))
    )
    return found.join(texts, "_text")


def conflict_audit(df: DataFrame, text: str, label: str) -> DataFrame:
    """What happens to each conflicting text: keep a unique majority label, else drop all copies.

    The map holds one entry per distinct label, never one per row.
    """
    rows = df.filter(F.col(text).isNotNull() & F.col(label).isNotNull())
    return _with_text(_audit(rows, text, label), rows, F.col(text), "text").select("text", "counts", "removed", "action")


def _audit(rows: DataFrame, text: str, label: str) -> DataFrame:
    """(_text, counts, removed, action) by text digest."""
    pairs = rows.groupBy(digest(text).alias("_text"), F.col(label).alias("label")).agg(F.count("*").alias("n"))
    audit = (
        pairs.groupBy("_text")
        .agg(
            F.sort_array(F.collect_list(F.struct("label", "n"))).alias("entries"),
            F.sum("n").alias("total"),
            F.max("n").alias("top"),
        )
        .filter(F.size("entries") > 1)
        .withColumn("modes", F.filter("entries", lambda e: e["n"] == F.col("top")))
    )
    unique = F.size("modes") == 1
    return audit.select(
        "_text",
        F.map_from_entries("entries").alias("counts"),
        F.when(unique, F.col("total") - F.col("top")).otherwise(F.col("total")).alias("removed"),
        F.when(unique, F.concat(F.lit("drop_minority_keep_"), F.col("modes")[0]["label"].cast("string")))
        .otherwise(F.lit("drop_all_tie"))
        .alias("action"),
    )


def resolve_conflicts(df: DataFrame, text: str, label: str) -> DataFrame:
    """Apply the audit. Joins on 32-byte digests of the few texts with dropped labels."""
    dropped = (
        _audit(df.filter(F.col(text).isNotNull() & F.col(label).isNotNull()), text, label)
        .select("_text", "action", F.explode(F.map_keys("counts")).alias("_label"))
        .filter(F.col("action") != F.concat(F.lit("drop_minority_keep_"), F.col("_label").cast("string")))
    )
    named = df.withColumn("_text", digest(text))
    same = (named["_text"] == dropped["_text"]) & (named[label] == dropped["_label"])
    return named.join(dropped, same, "left_anti").drop("_text")


def drop_exact_duplicates(df: DataFrame, text: str, label: str, row_id: str) -> DataFrame:
    """The row with the smallest id per (text, label).

    A min aggregate combines copies on the map side, so a text repeated in a
    third of all rows shuffles one row per task.
    """
    first = df.groupBy(digest(text, label).alias("_pair")).agg(F.min(row_id).alias(row_id)).select(row_id)
    return df.join(first, row_id, "left_semi")


def file_report(df: DataFrame, file: str, label: str, text: str, columns: DataFrame) -> DataFrame:
    """One row per input file: size, its own columns, missing labels, issues, status.

    ``columns`` has a row (file, column) for each column of each file's header.
    """
    own = columns.groupBy("file").agg(
        F.count_distinct("column").alias("n_columns"),
        F.max(F.col("column") == text).alias("has_text"),
        F.max(F.col("column") == label).alias("has_label"),
    )
    missing = F.count_if(F.col(label).isNull()) if label in df.columns else F.lit(None).cast("bigint")
    rows = df.groupBy(F.col(file).alias("file")).agg(F.count("*").alias("n_rows"), missing.alias("n_missing"))
    issues = F.array_compact(
        F.array(*[F.when(~F.col(has), F.lit(f"missing column {c}")) for has, c in (("has_text", text), ("has_label", label))])
    )
    joined = own.join(rows, "file", "full_outer").select(
        "file",
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        F.coalesce("n_columns", F.lit(0)).alias("n_columns"),
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("has_text", "has_label")],
        F.when(F.col("has_label"), F.coalesce("n_missing", F.lit(0))).alias("n_missing"),
    )
    return joined.select(
        "*",
        (F.col("n_missing") > 0).alias("has_missing"),
        F.array_join(issues, "; ").alias("issues"),
        F.when(F.size(issues) > 0, "problem").otherwise("valid").alias("status"),
    )


def file_label_counts(df: DataFrame, file: str, label: str) -> DataFrame:
    """Rows per file and label, null labels included."""
    return df.groupBy(F.col(file).alias("file"), F.col(label).alias("label")).agg(F.count("*").alias("n"))


def strict_validation(df: DataFrame, text: str, label: str) -> DataFrame:
    """Null, blank and duplicate counts on the required columns, one pass, one row per check."""
    rows = df.select(
        *[F.col(c).isNull().alias(f"{k}_null") for c, k in ((text, "t"), (label, "l"))],
        *[(is_blank(F.col(c)) & F.col(c).isNotNull()).alias(f"{k}_blank") for c, k in ((text, "t"), (label, "l"))],
        digest(*df.columns).alias("_row"),
    )
    flags = ["t_null", "l_null", "t_blank", "l_blank"]
    groups = rows.groupBy("_row").agg(F.count("*").alias("n"), *[F.count_if(F.col(f)).alias(f) for f in flags])
    totals = groups.agg(
        *[F.coalesce(F.sum(f), F.lit(0)).alias(f) for f in flags],
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )
    checks = [
        ("null", text, "t_null", "failure"),
        ("null", label, "l_null", "failure"),
        ("blank", text, "t_blank", "failure"),
        ("blank", label, "l_blank", "failure"),
        ("duplicate_rows", "*", "duplicates", "warning"),
    ]
    return totals.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(check).alias("check"),
                        F.lit(column).alias("column"),
                        F.col(value).alias("n"),
                        F.lit(severity).alias("severity"),
                    )
                    for check, column, value, severity in checks
                ]
            )
        ).alias("r")
    ).select("r.*")


def require_valid(df: DataFrame, text: str, label: str) -> None:
    """Raise with every failure that ``strict_validation`` finds; warnings pass."""
    bad = strict_validation(df, text, label).filter("severity = 'failure' AND n > 0").collect()  # four rows at most
    if bad:
        raise ValueError("; ".join(f"{r['n']} {r['check']} values in {r['column']}" for r in bad))


def column_unique_check(df: DataFrame, key: str) -> DataFrame:
    """Blank and repeated values of a key column."""
    value = F.coalesce(strip_ws(F.col(key).cast("string")), F.lit(""))
    found = (
        df.groupBy(digest(value).alias("_text"))
        .agg(F.count("*").alias("n"), F.max(value == "").alias("blank"))
        .filter("blank OR n > 1")
    )
    return _with_text(found, df, value, "value").select(
        F.when(F.col("blank"), "blank").otherwise("duplicate").alias("violation"), "value", "n"
    )


def allowed_values_check(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    value = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return df.filter(~value.isin(*allowed)).groupBy(value.alias("value")).agg(F.count("*").alias("n"))


def not_constant_check(df: DataFrame, column: str, value: object) -> DataFrame:
    """One row; ``failed`` when the table has rows and all hold ``value``."""
    same = F.col(column).eqNullSafe(F.lit(value))
    return df.agg(
        F.lit(column).alias("column"),
        ((F.count("*") > 0) & F.coalesce(F.every(same), F.lit(False))).alias("failed"),
    )


def non_empty_check(df: DataFrame, file: str, expected: DataFrame) -> DataFrame:
    """Expected files that contribute no row."""
    present = df.select(F.col(file).alias("file")).distinct()
    return expected.select(F.col(expected.columns[0]).alias("file")).distinct().join(present, "file", "left_anti")


def required_columns_check(columns: DataFrame, required: Sequence[str]) -> DataFrame:
    """Each file with each required column its header lacks; ``columns`` has rows (file, column)."""
    there = columns.groupBy("file").agg(F.collect_set(F.when(F.col("column").isin(*required), F.col("column"))).alias("there"))
    needed = F.array(*[F.lit(c) for c in required])
    return there.select("file", F.explode(F.array_except(needed, "there")).alias("missing_column"))


def blank_entry_check(df: DataFrame, row_id: str, column: str) -> DataFrame:
    """Rows whose ARRAY or MAP is empty or holds a blank item, key or value."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.MapType):
        entries = F.map_entries(column)
        blank = F.filter(entries, lambda e: is_blank(e["key"]) | is_blank(e["value"]))
    else:
        entries = F.col(column)
        blank = F.filter(entries, is_blank)
    return (
        df.select(
            F.col(row_id).alias("row_id"),
            F.coalesce(F.size(entries), F.lit(0)).cast("bigint").alias("n_entries"),
            F.coalesce(F.size(blank), F.lit(0)).cast("bigint").alias("n_blank"),
        )
        .filter("n_entries <= 0 OR n_blank > 0")
    )


def text_marker_check(
    df: DataFrame, row_id: str, text: str, markers: Sequence[str] = config.WORK_MARKERS
) -> DataFrame:
    """Each row with each work marker its text contains."""
    found = F.filter(F.array(*[F.lit(m) for m in markers]), lambda m: F.contains(F.col(text), m))
    return df.select(F.col(row_id).alias("row_id"), F.explode(found).alias("marker"))
