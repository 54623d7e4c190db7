"""Word lists, slang, look-alike digits, emoticons and emoji scores as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill import config
from reviewmill.functions.symbols import repair_mojibake, without_selector
from reviewmill.functions.text import is_blank, strip_ws
from reviewmill.operators.stemming import RULE_SCHEMA, checked_rules

#: Lexicons up to this size are maps in expressions.
MAP_ROWS = 1_000


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """(word): trimmed, lower-cased, distinct; blank lines and ``#`` comments skipped."""
    word = strip_ws(F.col("value"))
    return (
        spark.read.text(path)
        .filter(~is_blank(F.col("value")) & ~F.startswith(word, F.lit("#")))
        .select(F.lower(word).alias("word"))
        .distinct()
    )


def _read_object(spark: SparkSession, path: str, field: str, kind: str) -> DataFrame:
    return spark.read.schema(f"{field} {kind}").option("multiLine", True).json(path)


def read_slang(spark: SparkSession, path: str) -> DataFrame:
    """(token, target) from ``{"slang": {…}}``; blank keys or values are an error."""
    pairs = _read_object(spark, path, "slang", "map<string,string>").select(F.explode("slang").alias("token", "target"))
    if not pairs.filter(is_blank(F.col("token")) | is_blank(F.col("target"))).isEmpty():
        raise ValueError(f"{path} holds a blank slang key or value")
    return pairs.select(F.lower("token").alias("token"), F.lower("target").alias("target"))


def read_leet(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, letters ARRAY) from ``{"substitutions": {…}}``."""
    rules = _read_object(spark, path, "substitutions", "map<string,array<string>>").select(
        F.explode("substitutions").alias("symbol", "letters")
    )
    if not rules.filter("letters IS NULL OR size(letters) = 0").isEmpty():
        raise ValueError(f"{path} holds a rule without letters")
    return rules.select(
        "symbol",
        F.transform(F.filter("letters", lambda x: ~is_blank(x)), F.lower).alias("letters"),
    )


def read_extra_words(spark: SparkSession, path: str) -> DataFrame:
    """(word) from ``{"words": […]}``."""
    words = _read_object(spark, path, "words", "array<string>").select(F.explode("words").alias("word"))
    return words.filter(~is_blank(F.col("word"))).select(F.lower(strip_ws(F.col("word"))).alias("word")).distinct()


def read_emoticons(spark: SparkSession, path: str) -> DataFrame:
    """(emoticon, sentiment) from CSV; blanks dropped, the last of repeated emoticons wins."""
    raw = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    rows = raw.select(
        strip_ws(F.col("emoticon")).alias("emoticon"),
        strip_ws(F.col("sentiment")).alias("sentiment"),
        F.monotonically_increasing_id().alias("line"),
    ).filter(~is_blank(F.col("emoticon")) & ~is_blank(F.col("sentiment")))
    return rows.groupBy("emoticon").agg(F.max_by("sentiment", "line").alias("sentiment"))


def read_affix_rules(spark: SparkSession, path: str) -> DataFrame:
    """Affix rules from CSV with a header: place, prefix, suffix, head, tail, least; see ``operators/stemming.py``."""
    return checked_rules(spark.read.schema(RULE_SCHEMA).option("header", True).option("enforceSchema", False).csv(path))


def lexicon_map(df: DataFrame, key: str, value: str) -> dict[str, str] | DataFrame:
    """A lexicon as a map for expressions if it has at most ``MAP_ROWS`` rows, else the table as (key, value).

    Cleaning takes both forms and gives the same result with either.
    """
    rows = df.select(key, value).limit(MAP_ROWS + 1).collect()
    return {r[0]: r[1] for r in rows} if len(rows) <= MAP_ROWS else df.select(key, value)


def build_dictionary(words: DataFrame, extra: DataFrame) -> DataFrame:
    """Distinct lower-cased words of both tables."""
    both = words.select("word").union(extra.select("word"))
    return both.filter(~is_blank(F.col("word"))).select(F.lower(strip_ws(F.col("word"))).alias("word")).distinct()


def build_stopwords(stop: DataFrame, negations: DataFrame, extra: DataFrame) -> DataFrame:
    """Stopwords that are neither negations nor additional words."""
    words = stop.select(F.lower("word").alias("word")).distinct()
    kept = negations.select("word").union(extra.select(F.lower("word").alias("word")))
    return words.join(kept, "word", "left_anti")


def sentiment_token(score: Column, positive: float = 0.05, negative: float = -0.05) -> Column:
    return (
        F.when(score >= positive, F.lit(config.POSITIVE))
        .when(score <= negative, F.lit(config.NEGATIVE))
        .otherwise(F.lit(config.NEUTRAL))
    )


def score_emojis(
    df: DataFrame,
    emoji: str = "Emoji",
    score_columns: Sequence[str] = ("Sentiment score", "sentiment_score", "score"),
    positive: float = 0.05,
    negative: float = -0.05,
) -> DataFrame:
    """(emoji, score, token), once with and once without variation selectors.

    The score is the first given score column, else (Positive - Negative) / Occurrences.
    A later row replaces an earlier one for the same emoji.
    """
    def count(name: str, default: int) -> Column:
        return F.col(f"`{name}`").try_cast("double") if name in df.columns else F.lit(float(default))

    given = [F.col(f"`{c}`").try_cast("double") for c in score_columns if c in df.columns]
    computed = (count("Positive", 0) - count("Negative", 0)) / F.greatest(count("Occurrences", 1), F.lit(1.0))
    rows = df.select(
        repair_mojibake(strip_ws(F.col(emoji))).alias("emoji"),
        F.coalesce(*given, computed).alias("score"),
        F.monotonically_increasing_id().alias("line"),
    ).filter("emoji <> ''")
    keys = rows.select(F.explode(F.array_distinct(F.array("emoji", without_selector(F.col("emoji"))))).alias("emoji"), "score", "line")
    return (
        keys.groupBy("emoji")
        .agg(F.max_by("score", "line").alias("score"))
        .select("emoji", "score", sentiment_token(F.col("score"), positive, negative).alias("token"))
    )
