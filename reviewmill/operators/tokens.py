"""Token tables: build, filter, join negations, rebuild text, count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill import config
from reviewmill.functions.symbols import count_emojis, count_emoticons
from reviewmill.functions.text import WS, tokens
from reviewmill.scale import HOT_KEYS, by_repeats, hot_cold_join, materialize


def tokenize(df: DataFrame, row_id: str, text: str, listed: bool = False) -> DataFrame:
    """(id, pos, token) for each ``[a-z0-9_]+`` run of the lower-cased text; ``listed``: (id, items), the same in one row per id.

    The outer explode keeps the optimiser from matching twice just to drop texts without tokens.
    Rows that share an id are one document; only such rows are grouped for the lists.
    """
    if listed:
        single, several = by_repeats(df.select(F.col(row_id).alias("id"), F.col(text).alias("text")), "id")
        items = F.transform(tokens(F.col("text")), lambda token, i: F.struct(i.alias("pos"), token.alias("token")))
        lists = single.select("id", items.alias("items")).filter("size(items) > 0")
        return lists if several is None else lists.unionByName(token_lists(tokenize(several, "id", "text")))
    runs = df.select(F.col(row_id).alias("id"), F.posexplode_outer(tokens(F.col(text))).alias("pos", "token"))
    return runs.filter("token IS NOT NULL")


def token_lists(token_table: DataFrame) -> DataFrame:
    """(id, items): the (pos, token) of each id in order. A group is one document, which was one row before it was tokenised."""
    return token_table.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("pos", "token"))).alias("items"))


def token_frequencies(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """(token, df, n): the ids and the places with each token. No (id, token) is shuffled where ids don't repeat."""
    single, several = by_repeats(df.select(F.col(row_id).alias("id"), F.col(text).alias("text")), "id")
    none, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    words = single.select(tokens(F.col("text")).alias("words"))
    places = F.transform("words", lambda t: F.struct(t.alias("token"), none.alias("df"), one.alias("n")))
    firsts = F.transform(F.array_distinct("words"), lambda t: F.struct(t.alias("token"), one.alias("df"), none.alias("n")))
    marks = words.select(F.inline_outer(F.concat(places, firsts))).filter("token IS NOT NULL")
    if several is not None:
        per = tokenize(several, "id", "text").groupBy("id", "token").agg(F.count("*").alias("n"))
        marks = marks.unionByName(per.select("token", one.alias("df"), "n"))
    return marks.groupBy("token").agg(F.sum("df").alias("df"), F.sum("n").alias("n"))


def is_protected(token: Column, exclusions: Sequence[str], negations: Sequence[str] = ()) -> Column:
    return token.isin(*exclusions, *negations) | F.contains(token, F.lit("_"))


def filter_tokens(
    token_table: DataFrame,
    stopwords: DataFrame,
    exclusions: Sequence[str] = config.SPECIAL_TOKENS,
    min_length: int = 2,
) -> DataFrame:
    """Drop short tokens and stopwords, but never protected tokens. Each distinct token is decided once."""
    counts = materialize(token_table.groupBy("token").agg(F.count("*").alias("n")))
    kept = materialize(kept_words(counts, stopwords, exclusions, min_length).select("token"))
    return hot_cold_join(token_table, kept, "token", counts, limit=HOT_KEYS)


def kept_words(
    words: DataFrame, stopwords: DataFrame, exclusions: Sequence[str] = config.SPECIAL_TOKENS, min_length: int = 2
) -> DataFrame:
    """The rows of a table of distinct tokens that are protected, or long enough and no stopword."""
    protected = is_protected(F.col("token"), exclusions)
    stops = stopwords.select(F.col(stopwords.columns[0]).alias("_word"), F.lit(True).alias("_stop")).distinct()
    marked = words.join(stops, F.col("token") == F.col("_word"), "left")
    return marked.filter(protected | ((F.length("token") >= min_length) & F.col("_stop").isNull())).drop("_word", "_stop")


def joined_negations(items: Column) -> Column:
    """Merge negation + next token inside one document's ordered token structs.

    Items carry ``token``, ``stem``, ``is_negation`` and ``is_exclusion``. The
    token after a merged negation is never a negation, so pairs cannot chain.
    """

    def joins(left: Column, right: Column) -> Column:
        return left["is_negation"] & ~right["is_negation"] & ~right["is_exclusion"]

    def merge(item: Column, i: Column) -> Column:
        after, before = F.get(items, i + 1), F.get(items, i - 1)
        return (
            F.when(F.coalesce(joins(item, after), F.lit(False)), F.concat(item["token"], F.lit("_"), after["token"]))
            .when(F.coalesce(joins(before, item), F.lit(False)), F.lit(None).cast("string"))
            .otherwise(item["stem"])
        )

    return F.transform(items, merge)


def combine_negations(
    token_table: DataFrame, negations: Sequence[str], exclusions: Sequence[str] = config.SPECIAL_TOKENS
) -> DataFrame:
    """(id, pos, token) with each negation glued to the token that follows it.

    A table that ``tokenize`` has listed needs no grouping; flags are only set within a document.
    """
    lists = token_table if "items" in token_table.columns else token_lists(token_table)
    flagged = F.transform(
        "items",
        lambda x: F.struct(
            x["pos"].alias("pos"),
            x["token"].alias("token"),
            x["token"].alias("stem"),
            x["token"].isin(*negations).alias("is_negation"),
            x["token"].isin(*exclusions).alias("is_exclusion"),
        ),
    )
    documents = lists.select("id", flagged.alias("items")).withColumn("merged", joined_negations(F.col("items")))
    pairs = F.arrays_zip(F.transform("items", lambda x: x["pos"]).alias("pos"), F.col("merged").alias("token"))
    return (
        documents.select("id", F.inline(pairs).alias("pos", "token"))
        .filter("token IS NOT NULL")
    )


def rebuild_text(token_table: DataFrame) -> DataFrame:
    """(id, clean_text): each document's tokens in order, joined by spaces."""
    ordered = F.sort_array(F.collect_list(F.struct("pos", "token")))
    return token_table.groupBy("id").agg(
        F.array_join(F.transform(ordered, lambda x: x["token"]), " ").alias("clean_text")
    )


def count_tokens(df: DataFrame, text: str) -> DataFrame:
    """Total and distinct whitespace tokens."""
    words = df.select(F.explode_outer(F.regexp_extract_all(text, F.lit(f"[^{WS}]+"), F.lit(0))).alias("token"))
    counts = words.filter("token IS NOT NULL").groupBy("token").agg(F.count("*").alias("n"))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("total"), F.count("*").alias("unique")
    )


def emoji_emoticon_counts(df: DataFrame, text: str, emoticons: dict[str, str], emoji_keys: Sequence[str] = ()) -> DataFrame:
    """How many emoji and emoticons a replacement pass would convert."""
    zero = F.lit(0).cast("bigint")
    return df.agg(
        F.coalesce(F.sum(count_emojis(F.col(text), emoji_keys)), zero).alias("n_emoji"),
        F.coalesce(F.sum(count_emoticons(F.col(text), emoticons)), zero).alias("n_emoticon"),
    )
