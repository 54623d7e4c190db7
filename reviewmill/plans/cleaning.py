"""Raw text to cleaned text, with one decision per distinct token."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.config import ReviewConfig
from reviewmill.functions.symbols import convert_emojis, convert_emoticons, repair_mojibake
from reviewmill.functions.text import clean_structure, collapse_ws, remove_web_noise, tokens
from reviewmill.operators import symbols
from reviewmill.operators.tokens import joined_negations
from reviewmill.operators.vocabulary import Lexicons, token_counts
from reviewmill.plans.decisions import decide_remembered, decide_tokens
from reviewmill.scale import HOT_KEYS, hot_cold_join, materialize


def structured_text(df: DataFrame, row_id: str, text: str, lexicons: Lexicons) -> DataFrame:
    """(id, text): repaired, web noise stripped, emoticons and emoji as tokens, symbols stripped.

    Emoticon and emoji lexicons are maps, which go into the expression, or tables of any size.
    """
    rows = df.select(F.col(row_id).alias("id"), remove_web_noise(repair_mojibake(F.col(text))).alias("text"))
    if isinstance(lexicons.emoticons, DataFrame):
        rows = symbols.convert_emoticons(rows, "id", "text", lexicons.emoticons, *lexicons.emoticons.columns[:2])
    else:
        rows = rows.withColumn("text", convert_emoticons(F.col("text"), lexicons.emoticons))
    if isinstance(lexicons.emojis, DataFrame) or isinstance(lexicons.emoji_names, DataFrame):
        tables = [_as_table(df, lexicons.emojis, "token"), _as_table(df, lexicons.emoji_names, "name")]
        rows = symbols.convert_emojis(rows, "id", "text", *tables)
    else:
        rows = rows.withColumn("text", convert_emojis(F.col("text"), lexicons.emojis, lexicons.emoji_names))
    return rows.withColumn("text", clean_structure(F.col("text")))


def _as_table(df: DataFrame, lexicon: Mapping[str, str] | DataFrame, value: str) -> DataFrame:
    if isinstance(lexicon, DataFrame):
        return lexicon.toDF("emoji", value)
    return df.sparkSession.createDataFrame(list(lexicon.items()), f"emoji string, {value} string")


def clean_text(
    df: DataFrame,
    row_id: str,
    text: str,
    lexicons: Lexicons,
    cfg: ReviewConfig = ReviewConfig(),
    fuzzy: bool = True,
    memory: str | None = None,
    batch: str | None = None,
) -> DataFrame:
    """(id, clean_text) for every row; texts without tokens become empty strings.

    With ``memory``, a folder, token decisions are kept there and those of earlier
    batches are used again (``plans/decisions.py``); the result is the same.
    """
    listed = materialize(
        structured_text(df, row_id, text, lexicons).select("id", tokens(F.col("text")).alias("tokens"))
    )
    occurrences = listed.select("id", F.posexplode("tokens").alias("pos", "token"))
    counts = materialize(token_counts(occurrences))
    if memory is None:
        decided = decide_tokens(counts, lexicons, cfg, fuzzy)
    else:
        decided = decide_remembered(counts, lexicons, memory, cfg, fuzzy, batch).drop("fresh")
    decisions = materialize(decided.filter("kept").select("token", "normalized", "stem"))
    joined = hot_cold_join(occurrences, decisions, "token", counts, limit=HOT_KEYS)
    # What a token's word decides is added after the exchange, stems are moved where they differ from it.
    word, stem = F.col("normalized"), F.when(F.col("stem") != F.col("normalized"), F.col("stem"))
    moved = F.sort_array(F.collect_list(F.struct("pos", word.alias("token"), stem.alias("stem"))))
    items = F.transform(
        "items",
        lambda x: F.struct(
            x["token"].alias("token"),
            F.coalesce(x["stem"], x["token"]).alias("stem"),
            x["token"].isin(*lexicons.negations).alias("is_negation"),
            x["token"].isin(*lexicons.exclusions).alias("is_exclusion"),
        ),
    )
    # One group is one document, which was one row before.
    merged = joined.groupBy("id").agg(moved.alias("items")).select("id", items.alias("items"))
    merged = merged.select("id", joined_negations(F.col("items")).alias("words"))
    texts = merged.select("id", collapse_ws(F.array_join("words", " ")).alias("clean_text"))
    return listed.select("id").join(texts, "id", "left").select("id", F.coalesce("clean_text", F.lit("")).alias("clean_text"))
