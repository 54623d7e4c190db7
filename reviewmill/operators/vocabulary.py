"""Decide each distinct token once; the first matching rule wins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, fields
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill import config
from reviewmill.config import ReviewConfig
from reviewmill.functions.candidates import REPEATED, reading_candidates, repeat_candidates
from reviewmill.operators.fuzzy import lookalike_matches, rank_candidates
from reviewmill.operators.stemming import stems_by_rules
from reviewmill.operators.tokens import is_protected
from reviewmill.scale import deal
from reviewmill.sources.models import table_fingerprint

# Prefixes and suffixes a form may lose, longest first.
AFFIXES = (r"^(meng|mem|men|me|ber|ter|di|ke|se|pe)", r"(nya|kan|an|i|lah|kah|ku|mu)$")


@dataclass(frozen=True)
class Lexicons:
    """Word tables (any size) used by cleaning; emoticons and emoji are tables, too, or small maps."""

    dictionary: DataFrame  # (word)
    stopwords: DataFrame  # (word)
    slang: DataFrame  # (token, target)
    roots: DataFrame | None = None  # (token, root)
    negations: Sequence[str] = config.NEGATIONS
    kept_words: Sequence[str] = ()  # like negations, no stopwords whatever the table says
    exclusions: Sequence[str] = config.SPECIAL_TOKENS
    leet: dict[str, Sequence[str]] = field(default_factory=lambda: dict(config.LEET))
    emoticons: dict[str, str] | DataFrame = field(default_factory=dict)  # (emoticon, token)
    emojis: dict[str, str] | DataFrame = field(default_factory=dict)  # (emoji, token)
    emoji_names: dict[str, str] | DataFrame = field(default_factory=dict)  # (emoji, name)
    affixes: Sequence[str] | DataFrame = AFFIXES  # a prefix and a suffix pattern, or a table of rules


def resource_fingerprints(lexicons: Lexicons, cfg: ReviewConfig = ReviewConfig()) -> DataFrame:
    """(name, sha) of everything that decides how texts are cleaned and terms are weighed."""
    tables = {f.name: getattr(lexicons, f.name) for f in fields(lexicons) if isinstance(getattr(lexicons, f.name), DataFrame)}
    small = {f.name: repr(getattr(lexicons, f.name)) for f in fields(lexicons) if f.name not in tables}
    spark = lexicons.dictionary.sparkSession
    settings = spark.createDataFrame([(f"{k}={v}",) for k, v in sorted({**small, "config": repr(cfg)}.items())], "setting string")
    parts = [table_fingerprint(t, name) for name, t in sorted(tables.items())]
    return reduce(DataFrame.unionByName, [*parts, table_fingerprint(settings, "settings")])


def token_counts(token_table: DataFrame) -> DataFrame:
    """(token, n), combined on the map side."""
    return token_table.filter("token IS NOT NULL").groupBy("token").agg(F.count("*").alias("n"))


def protected_tokens(vocab: DataFrame, exclusions: Sequence[str], negations: Sequence[str]) -> DataFrame:
    return vocab.filter(is_protected(F.col("token"), exclusions, negations)).select(
        "token", F.col("token").alias("normalized"), F.lit("protected").alias("source")
    )


def slang_lookup(vocab: DataFrame, slang: DataFrame) -> DataFrame:
    return vocab.join(slang, "token").select("token", F.col("target").alias("normalized"), F.lit("slang").alias("source"))


def dictionary_lookup(vocab: DataFrame, dictionary: DataFrame) -> DataFrame:
    return vocab.join(dictionary.select(F.col("word").alias("token")), "token", "left_semi").select(
        "token", F.col("token").alias("normalized"), F.lit("dictionary").alias("source")
    )


REPEAT, LEET, TYPO = 0, 1, 2
RULE_NAMES = {REPEAT: "repeated", LEET: "leet", TYPO: "typo"}


def has_symbols(token: Column) -> Column:
    """Digits among letters."""
    return token.rlike("[0-9]") & token.rlike("[a-z]")


def spelling_candidates(residue: DataFrame, lexicons: Lexicons) -> DataFrame:
    """(token, rule, candidate): the spellings each rule would look up, at most three for a token and rule."""
    token = F.col("token")

    def entry(rule: int, applies: Column, candidates: Column) -> Column:
        return F.when(applies, F.struct(F.lit(rule).alias("rule"), candidates.alias("candidates")))

    entries = F.array_compact(
        F.array(
            entry(REPEAT, token.rlike(REPEATED), repeat_candidates(token)),
            entry(LEET, has_symbols(token), reading_candidates(token, lexicons.leet)),
            entry(TYPO, token.rlike("^[a-z]{4,}$"), F.array(token)),
        )
    )
    return (
        deal(residue, "token")
        .select("token", F.inline_outer(entries))
        .select("token", "rule", F.explode_outer("candidates").alias("candidate"))
        .filter("candidate <> ''")
    )


def normalize_vocab(
    vocab: DataFrame, lexicons: Lexicons, cfg: ReviewConfig = ReviewConfig(), fuzzy: bool = True
) -> DataFrame:
    """(token, normalized, source) for every token of ``vocab``.

    Lookups come first, so the spelling rules only run on the residue; the
    first rule with a result wins. ``fuzzy=False`` stops after exact candidates.
    """
    dictionary = lexicons.dictionary.select("word")
    token = F.col("token")
    looked_up = (
        vocab.select("token")
        .join(lexicons.slang.select("token", "target"), "token", "left")
        .join(dictionary.select(F.col("word").alias("token"), F.lit(True).alias("known")), "token", "left")
        .withColumn(
            "source",
            F.when(is_protected(token, lexicons.exclusions, lexicons.negations), "protected")
            .when(F.col("target").isNotNull(), "slang")
            .when(F.col("known"), "dictionary"),
        )
        .withColumn("normalized", F.when(F.col("source") == "slang", F.col("target")).otherwise(token))
    )
    rules = {
        REPEAT: (cfg.candidate_length_ratio, cfg.repeat_threshold),
        LEET: (cfg.candidate_length_ratio, cfg.leet_threshold),
        TYPO: (cfg.typo_length_ratio, cfg.typo_threshold),
    }
    residue = looked_up.filter("source IS NULL").select("token")
    candidates = spelling_candidates(residue, lexicons)
    alike = lookalike_matches(residue.filter(has_symbols(token)), dictionary, lexicons.leet)
    exact = alike.withColumn("rule", F.lit(LEET))
    ranked = rank_candidates(candidates, dictionary, rules, fuzzy, exact, lexicons.leet)
    near = F.abs(F.length("word") - F.length("token")) <= 1
    usable = ranked.filter(
        F.when(F.col("rule") == TYPO, (F.col("place") <= cfg.typo_rank) & near).otherwise(F.col("place") == 1)
    )
    found = usable.groupBy("token").agg(F.min(F.struct("rule", "place", "word")).alias("best")).select("token", "best.*")
    names = F.create_map(*[F.lit(x) for pair in RULE_NAMES.items() for x in pair])
    return looked_up.join(found.hint("merge"), "token", "left").select(
        "token",
        F.coalesce("word", "normalized").alias("normalized"),
        F.coalesce("source", names[F.col("rule")], F.lit("not_found")).alias("source"),
    )


def stem_tokens(
    vocab: DataFrame,
    roots: DataFrame | None,
    dictionary: DataFrame,
    exclusions: Sequence[str] = config.SPECIAL_TOKENS,
    affixes: Sequence[str] | DataFrame = AFFIXES,
) -> DataFrame:
    """(token, stem): protected and dictionary words stay; others use the root table,
    else the longest affix-stripped form that is a dictionary word, else stay.

    ``affixes`` is one prefix and one suffix pattern, each cut once, or a table of
    rules (``operators/stemming.py``), which are applied until a dictionary word or
    an entry of the root table is reached. What grows with ``vocab`` is merged: Spark
    would broadcast it by the size of its compressed files, a tenth of what it takes.
    """
    token = F.col("token")
    words = dictionary.select("word")
    vocab = vocab.select("token")
    free = vocab.filter(~is_protected(token, exclusions)).join(words.select(F.col("word").alias("token")), "token", "left_anti")
    if isinstance(affixes, DataFrame):
        known = words.select("word", F.col("word").alias("stem"))
        if roots is not None:
            listed = roots.select(F.col("token").alias("word"), F.col("root").alias("stem"))
            known = listed.unionByName(known.join(listed.select("word"), "word", "left_anti"))
        found = stems_by_rules(free, affixes, known).select("token", "stem")
        return vocab.join(found.hint("merge"), "token", "left").select("token", F.coalesce("stem", "token").alias("stem"))
    prefix, suffix = affixes
    bare = F.regexp_replace(token, prefix, "")
    forms = F.array(F.regexp_replace(token, suffix, ""), bare, F.regexp_replace(bare, suffix, ""))
    stripped = (
        free.select("token", F.explode(F.array_distinct(forms)).alias("word"))
        .filter("word <> token")
        .join(words, "word")
        .groupBy("token")
        .agg(F.min(F.struct((-F.length("word")).alias("size"), "word")).alias("best"))
        .select("token", F.col("best.word").alias("stripped"))
    )
    result = free.join(stripped.hint("merge"), "token", "left")
    if roots is None:
        stems = result.select("token", F.col("stripped").alias("stem"))
    else:
        stems = result.join(roots.select("token", "root"), "token", "left").select(
            "token", F.coalesce("root", "stripped").alias("stem")
        )
    return vocab.join(stems.filter("stem IS NOT NULL").hint("merge"), "token", "left").select(
        "token", F.coalesce("stem", "token").alias("stem")
    )


def normalization_stats(counts: DataFrame, decisions: DataFrame) -> DataFrame:
    """Tokens checked, occurrences per rule, and how often a token was seen again or first.

    Decisions that name the tokens new to this run (``fresh``) count all others as seen again.
    """
    joined = counts.join(decisions, "token")
    rules = {
        "typo_fixed": "typo", "typo_not_found": "not_found", "leet_fixed": "leet",
        "repeated_fixed": "repeated", "slang_normalized": "slang",
    }
    zero = F.lit(0).cast("bigint")
    first = F.col("fresh").cast("bigint") if "fresh" in joined.columns else F.lit(1).cast("bigint")
    totals = joined.agg(
        F.coalesce(F.sum("n"), zero).alias("tokens_checked"),
        *[F.coalesce(F.sum(F.when(F.col("source") == rule, F.col("n"))), zero).alias(stat) for stat, rule in rules.items()],
        F.coalesce(F.sum(F.col("n") - first), zero).alias("cache_hit"),
        F.coalesce(F.sum(first), zero).alias("cache_miss"),
    )
    return totals.unpivot([], totals.columns, "stat", "n")
