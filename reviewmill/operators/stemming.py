"""Stems by a table of affix rules, applied again and again until a known word is reached.

A rule is a row (place, prefix, suffix, head, tail, least). It fits a form that
starts with ``prefix``, ends with ``suffix`` and has at least ``least`` characters
between them; those stay, between ``head`` and ``tail``. So a rule can cut a
prefix, a suffix, or both at once, and can put back what an affix has changed:
``("men", "", "t", "")`` turns "menulis" into "tulis".
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.scale import deal, materialize

RULE_SCHEMA = "place int, prefix string, suffix string, head string, tail string, least int"
TEXTS = ("prefix", "suffix", "head", "tail")


def affix_rules(spark: SparkSession, rules: list[tuple]) -> DataFrame:
    """A table of rules from (prefix, suffix, head, tail, least) in order of preference."""
    return checked_rules(spark.createDataFrame([(i, *r) for i, r in enumerate(rules)], RULE_SCHEMA))


def checked_rules(rules: DataFrame) -> DataFrame:
    """``rules`` with missing parts as empty ones; refused if a rule does not shorten the forms that it fits.

    Rules that shorten end after as many steps as a token has characters.
    """
    part = {c: F.coalesce(F.col(c), F.lit("")).alias(c) for c in TEXTS}
    filled = rules.select(
        F.col("place").cast("int"), *part.values(), F.greatest(F.coalesce(F.col("least").cast("int"), F.lit(1)), F.lit(1)).alias("least")
    )
    longer = filled.filter(F.length("head") + F.length("tail") >= F.length("prefix") + F.length("suffix")).first()
    if longer:
        raise ValueError(f"an affix rule has to shorten its forms: {longer.asDict()}")
    return filled


def derive(forms: DataFrame, rules: DataFrame, sizes: list[tuple[int, int]]) -> DataFrame:
    """(form, place, child): what each rule that fits makes of ``forms``.

    Rules are found by an equi-join on both affixes: a form is taken apart once
    for each pair of affix lengths in ``sizes``, all that occur in the rules.
    """
    length = F.length("form")
    cuts = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(s).alias("s")) for p, s in sizes])
    fits = F.filter(cuts, lambda c: c["p"] + c["s"] < length)
    parts = forms.select("form", F.inline(fits)).select(
        "form",
        F.expr("left(form, p)").alias("prefix"),
        F.expr("right(form, s)").alias("suffix"),
        F.expr("substring(form, p + 1, length(form) - p - s)").alias("middle"),
    )
    return (
        parts.join(rules, ["prefix", "suffix"])
        .filter(F.length("middle") >= F.col("least"))
        .select("form", "place", F.concat("head", "middle", "tail").alias("child"))
    )


def stems_by_rules(tokens: DataFrame, rules: DataFrame, known: DataFrame) -> DataFrame:
    """(token, stem, steps) for every distinct ``token`` from which the rules lead to a known word.

    ``known`` is (word, stem): dictionary words are their own stems, others
    may be listed with a root. The fewest steps win, then the rules of the lowest
    places, the first step first; two rules of one place are told apart by what
    they make. Tokens that lead nowhere are left out, known ones have 0 steps.

    All tokens share one graph of forms: a form from which steps lead is taken apart
    once, however many tokens lead to it, one level of steps a round, and known forms
    are not taken apart any further. Stems then come back along the steps, so
    that a form is decided in the round of its fewest steps. Every round is made
    of equi-joins on stored tables; after the first one it reads steps only, not the
    tokens again, most of which no rule fits. Null tokens are ignored, repeated tokens
    and rules change nothing, an empty table of tokens, rules or words is fine.
    """
    rules = materialize(checked_rules(rules).distinct())
    sizes = [tuple(r) for r in rules.select(F.length("prefix"), F.length("suffix")).distinct().collect()]  # pairs of lengths
    words = known.filter("word IS NOT NULL").groupBy("word").agg(F.min("stem").alias("stem"))
    level = materialize(tokens.filter("token IS NOT NULL").select(F.col("token").alias("form")).distinct())
    first, steps, done = level, [], []
    while not level.isEmpty():
        looked = materialize(level.join(words, level["form"] == words["word"], "left").select("form", "stem"))
        done.append(looked.filter("stem IS NOT NULL"))
        if not sizes:
            break
        made = materialize(derive(deal(looked.filter("stem IS NULL").select("form"), "form"), rules, sizes))
        steps.append(made)
        apart = reduce(DataFrame.union, steps).select("form")
        level = materialize(made.select(F.col("child").alias("form")).distinct().join(apart, "form", "left_anti"))
    # A known form is met in every level that leads to it.
    settled = [materialize(reduce(DataFrame.union, done).distinct()).withColumn("steps", F.lit(0))] if done else []
    if not steps:
        return _of_tokens(first, settled)
    edges = reduce(DataFrame.union, steps)
    last = settled[0]
    while not last.isEmpty():
        before = reduce(DataFrame.union, settled).select("form")
        reached = edges.join(last.select(F.col("form").alias("child"), "stem", "steps"), "child").join(before, "form", "left_anti")
        best = F.min(F.struct("place", "child", "stem", "steps")).alias("best")
        last = materialize(
            reached.groupBy("form").agg(best).select("form", F.col("best.stem").alias("stem"), (F.col("best.steps") + 1).alias("steps"))
        )
        settled.append(last)
    return _of_tokens(first, settled)


def _of_tokens(tokens: DataFrame, settled: list[DataFrame]) -> DataFrame:
    if not settled:
        return tokens.select(F.col("form").alias("token"), F.col("form").alias("stem"), F.lit(0).alias("steps"))  # no rows
    # Forms and tokens are distinct. A semi-join would be pushed below the union and read the tokens once for each round.
    return tokens.join(reduce(DataFrame.union, settled), "form").withColumnRenamed("form", "token")
