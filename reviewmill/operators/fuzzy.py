"""Similar dictionary words without comparing all pairs.

A token and a word may match only when they share the first character, their
lengths are close and their insert/delete distance is small. For a pair of
lengths that distance fixes how many characters to delete on each side, so a
match means an equal remainder: one equi-join on the remainder finds exactly
the matching pairs. Two other kinds of join key cover the rest:

* where more than two characters would go on one side (long words), a word is
  cut into distance + 1 parts; one part must survive unchanged, and pairs that
  share a part are then scored;
* where one word is at least half as long again as the other, a window of it may
  match: if it has to hold the other word, its substrings of that length are the
  keys; if some distance is allowed, the shorter word is cut into distance + 1
  parts, and one part must stand unchanged somewhere in the longer word.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill import config
from reviewmill.functions.candidates import (
    CONTAINED_SCORE,
    FAR_SCORE,
    allowed_distance,
    common_subsequence,
    deletions,
    fuzzy_score,
    length_gap,
    lookalike_key,
    lookalike_pattern,
    open_class,
    open_letters,
    open_score,
    substrings,
    token_parts,
    window_distance,
    word_parts,
)
from reviewmill.scale import deal, materialize

MAX_DELETIONS = 2
BY_DELETION, BY_PART, BY_CONTAINMENT, BY_WINDOW = 0, 1, 2, 3
# Per rule: how far lengths may differ (a share of the token) and the lowest score.
Rules = Mapping[int, tuple[float, float]]
Leet = Mapping[str, Sequence[str]]


def _setting(rules: Rules, place: int) -> str:
    cases = " ".join(f"when {rule} then {float(values[place])}D" for rule, values in sorted(rules.items()))
    return f"case rule {cases} end"


def _routes(df: DataFrame) -> DataFrame:
    """(l1, l2) pairs a match can have: route, distance and deletions per side."""
    sized = df.filter((F.col("l1") > 0) & (F.col("l2") > 0)).filter(
        F.expr("abs(l1 - l2)") <= length_gap("l1", "ratio")
    )
    cut = sized.withColumn("distance", allowed_distance("l1", "l2", "threshold")).selectExpr(
        "*", "int((distance + l1 - l2) / 2) as token_cut", "int((distance - l1 + l2) / 2) as word_cut",
        f"{window_distance('l1', 'l2', 'threshold')} as inside",
    )
    return cut.selectExpr(
        "*",
        f"""explode(array_compact(array(
            case when distance >= abs(l1 - l2) then
                if(greatest(token_cut, word_cut) <= {MAX_DELETIONS}, {BY_DELETION}, {BY_PART}) end,
            case when inside = 0 then {BY_CONTAINMENT} when inside > 0 then {BY_WINDOW} end))) as route""",
    )


def _blocks(dictionary: DataFrame) -> DataFrame:
    """The first letters and lengths that words have; others need no keys."""
    return dictionary.select(F.expr("substr(word, 1, 1)").alias("first"), F.length("word").alias("l2")).distinct()


def _token_keys(tokens: DataFrame, dictionary: DataFrame, rules: Rules) -> DataFrame:
    sized = tokens.selectExpr(
        "rule", "token", "length(token) as l1", f"{_setting(rules, 0)} as ratio", f"{_setting(rules, 1)} as threshold"
    ).withColumn("gap", length_gap("l1", "ratio"))
    near = sized.selectExpr("*", "substr(token, 1, 1) as first", "explode(sequence(l1 - gap, l1 + gap)) as l2")
    routed = _routes(near.join(_blocks(dictionary), ["first", "l2"], "left_semi"))
    return routed.selectExpr(
        "rule", "token", "l1", "l2", "route", "distance",
        f"""explode_outer(case route
            when {BY_DELETION} then {deletions("token", "token_cut")}
            when {BY_PART} then {token_parts("token", "l2", "distance", "word_cut", "token_cut")}
            when {BY_WINDOW} then if(l1 < l2, {word_parts("token", "inside")}, {token_parts("token", "l2", "inside", "l2", "l1")})
            else {substrings("token", "least(l1, l2)")} end) as key""",
    )


def _word_keys(dictionary: DataFrame, rules: Rules) -> DataFrame:
    numbers = ", ".join(str(r) for r in sorted(rules))
    sized = dictionary.selectExpr("word", "length(word) as l2", f"explode(array({numbers})) as rule").selectExpr(
        "*", f"{_setting(rules, 0)} as ratio", f"{_setting(rules, 1)} as threshold"
    )
    lengths = "sequence(greatest(1, int(floor(l2 / (1 + ratio))) - 1), int(ceil(l2 / greatest(1 - ratio, 0.01D))) + 1)"
    routed = _routes(sized.selectExpr("*", f"explode({lengths}) as l1"))
    return routed.selectExpr(
        "rule", "word", "l1", "l2", "route",
        f"""explode_outer(case route
            when {BY_DELETION} then {deletions("word", "word_cut")}
            when {BY_PART} then {word_parts("word", "distance")}
            when {BY_WINDOW} then if(l2 <= l1, {word_parts("word", "inside")}, {token_parts("word", "l1", "inside", "l1", "l2")})
            else {substrings("word", "least(l1, l2)")} end) as key""",
    )


def rule_matches(tokens: DataFrame, dictionary: DataFrame, rules: Rules) -> DataFrame:
    """All (rule, token, word, score) that reach the rule's score in its length and first-letter block.

    ``tokens`` holds distinct (rule, token), ``dictionary`` distinct ``word``.
    """
    joined = _token_keys(tokens, dictionary, rules).join(_word_keys(dictionary, rules), ["rule", "l1", "l2", "route", "key"])
    # An equal remainder at distance 1 or 2 already is the distance, unless the words are equal.
    found = (
        F.when(F.expr(f"route in ({BY_CONTAINMENT}, {BY_WINDOW})"), F.lit(None))
        .when(F.expr("token = word"), F.lit(0))
        .when(F.expr("distance <= 2"), F.col("distance"))
        .otherwise(F.expr("length(token) + length(word)") - 2 * common_subsequence("token", "word"))
    )
    pairs = (
        joined.filter(f"route <> {BY_PART} or levenshtein(token, word, distance) >= 0")
        .withColumn("found", found)
        .groupBy("rule", "token", "word")
        .agg(F.max("found").alias("found"), F.max("distance").alias("distance"), F.max("route").alias("route"))
    )
    score = (
        F.when(F.expr(f"route = {BY_WINDOW}"), fuzzy_score("token", "word"))
        .when(F.expr(f"route = {BY_CONTAINMENT}"), F.greatest(F.expr("200D * least(length(token), length(word)) / (length(token) + length(word))"), _most()))
        .otherwise(F.expr("(1 - found / (length(token) + length(word))) * 100"))
    )
    scored = pairs.filter(f"route >= {BY_CONTAINMENT} or found <= distance").withColumn("score", score)
    return scored.filter(F.expr(f"route <> {BY_WINDOW} or score >= {_setting(rules, 1)} - 1e-9D")).select("rule", "token", "word", "score")


def _most() -> Column:
    """The score of a word that the other one holds."""
    return F.when(F.expr("greatest(length(token), length(word)) <= 8 * least(length(token), length(word))"), CONTAINED_SCORE).otherwise(FAR_SCORE)


def fuzzy_matches(tokens: DataFrame, dictionary: DataFrame, ratio: float, threshold: float) -> DataFrame:
    """All (token, word, score) with score >= ``threshold``."""
    ruled = deal(tokens.select("token", F.lit(0).alias("rule")), "token")
    return rule_matches(ruled, dictionary, {0: (ratio, threshold)}).drop("rule")


def dictionary_block(tokens: DataFrame, dictionary: DataFrame, ratio: float) -> DataFrame:
    """(token, n_words): how many dictionary words share the first letter and a near length.

    Counts per (first letter, length) are joined, never the words themselves.
    """
    blocks = dictionary.groupBy(F.expr("substr(word, 1, 1)").alias("first"), F.length("word").alias("size")).agg(
        F.count("*").alias("n")
    )
    gap = length_gap("length(token)", ratio)
    wanted = tokens.select(
        "token",
        F.expr("substr(token, 1, 1)").alias("first"),
        F.explode(F.sequence(F.length("token") - gap, F.length("token") + gap)).alias("size"),
    )
    return (
        wanted.join(blocks, ["first", "size"], "left")
        .groupBy("token")
        .agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n_words"))
    )


def lookalike_matches(tokens: DataFrame, dictionary: DataFrame, leet: Leet = config.LEET) -> DataFrame:
    """(token, word): the words that a reading of a token's symbols spells.

    Tokens and words meet on a key of look-alike classes, one row for each; then
    each position is checked by the word's pattern. No reading is enumerated.
    """
    keyed = tokens.select("token", lookalike_key(F.col("token"), leet).alias("key"))
    words = dictionary.select("word", lookalike_key(F.col("word"), leet).alias("key"), lookalike_pattern(F.col("word"), leet).alias("spelled"))
    return keyed.join(words, "key").filter(F.rlike("token", F.col("spelled"))).select("token", "word")


def _open_matches(candidates: DataFrame, dictionary: DataFrame, rules: Rules, leet: Leet) -> DataFrame:
    """(rule, candidate, word, score) for candidates with symbols that have several readings.

    The pairs are found where such symbols and their letters count as one letter,
    which no reading can miss; then the best reading of each pair is scored.
    """
    keyed = candidates.select("rule", "candidate", open_class(F.col("candidate"), leet).alias("token"))
    words = materialize(dictionary.select("word", open_class(F.col("word"), leet).alias("class")))
    found = rule_matches(keyed.select("rule", "token").distinct(), words.select(F.col("class").alias("word")).distinct(), rules)
    pairs = keyed.join(found.select("rule", "token", F.col("word").alias("class")), ["rule", "token"]).join(words, "class")
    scored = pairs.select("rule", "candidate", "word", open_score("candidate", "word", leet).alias("score"))
    return scored.filter(F.col("score") >= F.expr(_setting(rules, 1)) - 1e-9)


def rank_candidates(
    candidates: DataFrame,
    dictionary: DataFrame,
    rules: Rules,
    fuzzy: bool = True,
    exact: DataFrame | None = None,
    leet: Leet = config.LEET,
) -> DataFrame:
    """(token, rule, place, exact, word) for (token, rule, candidate) rows, best first.

    A candidate that is a word beats every similar word, as do the words of
    ``exact`` (token, rule, word). Ties go to the shorter candidate, then to the
    shorter and smaller word. Similar words are only searched for tokens without
    an exact one, and only for candidates made of letters and open symbols.
    """
    words = dictionary.select(F.col("word").alias("candidate"), F.lit(True).alias("known"))
    rows = candidates.join(words, "candidate", "left")
    if exact is not None:
        rows = rows.unionByName(exact.select(F.col("word").alias("candidate"), "token", "rule", F.lit(True).alias("known")))
    group = Window.partitionBy("token", "rule")
    checked = materialize(rows.withColumn("exact", F.coalesce(F.max("known").over(group), F.lit(False))))
    choices = checked.filter("known").select(
        "token", "rule", "candidate", "exact", F.col("candidate").alias("word"), F.lit(100.0).alias("score")
    ).distinct()
    if fuzzy:
        open_ = checked.filter(~F.col("exact")).select("token", "rule", "candidate", "exact")
        plain = open_.filter(F.col("candidate").rlike("^[a-z]+$"))
        spellings = deal(plain.select("rule", F.col("candidate").alias("token")), "token").distinct()
        similar = rule_matches(spellings, dictionary, rules).withColumnRenamed("token", "candidate")
        choices = choices.unionByName(plain.join(similar, ["rule", "candidate"]))
        if exact is not None:
            several = open_.filter(F.col("candidate").rlike(f"^[{open_letters(leet)}]+$") & ~F.col("candidate").rlike("^[a-z]+$"))
            distinct = deal(several.select("rule", "candidate"), "candidate").distinct()
            choices = choices.unionByName(several.join(_open_matches(distinct, dictionary, rules, leet), ["rule", "candidate"]))
    order = group.orderBy(F.desc(F.round("score", 9)), F.length("candidate"), F.length("word"), "word")
    return choices.withColumn("place", F.row_number().over(order)).select("token", "rule", "place", "exact", "word")


def best_dictionary_candidate(
    candidates: DataFrame, dictionary: DataFrame, threshold: float, ratio: float = 0.4
) -> DataFrame:
    """(token, word): the shortest candidate that is a word, else the most similar word."""
    exploded = candidates.select(
        "token", F.lit(0).alias("rule"), F.explode(F.array_distinct("candidates")).alias("candidate")
    )
    ranked = rank_candidates(exploded.filter("candidate <> ''"), dictionary, {0: (ratio, threshold)})
    return ranked.filter("place = 1").select("token", "word")


def typo_correction(
    tokens: DataFrame, dictionary: DataFrame, threshold: float = 85, ratio: float = 0.25, rank: int = 10
) -> DataFrame:
    """(token, word): the first of the ``rank`` most similar words that differs by at most one in length."""
    eligible = tokens.filter(F.col("token").rlike("^[a-z]{4,}$"))
    matches = fuzzy_matches(eligible, dictionary, ratio, threshold)
    order = Window.partitionBy("token").orderBy(F.desc("score"), F.length("word"), "word")
    return (
        matches.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= rank)
        .filter(F.abs(F.length("word") - F.length("token")) <= 1)
        .groupBy("token")
        .agg(F.min_by("word", "place").alias("word"))
    )
