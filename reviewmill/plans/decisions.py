"""Token decisions that are kept between runs: each batch decides only tokens that no batch before it held.

Decisions lie below ``path`` in one folder for each fingerprint of the lexicons
and settings, so a changed word, rule or threshold starts anew and going back
finds the old ones again. A batch adds its decisions as a whole or not at all
(``sources/snapshots.py``).
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.config import ReviewConfig
from reviewmill.operators.tokens import is_protected
from reviewmill.operators.vocabulary import Lexicons, normalize_vocab, resource_fingerprints, stem_tokens
from reviewmill.scale import materialize
from reviewmill.sources import snapshots


def decide_tokens(
    counts: DataFrame, lexicons: Lexicons, cfg: ReviewConfig = ReviewConfig(), fuzzy: bool = True
) -> DataFrame:
    """(token, normalized, source, stem, kept, is_negation, is_exclusion) per distinct token."""
    decided = materialize(normalize_vocab(counts, lexicons, cfg, fuzzy))
    word = F.col("normalized")
    distinct = decided.select(word.alias("token")).distinct()
    stems = stem_tokens(distinct, lexicons.roots, lexicons.dictionary, lexicons.exclusions, lexicons.affixes)
    stops = lexicons.stopwords.select(F.lower(F.col(lexicons.stopwords.columns[0])).alias("token")).distinct()
    stops = stops.filter(~F.col("token").isin(*lexicons.negations, *lexicons.kept_words))
    facts = stems.join(stops.withColumn("stop", F.lit(True)), "token", "left").select(
        F.col("token").alias("normalized"), "stem", F.coalesce("stop", F.lit(False)).alias("stop")
    )
    return decided.join(facts.hint("merge"), "normalized").select(
        "token",
        "normalized",
        "source",
        "stem",
        (is_protected(word, lexicons.exclusions) | ((F.length(word) >= cfg.min_token_length) & ~F.col("stop"))).alias("kept"),
        word.isin(*lexicons.negations).alias("is_negation"),
        word.isin(*lexicons.exclusions).alias("is_exclusion"),
    )


def decisions_home(lexicons: Lexicons, path: str, cfg: ReviewConfig = ReviewConfig(), fuzzy: bool = True) -> str:
    """The folder of the decisions that hold under these lexicons and settings."""
    prints = resource_fingerprints(lexicons, cfg).collect()  # one row for each lexicon
    named = sorted(f"{r['name']}={r['sha']}" for r in prints) + [f"fuzzy={fuzzy}"]
    return f"{path}/{hashlib.sha256(chr(10).join(named).encode()).hexdigest()}"


def remembered(counts: DataFrame, home: str) -> DataFrame | None:
    """The decisions kept at ``home``, one for a token, with the ``batch`` that made it; None if there are none.

    Two runs at the same time may both decide a token; they agree, and the batch with the smaller id counts.
    """
    spark = counts.sparkSession
    folders = snapshots.batches(spark, home)
    if not folders:
        return None
    kept = spark.read.parquet(*folders)
    rest = [c for c in kept.columns if c not in ("token", "batch")]
    return kept.groupBy("token").agg(F.min(F.struct("batch", *rest)).alias("d")).select("token", "d.*")


def decide_remembered(
    counts: DataFrame,
    lexicons: Lexicons,
    path: str,
    cfg: ReviewConfig = ReviewConfig(),
    fuzzy: bool = True,
    batch: str | None = None,
) -> DataFrame:
    """``decide_tokens`` of the tokens of ``counts``, with ``fresh``: whether this batch is the first with the token.

    Only fresh tokens go through the rules, and their decisions are kept under the
    id ``batch`` (by default a new one). A retried batch finds its own decisions
    and gives the same rows. An id that comes again with further tokens decides
    them, but keeps what was kept first. ``counts`` holds each token once; without
    tokens nothing is kept.
    """
    batch = uuid.uuid4().hex if batch is None else batch
    home = decisions_home(lexicons, path, cfg, fuzzy)
    kept = remembered(counts, home)
    unseen = counts if kept is None else counts.join(kept, "token", "left_anti")
    made = materialize(decide_tokens(materialize(unseen), lexicons, cfg, fuzzy).withColumn("batch", F.lit(batch)))
    if kept is not None:
        kept = materialize(kept.join(counts, "token", "left_semi"))
    if not made.isEmpty():
        snapshots.append(made, home, batch)
    every = made if kept is None else made.unionByName(kept)
    return every.withColumn("fresh", F.col("batch") == batch).drop("batch")
