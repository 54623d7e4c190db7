"""One query per operator over the given tables.

Every query reads whole tables. Inputs an operator needs but the tables lack
(labels as text, emoji, emoticons, broken encodings) are derived from them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill import config
from reviewmill.config import ReviewConfig
from reviewmill.functions import candidates, labels, symbols, text
from reviewmill.operators import bayes, charts, evaluation, features, fuzzy, profiling, quality, stemming, tokens, vocabulary
from reviewmill.operators import symbols as symbol_tables
from reviewmill.plans import cleaning, decisions, scoring, training
from reviewmill.scale import materialize, scratch_path, spread
from reviewmill.sources import history, lexicons, models, reviews, trees

# Small lexicons for texts in English, French and German.
NEGATIONS = ("no", "nicht", "pas")
SLANG = {"und": "and", "der": "the", "avec": "with", "les": "the", "oder": "or"}
AFFIXES = (r"^(un|re|ge|be)", r"(ing|ed|en|er|es|s|e)$")
# The same as a table: (prefix, suffix, head, tail, least), in order of preference.
AFFIX_RULES = [
    ("", "ies", "", "y", 2), ("", "ing", "", "", 3), ("", "ing", "", "e", 2), ("un", "ed", "", "", 3), ("ge", "t", "", "en", 3),
    ("", "ed", "", "", 3), ("", "ed", "", "e", 2), ("", "er", "", "", 3), ("", "en", "", "", 3), ("", "es", "", "", 3),
    ("", "s", "", "", 3), ("", "e", "", "", 3), ("un", "", "", "", 3), ("re", "", "", "", 3), ("ge", "", "", "", 3), ("be", "", "", "", 3),
]
EMOTICONS = {
    ":)": "positif", ":(": "negatif", ":-)": "positif", "8)": "positif", "=3": "positif", ":/": "netral",
    "d:": "netral", ";;": "negatif", "D:": "negatif", "oO": "netral", ":a": "netral", ";}": "positif",
}
# Words that stand in for emoji, so that texts without emoji exercise the conversion.
EMOJI_FOR = {
    "the": "😍", "nicht": "😡", "pour": "❤️", "with": "🐱", "und": "🚀", "and": "★", "of": "©", "que": "👍🏽", "that": "👩‍💻", "les": "✓",
}
EMOJIS = {"😍": "positif", "😡": "negatif", "❤": "positif", "👍": "positif"}
EMOJI_NAMES = {"🐱": "cat-face", "👩‍💻": "woman technologist"}
# Letters that a disguise writes as look-alike digits.
DISGUISE = "oilaesgtb"
MARKERS = (*config.WORK_MARKERS, "License", "http", "@")
CFG = ReviewConfig(label="quality", row_id="doc_id")

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(_table(spark, folder, "documents"))


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return spread(_table(spark, folder, "pages"))


def _reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their labels, null where a document has none."""
    return _documents(spark, folder).join(_table(spark, folder, "labels"), "doc_id", "left")


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder).join(_table(spark, folder, "labels"), "doc_id")


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = F.posexplode(F.split("text", "\n")).alias("line_no", "text")
    return _documents(spark, folder).select("doc_id", lines)


def _with_emoji(col: Column) -> Column:
    for word, emoji in EMOJI_FOR.items():
        col = F.replace(col, F.lit(f" {word} "), F.lit(f" {emoji} "))
    return col


def _map_rows(spark: SparkSession, mapping: dict[str, str], key: str, value: str) -> DataFrame:
    return spark.createDataFrame(sorted(mapping.items()), f"{key} string, {value} string")


def _vocabulary(spark: SparkSession, folder: str) -> tuple[DataFrame, vocabulary.Lexicons]:
    """Token counts of the documents and lexicons taken from their frequencies.

    The word tables are stored, as Spark would take them for as large as the table of all tokens.
    """
    documents = _documents(spark, folder)
    n_docs = _table(spark, folder, "documents").count()
    frequencies = materialize(tokens.token_frequencies(documents, "doc_id", "text"))
    common = F.col("token").rlike("^[a-z]{4,}$") & (F.col("df") * 50 >= n_docs)
    return frequencies.select("token", "n"), vocabulary.Lexicons(
        dictionary=materialize(frequencies.filter(common).select(F.col("token").alias("word"))),
        stopwords=materialize(frequencies.filter(F.col("df") * 2 > n_docs).select(F.col("token").alias("word"))),
        slang=_map_rows(spark, SLANG, "token", "target"),
        negations=NEGATIONS,
        affixes=AFFIXES,
    )


def _structured(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with symbols stripped."""
    cleaned = text.clean_structure(F.col("text"))
    return _labelled(spark, folder).select("doc_id", "quality", cleaned.alias("text"))


def _per_text(function: Callable[[Column], Column], table: str, key: str, column: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = spread(_table(spark, folder, table))
        return rows.select(key, function(F.col(column)).alias("result"))

    return query


# Sources -----------------------------------------------------------------


def _write_review_files(spark, folder) -> list[str]:
    """All documents as two CSV data sets, split by language; -1 where there is no label."""
    root = scratch_path(spark, "reviews")
    rows = _reviews(spark, folder).select("text", F.coalesce("quality", F.lit(-1)).alias("sentiment"), "lang")
    paths = [f"{root}/data1.csv", f"{root}/data2.csv"]
    for path, part in zip(paths, (F.col("lang").eqNullSafe("en"), ~F.col("lang").eqNullSafe("en")), strict=True):
        reviews.write_predictions(rows.filter(part), path)
    return paths


def read_reviews(spark, folder):
    return reviews.read_reviews(spark, _write_review_files(spark, folder)).select("text", "sentiment", "lang")


def union_datasets(spark, folder):
    conversations = _table(spark, folder, "conversations").select("conv_id", "role", "text")
    return reviews.union_datasets(_documents(spark, folder).select("doc_id", "lang", "text"), conversations)


def write_predictions(spark, folder):
    path = scratch_path(spark, "predictions")
    scored = _reviews(spark, folder).select(
        "doc_id", "text", labels.display_label(F.col("quality")).alias("sentimen"), labels.prediction_status(F.col("text")).alias("status")
    )
    reviews.write_predictions(scored, path)
    back = spark.read.schema(scored.schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    return back.csv(path)


def save_model(spark, folder):
    path = scratch_path(spark, "model")
    models.save_model(bayes.train_model(_structured(spark, folder), "doc_id", "text", "quality", CFG), path)
    priors = models.load_model(spark, path).priors
    return priors.select("label", F.round("log_prior", 6).alias("log_prior"))


def load_model(spark, folder):
    path = scratch_path(spark, "model")
    models.save_model(bayes.train_model(_structured(spark, folder), "doc_id", "text", "quality", CFG), path)
    theta = models.load_model(spark, path).theta
    return theta.select("label", "term", F.round("log_prob", 6).alias("log_prob"))


def fingerprint(spark, folder):
    return models.row_fingerprints(_documents(spark, folder), "doc_id", "text")


def table_fingerprint(spark, folder):
    return models.table_fingerprint(_documents(spark, folder).select("doc_id", "text", "lang"), "documents")


def compatibility_check(spark, folder):
    """Stored: all documents. Current: labelled documents, upper-cased where not English."""
    stored = models.row_fingerprints(_documents(spark, folder), "doc_id", "text")
    changed = F.when(F.col("lang") == "en", F.col("text")).otherwise(F.concat("text", F.lit("!")))
    current = models.row_fingerprints(_labelled(spark, folder).withColumn("text", changed), "doc_id", "text")
    return models.compatibility_check(stored, current)


def part_digests(spark, folder):
    path = scratch_path(spark, "tree")
    trees.save_tree(_documents(spark, folder), "doc_id", path, ["doc_id", "text", "lang"], depth=2)
    return trees.part_digests(spark, path)


def changed_keys(spark, folder):
    """Stored: all documents. Current: labelled documents, every seventh with another language."""
    stored, current = scratch_path(spark, "tree"), scratch_path(spark, "tree")
    columns = ["doc_id", "text", "lang"]
    other = F.when(F.col("doc_id") % 7 == 0, F.lit("xx")).otherwise(F.col("lang"))
    trees.save_tree(_documents(spark, folder), "doc_id", stored, columns, depth=3)
    trees.save_tree(_labelled(spark, folder).withColumn("lang", other), "doc_id", current, columns, depth=3)
    return trees.changed_keys(spark, stored, current)


def model_metadata(spark, folder):
    labelled = _labelled(spark, folder).withColumn("predicted", 1 - F.col("toxic"))
    prints = models.table_fingerprint(_documents(spark, folder).select("doc_id", "text", "lang"), "documents")
    record = models.model_metadata(labelled, "quality", evaluation.binary_metrics(labelled, "quality", "predicted"), prints)
    spread_out = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ",")
    return record.select(
        "model_version",
        "data_count",
        spread_out("label_distribution").alias("label_distribution"),
        spread_out("checksums").alias("checksums"),
        *[F.round(F.col("evaluation_metrics")[m], 6).alias(m) for m in ("accuracy", "precision", "recall", "f1")],
        F.array_join("pipeline_steps", ",").alias("pipeline_steps"),
    )


def read_lexicons(spark, folder):
    """All lines of all documents as a word list file, read back."""
    path = scratch_path(spark, "words")
    _lines(spark, folder).select(F.col("text").alias("value")).write.text(path)
    return lexicons.read_word_list(spark, path)


def _token_words(spark, folder, table, key, column) -> DataFrame:
    rows = spread(_table(spark, folder, table))
    return tokens.tokenize(rows, key, column).select(F.col("token").alias("word"))


def build_dictionary(spark, folder):
    words = _token_words(spark, folder, "documents", "doc_id", "text")
    return lexicons.build_dictionary(words, _token_words(spark, folder, "conversations", "conv_id", "text"))


def build_stopwords(spark, folder):
    stop = _token_words(spark, folder, "documents", "doc_id", "text")
    negations = spark.createDataFrame([(n,) for n in NEGATIONS], "word string")
    return lexicons.build_stopwords(stop, negations, _token_words(spark, folder, "benchmark", "item_id", "text"))


def score_emojis(spark, folder):
    """One emoji-like symbol per event type and user, counts from the event values."""
    events = _table(spark, folder, "events")
    symbol = F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("_"), F.col("event_type"), F.lit("️"))
    counts = events.groupBy(symbol.alias("Emoji")).agg(
        F.count("*").alias("Occurrences"),
        F.count_if(F.col("value") >= 60).alias("Positive"),
        F.count_if(F.col("value") < 50).alias("Negative"),
    )
    return lexicons.score_emojis(counts).select("emoji", F.round("score", 6).alias("score"), "token")


# Data quality ------------------------------------------------------------


def _raw_labels(spark, folder) -> DataFrame:
    """Labels as text with padding; unlabelled documents carry their language instead."""
    padded = F.concat(F.lit(" "), F.col("quality").cast("string"), F.lit("\t"))
    return _reviews(spark, folder).select("doc_id", F.coalesce(padded, F.col("lang")).alias("label"))


def drop_missing_required(spark, folder):
    lines = _lines(spark, folder).join(_table(spark, folder, "labels"), "doc_id", "left")
    return quality.drop_missing_required(lines, ["text", "quality"]).select("doc_id", "line_no", "quality")


def normalize_labels(spark, folder):
    return quality.normalize_labels(_raw_labels(spark, folder), "label")


def label_violations(spark, folder):
    return quality.label_violations(_raw_labels(spark, folder), "label")


def label_distribution_raw(spark, folder):
    return quality.label_distribution_raw(_labelled(spark, folder), "quality")


def conflict_texts(spark, folder):
    return quality.conflict_texts(_documents(spark, folder), "text", "source")


def conflict_audit(spark, folder):
    audit = quality.conflict_audit(_documents(spark, folder), "text", "source")
    entries = F.transform(F.map_entries("counts"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string")))
    return audit.select("text", F.array_join(entries, ",").alias("counts"), "removed", "action")


def resolve_conflicts(spark, folder):
    return quality.resolve_conflicts(_documents(spark, folder), "text", "source").select("doc_id", "source")


def drop_exact_duplicates(spark, folder):
    return quality.drop_exact_duplicates(_documents(spark, folder), "text", "lang", "doc_id").select("doc_id", "source")


def _mixed_files(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Three CSV data sets with columns of their own, read back: rows and (file, column)."""
    root = scratch_path(spark, "mixed")
    rows = _reviews(spark, folder).select("doc_id", "text", F.col("quality").alias("sentiment"), "lang")
    parts = {
        "data1.csv": rows.filter("lang = 'en'"),
        "data2.csv": rows.filter("lang = 'fr'").drop("sentiment"),
        "data3.csv": rows.filter("coalesce(lang NOT IN ('en', 'fr'), true)").drop("text", "lang"),
    }
    for name, part in parts.items():
        reviews.write_predictions(part, f"{root}/{name}")
    paths = [f"{root}/{name}" for name in parts]
    return reviews.read_reviews(spark, paths, required=()), reviews.file_columns(reviews.file_headers(spark, paths))


def file_report(spark, folder):
    rows, columns = _mixed_files(spark, folder)
    return quality.file_report(rows, "file", "sentiment", "text", columns)


def file_label_counts(spark, folder):
    return quality.file_label_counts(_reviews(spark, folder), "source", "quality")


def strict_validation(spark, folder):
    lines = _lines(spark, folder).join(_table(spark, folder, "labels"), "doc_id", "left")
    return quality.strict_validation(lines.select("text", "quality"), "text", "quality")


def column_unique_check(spark, folder):
    return quality.column_unique_check(_lines(spark, folder), "text")


def allowed_values_check(spark, folder):
    return quality.allowed_values_check(_documents(spark, folder), "lang", ["en", "fr"])


def not_constant_check(spark, folder):
    reviews_ = _reviews(spark, folder)
    parts = [quality.not_constant_check(reviews_, "lang", "en"), quality.not_constant_check(_table(spark, folder, "conversations").withColumn("kind", F.lit("chat")), "kind", "chat")]
    return parts[0].unionByName(parts[1])


def non_empty_check(spark, folder):
    """Documents are the expected files; labels give the rows."""
    expected = _documents(spark, folder).select(F.col("doc_id").alias("file"))
    return quality.non_empty_check(_table(spark, folder, "labels"), "doc_id", expected)


def required_columns_check(spark, folder):
    return quality.required_columns_check(_mixed_files(spark, folder)[1], ["text", "sentiment", "lang", "doc_id"])


def blank_entry_check(spark, folder):
    """Every sentence of a document: what follows the last stop is blank. Maps from the first word of a line to the rest."""
    items = F.split(F.regexp_replace("text", r"\n", " "), r"\.")
    rows = _documents(spark, folder).select("doc_id", items.alias("items"))
    lines = _lines(spark, folder).select("doc_id", "line_no", F.substring_index("text", " ", 1).alias("k"), F.expr("substr(text, length(substring_index(text, ' ', 1)) + 2)").alias("v"))
    maps = lines.groupBy("doc_id").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", "line_no", "k").alias("k"), "v"))).alias("entries")
    )
    lists = quality.blank_entry_check(rows, "doc_id", "items").withColumn("kind", F.lit("list"))
    return lists.unionByName(quality.blank_entry_check(maps, "doc_id", "entries").withColumn("kind", F.lit("map")))


def text_marker_check(spark, folder):
    return quality.text_marker_check(_documents(spark, folder), "doc_id", "text", MARKERS)


def display_label(spark, folder):
    rows = _reviews(spark, folder)
    return rows.select(
        "doc_id",
        labels.display_label(F.col("quality").cast("double")).alias("shown"),
        labels.display_label(F.coalesce(F.col("quality").cast("string"), F.col("lang"))).alias("own_text"),
        labels.display_label(F.col("quality"), default=F.lit(config.UNKNOWN_LABEL)).alias("known"),
    )


def invalid_text_mask(spark, folder):
    return _lines(spark, folder).select("doc_id", "line_no", labels.invalid_text_mask(F.col("text")).alias("invalid"))


# Text --------------------------------------------------------------------


def _mojibake(col: Column) -> Column:
    """UTF-8 bytes read as Latin-1."""
    return F.decode(F.encode(col, "UTF-8"), "ISO-8859-1")


def repair_mojibake(spark, folder):
    broken = _mojibake(_with_emoji(F.col("text")))
    return _documents(spark, folder).select("doc_id", broken.alias("b")).select("doc_id", symbols.repair_mojibake(F.col("b")).alias("result"))


def convert_emojis(spark, folder):
    rows = _documents(spark, folder).select("doc_id", _with_emoji(F.col("text")).alias("t"))
    return rows.select("doc_id", symbols.convert_emojis(F.col("t"), EMOJIS, EMOJI_NAMES).alias("result"))


def tokenize(spark, folder):
    return tokens.tokenize(_documents(spark, folder), "doc_id", "text").select("id", F.col("pos").cast("bigint").alias("pos"), "token")


def emoji_emoticon_counts(spark, folder):
    rows = _pages(spark, folder).select(_with_emoji(F.col("html")).alias("t"))
    return tokens.emoji_emoticon_counts(rows, "t", EMOTICONS, EMOJIS)


def _lexicon_table(spark, known: dict[str, str], others: DataFrame, names: str) -> DataFrame:
    """A lexicon that grows with the data: known symbols and one in brackets for each row, which no text holds."""
    listed = spark.createDataFrame(list(known.items()), names)
    symbol, token = listed.columns
    return listed.unionByName(others.select(F.concat(F.lit("\u27e6"), F.col(others.columns[0]), F.lit("\u27e7")).alias(symbol), F.lit("x").alias(token)))


def convert_emoticons_table(spark, folder):
    pages = _pages(spark, folder).select("page_id", F.col("html").alias("result"))
    table = _lexicon_table(spark, EMOTICONS, pages.select("page_id"), "emoticon string, sentiment string")
    return symbol_tables.convert_emoticons(pages, "page_id", "result", table)


def convert_emojis_table(spark, folder):
    rows = _documents(spark, folder).select("doc_id", _with_emoji(F.col("text")).alias("result"))
    table = _lexicon_table(spark, EMOJIS, rows.select("doc_id"), "emoji string, token string")
    names = spark.createDataFrame(list(EMOJI_NAMES.items()), "emoji string, name string")
    return symbol_tables.convert_emojis(rows, "doc_id", "result", table, names)


def emoji_emoticon_counts_table(spark, folder):
    rows = _pages(spark, folder).select("page_id", _with_emoji(F.col("html")).alias("t"))
    emojis = _lexicon_table(spark, EMOJIS, rows.select("page_id"), "emoji string, token string")
    emoticons = _lexicon_table(spark, EMOTICONS, rows.select("page_id"), "emoticon string, sentiment string")
    counts = [
        symbol_tables.symbol_count(symbol_tables.emoji_matches(rows, "page_id", "t", emojis), "n_emoji"),
        symbol_tables.symbol_count(symbol_tables.emoticon_matches(rows, "page_id", "t", emoticons), "n_emoticon"),
    ]
    return counts[0].crossJoin(counts[1])  # one row each


def clean_text(spark, folder):
    """Cleaned text with exact vocabulary rules."""
    _, lexicon = _vocabulary(spark, folder)
    return cleaning.clean_text(_documents(spark, folder), "doc_id", "text", lexicon, CFG, fuzzy=False)


def clean_text_fuzzy(spark, folder):
    """Cleaned text with similar-word rules."""
    _, lexicon = _vocabulary(spark, folder)
    return cleaning.clean_text(_documents(spark, folder), "doc_id", "text", lexicon, CFG)


# Vocabulary --------------------------------------------------------------


def protected_tokens(spark, folder):
    counts, lexicon = _vocabulary(spark, folder)
    return vocabulary.protected_tokens(counts, lexicon.exclusions, lexicon.negations)


def slang_lookup(spark, folder):
    counts, lexicon = _vocabulary(spark, folder)
    return vocabulary.slang_lookup(counts, lexicon.slang)


def dictionary_lookup(spark, folder):
    counts, lexicon = _vocabulary(spark, folder)
    return vocabulary.dictionary_lookup(counts, lexicon.dictionary)


def repeat_candidates(spark, folder):
    counts, _ = _vocabulary(spark, folder)
    return counts.filter(F.col("token").rlike(candidates.REPEATED)).select(
        "token", F.explode(candidates.repeat_candidates(F.col("token"))).alias("candidate")
    )


def leet_candidates(spark, folder):
    """The dictionary words that tokens spell with look-alikes; every token also as a disguise of itself."""
    counts, lexicon = _vocabulary(spark, folder)
    disguised = counts.select(F.translate("token", DISGUISE, "011435678").alias("token"))
    words = counts.select("token").union(disguised).filter(vocabulary.has_symbols(F.col("token"))).distinct()
    return fuzzy.lookalike_matches(words, lexicon.dictionary).select("token", F.col("word").alias("candidate"))


def dictionary_block(spark, folder):
    counts, lexicon = _vocabulary(spark, folder)
    return fuzzy.dictionary_block(counts, lexicon.dictionary, CFG.typo_length_ratio)


def fuzzy_score(spark, folder):
    """Scores of all (token, word) pairs that reach the typo threshold."""
    counts, lexicon = _vocabulary(spark, folder)
    pairs = fuzzy.fuzzy_matches(counts, lexicon.dictionary, CFG.typo_length_ratio, CFG.typo_threshold)
    return pairs.select("token", "word", F.round(candidates.fuzzy_score("token", "word"), 6).alias("score"))


def best_dictionary_candidate(spark, folder):
    """The best word for the repeated-letter spellings of every token."""
    counts, lexicon = _vocabulary(spark, folder)
    spellings = counts.select("token", candidates.repeat_candidates(F.col("token")).alias("candidates"))
    return fuzzy.best_dictionary_candidate(spellings, lexicon.dictionary, CFG.repeat_threshold, CFG.candidate_length_ratio)


def typo_correction(spark, folder):
    counts, lexicon = _vocabulary(spark, folder)
    unknown = counts.join(lexicon.dictionary.withColumnRenamed("word", "token"), "token", "left_anti")
    return fuzzy.typo_correction(unknown, lexicon.dictionary, CFG.typo_threshold, CFG.typo_length_ratio, CFG.typo_rank)


def normalize_vocab(spark, folder):
    counts, lexicon = _vocabulary(spark, folder)
    return vocabulary.normalize_vocab(counts, lexicon, CFG)


def normalize_vocab_exact(spark, folder):
    counts, lexicon = _vocabulary(spark, folder)
    return vocabulary.normalize_vocab(counts, lexicon, CFG, fuzzy=False)


def filter_tokens(spark, folder):
    _, lexicon = _vocabulary(spark, folder)
    kept = tokens.filter_tokens(tokens.tokenize(_documents(spark, folder), "doc_id", "text"), lexicon.stopwords)
    return kept.select("id", F.col("pos").cast("bigint").alias("pos"), "token")


def combine_negations(spark, folder):
    table = tokens.tokenize(_documents(spark, folder), "doc_id", "text", listed=True)
    return tokens.combine_negations(table, NEGATIONS).select("id", F.col("pos").cast("bigint").alias("pos"), "token")


def stem_tokens(spark, folder):
    counts, lexicon = _vocabulary(spark, folder)
    return vocabulary.stem_tokens(counts, None, lexicon.dictionary, lexicon.exclusions, AFFIXES)


def stem_tokens_rules(spark, folder):
    """The same tokens by a table of rules, which are applied until a dictionary word is reached."""
    counts, lexicon = _vocabulary(spark, folder)
    rules = stemming.affix_rules(spark, AFFIX_RULES)
    return vocabulary.stem_tokens(counts, None, lexicon.dictionary, lexicon.exclusions, rules)


def remembered_decisions(spark, folder):
    """Decisions for all documents in two batches, English ones first; the second decides only what is new in it."""
    _, lexicon = _vocabulary(spark, folder)
    documents, english = _documents(spark, folder), F.col("lang").eqNullSafe("en")
    path = scratch_path(spark, "decisions")
    for part in (english, ~english):
        counts = materialize(vocabulary.token_counts(tokens.tokenize(documents.filter(part), "doc_id", "text")))
        made = decisions.decide_remembered(counts, lexicon, path, CFG, fuzzy=False)
    return made.select("token", "normalized", "source", "stem", "fresh")


def rebuild_text(spark, folder):
    return tokens.rebuild_text(tokens.tokenize(_documents(spark, folder), "doc_id", "text"))


def normalization_stats(spark, folder):
    counts, lexicon = _vocabulary(spark, folder)
    return vocabulary.normalization_stats(counts, vocabulary.normalize_vocab(counts, lexicon, CFG))


def count_tokens(spark, folder):
    return tokens.count_tokens(_documents(spark, folder), "text")


# Features and model ------------------------------------------------------


def _vocab_idf(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Term counts and the weighted vocabulary of structured texts."""
    counts = materialize(features.term_counts(rows, "doc_id", "text", keep=("quality",)))
    n_docs = rows.count()
    return counts, materialize(features.idf_smooth(features.document_frequency(counts, n_docs), n_docs))


def stratified_split(spark, folder):
    return features.stratified_split(_labelled(spark, folder), "quality", "doc_id").select("doc_id", "quality", "is_test")


def vectorizer_tokens(spark, folder):
    table = features.vectorizer_tokens(_all_structured(spark, folder), "doc_id", "text")
    return table.select("id", F.col("pos").cast("bigint").alias("pos"), "token")


def ngrams_1_2(spark, folder):
    grams = features.ngrams_1_2(_all_structured(spark, folder), "doc_id", "text")
    return grams.groupBy("id", "term").agg(F.count("*").alias("n"))


def document_frequency(spark, folder):
    return _vocab_idf(_structured(spark, folder))[1].select("term", "df")


def tf(spark, folder):
    return features.tf(*_vocab_idf(_structured(spark, folder)))


def idf_smooth(spark, folder):
    return _vocab_idf(_structured(spark, folder))[1].select("term", "df", F.round("idf", 6).alias("idf"))


def tfidf_l2(spark, folder):
    weights = features.tfidf_l2(*_vocab_idf(_structured(spark, folder)))
    return weights.select("id", "term", F.round("weight", 6).alias("weight"))


def nb_priors(spark, folder):
    priors = bayes.nb_priors(_labelled(spark, folder), "quality")
    return priors.select("label", F.round("log_prior", 6).alias("log_prior"))


def nb_fit(spark, folder):
    counts, vocab = _vocab_idf(_structured(spark, folder))
    fitted = bayes.nb_fit(features.tfidf_l2(counts, vocab, keep=("quality",)), "quality", vocab, CFG.labels, CFG.alpha)
    theta = models.Model(fitted, fitted, CFG.labels).theta
    return theta.select("label", "term", F.round("log_prob", 6).alias("log_prob"))


def _split_model(spark, folder) -> tuple[DataFrame, models.Model]:
    rows = materialize(features.stratified_split(_structured(spark, folder), "quality", "doc_id"))
    return rows, bayes.train_model(rows.filter(~F.col("is_test")), "doc_id", "text", "quality", CFG)


def _all_structured(spark, folder) -> DataFrame:
    return _documents(spark, folder).select("doc_id", text.clean_structure(F.col("text")).alias("text"))


def nb_predict(spark, folder):
    """Predict every document with a model of the training split."""
    _, model = _split_model(spark, folder)
    return bayes.nb_predict(_all_structured(spark, folder), "doc_id", "text", model, CFG).select("id", "prediction")


def nb_predict_proba(spark, folder):
    _, model = _split_model(spark, folder)
    proba = bayes.nb_predict_proba(_all_structured(spark, folder), "doc_id", "text", model, CFG)
    return proba.select("id", "label", F.round("proba", 6).alias("proba"))


def confidence_level(spark, folder):
    _, model = _split_model(spark, folder)
    predicted = bayes.nb_predict(_all_structured(spark, folder), "doc_id", "text", model, CFG)
    level = labels.confidence_level(F.col("confidence"), CFG.confidence_high, CFG.confidence_medium)
    return predicted.select("id", level.alias("level"))


def _scored_lines(spark, folder) -> DataFrame:
    """Every line of every conversation, blank lines included, scored."""
    _, lexicon = _vocabulary(spark, folder)
    training_rows = materialize(
        cleaning.clean_text(_labelled(spark, folder), "doc_id", "text", lexicon, CFG, fuzzy=False)
        .join(_table(spark, folder, "labels").select(F.col("doc_id").alias("id"), "quality"), "id")
    )
    model = bayes.train_model(training_rows, "id", "clean_text", "quality", CFG)
    lines = (
        spread(_table(spark, folder, "conversations"))
        .select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("line_no", "text"))
        .withColumn("key", F.concat_ws("-", "conv_id", "turn", "line_no"))
    )
    return scoring.batch_score(lines, "key", "text", model, lexicon, CFG, fuzzy=False)


def batch_score(spark, folder):
    return _scored_lines(spark, folder).select("key", "text", "sentimen", F.round("tingkat_keyakinan", 6).alias("tingkat_keyakinan"), "status")


def prediction_history(spark, folder):
    """Events appended in two batches after a reset, read back."""
    path = scratch_path(spark, "history")
    events = _table(spark, folder, "events").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.col("props").alias("text"),
        F.col("event_type").alias("sentimen"),
        F.col("value").alias("tingkat_keyakinan"),
    )
    history.reset_history(spark, path)
    history.append_history(events.filter("tingkat_keyakinan >= 50"), path)
    history.append_history(events.filter("tingkat_keyakinan < 50 OR tingkat_keyakinan IS NULL"), path)
    return history.read_history(spark, path).groupBy("sentimen").agg(
        F.count("*").alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last")
    )


def prediction_counts(spark, folder):
    return history.prediction_counts(_table(spark, folder, "events"), "event_type")


# Evaluation --------------------------------------------------------------


def _pairs(spark, folder) -> DataFrame:
    """Quality as the truth, "not toxic" as the prediction."""
    return _table(spark, folder, "labels").select(F.col("quality").alias("actual"), (1 - F.col("toxic")).alias("predicted"))


def binary_metrics(spark, folder):
    metrics = evaluation.binary_metrics(_pairs(spark, folder), "actual", "predicted")
    return metrics.select(*[F.round(c, 6).alias(c) for c in metrics.columns])


def confusion_matrix(spark, folder):
    return evaluation.confusion_matrix(_pairs(spark, folder), "actual", "predicted")


def classification_report(spark, folder):
    return evaluation.classification_report(evaluation.confusion_matrix(_pairs(spark, folder), "actual", "predicted"))


def evaluate_model(spark, folder):
    """Split, train and evaluate on structured texts: the report with split sizes."""
    rows, model = _split_model(spark, folder)
    rows = rows.select(F.col("doc_id").alias("id"), "quality", F.col("text").alias("clean_text"), "is_test")
    sizes = rows.agg(F.count_if(~F.col("is_test")).alias("train_size"), F.count_if("is_test").alias("test_size"))
    result = training.evaluate_model(rows.filter("is_test"), sizes, model, CFG)
    return result.report.withColumn("train_size", sizes.select("train_size").scalar()).withColumn("test_size", sizes.select("test_size").scalar())


def train_and_evaluate(spark, folder):
    """The whole run with full cleaning: every test row with label and prediction, one for each text and label."""
    _, lexicon = _vocabulary(spark, folder)
    rows = _labelled(spark, folder).select("doc_id", "text", "quality")
    _, result = training.train_and_evaluate(rows, lexicon, CFG, strict=False)
    return result.predictions.select("id", "label", "prediction", F.round("confidence", 6).alias("confidence"))


# Profile -----------------------------------------------------------------


def _profile(function: Callable[..., DataFrame], *args, columns: tuple[str, ...] | None = None, **kwargs) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = _reviews(spark, folder)
        return function(rows.select(*columns) if columns else rows, *args, **kwargs)

    return query


def dataset_sample(spark, folder):
    return profiling.dataset_sample(_reviews(spark, folder), "doc_id", 50).select("doc_id", "text", "quality")


def duplicate_examples(spark, folder):
    return profiling.duplicate_examples(_documents(spark, folder).select("doc_id", "text", "lang"), "doc_id").select("doc_id", "lang")


def dataset_info(spark, folder):
    return profiling.dataset_info(_reviews(spark, folder))


# Charts ------------------------------------------------------------------


def chart_top_words(spark, folder):
    _, lexicon = _vocabulary(spark, folder)
    words = tokens.tokenize(_documents(spark, folder), "doc_id", "text")
    return charts.chart_top_words(words, CFG.top_words, stopwords=lexicon.stopwords)


def chart_confusion(spark, folder):
    return charts.chart_confusion(confusion_matrix(spark, folder))


def chart_metrics(spark, folder):
    return charts.chart_metrics(evaluation.binary_metrics(_pairs(spark, folder), "actual", "predicted"))


_TEXT_COLUMNS = ("text", "lang", "source", "quality")

QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        read_reviews, union_datasets, write_predictions, save_model, load_model, fingerprint,
        table_fingerprint, part_digests, changed_keys, compatibility_check, model_metadata, read_lexicons, build_dictionary,
        build_stopwords, score_emojis,
        drop_missing_required, normalize_labels, label_violations, label_distribution_raw, conflict_texts,
        conflict_audit, resolve_conflicts, drop_exact_duplicates, file_report, file_label_counts, strict_validation,
        column_unique_check, allowed_values_check, not_constant_check, non_empty_check, required_columns_check,
        blank_entry_check, text_marker_check, display_label, invalid_text_mask,
        repair_mojibake, convert_emojis, tokenize, emoji_emoticon_counts, convert_emoticons_table,
        convert_emojis_table, emoji_emoticon_counts_table, clean_text, clean_text_fuzzy,
        protected_tokens, slang_lookup, dictionary_lookup, repeat_candidates, leet_candidates, dictionary_block,
        fuzzy_score, best_dictionary_candidate, typo_correction, normalize_vocab, normalize_vocab_exact,
        filter_tokens, combine_negations, stem_tokens, stem_tokens_rules, remembered_decisions, rebuild_text, normalization_stats, count_tokens,
        stratified_split, vectorizer_tokens, ngrams_1_2, document_frequency, tf, idf_smooth, tfidf_l2, nb_priors,
        nb_fit, nb_predict, nb_predict_proba, confidence_level, batch_score, prediction_history, prediction_counts,
        binary_metrics, confusion_matrix, classification_report, evaluate_model, train_and_evaluate,
        dataset_sample, duplicate_examples, dataset_info, chart_top_words, chart_confusion, chart_metrics,
    )
} | {
    "strip_html": _per_text(text.strip_html, "pages", "page_id", "html"),
    "strip_urls": _per_text(text.strip_urls, "pages", "page_id", "html"),
    "strip_mentions": _per_text(text.strip_mentions, "documents", "doc_id", "text"),
    "unwrap_hashtags": _per_text(text.unwrap_hashtags, "pages", "page_id", "html"),
    "collapse_ws": _per_text(text.collapse_ws, "documents", "doc_id", "text"),
    "remove_web_noise": _per_text(text.remove_web_noise, "pages", "page_id", "html"),
    "convert_emoticons": _per_text(partial(symbols.convert_emoticons, emoticons=EMOTICONS), "pages", "page_id", "html"),
    "emoji_description": _per_text(symbols.emoji_description, "documents", "doc_id", "text"),
    "clean_structure": _per_text(text.clean_structure, "pages", "page_id", "html"),
    "dataset_shape": _profile(profiling.dataset_shape, "source"),
    "data_size": _profile(profiling.data_size, columns=("text", "lang", "source")),
    "missing_values": _profile(profiling.missing_values),
    "duplicate_rows": _profile(profiling.duplicate_rows, columns=("text", "lang", "quality")),
    "char_length_stats": _profile(profiling.char_length_stats, "text"),
    "word_count_stats": _profile(profiling.word_count_stats, "text"),
    "unique_texts": _profile(profiling.unique_texts, "text"),
    "longest_reviews": _profile(profiling.longest_reviews, "text", "doc_id"),
    "shortest_reviews": _profile(profiling.shortest_reviews, "text", "doc_id"),
    "label_balance": _profile(profiling.label_balance, "quality"),
    "describe_all": _profile(profiling.describe_all),
    "dataset_summary": _profile(profiling.dataset_summary, "quality", columns=_TEXT_COLUMNS),
    "chart_label_distribution": _profile(charts.chart_label_distribution, "quality"),
    "chart_histogram": _profile(charts.chart_histogram, "text"),
    "chart_boxplot": _profile(charts.chart_boxplot, "text"),
}
