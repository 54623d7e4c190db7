"""One query for each operator, over its whole table, with the parameters it runs with in production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm import (
    decontaminate,
    embeddings,
    langid,
    minhash,
    mixing,
    pieces,
    runs,
    search,
    sharding,
    substrings,
    toxicity,
    units,
    url_filter,
)
from reviewmill.llm.base import table

URL_RULES = (
    url_filter.Rule("com", "/", "allow"),
    url_filter.Rule("example.com", "/en/", "block"),
    url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"),
    url_filter.Rule("net", "/fr/", "block"),
)
#: Where no rule fits: hosts and paths that name gambling and pills.
URL_GLOBS = tuple(url_filter.Glob(f"**{word}**", "block") for word in ("casino", "free-bets", "cheap-pills"))


def _bucket(key: str, of: int):
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(of))


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.remove_repeated(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


def op2_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"), words=4).drop("_fp")


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Passages also stand inside lines, so units are sentences; stretches below 20 words are stock phrases and stay."""
    return units.remove_repeated_units(table(spark, folder, "documents"), pattern=units.SENTENCE, least_words=20)


def op4_pivotal_mix(spark: SparkSession, folder: str) -> DataFrame:
    plan = mixing.mix(table(spark, folder, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op5_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_filter.filter_urls(table(spark, folder, "pages"), "url", URL_RULES, URL_GLOBS)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(table(spark, folder, "documents"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.train(docs, labels.filter(_bucket("doc_id", 5) != 0))
    score = toxicity.score_toxicity(docs, model)
    return docs.select("doc_id", (_bucket("doc_id", 5) == 0).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = langid.train(docs.filter(_bucket("doc_id", 4) != 2))
    found = docs.select(
        "doc_id", (_bucket("doc_id", 4) == 2).alias("held_out"), langid.label_languages(docs, model).alias("found")
    )
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def op10_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    vocabulary = pieces.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))
    found = pieces.round_trip(table(spark, folder, "documents"), vocabulary)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``text`` as op13 takes it: a tenth of the documents, by hash of their id, repeat from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    cut = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    cut = cut.withColumn("n", F.size("words")).withColumn("a", F.expr("CAST(CASE WHEN n > 0 THEN g % n END AS INT)"))
    cut = cut.withColumn("p", F.expr("CAST(1 + (n - a) DIV (3 + g % 8) AS INT)"))
    turns = F.expr("flatten(array_repeat(slice(words, a + 1, p), 1 + CAST((n - a) DIV p AS INT)))")
    repeated = F.array_join(F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), turns), F.lit(1), F.col("n")), " ")
    return cut.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = with_planted_periods(table(spark, folder, "documents")).select("doc_id", runs.periodic_runs().alias("found"))
    lines = F.transform("found.runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("found.runs") > 0, "\n").otherwise(""))
    longest = F.array_max(F.transform("found.runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    described = found.select(
        "doc_id",
        F.size("found.runs").cast("long").alias("n_runs"),
        (-longest["col2"]).alias("start"),
        longest["length"].alias("length"),
        (-longest["col3"]).alias("period"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("found.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    return described.withColumn("exponent_milli", F.expr("(1000 * length) DIV period"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup, op2_minhash_dedup, op3_line_dedup, op4_pivotal_mix, op5_url_filter,
        op6_decontamination, op7_kd_shards, op8_toxicity, op9_language, op10_embedding_dedup,
        op11_lexical_search, op12_sentencepiece, op13_periodic_runs,
    )
}
