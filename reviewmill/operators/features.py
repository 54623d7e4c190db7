"""Split, n-grams, document frequency and TF-IDF as long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.scale import HOT_KEYS, by_repeats, deal, few, hot_cold_join, materialize

_BUCKET_DIGITS = 4  # 65,536 hash buckets per label


def split_quotas(counts: DataFrame, test_size: float) -> DataFrame:
    """(label, quota): test rows per class, ``ceil(test_size * n)`` in total.

    Whole shares first, then the largest remainders; equal remainders go to the
    smaller label. One row per class.
    """
    classes = Window.partitionBy(F.lit(0))  # one row per class
    total = F.sum("n").over(classes)
    tests = F.ceil(F.lit(test_size) * total)
    shares = counts.select("label", tests.alias("tests"), (F.col("n") * tests / total).alias("exact"))
    floors = shares.withColumn("whole", F.floor("exact"))
    place = F.row_number().over(classes.orderBy(F.desc(F.col("exact") - F.col("whole")), "label"))
    spare = F.col("tests") - F.sum("whole").over(classes)
    return floors.select(
        "label", (F.col("whole") + F.when(place <= spare, 1).otherwise(0)).cast("bigint").alias("quota")
    )


def split_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(str(seed)), F.lit("|"), F.col(key).cast("string")))


def stratified_split(df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """``df`` with BOOLEAN ``is_test``: per class, the quota of rows with the smallest hash.

    Rows are counted in 65,536 hash buckets per class; only the bucket where the
    quota is reached is ranked, which gives one exact cut-off hash per class. So
    a class with most of the rows is never sorted in one task.
    """
    rows = materialize(df.select(F.col(label).alias("label"), F.col(key).alias("key"), split_hash(key, seed).alias("hash")))
    rows = rows.withColumn("bucket", F.substring("hash", 1, _BUCKET_DIGITS))
    buckets = rows.groupBy("label", "bucket").agg(F.count("*").alias("n"))
    quotas = F.broadcast(split_quotas(buckets.groupBy("label").agg(F.sum("n").alias("n")), test_size))
    upto = F.sum("n").over(Window.partitionBy("label").orderBy("bucket"))
    edges = (
        buckets.withColumn("upto", upto)
        .join(quotas, "label")
        .filter((F.col("quota") > 0) & (F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("n") < F.col("quota")))
        .select("label", "bucket", (F.col("quota") - F.col("upto") + F.col("n")).alias("left"))
    )  # one row per class
    ranked = rows.join(F.broadcast(edges), ["label", "bucket"]).withColumn(
        "place", F.row_number().over(Window.partitionBy("label", "bucket").orderBy("hash", "key"))
    )
    cuts = ranked.filter(F.col("place") == F.col("left")).select(
        F.col("label").alias("_label"), F.struct("hash", "key").alias("_cut")
    )  # one row per class
    mine = F.struct(split_hash(key, seed).alias("hash"), F.col(key).alias("key"))
    return (
        df.join(F.broadcast(cuts), F.col(label) == F.col("_label"), "left")
        .withColumn("is_test", F.coalesce(mine <= F.col("_cut"), F.lit(False)))
        .drop("_label", "_cut")
    )


def words_of(text: Column) -> Column:
    """Words of two or more characters of already cleaned text, in order. ASCII texts need no tables of Unicode."""
    wide = F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))
    plain = F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9_]{2,}"), F.lit(0))
    return F.when(F.octet_length(text) == F.length(text), plain).otherwise(wide)


def ngrams_of(words: str, low: int = 1, high: int = 2) -> Column:
    """All n-grams of ``low`` to ``high`` adjacent words of an array column, joined by spaces."""
    grams = [words]
    for n in range(2, high + 1):
        room = f"greatest(size({words}) - {n - 1}, 0)"
        grams.append(f"zip_with(slice({grams[-1]}, 1, {room}), slice({words}, {n}, {room}), (a, b) -> concat(a, ' ', b))")
    return F.expr(f"concat({', '.join(grams[low - 1:])})")


def _counted(df: DataFrame, keep: tuple[str, ...], items: Column) -> DataFrame:
    """(id, *keep, term, tf) of each row's array: sorted, equal values lie side by side, and a count is the way to the next."""
    rows = df.select("id", *keep, F.sort_array(items).alias("_all"))
    starts = "filter(if(size(_all) > 0, sequence(0, size(_all) - 1), array()), i -> i = 0 or get(_all, i) <> get(_all, i - 1))"
    placed = rows.select("id", *keep, "_all", F.expr(starts).alias("_starts"))
    runs = placed.select("id", *keep, "_all", "_starts", F.posexplode_outer("_starts").alias("_run", "_start")).filter("_start IS NOT NULL")
    after = F.coalesce(F.get("_starts", F.col("_run") + 1), F.size("_all"))
    return runs.select("id", *keep, F.get("_all", F.col("_start")).alias("term"), (after - F.col("_start")).cast("bigint").alias("tf"))


def _terms(df: DataFrame, keep: tuple[str, ...], low: int, high: int) -> DataFrame:
    """(id, *keep, term). The outer explode keeps the optimiser from computing the words again to drop empty texts."""
    words = df.select("id", *keep, words_of(F.col("text")).alias("words"))
    terms = words.select("id", *keep, F.explode_outer(ngrams_of("words", low, high)).alias("term"))
    return terms.filter("term IS NOT NULL")


def vectorizer_tokens(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """(id, pos, token)"""
    words = df.select(F.col(row_id).alias("id"), F.posexplode_outer(words_of(F.col(text))).alias("pos", "token"))
    return words.filter("token IS NOT NULL")


def ngrams_1_2(df: DataFrame, row_id: str, text: str, low: int = 1, high: int = 2) -> DataFrame:
    """(id, term): one row per n-gram occurrence."""
    return _terms(df.select(F.col(row_id).alias("id"), F.col(text).alias("text")), (), low, high)


def term_counts(df: DataFrame, row_id: str, text: str, low: int = 1, high: int = 2, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, term, tf).

    Whole texts are spread by id first: the compact text travels instead of its
    n-grams, and the counts per (id, term) need no further exchange. Texts alone
    under their id are counted by themselves, only the others are grouped.
    """
    single, several = by_repeats(df.select(F.col(row_id).alias("id"), *keep, F.col(text).alias("text")), "id")
    words = deal(single, "id").select("id", *keep, words_of(F.col("text")).alias("words"))
    counts = _counted(words, keep, ngrams_of("words", low, high))
    if several is None:
        return counts
    grouped = _terms(deal(several, "id"), keep, low, high).groupBy("id", *keep, "term").agg(F.count("*").alias("tf"))
    return counts.unionByName(grouped)


def document_frequency(counts: DataFrame, n_docs: int | Column, min_df: int = 2, max_df: float = 0.95) -> DataFrame:
    """(term, df) of terms with ``min_df <= df <= max_df * n_docs``; ``counts`` has one row per (id, term)."""
    frequency = counts.groupBy("term").agg(F.count("*").alias("df"))
    n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    return frequency.filter((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n))


def tf(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """(id, term, tf) restricted to the vocabulary; ``counts`` is read twice, frequent terms stay where they are."""
    return hot_cold_join(counts, vocab.select("term"), "term", vocab, "df", HOT_KEYS, True).select("id", "term", "tf")


def idf_smooth(vocab: DataFrame, n_docs: int | Column) -> DataFrame:
    """(term, df, idf) with ``ln((1 + n) / (1 + df)) + 1``."""
    n = n_docs if isinstance(n_docs, Column) else F.lit(n_docs)
    return vocab.select("term", "df", (F.log((n + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def tfidf_l2(counts: DataFrame, vocab: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, term, weight): tf * idf divided by the document's length.

    The squared lengths are one aggregate per document, joined back; they are stored
    first and moved instead of the weights if they are few.
    """
    raw = materialize(
        hot_cold_join(counts, vocab.select("term", "idf"), "term", vocab, "df", HOT_KEYS, True).select(
            "id", *keep, "term", (F.col("tf") * F.col("idf")).alias("raw")
        )
    )
    squares = materialize(raw.groupBy("id").agg(F.sum(F.col("raw") * F.col("raw")).alias("square")))
    return raw.join(few(squares), "id").select("id", *keep, "term", (F.col("raw") / F.sqrt("square")).alias("weight"))
