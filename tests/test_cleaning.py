"""Literal cleaning cases and text expressions."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from reviewmill import config
from reviewmill.functions import candidates, symbols, text
from reviewmill.operators import features, fuzzy
from reviewmill.operators.vocabulary import Lexicons, normalize_vocab
from reviewmill.plans.cleaning import clean_text

SLANG = {"ga": "tidak", "bgt": "banget"}
WORDS = "barangnya bagus banget produk ini pengirimannya lama mantap sesuai deskripsi kirim saja".split()


@pytest.fixture(scope="module")
def lexicons(spark):
    return Lexicons(
        dictionary=spark.createDataFrame([(w,) for w in WORDS], "word string"),
        stopwords=spark.createDataFrame([("ini",), ("di",)], "word string"),
        slang=spark.createDataFrame(sorted(SLANG.items()), "token string, target string"),
        emoticons={":)": "positif", ":(": "negatif", "T_T": "negatif"},
        emojis={"😍": "positif", "😡": "negatif", "❤": "positif"},
        emoji_names={"🐱": "cat-face"},
    )


CASES = {
    "mantap b4nget 😍": "mantap banget positif",
    "deskrpsi ini ga sesuai 😡": "deskripsi tidak_sesuai negatif",
    "kirimmm lamaaa T_T": "kirim lama negatif",
    "PRODUK MANTAP SAJA... ❤️": "produk mantap saja positif",
    "belum kirim produk": "belum_kirim produk",
    "sesuaiii bgt :)": "sesuai banget positif",
    "baca http://misal.id/a?b=1 @penjual #bagusbanget": "baca bagusbanget",
    "@penjuál qrs": "qrs",
    "jangan tanpa bagus": "jangan tanpa_bagus",
    "bagus kurang": "bagus kurang",
    "saja lama": "saja lama",
    "🐱 🚀": "cat_face deskripsi_emoji",
    "": "",
}


def test_literal_cases(spark, lexicons):
    rows = spark.createDataFrame(list(enumerate(CASES)), "id bigint, text string")
    cleaned = {r.id: r.clean_text for r in clean_text(rows, "id", "text", lexicons).collect()}
    assert cleaned == dict(enumerate(CASES.values()))


def test_lexicon_tables_clean_as_maps_do(spark, lexicons):
    tables = replace(
        lexicons,
        emoticons=spark.createDataFrame(list(lexicons.emoticons.items()), "emoticon string, sentiment string"),
        emojis=spark.createDataFrame(list(lexicons.emojis.items()), "emoji string, token string"),
    )
    rows = spark.createDataFrame(list(enumerate(CASES)), "id bigint, text string")
    cleaned = {r.id: r.clean_text for r in clean_text(rows, "id", "text", tables).collect()}
    assert cleaned == dict(enumerate(CASES.values()))


def test_dictionary_words_stay(spark, lexicons):
    vocab = lexicons.dictionary.select(F.col("word").alias("token"), F.lit(1).alias("n"))
    for row in normalize_vocab(vocab, lexicons).collect():
        assert (row.normalized, row.source) == (row.token, "dictionary")


def _values(spark, rows, column):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], "t string").select(column).collect()]


EMOJI_CASES = {
    "★★ ok ✓ ♪": "★★ ok ✓ ♪",
    "a©b ™ ▶": "a deskripsi_emoji b  deskripsi_emoji   deskripsi_emoji ",
    "👍🏽": " deskripsi_emoji ",  # the known thumb does not win against the whole sequence
    "👍": " positif ",
    "❤️‍🔥": " deskripsi_emoji ",
    "❤️ ❤": " positif   positif ",
    "👩‍💻🐱": " woman_technologist  cat_face ",
    "🇮🇩 1️⃣": " deskripsi_emoji   deskripsi_emoji ",
}


def test_emoji_sequences_and_plain_symbols(spark):
    known, names = {"👍": "positif", "❤": "positif"}, {"👩‍💻": "woman technologist", "🐱": "cat-face"}
    assert _values(spark, EMOJI_CASES, symbols.convert_emojis(F.col("t"), known, names)) == list(EMOJI_CASES.values())
    assert _values(spark, EMOJI_CASES, symbols.count_emojis(F.col("t"), known)) == [0, 3, 1, 1, 1, 2, 2, 2]


def test_broken_encodings_are_repaired(spark):
    cases = {
        "ðŸ˜\x8d bagus 中": "😍 bagus 中",
        "😍 ü".encode().decode("latin1"): "😍 ü",
        "😍 é".encode().decode("latin1"): "😍 é".encode().decode("latin1"),  # the broken é holds ©, so nothing is gained
        "é": "é",
        "★ ok".encode().decode("latin1"): "★ ok".encode().decode("latin1"),  # no emoji to gain either
        "Ã©": "Ã©",  # no emoji to gain
        "plain": "plain",
    }
    assert _values(spark, cases, symbols.repair_mojibake(F.col("t"))) == list(cases.values())


def test_structure_is_idempotent(spark):
    rows = ["<b>A</b> b@c #d  e f", "Tidak   bagus!!", "é_9"]
    once = text.clean_structure(F.col("t"))
    assert _values(spark, rows, once) == _values(spark, rows, text.clean_structure(once))


def test_word_count_of_blank_text_is_zero(spark):
    assert _values(spark, ["", "  ", "a b"], text.word_count(F.col("t"))) == [0, 0, 2]


def test_candidates(spark):
    leet, repeats = spark.range(1).select(
        candidates.reading_candidates(F.lit("b4gu5")), F.sort_array(candidates.repeat_candidates(F.lit("laaamaa")))
    ).first()
    assert leet == ["bagus"]
    assert repeats == ["laaamaa", "laamaa", "lamaa"]


LOOKALIKES = {
    "b4gu5": {"bagus"}, "1n1": {"ini"}, "1ama": {"lama"}, "m4nt4ppp": {"mantap"}, "11111111": set(), "1111111a": set(), "s4ja1": set(),
    "b4gu55555": {"bagus"}, "in1": {"ini"}, "1lll4ma": {"lama"}, "lam444a": {"lama"}, "2ini": set(), "0455074550abc": set(),
}


def test_lookalikes_are_matched_without_readings(spark, lexicons):
    words = lexicons.dictionary
    tokens = spark.createDataFrame([(t,) for t in (*LOOKALIKES, "1" * 5000, "4" * 5000 + "b")], "token string")
    found = {}
    for r in fuzzy.lookalike_matches(tokens, words).collect():
        found.setdefault(r.token, set()).add(r.word)
    assert {t: found.pop(t, set()) for t in LOOKALIKES} == LOOKALIKES and not found


def test_long_and_ambiguous_tokens(spark, lexicons):
    vocab = spark.createDataFrame(
        [("pengir1mannya1",), ("k1111rim",), ("p3ngirlmannya",), ("acgt" * 1250,), ("1a" * 2500,), ("ha" * 60,)], "token string"
    )
    found = {r.token: (r.normalized, r.source) for r in normalize_vocab(vocab, lexicons).collect()}
    assert found["pengir1mannya1"] == ("pengirimannya", "leet")
    assert found["p3ngirlmannya"] == ("pengirimannya", "leet")
    assert found["k1111rim"] == ("kirim", "leet")
    assert all(s == "not_found" for t, (_, s) in found.items() if len(t) > 100)


NEGATED = {"tidak bagus": "tidak_bagus", "ga bagus": "tidak_bagus", "jangan kirim lama": "jangan_kirim lama", "ini produk": "produk"}


def test_negations_stay_even_if_they_are_stopwords(spark, lexicons):
    listed = [*config.NEGATIONS, "ini", "di", "produk", "Tidak"]
    stops = spark.createDataFrame([(w,) for w in listed], "word string")
    rows = spark.createDataFrame(list(enumerate(NEGATED)), "id bigint, text string")
    cleaned = {r.id: r.clean_text for r in clean_text(rows, "id", "text", replace(lexicons, stopwords=stops, kept_words=("produk",))).collect()}
    assert cleaned == dict(enumerate(NEGATED.values()))


@pytest.mark.parametrize("a, b, score", [("bgus", "bagus", 88.8889), ("kitten", "sitting", 61.5385), ("pengrimannya", "pengirimannya", 96.0), ("a", "ab", 90.0)])
def test_scores(spark, a, b, score):
    row = spark.createDataFrame([(a, b)], "a string, b string").select(candidates.fuzzy_score("a", "b")).first()
    assert row[0] == pytest.approx(score, abs=1e-4)


def test_quick_rule_outs_give_what_the_plain_patterns_give(spark):
    rows = ["", None, " ", "\u00a0", "a", " a", "a\u2003", "a \n b", "\ta b\r\n", "<b>x</b>@y #z_é#q www.x WWW.Y hTTps://a b://c <", "é Ab\u00a0c ünder_x 12 x", "\u212awww.x", "a\n\nb-C"]
    texts = spark.createDataFrame([(r,) for r in rows], "t string")
    t, ws = F.col("t"), text.WS
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(t, text.HTML_TAG, " "), text.URL, " "), text.MENTION, " "), text.HASHTAG, " $1 ")
    pairs = [
        (text.strip_markup(t), bare),
        (text.clean_structure(t), F.trim(F.regexp_replace(F.lower(bare), "[^a-z0-9_]+", " "))),
        (text.strip_ws(t), F.regexp_replace(t, f"^[{ws}]+|[{ws}]+$", "")),
        (features.words_of(t), F.regexp_extract_all(F.lower(t), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))),
    ]
    for quick, plain in pairs:
        assert texts.filter(~quick.eqNullSafe(plain)).collect() == []
    grams = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],), (None,)], "w array<string>").select(features.ngrams_of("w", 1, 3).alias("g"))
    assert [r.g for r in grams.collect()] == [["a", "b", "c", "a b", "b c", "a b c"], ["a"], [], None]
    assert "(?U)" not in str(text.clean_structure(t)) and "regexp_extract_all" in str(text.clean_structure(t))
