import random

import pytest
from pyspark.sql import functions as F

from reviewmill.functions import symbols as by_map
from reviewmill.operators import symbols

PARTS = [":", ")", "-", "(", "D", ":)", ":-)", ":-))", "x", "é", " ", "=3", "😍", "❤️", "❤", "👩‍💻", "👍🏽", "🇮🇩", "#️⃣", "★", "©", "a", "word"]


@pytest.fixture(scope="module")
def texts(spark):
    own = random.Random(8)
    rows = [(i, "".join(own.choice(PARTS) for _ in range(own.randrange(25)))) for i in range(250)]
    rows += [(900, None), (901, ""), (902, ":-)" * 4_000), (903, "no symbol here"), (904, "👩‍💻‍👩" + "‍👩" * 50 + " end")]
    return spark.createDataFrame([(i, t, "kept", 1, 2) for i, t in rows], "id int, text string, token string, start int, row int").repartition(4)


def same(found, expected):
    assert {r.id: r.text for r in found.collect()} == {r.id: r.text for r in expected.collect()}


def test_emoticons_by_table_equal_those_by_map(spark, texts):
    known = {":)": "positif", ":-)": "positif", ":-))": "sangat", ")-": "aneh", "-)": "netral", "=3": "netral", "x:": "negatif", "😍:": "positif", ":-": "kurang", "D": "d"}
    table = spark.createDataFrame([*known.items(), ("", "empty")], "emoticon string, sentiment string")
    found = symbols.convert_emoticons(texts, "id", "text", table)
    assert found.columns == texts.columns
    same(found, texts.withColumn("text", by_map.convert_emoticons(F.col("text"), known)))
    count = symbols.symbol_count(symbols.emoticon_matches(texts, "id", "text", table), "n").first().n
    assert count == texts.agg(F.sum(by_map.count_emoticons(F.col("text"), known))).first()[0]


def test_a_hundred_thousand_emoticons(spark, texts):
    own = random.Random(2)
    known = {":)": "positif", ":-)": "positif", "=3": "netral"}
    while len(known) < 100_000:
        known["".join(own.choice(":-)(=3xDé;8~^*") for _ in range(own.randrange(3, 9)))] = own.choice(["a", "b"])
    table = spark.createDataFrame(list(known.items()), "emoticon string, sentiment string")
    found = {r.id: r.text for r in symbols.convert_emoticons(texts, "id", "text", table).collect()}
    longest = max(map(len, known))
    for r in texts.collect():
        if r.text is None or len(r.text) > 5_000:
            continue
        out, at = [], 0
        while at < len(r.text):
            size = next((n for n in range(longest, 0, -1) if at + n <= len(r.text) and r.text[at : at + n] in known), 0)
            out.append(f" {known[r.text[at : at + size]]} " if size else r.text[at])
            at += size or 1
        assert found[r.id] == "".join(out)


def test_emoji_by_table_equal_those_by_map(spark, texts):
    tokens = {"😍": "positif", "❤": "cinta", "★": "bintang", "x★": "dua", "👍": "jempol", "a😍": "tiga"}
    names = {"👩‍💻": "woman technologist", "❤️": "red-heart", "🇮🇩": "flag", "©": "-", "word★": "named"}
    emojis = spark.createDataFrame(list(tokens.items()), "emoji string, token string")
    named = spark.createDataFrame(list(names.items()), "emoji string, name string")
    same(symbols.convert_emojis(texts, "id", "text", emojis, named), texts.withColumn("text", by_map.convert_emojis(F.col("text"), tokens, names)))
    same(symbols.convert_emojis(texts, "id", "text", emojis), texts.withColumn("text", by_map.convert_emojis(F.col("text"), tokens)))


def test_empty_tables(spark, texts):
    none = spark.createDataFrame([], "emoticon string, sentiment string")
    same(symbols.convert_emoticons(texts, "id", "text", none), texts)
    table = spark.createDataFrame([(":)", "x")], "emoticon string, sentiment string")
    assert symbols.convert_emoticons(texts.limit(0), "id", "text", table).count() == 0
