import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from reviewmill.llm import pieces, queries

FOLDER = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load(MODEL)


@pytest.fixture(scope="module")
def encoder(vocabulary):
    return pieces.Encoder(vocabulary)


def test_random_texts_against_the_library(library, encoder):
    own = random.Random(1)
    parts = list("abcdetiosn  ▁\n\t0119ééß日本𝕏ñ\0") + ["▁▁▁", "ing", "the", "  ", "<s>", "<0x41>", "tion"]
    texts = ["".join(own.choice(parts) for _ in range(own.randrange(40))) for _ in range(5_000)]
    for text, ids in zip(texts, encoder.encoded(texts), strict=True):
        assert ids.tolist() == library.encode(text), text


@pytest.mark.parametrize("text", ["a" * 60_000, " " * 60_000, "=-" * 20_000, "𝕏é" * 5_000, "ab▁" * 9_999])
def test_long_texts_without_blanks(library, encoder, text):
    assert next(encoder.encoded([text])).tolist() == library.encode(text)


def test_long_random_word(library, encoder):
    own = random.Random(5)
    text = "".join(own.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(50_000))
    assert next(encoder.encoded([text])).tolist() == library.encode(text)


def test_border_check_against_merging(encoder):
    own = random.Random(2)
    some = own.sample(sorted(encoder.halves), 400) + sorted(encoder.halves)[:60]
    for _ in range(30_000):
        left, right = own.choice(some), own.choice(some)
        merged = encoder.merge(encoder.pieces[left] + encoder.pieces[right])[0]
        assert encoder.can_follow(left, right) == (merged == [left, right])


def test_few_words_and_pairs_remembered(library, vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "WORDS", 3)
    monkeypatch.setattr(pieces, "PARTS", 2)
    monkeypatch.setattr(pieces, "LONG", 8)
    monkeypatch.setattr(pieces, "PAIRS", 3)
    small = pieces.Encoder(vocabulary)
    texts = ["one two three four five six", "one seven two", "", "six unremembered words one"] * 3
    assert [x.tolist() for x in small.encoded(texts)] == library.encode(texts)
    assert len(small.known) <= 3 and len(small.known.old) <= 3 and len(small.parts) <= 2 and len(small.picks) <= 3


def test_decoding_any_ids(spark, library, vocabulary):
    own = random.Random(3)
    pools = [range(3, 259), range(259, 32_000), (0, 1, 2, 29871), range(3, 259)]
    lists = [[own.choice(own.choice(pools)) for _ in range(own.randrange(9))] for _ in range(3_000)]
    rows = spark.createDataFrame([*enumerate(lists), (-1, None)], "k int, ids array<int>")
    found = {r.k: r.text for r in rows.select("k", pieces.decode(spark, vocabulary, "ids").alias("text")).collect()}
    assert found.pop(-1) == ""
    assert found == {k: library.decode(ids) for k, ids in enumerate(lists)}


def test_nulls_blanks_repeats_and_clashing_columns(spark, documents, library, vocabulary):
    texts = {1: None, 2: "", 3: " ", 4: "  two  blanks ", 5: "same", 6: "same", 7: "x " * 9_000 + "y" * 9_000}
    docs = documents([(i, t, "s") for i, t in texts.items()]).withColumnRenamed("size", "ids")
    rows = docs.select("doc_id", "ids", pieces.encode(spark, vocabulary).alias("found")).collect()
    assert {r.doc_id: r.found for r in rows} == {i: library.encode(t or "") for i, t in texts.items()}
    both = pieces.round_trip(docs, vocabulary).collect()
    assert {r.doc_id: (r.ids, r.decoded) for r in both} == {
        i: (library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t in texts.items()
    }
    assert pieces.round_trip(documents([]), vocabulary).count() == 0
    assert documents([]).select(pieces.encode(spark, vocabulary).alias("ids")).count() == 0


def test_other_models_are_refused(monkeypatch):
    class Changing(sentencepiece.SentencePieceProcessor):
        def normalize(self, text):
            return text.strip()

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Changing)
    with pytest.raises(ValueError, match="changes texts"):
        pieces.Vocabulary.load(MODEL)


def test_query_against_the_library(spark, library):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    found = {r.doc_id: r for r in queries.op12_sentencepiece(spark, FOLDER).collect()}
    assert len(found) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "")
        row = found[d.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
