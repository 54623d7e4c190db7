"""The join keys of the similarity search against brute force."""

import random

import pytest

from reviewmill.functions.candidates import fuzzy_score
from reviewmill.operators.fuzzy import fuzzy_matches


def _lcs(a: str, b: str) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def _score(a: str, b: str) -> float:
    score = (1 - (len(a) + len(b) - 2 * _lcs(a, b)) / (len(a) + len(b))) * 100
    long, short = sorted((a, b), key=len, reverse=True)
    if len(long) * 2 < len(short) * 3:
        return score
    m = len(short)
    windows = [long[max(0, s) : s + m] for s in range(1 - m, len(long))]
    best = max(200 * _lcs(short, w) / (m + len(w)) for w in windows)
    return max(score, (0.9 if len(long) <= 8 * m else 0.6) * best)


def _variant(word: str, rng: random.Random) -> str:
    letters = list(word)
    for _ in range(rng.randint(0, 7)):
        place = rng.randrange(1, len(letters) + 1)
        if rng.random() < 0.5 and len(letters) > 2 and place < len(letters):
            del letters[place]
        else:
            letters.insert(place, rng.choice("abc"))
    return "".join(letters)


def test_scores_of_windows_equal_an_exhaustive_search(spark):
    """Lengths 1 to 60 on both sides, and words beyond the bits of a number."""
    rng = random.Random(5)
    pairs = []
    for size in range(1, 61):
        word = "".join(rng.choice("abcde") for _ in range(size))
        for other in (rng.randrange(1, 61), max(1, size * 3 // 5), min(60, size * 8 // 5)):
            text = list((word * 60)[rng.randrange(size) :][:other])
            for _ in range(rng.randrange(3)):
                text[rng.randrange(other)] = rng.choice("abcde")
            pairs.append((word, "".join(text)))
    pairs += [("ab" * 40, "ba" * 41), ("abc" * 25, "cab"), ("a", "b" * 9 + "a"), ("", "a"), ("a", "")]
    rows = spark.createDataFrame(pairs, "a string, b string").repartition(8)
    for r in rows.select("a", "b", fuzzy_score("a", "b").alias("score")).collect():
        expected = _score(r.a, r.b) if r.a and r.b else 0.0
        assert r.score == pytest.approx(expected, abs=1e-9), (r.a, r.b)


@pytest.mark.parametrize("ratio, threshold", [(0.4, 85), (0.6, 80)])
def test_long_words_that_match_by_a_window(spark, ratio, threshold):
    rng = random.Random(11)
    words = {"".join(rng.choice("abcdefgh") for _ in range(rng.randint(8, 45))) for _ in range(120)}
    tokens = set()
    for w in words:
        for _ in range(3):
            part = list(w[: rng.randrange(len(w) // 2, len(w) + 1)])
            for _ in range(rng.randrange(3)):
                place = rng.randrange(1, len(part))
                part[place : place + rng.randrange(2)] = rng.choice("abcdefgh")
            tokens.add("".join(part) + "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(12))))
        tokens.add(w[:-1] + "".join(rng.choice("abcdefgh") for _ in range(len(w) * 3 // 2 + 2 - len(w))))
    expected = {
        (t, w): round(_score(t, w), 6)
        for t in tokens
        for w in words
        if t[0] == w[0] and abs(len(t) - len(w)) <= max(1, int(len(t) * ratio)) and _score(t, w) >= threshold - 1e-9
    }
    found = fuzzy_matches(
        spark.createDataFrame([(t,) for t in tokens], "token string"),
        spark.createDataFrame([(w,) for w in words], "word string"), ratio, threshold,
    ).collect()
    assert {(r.token, r.word): round(r.score, 6) for r in found} == expected
    base = {k for k, v in expected.items() if (1 - (len(k[0]) + len(k[1]) - 2 * _lcs(*k)) / (len(k[0]) + len(k[1]))) * 100 < threshold}
    assert any(t not in w and w not in t for t, w in base)


@pytest.mark.parametrize("ratio, threshold", [(0.25, 85), (0.4, 88), (0.25, 70)])
def test_matches_equal_brute_force(spark, ratio, threshold):
    rng = random.Random(7)
    words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 34))) for _ in range(150)}
    tokens = {_variant(w, rng) for w in words for _ in range(3)} | {"a", "ab", "abc"}
    expected = {
        (t, w): round(_score(t, w), 6)
        for t in tokens
        for w in words
        if t[0] == w[0] and abs(len(t) - len(w)) <= max(1, int(len(t) * ratio)) and _score(t, w) >= threshold - 1e-9
    }
    found = fuzzy_matches(
        spark.createDataFrame([(t,) for t in tokens], "token string"),
        spark.createDataFrame([(w,) for w in words], "word string"),
        ratio,
        threshold,
    ).collect()
    assert len(found) == len({(r.token, r.word) for r in found})
    assert {(r.token, r.word): round(r.score, 6) for r in found} == expected
