import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewmill.llm import queries, runs

FOLDER = "/root/testdata/sf0.001"


def brute(words, least=12):
    """{(start, length): smallest period} by looking at every period."""
    found = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q) and j > i:
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapse(words, found):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found)]


@pytest.mark.parametrize("alphabet", [1, 2, 3, 6])
def test_runs_against_every_period(alphabet):
    own = random.Random(alphabet)
    for case in range(250):
        n = own.randrange(0, 90)
        words = [own.randrange(alphabet) for _ in range(n)]
        if case % 2 and n:  # periods inside periods
            p = own.randrange(1, n + 1)
            words = [words[i % p] for i in range(n)]
            for _ in range(own.randrange(0, 3)):
                words[own.randrange(n)] = own.randrange(alphabet)
        for least in (2, 12):
            found = runs.find_runs(np.array(words, np.int64), runs.Rules(words=least))
            assert sorted(zip(*(x.tolist() for x in found), strict=True)) == brute(words, least), words


def test_two_periodic_regions_one_period_apart():
    for text in ("ababababab" "abababa" "abababa" "babababab", "ab" * 9 + "a" + "ab" * 9 + "a" + "ab" * 9, "aab" * 7 + "aabab" * 6):
        words = [ord(c) for c in text]
        found = runs.find_runs(np.array(words, np.int64))
        assert list(zip(*(x.tolist() for x in found), strict=True)) == sorted(brute(words))


def test_texts_nulls_blanks_repeats_and_a_long_text(spark, documents):
    rng = random.Random(3)
    long = " ".join(rng.choice("abc") + str(rng.randrange(300)) for _ in range(40_000))
    texts = {
        1: "a b " * 9 + "end", 2: None, 3: "", 4: " \t\x0b\n", 5: "x y " * 12, 6: long + (" one two three" * 5_000),
        7: "a b " * 9 + "end", 8: "word " * 11, 9: "word " * 12, 10: "a b c d e f\n" * 2,
    }
    docs = documents([*((i, t, "s") for i, t in texts.items()), (None, "q " * 12, "s")])
    rows = docs.select("doc_id", runs.periodic_runs().alias("r")).select("doc_id", "r.*").collect()
    by = {r.doc_id: r for r in rows}
    for i, text in texts.items():
        words = (text or "").encode().split()
        expected = [(40_000, 15_000, 3)] if i == 6 else brute(words)
        assert [tuple(r) for r in by[i].runs] == expected, i
        assert by[i].n_words == len(words)
        if i != 6:
            assert by[i].collapsed.encode().split() == collapse(words, expected)
    assert by[6].collapsed == long + " one two three"
    assert by[1].collapsed == "a b end" and by[1].runs == by[7].runs
    assert by[None].collapsed == "q"
    assert documents([]).select(runs.periodic_runs().alias("r")).count() == 0


def test_texts_of_a_batch_do_not_touch(spark, documents):
    docs = documents([(i, "same words", "s") for i in range(40)]).coalesce(1)
    assert docs.select(F.size(runs.periodic_runs()["runs"]).alias("n")).agg(F.sum("n")).first()[0] == 0


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    found = {r.doc_id: r for r in queries.op13_periodic_runs(spark, FOLDER).collect()}
    assert len(found) == len(docs)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    seen = 0
    for d in docs:
        words = (d.text or "").encode().split()
        if len(words) > 3_000:
            continue
        h = zlib.crc32(str(d.doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        expected = brute(words)
        seen += len(expected)
        best = max(expected, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        row = found[d.doc_id]
        assert (row.n_runs, row.start, row.length, row.period) == (len(expected), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if expected else None)
        assert row.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in expected).encode())
        assert row.collapsed_sha256 == sha(b" ".join(collapse(words, expected)))
    assert seen > 10
