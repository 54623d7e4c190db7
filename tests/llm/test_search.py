import math
import random
import re

import pytest

from reviewmill.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, k=10):
    """{item place: [(key, score)]} by scoring every document; keys may repeat."""
    held = [(key, terms(text)) for key, text in docs]
    held = [(key, words) for key, words in held if words]
    n_docs, n_terms = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, words in held:
        for t in set(words):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for key, words in held:
            m = 100 - 90 + (90 * len(words) * n_docs) // n_terms
            score = 0
            for t in set(terms(text)):
                tf = words.count(t)
                if tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((key, score))
        scored.sort(key=lambda r: (-r[1], r[0] is None, r[0] or 0))
        out.append((item, scored[:k]))
    return out


def ranked(spark, documents, docs, items):
    queries = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, rank int, score string")
    found = search.rank(documents([(i, t, "s") for i, t in docs]), queries).collect()
    out = {}
    for r in sorted(found, key=lambda r: (r.item_id if r.item_id is not None else -1, r.rank)):
        out.setdefault(r.item_id, []).append((r.rank, r.doc_id, r.score))
    return out


@pytest.fixture
def texts():
    own = random.Random(4)
    words = [f"w{int(own.paretovariate(0.6)) % 400}" for _ in range(4_000)]
    docs = [(i, " ".join(own.choice(words) for _ in range(own.randrange(1, 60)))) for i in range(900)]
    docs += [(1_000 + i, docs[i % 3][1]) for i in range(200)]  # ties
    items = [(i, " ".join(own.choice(words) for _ in range(own.randrange(1, 25)))) for i in range(30)]
    items += [(50 + i, docs[i][1]) for i in range(6)]
    return docs, items


@pytest.mark.parametrize("block", [(search.BLOCK, search.SHORT, search.CELLS), (8, 2, 40_000), (16, 0, 9_000)])
def test_against_scoring_every_document(spark, documents, texts, monkeypatch, block):
    for name, value in zip(("BLOCK", "SHORT", "CELLS"), block, strict=True):
        monkeypatch.setattr(search, name, value)
    found = ranked(spark, documents, *texts)
    for item, best in brute(*texts):
        assert found.get(item, []) == [(r + 1, key, score) for r, (key, score) in enumerate(best)]


def test_several_parts_of_queries(spark, documents, texts, monkeypatch):
    monkeypatch.setattr(search, "QUERY_BYTES", 900)
    docs, items = texts[0][:300], texts[1]
    found = ranked(spark, documents, docs, items)
    assert {i: [x[1:] for x in v] for i, v in found.items()} == {i: best for i, best in brute(docs, items) if best}


def test_nulls_blanks_letters_repeats_and_long_texts(spark, documents):
    docs = [
        (5, None), (6, ""), (7, " .,! "), (1, "Été ÉTÉ été"), (2, "ABC abc-def"), (3, "abc"), (3, "abc"), (None, "abc"),
        (4, "long " * 30_000 + "rare"), (8, "x\u0080y   z"), (9, "other words that nobody asks for"),
    ]
    items = [(1, "abc"), (2, None), (3, ""), (4, "rare Été"), (5, "x\u0080Y  "), (6, "nowhere"), (None, "def def")]
    found = ranked(spark, documents, docs, items)
    assert {i: [x[1:] for x in v] for i, v in found.items()} == {i: best for i, best in brute(docs, items) if best}
    assert [x[1] for x in found[1]] == [2, 3, 3, None]


def test_empty_tables(spark, documents):
    assert ranked(spark, documents, [], [(1, "abc")]) == {}
    assert ranked(spark, documents, [(1, "abc")], []) == {}


def test_blocks_are_skipped_only_below_the_threshold(texts, monkeypatch):
    import numpy as np

    monkeypatch.setattr(search, "BLOCK", 16)
    monkeypatch.setattr(search, "SHORT", 4)
    docs, items = texts
    queries = search.Queries.of(items)
    place = {t: i for i, t in enumerate(queries.terms)}
    corpus = search.Corpus(len(docs), sum(len(terms(t)) for _, t in docs))
    first, ids, values = [0], [], []
    df = np.zeros(len(place), np.int64)
    for _, text in docs:
        words = [w.encode() for w in terms(text)]
        for t in sorted({w for w in words if w in place}):
            ids.append(place[t])
            df[place[t]] += 1
            values.append(corpus.values(np.array([words.count(t)]), np.array([len(words)]))[0])
        first.append(len(ids))
    weight = corpus.weight(df)
    lists = search.Lists(np.array(first), np.array(ids), np.array(values))
    shard = search.Shard.build([i for i, _ in docs], lists, weight).open()
    skipped = 0
    for wanted in queries.of_item:
        columns = np.searchsorted(shard.local, wanted)
        scores = (shard.table[:, columns] * weight[wanted]).sum(axis=1)
        for least in np.sort(scores)[[-1, -5, -50, -300]].tolist():
            some = shard.candidates(columns, weight[wanted], max(1, least), few=False)
            assert set(np.flatnonzero((scores >= least) & (scores > 0))) <= set(some.tolist())
            skipped += len(docs) - len(some)
    assert skipped > 0
