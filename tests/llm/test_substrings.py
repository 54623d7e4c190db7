import hashlib
import random

import pytest

from reviewmill.llm import substrings


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for raw in raws:
        for k in range(len(raw) - length + 1):
            seen[raw[k : k + length]] = seen.get(raw[k : k + length], 0) + 1
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if seen[raw[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, documents, texts, length, gram, cell):
    docs = documents([(i, t, "s") for i, t in enumerate(texts)])
    rows = substrings.remove_repeated(docs, length=length, gram=gram, cell=cell).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows] == brute(texts, length)
    for r, text in zip(rows, texts):
        raw = (text or "").encode()
        edges = [0, *(x for s in r.spans for x in (s.start, s.stop)), len(raw)]
        assert b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])) == bytes(r.kept)


def test_random_texts_against_brute_force(spark, documents):
    own = random.Random(3)
    passages = ["".join(own.choice("abcé ") for _ in range(n)) for n in (39, 40, 41, 60, 200)]
    texts = [None, "", "short", passages[1], passages[1], "a" * 300, "ab" * 150, "a" * 45]
    for _ in range(60):
        noise = ["".join(own.choice("abcdefgh") for _ in range(own.randrange(80))) for _ in range(4)]
        texts.append("".join(n + own.choice([*passages, ""]) for n in noise))
    check(spark, documents, texts, 40, 8, 17)


def test_crowded_cores_are_divided(spark, documents, monkeypatch):
    monkeypatch.setattr(substrings, "TOGETHER", 3)
    own = random.Random(5)
    passage = "".join(own.choice("abcdef") for _ in range(52))
    texts = []
    for _ in range(40):
        a, b = ("".join(own.choice("xyz") for _ in range(own.randrange(1, 30))) for _ in range(2))
        texts.append(a + passage[own.randrange(4) : 52 - own.randrange(4)] + b)
    check(spark, documents, texts, 40, 8, 17)


def test_long_texts_are_hashed_in_parts(spark, documents, monkeypatch):
    monkeypatch.setattr(substrings, "PART", 64)
    own = random.Random(9)
    base = "".join(own.choice("abcd") for _ in range(700))
    check(spark, documents, [base, base[100:500] + "!" + base[300:], "q" * 200], 40, 8, 17)


def test_one_cell_and_single_offsets(spark, documents):
    own = random.Random(11)
    base = "".join(own.choice("abcd") for _ in range(300))
    texts = [base, "zz" + base[50:200] + "yy", base[10:49]]
    check(spark, documents, texts, 40, 8, 33)
    check(spark, documents, texts, 40, 8, 1)
    with pytest.raises(ValueError):
        substrings.remove_repeated(documents([(1, "a", "s")]), length=40, gram=8, cell=34)


def test_repeated_rows_null_keys_and_empty_table(spark, documents):
    text = "".join(random.Random(2).choice("abcd") for _ in range(60))
    docs = documents([(1, text, "s"), (1, text, "s"), (None, "kept as it is" * 2, "s")])
    rows = substrings.remove_repeated(docs, length=40, gram=8, cell=17).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in rows) == [(0, 0), (1, 60), (1, 60)]
    assert substrings.remove_repeated(documents([])).count() == 0
