import random

import numpy as np

from reviewmill.llm import decontaminate as dc


def brute(texts, items, rules):
    """{(doc, item): most equal words of a stretch}, every shift and every stretch tried."""
    out = {}
    for i, text in texts:
        a = dc.words_of(text)
        for k, item in items:
            b = dc.words_of(item)
            best = 0
            for shift in range(-len(b) + 1, len(a)):
                equal = [a[p] == b[p - shift] for p in range(max(0, shift), min(len(a), shift + len(b)))]
                for x in range(len(equal)):
                    n = 0
                    for y in range(x, len(equal)):
                        n += equal[y]
                        if n >= rules.share * (y - x + 1):
                            best = max(best, n)
            if b and best >= min(rules.words, len(b)):
                out[i, k] = best
    return out


def found(spark, documents, texts, items, **options):
    docs = documents([(i, t, "s") for i, t in texts])
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in dc.find_overlaps(docs, bench, **options).collect()}


def test_substituted_passages_are_found_and_others_left(spark, documents, prose):
    own = random.Random(2)
    items = [(k, prose(n, seed=k)) for k, n in enumerate((40, 25, 15, 13, 12, 7, 1))] + [(20, None), (21, "..."), (22, prose(30, seed=77))]
    texts = [(900, None), (901, ""), (902, prose(400, seed=500))]
    for j in range(40):
        k, item = own.choice(items[:6])
        words = item.split()
        if len(words) > 20:  # every ninth word or so differs
            for at in range(own.randrange(9), len(words), 9):
                words[at] = f"other{own.randrange(99)}"
        body = [*prose(own.randrange(40), seed=600 + j).split(), *words, *prose(own.randrange(40), seed=700 + j).split()]
        texts.append((j, ", ".join(body).upper() if own.random() < 0.3 else " ".join(body)))
    got = found(spark, documents, texts, items)
    want = brute(texts, items, dc.Rules())
    assert set(got) == set(want)
    for key, overlap in got.items():
        text, item = dc.words_of(dict(texts)[key[0]]), dc.words_of(dict(items)[key[1]])
        a = text[overlap.first_word : overlap.first_word + overlap.n_span]
        b = item[overlap.item_first_word : overlap.item_first_word + overlap.n_span]
        assert sum(x == y for x, y in zip(a, b, strict=True)) == overlap.n_equal >= 0.8 * overlap.n_span


def test_passes_give_the_same_result(spark, documents, prose, monkeypatch):
    items = [(k, prose(20, seed=k)) for k in range(12)]
    texts = [(k, "before " + items[k][1] + " after " + items[(k + 3) % 12][1]) for k in range(12)]
    whole = found(spark, documents, texts, items)
    monkeypatch.setattr(dc, "PASS_BYTES", 300)
    assert set(found(spark, documents, texts, items)) == set(whole) == {(k, j) for k in range(12) for j in (k, (k + 3) % 12)}
    # each pass is a job by itself: no task holds the indexes of two
    docs = documents([(i, t, "s") for i, t in texts] + [(99, "clean", "s")])
    bench = spark.createDataFrame(items, "item_id long, text string")
    for result in (dc.find_overlaps(docs, bench), dc.decontaminate(docs, bench)):
        assert result._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") <= 1
    assert [r.doc_id for r in dc.decontaminate(docs, bench).collect()] == [99]


def test_filter_keeps_columns_and_takes_empty_tables(spark, documents, prose):
    item = prose(20, seed=5)
    docs = documents([(1, "x " + item, "s"), (2, prose(50, seed=6), None), (2, None, "s")])
    bench = spark.createDataFrame([(1, item), (1, item)], "item_id long, text string")
    kept = dc.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 2]
    assert dc.decontaminate(docs, bench.limit(0)).count() == 3
    assert dc.decontaminate(documents([]), bench).count() == 0


def test_masks_ignore_their_zeros():
    codes = np.arange(20, dtype=np.uint64)
    for mask in dc.MASKS:
        changed = codes.copy()
        for at, keep in enumerate(mask):
            if keep == "0":
                changed[at] += np.uint64(1000)
        assert dc.seeded(codes, mask)[0] == dc.seeded(changed, mask)[0]
        changed[0] += np.uint64(1)
        assert dc.seeded(codes, mask)[0] != dc.seeded(changed, mask)[0]


def test_densely_substituted_passages_are_found(spark, documents, prose):
    """Every 4th to 9th word at every offset, random words, and the mixtures between, as the plain rule says."""
    own = random.Random(11)
    sizes = (13, 14, 15, 16, 17, 18, 20, 25, 40, 60)
    items = [(k, prose(n, seed=1000 + k)) for k, n in enumerate(sizes)]
    texts = []

    def plant(words, places):
        words = [f"other{own.randrange(99)}" if p in places else w for p, w in enumerate(words)]
        body = [*prose(own.randrange(12)).split(), *words, *prose(own.randrange(12)).split()]
        texts.append((len(texts), " ".join(body)))

    for _, item in items:
        words = item.split()
        for period in range(4, 10):
            for offset in range(period):
                plant(words, set(range(offset, len(words), period)))
        for share in (0.1, 0.15, 0.2, 0.25):
            for _ in range(4):
                plant(words, {p for p in range(len(words)) if own.random() < share})
    plant(items[5][1].split(), {10, 14})  # 10 equal, 1 differing, 3 equal, 1 differing, 3 equal
    got, want = found(spark, documents, texts, items), brute(texts, items, dc.Rules())
    assert {key: o.n_equal for key, o in got.items()} == want
    assert (len(texts) - 1, 5) in got


def held(mask, places, size):
    """Whether a stretch of ``size`` words that differ at ``places`` holds the mask."""
    return any(all(k == "0" or at + i not in places for i, k in enumerate(mask)) for at in range(size - len(mask) + 1))


def test_seeds_are_held_by_every_overlap():
    """All ways to differ that have no smaller overlap inside hold a seed; other rules get other seeds."""
    from itertools import combinations

    assert all("0" in mask for mask in dc.MASKS)
    for n, d in ((13, 1), (13, 2), (13, 3), (16, 4), (20, 5)):
        for places in combinations(range(n + d), d):
            assert any(held(mask, set(places), n + d) for mask in dc.MASKS)
    assert not dc.covers(("1" * 5,), dc.Rules()) and dc.covers(("1" * 4,), dc.Rules())
    for rules in (dc.Rules(13, 1.0), dc.Rules(8, 0.5), dc.Rules(20, 0.9), dc.Rules(2, 0.8)):
        family = dc.masks(rules)
        assert dc.covers(family, rules) and all(len(mask) <= rules.words for mask in family)
