import numpy as np
import pytest

from reviewmill.llm import mixing


def targets(sizes, weights, share, most):
    """Water filling by hand: {source: target}."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    out, pot = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in out]
        if not open_:
            return out
        level = (pot - sum(out.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > most * sizes[s]]
        if not over:
            return out | {s: weight[s] * level for s in open_}
        out |= {s: most * sizes[s] for s in over}


def rows(prose):
    out = [(i, prose(1 + i % 37, seed=i), f"src{i * i % 7}") for i in range(600)]
    return [*out, (600, None, "src1"), (601, "", None), (602, prose(9, seed=1), None), (None, prose(4, seed=2), "é")]


def test_targets_and_taken_words(spark, documents, prose, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    monkeypatch.setattr(mixing, "RESERVE", 4)
    data = rows(prose)
    found = mixing.mix(documents(data)).collect()
    assert len(found) == len(data)
    sizes = {}
    for _, text, source in data:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = targets(sizes, (5, 2, 1), 1.5, 2)
    source_of = {i: s for i, _, s in data}
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        source = source_of[r.doc_id]
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        assert 0 <= r.copies <= 2
        taken[source] += r.copies * r.size
    for source in sizes:
        assert abs(taken[source] - want[source]) <= 37
    again = mixing.mix(documents(data[::-1]).repartition(7)).collect()
    assert sorted((r.doc_id or -1, r._fp, r.copies) for r in again) == sorted((r.doc_id or -1, r._fp, r.copies) for r in found)


def test_pivot_keeps_words_and_expectation():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 50, 40).astype(float)
    share = rng.random(40)
    total = np.zeros(40)
    for _ in range(3000):
        out = mixing.pivot(share, size, rng)
        open_ = (out > 0) & (out < 1)
        assert open_.sum() <= 1 and (out @ size) == pytest.approx(share @ size)
        total += out
    assert np.abs(total / 3000 - share).max() < 0.05


def test_settling_keeps_words_and_expectations():
    rng = np.random.default_rng(2)
    size, sizes = 70.0, rng.integers(1, 9, 30).astype(float)
    start = rng.random(30)
    total, mean = np.zeros(30), 0.0
    for _ in range(4000):
        pool = start.copy()
        share = mixing.settle(0.3, size, pool, sizes, rng)
        assert share * size + pool @ sizes == pytest.approx(0.3 * size + start @ sizes)
        assert pool.min() >= 0 and pool.max() <= 1
        total, mean = total + pool, mean + share
    assert np.abs(total / 4000 - start).max() < 0.05 and abs(mean / 4000 - 0.3) < 0.05
    spent = np.array([0.0, 1.0])
    assert mixing.settle(0.3, 5.0, spent, np.ones(2), rng) == 0.3  # nothing to trade with


def test_exchange_comes_nearer_with_every_turn():
    share, size = np.array([1.0, 0.0, 0.0, 1.0]), np.array([9.0, 7.0, 3.0, 2.0])
    assert list(mixing.exchange(share, size, 8.0)) == [1, 1, 0, 1]  # 7 more, 1 left that no turn lessens
    assert list(mixing.exchange(share, size, 0.4)) == list(share)
    assert list(mixing.exchange(share[:0], size[:0], 5.0)) == []


def test_a_long_document_is_made_up_for_by_short_ones(spark, documents, prose):
    data = [(i, prose(5 + i % 11, seed=i), "a") for i in range(400)] + [(900 + i, prose(300 + i, seed=i), "a") for i in range(9)]
    found = mixing.mix(documents(data), share=0.7).collect()
    taken, want = sum(r.copies * r.size for r in found), found[0].target
    assert abs(taken - want) <= 5 and any(r.copies for r in found if r.size > 200)


def test_buckets_follow_the_rows_of_a_source_and_equal_rows_are_spread(spark, documents, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    monkeypatch.setattr(mixing, "COPIES", 70)
    groups = []
    plain = mixing._round

    def counted(rows, group, seed, last=False):
        groups.append({(r.source, r._bucket): r["count"] for r in rows.groupBy(*group).count().collect()})
        return plain(rows, group, seed, last)

    monkeypatch.setattr(mixing, "_round", counted)
    data = [(7, "same row again", "hot")] * 1000 + [(1000 + i, f"word number {i}", f"s{i % 100}") for i in range(200)]
    found = mixing.mix(documents(data)).collect()
    first = groups[0]
    assert len(found) == len(data) and max(first.values()) < 150
    assert sum(s == "hot" for s, _ in first) == 20 and sum(s != "hot" for s, _ in first) == 100
    again = mixing.mix(documents(data[::-1]).repartition(7)).collect()
    assert sorted((r.doc_id, r.copies) for r in again) == sorted((r.doc_id, r.copies) for r in found)


def test_documents_as_taken(spark, documents, prose):
    data = rows(prose)[:50] + [(7, "twin twin", "src0")] * 3
    docs = documents(data)
    plan = mixing.mix(docs)
    taken = mixing.mixed_documents(docs, plan)
    assert taken.columns == docs.columns
    want = {}
    for r in plan.collect():
        want[r.doc_id, r.size] = want.get((r.doc_id, r.size), 0) + r.copies
    got = {}
    for r in taken.collect():
        k = (r.doc_id, len((r.text or "").split()))
        got[k] = got.get(k, 0) + 1
    assert got == {k: n for k, n in want.items() if n}


def test_empty_table_and_sources_without_words(spark, documents):
    assert mixing.mix(documents([])).count() == 0
    found = mixing.mix(documents([(1, None, "a"), (2, " ", None)])).collect()
    assert {(r.copies, r.target) for r in found} == {(0, 0.0)}
