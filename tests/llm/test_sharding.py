import random
import zlib
from collections import Counter, defaultdict

from reviewmill.llm import sharding


def test_shards_are_even_whole_and_numbered(spark, documents, prose, monkeypatch):
    monkeypatch.setattr(sharding, "NUMBERED", 20)
    data = [(i, prose(1 + i * 7 % 60, seed=i), f"s{i % 5}") for i in range(900)]
    data += [(2000 + i, "one text in many rows " * 3, f"s{i % 5}") for i in range(300)]  # heavier than a shard
    data += [(3000 + i, "a small group", None) for i in range(4)] + [(None, None, None), (None, None, None), (5, "", "s1")]
    found = sharding.shard(documents(data), shards=13).collect()
    assert len(found) == len(data)
    size, slots = Counter(), defaultdict(list)
    for r in found:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    assert set(size) == set(range(13))
    mean = sum(size.values()) / 13
    assert max(abs(x - mean) for x in size.values()) < 0.15 * mean
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in data)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == want
    small = {r.shard for r in found if (r.doc_id or 0) >= 3000}
    assert len(small) == 1


def test_few_rows_and_empty_table(spark, documents):
    assert sharding.shard(documents([])).count() == 0
    found = sharding.shard(documents([(1, "a", None), (1, "a", None)]), shards=4).collect()
    assert sorted(r.slot for r in found if r.shard == found[0].shard)[0] == 0 and len(found) == 2


def test_reruns_agree(spark, documents, prose):
    data = [(i, prose(1 + i % 9, seed=i % 50), f"s{i % 3}") for i in range(200)]
    one = sharding.shard(documents(data), shards=7).collect()
    two = sharding.shard(documents(data[::-1]).repartition(5), shards=7).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in one) == sorted((r.doc_id, r.shard, r.slot) for r in two)


def plain_cut(points, room, widths, first=0):
    """{name: shard} by sorting and cutting one box after the other; points are (name, weight, dims, mark)."""
    if len(room) == 1 or not points:
        return {p[0]: first for p in points}
    spans = [max(p[2][k] for p in points) - min(p[2][k] for p in points) for k in range(len(widths))]
    dim = max(range(len(widths)), key=lambda k: (spans[k] / widths[k], -k))
    order = sorted(points, key=lambda p: (p[2][dim], p[3]))
    half = len(room) // 2
    goal = sum(p[1] for p in points) * (sum(room[:half]) / sum(room))
    at, before = 0, 0
    while at < len(order) - 1 and before + order[at][1] < goal:
        before += order[at][1]
        at += 1
    at += goal - before > order[at][1] / 2
    left = plain_cut(order[:at], room[:half], widths, first)
    return left | plain_cut(order[at:], room[half:], widths, first + half)


def test_tree_equals_a_plain_recursive_cut(spark, monkeypatch):
    monkeypatch.setattr(sharding, "FINE", 0.0)
    monkeypatch.setattr(sharding, "BIN_BITS", 3)
    monkeypatch.setattr(sharding, "BINS", 8)
    rng = random.Random(4)
    points = [(i, rng.randint(1, 90), (rng.randint(0, 40), rng.randint(0, 3) * 7, 5), rng.randrange(1 << 40)) for i in range(160)]
    room = [rng.uniform(0.5, 2) for _ in range(7)]
    table = spark.createDataFrame([(n, w, list(d), m) for n, w, d, m in points], "_name long, _weight long, _dims array<long>, _mark long")
    found = {r._name: r._box for r in sharding.grow(table, 3, room, 1.0).collect()}
    widths = [max(1, max(p[2][k] for p in points) - min(p[2][k] for p in points)) for k in range(3)]
    assert found == plain_cut(points, room, widths)


def test_groups_are_split_only_where_no_shard_has_room(spark, documents, prose):
    data = [(i, prose(1 + i * 7 % 60, seed=i), f"s{i % 5}") for i in range(900)]
    total = sum(len(t) + 16 for _, t, _ in data)
    copies = {"half": 0.5, "third": 0.35, "nearly": 0.85, "above": 1.6}  # shares of a shard, about
    for k, (name, share) in enumerate(copies.items()):
        text = f"{name} " * 8
        data += [(5000 + 1000 * k + i, text, "s1") for i in range(int(share * total / 10 / (len(text) + 16)))]
    found = sharding.shard(documents(data), shards=10).collect()
    sizes, homes = Counter(), defaultdict(set)
    for r in found:
        sizes[r.shard] += r.size
        homes[r.doc_id // 1000].add(r.shard)
    assert len(found) == len(data) and len(sizes) == 10
    assert [len(homes[g]) for g in (5, 6, 7)] == [1, 1, 1] and len(homes[8]) > 1
    mean = sum(sizes.values()) / 10
    assert max(abs(x - mean) for x in sizes.values()) < 0.15 * mean


def test_room_is_given_to_the_heaviest_first():
    homes, room = sharding.place_whole({1: 6, 2: 5, 3: 4, 4: 11, 5: 5, 6: 4}, [10.0, 10.0])
    assert homes == {1: 0, 2: 1, 5: 1, 3: 0} and room == [0.0, 0.0]  # 4 fits nowhere, 6 finds no room
