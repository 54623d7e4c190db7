import random
import re

from reviewmill.llm import minhash


def sets_of(texts, width):
    out = {}
    for i, t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        out[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    return out


def brute(texts, width, percent):
    sets = sets_of(texts, width)
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def variants(prose):
    own = random.Random(4)
    texts = []
    for group in range(12):
        words = prose(60 + 5 * group, seed=group).split()
        for _ in range(8):
            changed = list(words)
            for _ in range(own.randrange(5)):
                changed[own.randrange(len(changed))] = f"new{own.randrange(1000)}"
            texts.append(" ".join(changed) if own.random() < 0.8 else "\n".join(changed).upper())
    own.shuffle(texts)
    return [*texts, None, "", " \t\n", "two words", "Two  WORDS", "é É", "é é", "a b c d", "a b c d a b c d"]


def test_against_brute_force(spark, documents, prose):
    texts = list(enumerate(variants(prose)))
    for width in (4, 5):
        found = minhash.near_duplicates(documents([(i, t, "s") for i, t in texts]), words=width).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(texts, width, 80)


def test_chains_reach_beyond_the_first_hub(spark, documents, prose):
    words = prose(100, seed=99).split()
    texts = []
    for step in range(30):  # each text is like the next, the ends share nothing
        words = [*words[5:], *prose(5, seed=1000 + step).split()]
        texts.append((step, " ".join(words)))
    found = minhash.near_duplicates(documents([(i, t, "s") for i, t in texts]), words=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute(texts, 4, 80)


def test_blocks_follow_the_bytes_of_their_texts(spark, documents, prose, monkeypatch):
    words = prose(100, seed=99).split()
    texts = []
    for step in range(24):
        words = [*words[5:], *prose(5, seed=2000 + step).split()]
        texts.append((step, " ".join(words)))
    texts.append((99, " ".join([*words, *prose(20000, seed=5).split()])))  # a long one beside them
    plain = {r.doc_id: (r.component_id, r.kept) for r in minhash.near_duplicates(documents([(i, t, "s") for i, t in texts]), words=4).collect()}
    blocks = []
    real = type(spark.range(1)).groupBy

    def seen(df, *by):
        if [c for c in by if isinstance(c, str)] == ["crowd", "low", "high"]:
            blocks.append(df.select("block").distinct().count())
        return real(df, *by)

    monkeypatch.setattr(minhash, "BLOCK_BYTES", 1000)
    monkeypatch.setattr(type(spark.range(1)), "groupBy", seen, raising=True)
    found = {r.doc_id: (r.component_id, r.kept) for r in minhash.near_duplicates(documents([(i, t, "s") for i, t in texts]), words=4).collect()}
    assert found == plain == {i: v[1:] for i, v in brute(texts, 4, 80).items()}
    assert blocks and max(blocks) > 5


def test_all_pairs_within_the_distance_share_a_key():
    import numpy as np

    signature = minhash.Signature(chunks=4, width=3, errors=1)
    own = np.random.default_rng(0)
    base = own.integers(0, 1 << 63, (1, signature.size), dtype=np.uint64)
    for _ in range(200):
        other = base.copy()
        at = own.choice(signature.size, signature.distance, replace=False)
        other[0, at] ^= own.integers(1, 1 << 62, len(at), dtype=np.uint64)
        keys = [set(minhash.join_keys(x, signature)[0].tolist()) for x in (base, other)]
        assert keys[0] & keys[1]


def test_repeated_keys_nulls_and_empty_table(spark, documents, prose):
    text = prose(30, seed=1)
    docs = documents([(1, text, "s"), (1, text, "s"), (None, text, "s"), (2, text + " more", "s"), (3, None, "s")])
    found = minhash.near_duplicates(docs)
    assert sorted((r.doc_id or 0, r.component_id, r.kept) for r in found.collect()) == [
        (0, 1, False), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True),
    ]
    kept = minhash.keep_first(docs, found)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]
    assert minhash.near_duplicates(documents([])).count() == 0
