import math

import numpy as np

from reviewmill.llm import embeddings


def brute(rows, threshold):
    ok = {}
    for i, v in rows:
        if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok[i] = np.array(v, np.float32).astype(float)
    up = {i: i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    links = dict.fromkeys(up, 0)
    ids = sorted(ok)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = ok[a], ok[b]
            if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links[a] += 1
                links[b] += 1
                p, q = sorted((root(a), root(b)))
                up[q] = p
    return {i: (links[i], root(i), root(i) == i) for i in up}


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for centre in rng.standard_normal((40, 16)):
        for spread in (0, 0, 0.02, 0.05, 0.1):
            rows.append((centre + spread * rng.standard_normal(16)) * rng.uniform(0.1, 10))
    rows = [r.astype(np.float32).tolist() for r in rows] + [rows[0].astype(np.float32).tolist()]
    rows += [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [1e-30] * 16]
    rows = list(enumerate(rows))
    table = spark.createDataFrame([(i, v, 1, "z") for i, v in rows], "vec_id long, embedding array<float>, label int, cls string")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(table).collect()}
    want = brute(rows, 0.9)
    assert set(found) == set(want)
    got, real = sum(f[0] for f in found.values()), sum(w[0] for w in want.values())
    assert got >= 0.97 * real and all(found[i][0] <= want[i][0] for i in want)
    assert sum(found[i] == want[i] for i in want) >= 0.95 * len(want)


def test_recall_on_the_whole_table(spark):
    import duckdb

    rows = duckdb.sql("SELECT vec_id, embedding FROM '/root/testdata/sf0.1/embeddings.parquet'").fetchall()
    rng = np.random.default_rng(1)
    close = []
    for k, (_, v) in enumerate(rows[:400]):  # pairs around the threshold
        x = np.array(v) / np.linalg.norm(v)
        y = rng.standard_normal(len(x))
        y -= (y @ x) * x
        cosine = rng.uniform(0.9, 0.99)
        close.append((10_000 + k, (cosine * x + math.sqrt(1 - cosine**2) * y / np.linalg.norm(y)).tolist()))
    table = spark.createDataFrame([*rows, *close], "vec_id long, embedding array<float>")
    found = {r.vec_id: r.n_links for r in embeddings.near_duplicates(table).collect()}
    x = np.array([v for _, v in [*rows, *close]], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    real = (x @ x.T >= 0.9).sum() - len(x)
    assert real >= 800 and sum(found.values()) >= 0.97 * real


def test_null_and_repeated_keys_and_empty_table(spark):
    table = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.01])], "vec_id long, embedding array<float>")
    found = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(table).collect())
    assert found == [(0, 2, 1, False), (1, 2, 1, True), (1, 2, 1, True)]
    assert embeddings.near_duplicates(table.limit(0)).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    from reviewmill.llm.base import components

    edges = [(k, k + 1) for k in range(50, 0, -1)] + [(200, k) for k in range(201, 260)] + [(300, 300), (401, 400), (400, 401)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {roots[k] for k in range(1, 52)} == {1} and {roots[k] for k in range(200, 260)} == {200} and roots[401] == 400
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
