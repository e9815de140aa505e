"""Embedding near-dedup against brute force."""

import numpy as np
import pytest

from quarry.llm import embedding_dedup as E

VEC = "vec_id long, embedding array<float>"


def brute(rows, threshold=0.9):
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n, low = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    unit = {i: np.array(rows[i][1], np.float32).astype(float) for i in ok}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    for a in ok:
        for b in ok:
            if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                n[a] += 1
                n[b] += 1
                low[find(a)] = find(b)
    names = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            names[find(i)] = min(names.get(find(i), d), d)
    return sorted(((d, n[i], names.get(find(i)), d is not None and names[find(i)] == d) for i, (d, _) in enumerate(rows)), key=repr)


def near(rng, v, cosine):
    w = rng.standard_normal(len(v))
    w -= w @ v * v / (v @ v)
    return cosine * v / np.linalg.norm(v) + np.sqrt(1 - cosine**2) * w / np.linalg.norm(w)


def linked(spark, rows, **more):
    df = spark.createDataFrame([(d, None if v is None else [None if x is None else float(x) for x in v]) for d, v in rows], VEC)
    return sorted(map(tuple, E.link(spark, df, **more).collect()), key=repr)


def test_all_links_are_found(spark, monkeypatch):
    monkeypatch.setattr(E, "PER_CELL", 20)
    monkeypatch.setattr(E, "BLOCK", 16)  # many pairs of blocks
    rng = np.random.Generator(np.random.PCG64(2))
    vectors = [rng.standard_normal(24) for _ in range(150)]
    vectors += [near(rng, vectors[i % 30], c) for i, c in enumerate(rng.uniform(0.85, 0.99, 120))]
    vectors += [near(rng, vectors[3], 0.99) for _ in range(120)]  # a large group
    rows = [(int(i), v.astype(np.float32).tolist()) for i, v in zip(rng.permutation(5000), vectors)]
    assert linked(spark, rows) == brute(rows)


def test_recall_among_thousands_of_centres(spark, monkeypatch):
    monkeypatch.setattr(E, "PER_CELL", 6)  # 2,000 centres
    rng = np.random.Generator(np.random.PCG64(5))
    a = E.unit(rng.standard_normal((6000, 64)))
    w = rng.standard_normal(a.shape)
    w = E.unit(w - (w * a).sum(axis=1, keepdims=True) * a)
    rows = np.concatenate([a, 0.901 * a + np.sqrt(1 - 0.901**2) * w]).astype(np.float32)  # 6,000 pairs, no other link
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows.tolist())], VEC)
    found = E.link(spark, df).agg({"n_links": "sum"}).collect()[0][0] / 2
    print("recall", found / 6000)
    assert 0.99 * 6000 < found <= 6000


def test_embeddings_that_share_a_direction(spark, monkeypatch):
    """Median cosine over 0.7, as text embedders give: still hundreds of
    cells, and the links are found."""
    monkeypatch.setattr(E, "PER_CELL", 20)
    rng = np.random.Generator(np.random.PCG64(11))
    mean = E.unit(rng.standard_normal((1, 64)))
    a = E.unit(E.unit(rng.standard_normal((4000, 64))) + 1.62 * mean)
    u = np.roll(a, 7, axis=0)
    w = E.unit(u - (u * a).sum(axis=1, keepdims=True) * a)
    rows = np.concatenate([a, 0.901 * a + np.sqrt(1 - 0.901**2) * w]).astype(np.float32)
    units = E.unit(rows)
    exact = units @ units.T
    assert 0.7 < np.median(exact) < 0.8
    links = int((np.triu(exact, 1) >= 0.9).sum())
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows.tolist())], VEC)
    centres, pool = E._centres(df.withColumnRenamed("vec_id", "node"), 64, len(rows))
    assert len(centres) >= 300
    found = E.link(spark, df).agg({"n_links": "sum"}).collect()[0][0] / 2
    print("centres", len(centres), "visits", E.visits_measured(centres, pool, 0.9), "recall", found / links)
    assert 0.98 * links < found <= links


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, nan]), (5, [1.0, inf]), (6, [None, 1.0]), (None, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [2.0, 0.0]),
            (9, [2.0, 0.0]), (10, [0.0, -1.0]), (11, [-0.0, -1.0]), (12, [1.0, 0.0, 0.0]), (13, [1e-30, 0.0]), (None, None), (14, [3e38, 1e38])]
    assert linked(spark, rows) == brute(rows)
    assert linked(spark, rows[:6]) == brute(rows[:6])
    assert linked(spark, []) == []


def test_other_columns_do_not_clash(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], 5, "x"), (2, [1.0, 0.1], 6, "y")], "vec_id long, embedding array<double>, node int, n_links string")
    assert sorted(map(tuple, E.link(spark, df).collect())) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.Generator(np.random.PCG64(3))
    a = E.unit(rng.standard_normal((400, 64)))
    b = E.unit(np.stack([near(rng, v, c) for v, c in zip(a, rng.uniform(-0.9, 0.95, 400))]))
    codes, factors = E.encode(a)
    guess, error = E.estimate(codes, factors, b)
    exact = a @ b.T
    off = guess - exact
    assert abs(off.mean()) < 0.003
    assert (np.abs(off) <= E.CONFIDENCE * error[:, None]).mean() > 0.9999
    assert np.allclose(E.rotation(64) @ E.rotation(64).T, np.eye(64))


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_given_vectors(spark, folder):
    path = f"/root/testdata/{folder}/embeddings.parquet"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(path).collect()]
    got = sorted(map(tuple, E.link(spark, spark.read.parquet(path)).collect()), key=repr)
    assert got == brute(rows)
