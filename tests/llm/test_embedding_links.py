import numpy as np

from tidemark.llm import embedding_links as E


def graph(ids, vectors, threshold=0.9):
    good = [i for i, v in enumerate(vectors) if v and None not in v and np.isfinite(v).all() and np.any(v)]
    links, label = [set() for _ in ids], list(range(len(ids)))
    for i in good:
        for j in good:
            if i < j and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    links[i].add(j), links[j].add(i)
    changed = True
    while changed:
        changed = False
        for i, own in enumerate(links):
            for j in own:
                if label[j] < label[i]:
                    label[i], changed = label[j], True
    low = {}
    for i, n in zip(ids, label):
        low[n] = min([x for x in (i, low.get(n)) if x is not None], default=None)
    return sorted(((i, len(own), low[n]) for i, own, n in zip(ids, links, label)), key=str)


def groups(spark, ids, vectors, kind="double"):
    rows = [(i, v, 1) for i, v in zip(ids, vectors)]
    df = spark.createDataFrame(rows, f"vec long, e array<{kind}>, n_links int")
    return E.embedding_groups(df, "vec", "e").collect()


def plain(got):
    assert all(r["kept"] == (r["id"] is not None and r["id"] == r["component_id"]) for r in got)
    return sorted(((r["id"], r["n_links"], r["component_id"]) for r in got), key=str)


def test_hadamard_is_orthogonal():
    h = E.hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16)) and np.allclose(np.abs(h), 0.25)


def near_copies(n, dims, noise, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(max(1, n // 8), dims))
    return base[rng.integers(0, len(base), n)] + noise * rng.normal(size=(n, dims))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [], [0.0, 0.0], [nan, 1.0], [1.0, inf], [None, 1.0], [1.0, 0.0], [2.0, 0.0], [1.0, 0.0], [0.0, 1.0], [1e300, 1e299],
               [1e-300, 0.0], [-1.0, 0.0], [1.0], [-3.0], [5.0], [1.0, 0.0, 0.0], [0.0, -0.0], [1.0, 0.0], [0.3, 1.0]]
    ids = [*range(10, 10 + len(vectors) - 2), None, 12]
    assert plain(groups(spark, ids, vectors)) == graph(ids, vectors)
    assert groups(spark, [], []) == []


def test_near_copies_equal_brute_force(spark):
    vectors = near_copies(600, 64, 0.2, 4).tolist() + near_copies(200, 10, 0.3, 5).tolist()
    assert plain(groups(spark, range(800), vectors)) == graph(range(800), vectors)


def test_one_large_group_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(E, "CHUNK", 90)
    monkeypatch.setattr(E, "PAIRS", 700)
    vectors = near_copies(7, 32, 0.0, 1)[:1] + 0.15 * np.random.default_rng(2).normal(size=(400, 32))
    vectors = vectors.tolist() + [[1.0] * 32] * 50
    assert plain(groups(spark, range(450), vectors)) == graph(range(450), vectors)


def test_recall_at_the_threshold():
    """Pairs at cosine 0.9 exactly, for the parameters of small and large tables."""
    rng = np.random.default_rng(9)
    for count in (500, 10**5, 10**7):
        lsh = E.CrossPolytope.for_count(count, 64)
        a = E.unit(rng.normal(size=(1000, 64)).tolist())
        side = rng.normal(size=a.shape)
        side -= (side * a).sum(1, keepdims=True) * a
        b = 0.9 * a + np.sqrt(1 - 0.81) * E.unit(side.tolist())
        x, y = lsh.buckets(a), lsh.buckets(b)
        meet = (x == y[:, :, :1]).any(axis=2) | (y == x[:, :, :1]).any(axis=2)
        print(count, lsh, meet.mean(), meet.any(axis=1).mean())
        assert meet.any(axis=1).mean() >= 0.995
