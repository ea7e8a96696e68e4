import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.operators import communities, joins, mixtures, models
from tesserae.plans import modelling
from tesserae.plans.frames import cells


def vectors(spark, sf_dir):
    rows = modelling._vectors(spark, sf_dir).orderBy("id").collect()
    return [r["id"] for r in rows], np.array([r["v"] for r in rows])


def test_principal_components(spark, sf_dir):
    _, x = vectors(spark, sf_dir)
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    want = np.linalg.eigvalsh(np.cov(z.T))[::-1][:3]
    got = {r["component"]: r["variance"] for r in modelling.principal_component_spread(spark, sf_dir).collect()}
    assert np.allclose([got[i] for i in range(3)], want, atol=1e-5)


def test_head(spark, sf_dir):
    ids, x = vectors(spark, sf_dir)
    w1, b1, w2, b2 = modelling._head(64)
    z = np.maximum(x @ w1 + b1, 0) @ w2 + b2
    e = np.exp(z - z.max(1, keepdims=True))
    p = e / e.sum(1, keepdims=True)
    got = {r["id"]: (r["predicted"], r["confidence"]) for r in modelling.head_predictions(spark, sf_dir).collect()}
    assert all(got[i][0] == q.argmax() and abs(got[i][1] - q.max()) < 1e-5 for i, q in zip(ids, p))


def test_k_means_covers_all(spark, sf_dir):
    rows = modelling.embedding_clusters(spark, sf_dir).collect()
    assert sum(r["n"] for r in rows) == len(vectors(spark, sf_dir)[0]) and {r["cluster"] for r in rows} <= set(range(8))


def test_propagation(spark):
    edges = [(1, 2, 3), (2, 3, 3), (1, 3, 3), (4, 5, 3), (5, 6, 3), (4, 6, 3), (3, 4, 1)]
    labels = {n: n for n in range(1, 7)}
    for _ in range(4):
        new = {}
        for n in labels:
            weight = {}
            for a, b, w in edges:
                for p, q in ((a, b), (b, a)):
                    if p == n:
                        weight[labels[q]] = weight.get(labels[q], 0) + w
            new[n] = min(weight, key=lambda k: (-weight[k], k))
        labels = new
    got = models.propagated_labels(spark.createDataFrame(edges, "a long, b long, w long"), 4).collect()
    assert {r["node"]: r["label"] for r in got} == labels


def nearest_ten(ids, x):
    """By brute force; ties to the smaller id, as ids are sorted."""
    out = {}
    for i, a in enumerate(ids):
        d = ((x - x[i]) ** 2).sum(1)
        out[a] = [ids[j] for j in np.argsort(d, kind="stable") if j != i][:10]
    return out


def test_nearest_across_blocks(spark, sf_dir):
    ids, x = vectors(spark, sf_dir)
    x = np.minimum(x, 10.0)  # with ties
    x[::7] = x[3]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "id long, v array<double>")
    got = {}
    for r in models.nearest_in_feature_space(df, 10, block_rows=64).orderBy("a", "rank").collect():
        got.setdefault(r["a"], []).append(r["b"])
    assert got == nearest_ten(ids, x)
    assert models.nearest_in_feature_space(df.limit(4), 10).count() == 12


@pytest.mark.parametrize("pivots", [1, 7, 60])
def test_nearest_by_pivots(spark, pivots):
    """Clustered vectors, a third of them equal, rows that ask others, and few rows."""
    rng = np.random.default_rng(pivots)
    x = np.concatenate([rng.normal(c * 20, 1, (60, 5)) for c in range(4)] + [np.full((120, 5), 20.0)]).round(2)
    ids = list(range(len(x)))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)] + [(900, None)], "id long, v array<double>")
    got = {}
    for r in models.nearest_in_feature_space(df, 10, block_rows=40, pivots=pivots).orderBy("a", "rank").collect():
        got.setdefault(r["a"], []).append(r["b"])
    assert got == nearest_ten(ids, x)
    asking = spark.createDataFrame([(1000 + i, (v + 0.5).tolist()) for i, v in enumerate(x[::17])], "id long, v array<double>")
    for r in models.nearest_in_feature_space(asking, 1, block_rows=40, others=df, pivots=pivots, distances=True).collect():
        d = ((x - x[::17][r["a"] - 1000] - 0.5) ** 2).sum(1)
        assert r["d"] == pytest.approx(d.min()) and d[r["b"]] == pytest.approx(d.min())
    assert models.nearest_in_feature_space(df.where("id < 3"), 10, pivots=pivots).count() == 6
    assert models.nearest_in_feature_space(df.where("v is null"), 3).isEmpty()


def test_pivots_prune_clustered_vectors():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c * 50, 1, (500, 8)) for c in range(8)])
    pivots = models.Pivots(x[::100])
    at, far = pivots.cells(x)
    low, high = (np.array([f(far[at == c]) for c in range(len(pivots.places))]) for f in (np.min, np.max))
    bound = pivots.bounds(x, low, high)
    d = np.sqrt(((x[:, None] - x[at.argsort(kind="stable")][None, ::37]) ** 2).sum(2))
    cells = at[at.argsort(kind="stable")][::37]
    assert (bound[:, cells] <= d + 1e-9).all() and (bound > 20).mean() > 0.8


def test_k_means(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(c * 9, 1, (50, 3)) for c in range(4)]).round(1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(-1, None)], "id long, v array<double>").repartition(3)
    start = x[[0, 1, 2, 3]]
    centres, squares = mixtures.k_means_centres(df, "v", 4, 7, centres=start)
    want = start
    while True:
        at = ((x[:, None] - want) ** 2).sum(2).argmin(1)
        new = np.array([x[at == c].mean(0) if (at == c).any() else want[c] for c in range(4)])
        if np.allclose(new, want):
            break
        want = new
    assert np.allclose(centres, want) and squares == pytest.approx(((x - want[at]) ** 2).sum())
    got = mixtures.k_means(df, "v", 4, 7).collect()
    names = {r["id"]: r["cluster"] for r in got}
    assert names.pop(-1) is None and all(len({names[50 * c + i] for i in range(50)}) == 1 for c in range(4)) and len(set(names.values())) == 4


@pytest.mark.parametrize("shape", ["full", "diagonal", "spherical"])
def test_mixture(spark, shape):
    """Every round is numpy's, and the log-likelihood never falls."""
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(0, 1, (120, 2)), rng.normal(4, 2, (80, 2)) @ np.array([[1, 0.5], [0, 1]])])
    df = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").repartition(3)
    start = mixtures.Mixture(np.array([0.5, 0.5]), np.array([[0.0, 0.0], [3.0, 3.0]]), np.array([np.eye(2)] * 2))
    w, m, c = start.weights, start.means, start.covariances
    seen = []
    for _ in range(6):
        dens = np.stack([w[j] * np.exp(-0.5 * np.einsum("ij,jk,ik->i", x - m[j], np.linalg.inv(c[j]), x - m[j])) / (2 * np.pi * np.sqrt(np.linalg.det(c[j]))) for j in range(2)], axis=1)
        seen.append(np.log(dens.sum(1)).sum())
        r = dens / dens.sum(1, keepdims=True)
        n = r.sum(0)
        w, m = n / len(x), (r.T @ x) / n[:, None]
        c = np.array([((x - m[j]).T * r[:, j]) @ (x - m[j]) / n[j] for j in range(2)])
        if shape == "diagonal":
            c = c * np.eye(2)
        elif shape == "spherical":
            c = np.array([np.trace(v) / 2 * np.eye(2) for v in c])
    for rounds in (1, 6):
        got = mixtures.fit_mixture(df, "v", 2, shape=shape, rounds=rounds, tolerance=0.0, ridge=0.0, start=start)
        free = 1 + 4 + 2 * {"full": 3, "diagonal": 2, "spherical": 1}[shape]
        assert got.likelihood == pytest.approx(seen[rounds - 1]) and got.bic == pytest.approx(2 * seen[rounds - 1] - free * np.log(len(x)))
    assert all(a <= b + 1e-9 for a, b in zip(seen, seen[1:]))
    named = mixtures.mixed(df, "v", got).groupBy("component").count().collect()
    assert sum(r["count"] for r in named) == len(x)


def planted(seed, groups, size, inner, outer):
    rng = np.random.default_rng(seed)
    n = groups * size
    return [(int(j), i, int(rng.integers(1, 4))) for i in range(n) for j in range(i) if rng.random() < (inner if i // size == j // size else outer)]


def modularity_of(edges, label, resolution=1.0):
    total = sum(w for _, _, w in edges)
    k = {}
    for a, b, w in edges:
        for x in (a, b):
            k[label[x]] = k.get(label[x], 0) + w
    return sum(w for a, b, w in edges if label[a] == label[b]) / total - resolution * sum(v * v for v in k.values()) / (2 * total) ** 2


@pytest.mark.parametrize("few", [0, communities.FEW])
@pytest.mark.parametrize("connected", [False, True])
def test_louvain_finds_planted_groups(spark, connected, few):
    edges = planted(1, 5, 12, 0.6, 0.03) + [(0, 0, 2)]
    df = spark.createDataFrame(edges, "a long, b long, w long")
    found = communities.louvain(df, connected=connected, few=few)
    label = {r["node"]: r["community"] for r in found.collect()}
    assert len({(n // 12, c) for n, c in label.items()}) == 5 == len(set(label.values()))
    assert communities.modularity(df, found) == pytest.approx(modularity_of(edges, label))


def test_modularity_never_falls(spark):
    """Moves by rounds on a graph without groups, against single moves: no single one gains any more."""
    edges = planted(3, 1, 24, 0.25, 0)
    df = spark.createDataFrame(edges, "a long, b long, w long")
    total = 2.0 * sum(w for _, _, w in edges)
    label = {r["node"]: r["c"] for r in communities._moved(df, total, 1.0).collect()}
    now = modularity_of(edges, label)
    assert now >= modularity_of(edges, {n: n for n in label})
    for n in label:
        near = {label[b if a == n else a] for a, b, _ in edges if n in (a, b)}
        assert all(modularity_of(edges, label | {n: c}) <= now + 1e-9 for c in near)
    assert communities.louvain(df.where("false")).isEmpty()


def test_single_moves():
    edges = planted(4, 3, 9, 0.5, 0.1)
    label = communities._here(edges, 1.0, True)
    assert modularity_of(edges, label) >= modularity_of(edges, {n: n // 9 for n in label}) - 0.05
    for c in set(label.values()):
        own, seen = {n for n in label if label[n] == c}, set()
        todo = [min(own)]
        while todo:
            n = todo.pop()
            seen.add(n)
            todo += [b if a == n else a for a, b, _ in edges if n in (a, b) and {a, b} <= own and (b if a == n else a) not in seen]
        assert seen == own


def test_moves_that_share_no_community(spark):
    rows = [(1, 1, 2, 0.5), (2, 2, 3, 0.7), (3, 4, 5, 0.1), (4, 6, 5, 0.1), (5, 7, 8, 0.2)]
    got = communities._apart(spark.createDataFrame(rows, "a long, c long, best long, gain double"))
    assert sorted(r["a"] for r in got.collect()) == [2, 3, 5]


def test_communities_of_all_vectors(spark, sf_dir):
    ids, x = vectors(spark, sf_dir)
    near = {a: set(b) for a, b in nearest_ten(ids, x).items()}
    around = {a: {b: len(near[a] & near[b]) for b in ids if b != a and len(near[a] & near[b]) >= 2} for a in ids}
    want = {a: a for a in ids if around[a]}
    for _ in range(4):
        new = {}
        for a in want:
            weight = {}
            for b, w in around[a].items():
                weight[want[b]] = weight.get(want[b], 0) + w
            new[a] = min(weight, key=lambda k: (-weight[k], k))
        want = new
    assert any(a % 5 for a in want)
    assert {r["node"]: r["label"] for r in modelling.propagated_communities(spark, sf_dir).collect()} == want


def test_density_clusters(spark, sf_dir):
    points = cells(spark, sf_dir).select("sample_id", F.col("cell_id").alias("id"), "x", "y")
    near = {}
    for r in joins.near_pairs(points, ["sample_id"], 24.0).collect():
        near.setdefault(r["a"], set()).add(r["b"])
    core = {a for a, b in near.items() if len(b) + 1 >= 3}
    name = {}
    for c in sorted(core):
        if c not in name:
            todo = [c]
            while todo:
                n = todo.pop()
                if n not in name:
                    name[n] = c
                    todo += near[n] & core
    want = {}
    for r in points.collect():
        i = r["id"]
        around = sorted(near.get(i, set()) & core)
        want[i] = name[i] if i in core else name[around[0]] if around else None
    assert {r["id"]: r["cluster"] for r in modelling.density_clusters(spark, sf_dir).collect()} == want


def clusters_frame(spark, rows):
    return spark.createDataFrame([(i, n, [float(x) for x in v]) for i, n, v in rows], "label long, n long, v array<double>")


def merged_one_by_one(rows, k):
    rows, to = {i: (n, np.array(v, float)) for i, n, v in rows}, {i: i for i, _, _ in rows}
    while len(rows) > k:
        _, a, b = min((((rows[a][1] - rows[b][1]) ** 2).sum(), a, b) for a in rows for b in rows if a < b)
        (n, u), (m, v) = rows[a], rows.pop(b)
        rows[a] = n + m, (n * u + m * v) / (n + m)
        to = {x: a if y == b else y for x, y in to.items()}
    return to


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merging_to_k(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, int(rng.integers(1, 30)), rng.normal(0, 10, 3) if i % 2 else rng.normal(40 * (i % 5), 1, 3)) for i in range(70)]
    got = models.merge_to_k(clusters_frame(spark, rows), 6)
    assert {r["label"]: r["merged"] for r in got.collect()} == merged_one_by_one(rows, 6)


@pytest.mark.parametrize("few", [0, 9])
def test_merging_in_rounds(spark, few):
    """What the rounds merge, and what they leave to the driver, is what one merge after another gives."""
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(1, 9)), rng.normal(30 * (i % 6), 1, 2)) for i in range(14)]
    assert {r["label"]: r["merged"] for r in models.merge_to_k(clusters_frame(spark, rows), 6, few=few).collect()} == merged_one_by_one(rows, 6)


def test_merging_few(spark):
    rows = [(1, 10, (0, 0)), (2, 1, (1, 0)), (3, 5, (50, 0)), (4, 2, (52, 0))]
    assert {r["label"]: r["merged"] for r in models.merge_to_k(clusters_frame(spark, rows), 2).collect()} == {1: 1, 2: 1, 3: 3, 4: 3}
    assert {r["merged"] for r in models.merge_to_k(clusters_frame(spark, rows), 9).collect()} == {1, 2, 3, 4}
    assert models.merge_to_k(clusters_frame(spark, rows).where("false"), 2).isEmpty()


def test_merging_small_ones(spark):
    rng = np.random.default_rng(4)
    rows = [(i, int(rng.integers(1, 30)), rng.normal(0, 10, 2)) for i in range(50)]
    held, want = {i: (n, np.array(v)) for i, n, v in rows}, {i: i for i, _, _ in rows}
    while any(n < 15 for n, _ in held.values()):
        large = [i for i, (n, _) in held.items() if n >= 15]
        to = {i: i if n >= 15 else min(large, key=lambda j: (((held[j][1] - v) ** 2).sum(), j)) for i, (n, v) in held.items()}
        new = {}
        for i, j in to.items():
            n, total = new.get(j, (0, np.zeros(2)))
            new[j] = n + held[i][0], total + held[i][0] * held[i][1]
        held, want = {j: (n, t / n) for j, (n, t) in new.items()}, {x: to[y] for x, y in want.items()}
    assert {r["label"]: r["merged"] for r in models.merge_small(clusters_frame(spark, rows), 15).collect()} == want
    few = [(1, 1, (0, 0)), (2, 2, (1, 0)), (3, 1, (9, 0)), (4, 2, (9, 1))]
    assert {r["label"]: r["merged"] for r in models.merge_small(clusters_frame(spark, few), 3).collect()} == {1: 1, 2: 1, 3: 3, 4: 3}
    assert {r["merged"] for r in models.merge_small(clusters_frame(spark, few), 100).collect()} == {1}


def test_forced_clusters(spark, sf_dir):
    assert len({r["merged"] for r in modelling.forced_clusters(spark, sf_dir).collect()}) == 5
