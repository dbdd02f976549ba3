"""Batched k-means against a plain Lloyd loop from the same first centres."""

import math

import numpy as np
import pytest

from tidewater.operators import clusters as C
from tidewater.operators import lloyd as L


def plain_lloyd(x, centres, rounds):
    centres, sse = centres.copy(), math.inf
    for n in range(rounds):
        far = ((x[:, None, :] - centres[None, :, :]) ** 2).sum(2)
        near = far.argmin(1)
        sse = far.min(1).sum()
        moved = np.stack([x[near == c].mean(0) if (near == c).any() else centres[c] for c in range(len(centres))])
        still = np.abs(moved - centres).max() <= 1e-9 * np.abs(moved).max()
        centres = moved
        if still:
            break
    return centres, sse, n + 1


@pytest.fixture(scope="module")
def blobs(spark):
    draw = np.random.default_rng(4)
    x = np.concatenate([draw.normal(c, 0.4, (150, 3)) for c in ((0, 0, 0), (3, 0, 1), (0, 4, 2), (5, 5, 5))])
    x[5] = x[6]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(900, None), (901, [1.0]), (902, [1.0, None, 2.0])]
    return x, spark.createDataFrame(rows + odd, "id int, vec array<double>").repartition(5)


@pytest.mark.parametrize("shipped", [0, L.SHIPPED])
def test_all_models_equal_plain_loops(blobs, shipped):
    x, df = blobs
    data = L.Rounds(df, "vec", sets=2, seed=3)
    models = L.fit_many(df, "vec", [1, 2, 5], starts=4, iterations=60, seed=3, sets=2, shipped=shipped)
    assert len(models) == 3 * 3 * 4
    for m in models:
        points = L.drawn(data.low, data.high, len(x), 3, m.space, 0) if m.space else x
        first = data.first_centres(m.space, 5, 4)[m.start, : m.k]
        centres, sse, rounds = plain_lloyd(points, first, 60)
        assert np.allclose(m.centres, centres, atol=1e-9) and m.sse == pytest.approx(sse, rel=1e-9) and m.rounds == rounds
    assert all(len(np.unique(data.first_centres(0, 5, 4)[s], axis=0)) == 5 for s in range(4))


def test_one_round_is_the_step(blobs):
    x, df = blobs
    sound = df.filter("id < 900")
    data = L.Rounds(df, "vec")
    firsts = data.first_centres(0, 4, 3)
    models = [L.Model(0, 4, s, firsts[s].copy()) for s in range(3)]
    L.lloyd_round(data, models)
    for s, m in enumerate(models):
        for r in C.kmeans_step(sound, "vec", firsts[s]).collect():
            assert m.centres[r.cluster][r.pos] == pytest.approx(r.centre)


def test_first_centres_do_not_depend_on_the_partitions(blobs):
    _, df = blobs
    a = L.Rounds(df.repartition(1), "vec").first_centres(0, 6, 3)
    b = L.Rounds(df.repartition(9), "vec").first_centres(0, 6, 3)
    assert np.array_equal(a, b)


def test_elbow_and_gap(spark, blobs):
    x, df = blobs
    curve = {r.k: r.wss for r in C.elbow(df, "vec", [1, 2, 4, 6], starts=10, iterations=100).collect()}
    assert curve[1] == pytest.approx(((x - x.mean(0)) ** 2).sum()) and curve[1] > curve[2] > curve[4] > curve[6]
    rows = sorted(C.gap_statistic(df, "vec", range(1, 7), sets=10, starts=5).collect())
    gaps = {r.k: r.gap for r in rows}
    assert max(gaps, key=gaps.get) == 4
    assert all(r.gap == pytest.approx(r.ref_log_w - r.log_w) for r in rows)
    none = spark.createDataFrame([], "vec array<double>")
    assert C.elbow(none, "vec", [2]).count() == 0 and C.gap_statistic(none, "vec", [2], sets=2).count() == 0


# ---- indices and kernel k-means


def test_indices_from_plain_formulas(spark, blobs):
    from tidewater.operators import indices as I

    x, df = blobs
    rows = {r.k: r.asDict() for r in I.cluster_indices(df, "vec", range(2, 7), starts=20).collect()}
    n, p = x.shape
    fits = {k: m.centres for k, m in L.best(L.fit_many(df, "vec", range(1, 8), 20)).items()}
    near = {k: ((x[:, None] - c[None]) ** 2).sum(2).argmin(1) for k, c in fits.items()}
    total = (x - x.mean(0)).T @ (x - x.mean(0))
    within = {k: sum((x[g == j] - x[g == j].mean(0)).T @ (x[g == j] - x[g == j].mean(0)) for j in range(k)) for k, g in near.items()}
    tr = {k: np.trace(w) for k, w in within.items()}
    pair = ((x[:, None] - x[None]) ** 2).sum(2)
    diff = lambda k: (k - 1) ** (2 / p) * tr[k - 1] - k ** (2 / p) * tr[k]
    for k in range(2, 7):
        g, got = near[k], rows[k]
        mean = np.stack([x[g == j].mean(0) for j in range(k)])
        size = np.array([(g == j).sum() for j in range(k)])
        radius = np.array([np.sqrt(((x[g == j] - mean[j]) ** 2).sum(1).mean()) for j in range(k)])
        gaps = np.sqrt(((mean[:, None] - mean[None]) ** 2).sum(2))
        db = np.mean([max((radius[i] + radius[j]) / gaps[i, j] for j in range(k) if j != i) for i in range(k)])
        sil = []
        for i in range(n):
            own = pair[i, g == g[i]].sum() / (size[g[i]] - 1)
            other = min(pair[i, g == j].mean() for j in range(k) if j != g[i])
            sil.append((other - own) / max(other, own))
        between = total - within[k]
        pooled = within[k] / (n - k)
        want = {
            "kl": abs(diff(k) / diff(k + 1)), "calinski_harabasz": (np.trace(between) / (k - 1)) / (tr[k] / (n - k)),
            "hartigan": (tr[k] / tr[k + 1] - 1) * (n - k - 1), "scott": n * np.log(np.linalg.det(total) / np.linalg.det(within[k])),
            "marriot": k * k * np.linalg.det(within[k]) / np.linalg.det(total), "trcovw": np.trace(pooled @ pooled), "tracew": tr[k],
            "friedman": np.trace(np.linalg.inv(within[k]) @ between), "rubin": np.linalg.det(total) / np.linalg.det(within[k]),
            "ratkowsky": np.mean(np.sqrt(np.diag(between) / np.diag(total))) / np.sqrt(k), "ball": tr[k] / k, "davies_bouldin": db,
            "silhouette": np.mean(sil), "dindex": np.mean([np.sqrt(((x[g == j] - mean[j]) ** 2).sum(1)).mean() for j in range(k)]),
        }
        for name, value in want.items():
            assert got[name] == pytest.approx(value, rel=1e-6), (k, name)
        assert np.isfinite(got["ccc"]) and got["sd"] > 0
    assert sum(r["votes"] for r in rows.values()) == len(I.VOTES) == 16
    assert max(rows, key=lambda k: rows[k]["votes"]) == 4
    assert I.voted({1: 9.0, 2: 5.0, 3: 5.0, 4: 1.0}, [2, 3], "max") == 2


def test_kernel_kmeans_with_all_rows_as_landmarks_is_exact(spark, blobs):
    x, df = blobs
    rows = C.kernel_kmeans(df, "vec", 4, gamma=0.3, landmarks=1000, starts=5).collect()
    assert len(rows) == len(x) and max(abs(r.missed) for r in rows) < 1e-6
    at = {r.id: r.cluster for r in rows}
    g = np.array([at[i] for i in range(len(x))])
    kernel = np.exp(-0.3 * ((x[:, None] - x[None]) ** 2).sum(2))
    # exact kernel k-means leaves every row where it is
    far = np.stack([kernel[g == j][:, g == j].mean() - 2 * kernel[:, g == j].mean(1) for j in range(4)], axis=1)
    assert (far.argmin(1) == g).all()
    some = C.landmark_features(df, "vec", 0.3, landmarks=40).collect()
    assert 0 <= max(r.missed for r in some) < 0.5


def test_a_step_holds_little():
    # 275 models of 1,650 centres took 125 MB a task
    import tracemalloc

    x = np.random.default_rng(2).normal(size=(6000, 64))
    models = [(i * 25 + s, x[s : s + k]) for i, k in enumerate(range(1, 12)) for s in range(25)]
    tracemalloc.start()
    found = L.met(x, models)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20 and all(n.sum() == 6000 for n, _, _ in found.values())
