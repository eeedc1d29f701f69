"""Mixtures of all k in one pass, and k-means|| seeding, against plain versions."""
import numpy as np
import pytest
from pyspark.ml import PipelineModel

from kiln.operators import multikmeans as K
from kiln.operators.cluster import assemble, choose_k, fit_clusters, k_sweep
from kiln.operators.mixtures import Mixture, em_step, multi_gmm


def frame(spark, x):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)],
                                 "id long, " + ", ".join(f"x{j} double" for j in range(x.shape[1])))


def blobs(n=80, offset=0.0):
    rng = np.random.default_rng(3)
    parts = [rng.multivariate_normal(c, s, n) for c, s in (
        ((0, 0), ((1, .8), (.8, 1))), ((9, 1), ((.5, 0), (0, 2))), ((2, 12), ((2, -.5), (-.5, .4))))]
    return np.concatenate(parts) + offset


def plain_density(x, mix):
    cols = []
    for w, mu, cov in zip(mix.weights, mix.means, mix.covs):
        off = x - mu
        q = np.einsum("ni,ij,nj->n", off, np.linalg.inv(cov), off)
        cols.append(w * np.exp(-q / 2) / np.sqrt((2 * np.pi) ** x.shape[1] * np.linalg.det(cov)))
    return np.stack(cols, 1)


@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_a_step_equals_the_plain_one(spark, offset):
    x = blobs(offset=offset)
    start = Mixture(np.array([.3, .7]), np.array([[1., 1.], [4., 8.]]) + offset, np.array([[[4, 1], [1, 5]], [[9, 0], [0, 9]]], float))
    got = em_step(assemble(frame(spark, x), ["x0", "x1"]), start)
    dens = plain_density(x, start)
    r = dens / dens.sum(1)[:, None]
    mu = r.T @ x / r.sum(0)[:, None]
    assert np.isclose(got.log_likelihood, np.log(dens.sum(1)).sum())
    assert np.allclose(got.weights, r.mean(0)) and np.allclose(got.means, mu, rtol=0, atol=1e-6)
    for c in range(2):
        off = x - mu[c]
        assert np.allclose(got.covs[c], (r[:, c][:, None] * off).T @ off / r[:, c].sum() + 1e-6 * np.eye(2), atol=1e-6)
    assert list(got.sizes) == list(np.bincount(r.argmax(1), minlength=2))


def test_all_k_are_fitted_and_bic_finds_three(spark):
    x = blobs()
    vec = assemble(frame(spark, x), ["x0", "x1"])
    curve, models = k_sweep(vec, "GMM", return_models=True)
    assert [k for k, _ in curve] == list(range(2, 11)) and choose_k(curve, "GMM") == 3
    assert sorted(models[3].sizes) == [80, 80, 80]
    assert all(m.n == 240 and sum(m.sizes) == 240 and np.isclose(m.weights.sum(), 1) for m in models.values())
    assert np.isclose(models[3].log_likelihood, np.log(plain_density(x, models[3]).sum(1)).sum())


def test_the_fitted_step_scores_as_the_mixture_and_persists(spark, tmp_path):
    x = blobs(30)
    df = frame(spark, x)
    mix = multi_gmm(assemble(df, ["x0", "x1"]), [3])[3]
    PipelineModel([mix.model()]).write().overwrite().save(str(tmp_path / "m"))
    got = PipelineModel.load(str(tmp_path / "m")).transform(assemble(df, ["x0", "x1"])).orderBy("id").collect()
    dens = plain_density(x, mix)
    want = dens / dens.sum(1)[:, None]
    assert np.allclose([r["probability"] for r in got], want, atol=1e-9)
    assert [r["prediction"] for r in got] == list(want.argmax(1))


def test_min_cluster_size_bars_small_clusters(spark):
    curve, sizes = [(2, 50.0), (3, 40.0), (4, 10.0)], {2: [60, 40], 3: [50, 40, 10], 4: [50, 40, 8, 2]}
    assert choose_k(curve[:3] + [(5, 99.0)], "GMM", {**sizes, 5: [1] * 5}, 5) == 3
    assert choose_k(curve + [(5, 99.0)], "GMM") == 4
    assert choose_k(curve, "GMM", sizes, 1000) == 2
    far = np.concatenate([blobs(), [[200., 200.], [200.1, 200.], [200., 200.1]]])
    _m, lab, _c = fit_clusters(frame(spark, far), ["x0", "x1"], "GMM", min_cluster_size=20, ks=range(2, 6))
    assert min(r["count"] for r in lab.groupBy("cluster").count().collect()) >= 20 or lab.select("cluster").distinct().count() == 2


def test_more_components_than_points_and_equal_rows(spark):
    x = np.repeat([[0., 0.], [1., 5.]], 20, axis=0)
    models = multi_gmm(assemble(frame(spark, x), ["x0", "x1"]), [2, 4])
    assert sorted(models[2].sizes) == [20, 20]
    assert np.isfinite(models[4].log_likelihood) and sum(models[4].sizes) == 40


def test_seeding_takes_four_passes_and_is_no_worse_than_plain_starts(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(c, .3, (40, 2)) for c in rng.uniform(0, 30, (10, 2))])
    passes = []
    race, lloyd = K._race, K._lloyd_pass
    monkeypatch.setattr(K, "_race", lambda *a: passes.append("race") or race(*a))
    monkeypatch.setattr(K, "_lloyd_pass", lambda *a, **k: (passes.append("count") if "sums" in k else None) or lloyd(*a, **k))
    fits = K.multi_kmeans(assemble(frame(spark, x), ["x0", "x1"]), [(k, s) for k in (2, 10) for s in range(10)])
    assert passes == ["race", "race", "race", "count"]
    centre = np.array([x[i * 40:(i + 1) * 40].mean(0) for i in range(10)])
    best = ((x - centre[np.repeat(range(10), 40)]) ** 2).sum()
    assert min(v for (k, _s), (_c, v) in fits.items() if k == 10) <= best * (1 + 1e-9)


def test_the_race_draws_equal_points_once(spark):
    x = np.concatenate([np.zeros((500, 2)), [[3., 4.]], [[6., 8.]]])
    pts, d, _means = K._points(assemble(frame(spark, x), ["x0", "x1"]), "features")
    got = K._race(pts, {}, {0: 5, 1: 1}, 0, {0: 1, 1: 2}, d)
    pts.unpersist()
    assert len(got[0]) == 3 and len(got[1]) == 1


def test_given_centres_and_no_rows(spark):
    x = blobs(20)
    vec = assemble(frame(spark, x), ["x0", "x1"])
    start = np.array([[0., 0.], [5., 5.]])
    centres, inertia = K.multi_kmeans(vec, [(2, 0)], max_iter=1, tol=-1, init={(2, 0): start})[(2, 0)]
    near = ((x[:, None] - start) ** 2).sum(2).argmin(1)
    want = np.array([x[near == c].mean(0) for c in (0, 1)])
    assert np.allclose(centres, want) and np.isclose(inertia, ((x[:, None] - want) ** 2).sum(2).min(1).sum())
    with pytest.raises(ValueError):
        multi_gmm(vec.limit(0), [2])
