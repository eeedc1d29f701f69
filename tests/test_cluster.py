import numpy as np

from kiln.operators.cluster import (calinski_harabasz, fit_clusters, kneedle, pca, persona_traits,
                                    personas)


def test_kneedle_finds_the_elbow():
    ks = list(range(2, 11))
    assert kneedle(ks, [1000, 400, 180, 120, 100, 90, 85, 82, 80]) == 4
    assert kneedle(ks, [10] * 9) == 3


def _blobs(spark):
    rng = np.random.default_rng(7)
    pts = np.concatenate([rng.normal(c, 0.3, size=(60, 2)) for c in ((0, 0), (5, 5), (0, 6))])
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "id long, x double, y double")


def test_kmeans_gmm_and_personas(spark):
    df = _blobs(spark)
    _m, lab, curve = fit_clusters(df, ["x", "y"], "KMeans", n_init=3)
    assert len(curve) == 9 and lab.select("cluster").distinct().count() == 3
    assert lab.agg({"certainty": "min"}).first()[0] == 1.0
    _g, glab, _ = fit_clusters(df, ["x", "y"], "GMM", k=3)
    c = [r[0] for r in glab.select("certainty").collect()]
    assert min(c) > 0.3 and max(c) <= 1.0
    p = personas(lab, ["x", "y"]).collect()
    assert sum(r["sample_size"] for r in p) == 180
    assert all(set(r["dominant_traits"]) == {"x", "y"} for r in p)


def test_calinski_harabasz_matches_formula(spark):
    df = _blobs(spark).withColumn("cluster", (__import__("pyspark.sql.functions", fromlist=["col"]).col("id") / 60).cast("int"))
    r = calinski_harabasz(df, ["x", "y"]).first()
    X = np.array([[row["x"], row["y"]] for row in df.orderBy("id").collect()])
    lab = np.repeat([0, 1, 2], 60)
    mu = X.mean(0)
    B = sum(60 * np.sum((X[lab == k].mean(0) - mu) ** 2) for k in range(3))
    W = sum(np.sum((X[lab == k] - X[lab == k].mean(0)) ** 2) for k in range(3))
    assert np.isclose(r["score"], (B / 2) / (W / (180 - 3)))
    z = persona_traits(df, ["x", "y"]).count()
    assert z == 6


def test_pca_retains_variance(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=200)
    rows = [(float(x), float(2 * x + rng.normal(scale=0.01)), float(rng.normal(scale=0.01))) for x in a]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    out, ratios = pca(df, ["a", "b", "c"], retain=0.95)
    assert out.columns == ["PC1"] and ratios[0] > 0.95
    assert abs(out.agg({"PC1": "avg"}).first()[0]) < 1e-9


def test_segment_one_call(spark):
    from pyspark.sql import functions as F

    from kiln.plans.clustering import segment
    df = _blobs(spark).withColumn("ClientID", (F.col("id") % 40)).drop("id")
    res = segment(df, algo="KMeans", k=3)
    assert res["policy"]["subject_id"] == "ClientID"
    assert set(res["features"]) == {"x", "y"}
    p = res["personas"].collect()
    assert len(p) == 3 and sum(r["sample_size"] for r in p) == 180


def test_segment_interactions_on_unscaled(spark):
    from pyspark.sql import functions as F

    from kiln.operators.features import build_interactions
    from kiln.plans.clustering import segment
    df = _blobs(spark).withColumn("ClientID", (F.col("id") % 40)).drop("id") \
        .withColumn("w", F.col("x") + 10.0)
    strat = {"interaction_priorities": [{"pair": ["w", "y"], "logic": "multiplication", "name": "wy"}]}
    exp = build_interactions(df, strat["interaction_priorities"]).agg(F.avg("wy")).first()[0]
    res = segment(df, strategy=strat, algo="KMeans", k=3)
    assert "wy" in res["features"]
    got = res["silver"].agg(F.avg("wy")).first()[0]
    assert abs(got - exp) < 1e-9                      # built from the unscaled columns (capped at p99)
    res2 = segment(df, strategy=strat, algo="KMeans", k=3, interactions_on="scaled")
    # in parity mode the interaction is built later, by the gold step, from the scaled silver
    assert "wy" in res2["features"] and "wy" not in res2["silver"].columns


def test_segment_with_interactions_and_pca_scores_raw_rows(spark, tmp_path):
    import numpy as np
    from pyspark.ml import PipelineModel
    from kiln.operators.score import score
    from kiln.plans.clustering import segment
    rng = np.random.default_rng(12)
    rows = [(float(a), float(b), float(c)) for a, b, c in rng.normal(size=(240, 3)) + rng.choice([0, 9, 18], size=(240, 1)) + 5]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    strategy = {"interaction_priorities": [{"pair": ["a", "b"], "logic": "ratio", "name": "a_per_b"}],
                "preprocessing_metadata": {"dimensionality_reduction_recommendation": {"method": "PCA", "variance_retention_threshold": 0.9}}}
    for doc in (strategy, {"interaction_priorities": strategy["interaction_priorities"]}):
        res = segment(df, doc, k=3)
        res["prep"].write().overwrite().save(str(tmp_path / "prep"))
        got = score(df, PipelineModel.load(str(tmp_path / "prep")), res["model"], res["features"])
        assert got.columns == ["a", "b", "c", "cluster"]
        want = sorted(r["count"] for r in res["labeled"].groupBy("cluster").count().collect())
        assert sorted(r["count"] for r in got.groupBy("cluster").count().collect()) == want


def test_euclidean_silhouette_within_its_bound(spark):
    import numpy as np

    from kiln.operators.silhouette import euclidean_silhouette
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(m, 3)) + c for m, c in ((1500, 0), (400, 3), (60, -4))] + [[[50.0, 0, 0]]])
    label = ["a"] * 1500 + ["b"] * 400 + ["c"] * 60 + ["alone"]
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    member = np.array([[a == b for b in sorted(set(label))] for a in label], float)
    sums, size, own = dist @ member, member.sum(axis=0), member.argmax(axis=1)
    a = sums[range(len(x)), own] / np.maximum(size[own] - 1, 1)
    b = np.where(member > 0, np.inf, sums / size).min(axis=1)
    want = float(np.where(size[own] > 1, (b - a) / np.maximum(a, b), 0).mean())
    df = spark.createDataFrame([(*map(float, v), c) for v, c in zip(x, label)] + [(1.0, None, 2.0, "a"), (1.0, float("nan"), 2.0, "b")], "x double, y double, z double, c string").repartition(3)
    whole = euclidean_silhouette(df, ["x", "y", "z"], "c", epsilon=0.05)
    assert whole["bound"] == 0 and abs(whole["silhouette"] - want) < 1e-6 and whole["n"] == len(x)
    some = euclidean_silhouette(df, ["x", "y", "z"], "c", epsilon=0.25)
    assert some["sampled"] < len(x) / 2 and abs(some["silhouette"] - want) < 0.05 < some["bound"]
    assert euclidean_silhouette(df.filter("c = 'a'"), ["x", "y", "z"], "c")["silhouette"] is None


def test_points_of_one_part_are_dealt_to_every_core(spark):
    from pyspark.sql import functions as F

    from kiln.operators import multikmeans as K
    from kiln.operators.cluster import assemble
    vec = assemble(spark.range(400).selectExpr("cast(id % 7 as double) x", "cast(id as double) y").coalesce(1), ["x", "y"])
    pts, _d, _means = K._points(vec, "features")
    rows = [r["n"] for r in pts.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(rows) >= spark.sparkContext.defaultParallelism and max(rows) < 200
    pts.unpersist()


def test_cells_give_the_plain_assignment_and_open_few_points(monkeypatch):
    import numpy as np

    from kiln.operators import multikmeans as K
    rng = np.random.default_rng(3)
    tally, seen = K._tally, []
    monkeypatch.setattr(K, "_tally", lambda total, x, *a: seen.append(x.shape[1]) or tally(total, x, *a))
    for n, d, k in ((1, 2, 3), (33, 1, 4), (3000, 3, 41), (40_000, 3, 6), (40_000, 2, 1)):
        x = rng.normal(0, 4, (n, d))
        x[: n // 3] = np.round(x[: n // 3])                             # many equal points, and ties
        models = {0: rng.normal(0, 4, (k, d)), 1: np.round(rng.normal(0, 3, (k, d))), 2: np.repeat(x[:1], k, 0)}
        del seen[:]
        got = K._assigned(*K._in_cells(x), models)
        for m, c in models.items():
            d2 = ((x[:, None] - c) ** 2).sum(2)
            near = d2.argmin(1)
            if m < 2:
                assert abs(got[m][0][:, 0] - np.bincount(near, minlength=k)).sum() <= (d2 <= d2.min(1)[:, None] + 1e-9).sum() - n
            else:
                assert got[m][0][0, 0] == n                             # equal centres: the first
            assert got[m][0][:, 0].sum() == n and np.allclose(got[m][0][:, 1:].sum(0), x.sum(0), atol=1e-8)
            assert np.isclose(got[m][1], d2.min(1).sum(), rtol=1e-9, atol=1e-8)
        if (n, k) == (40_000, 6):
            K._assigned(*K._in_cells(x), {0: models[0]})
            del seen[:]
            K._assigned(*K._in_cells(x), {0: models[0]})
            assert sum(seen) < n / 2


def test_the_input_of_a_sweep_is_made_once(spark):
    from kiln.operators.cluster import assemble, k_sweep
    made = spark.sparkContext.accumulator(0)

    def rows(batches):
        for b in batches:
            made.add(len(b))
            yield b

    df = spark.range(200, numPartitions=3).selectExpr("cast(id % 7 as double) x", "cast(id as double) y").mapInPandas(rows, "x double, y double")
    assert len(k_sweep(assemble(df, ["x", "y"]), ks=[2, 3], n_init=2)) == 2
    assert made.value == 200
