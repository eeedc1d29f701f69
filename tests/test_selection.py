import numpy as np

from kiln.operators.select import corr_filter, correlation_matrix, top_correlated, variance_filter, vif_filter


def _frame(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=n)
    b = a * 2 + rng.normal(scale=0.01, size=n)
    c = rng.normal(size=n)
    d = a + c + rng.normal(scale=0.01, size=n)
    rows = [(float(x), float(y), float(z), float(w), 1.0) for x, y, z, w in zip(a, b, c, d)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, k double"), (a, b, c, d)


def test_correlation_matches_numpy(spark):
    df, (a, b, c, d) = _frame(spark)
    m = correlation_matrix(df, ["a", "b", "c", "d"])
    assert np.allclose(m, np.corrcoef([a, b, c, d]), atol=1e-10)


def test_filters(spark):
    df, _ = _frame(spark)
    assert variance_filter(df, ["a", "k"], 0.01) == ["a"]
    assert corr_filter(df, ["a", "b", "c"], 0.85) == ["a", "c"]
    assert corr_filter(df, ["a", "b", "c"], 0.85, keep=["b"]) == ["a", "b", "c"]
    # non-greedy: c is evicted by the (dropped) b? no: only |r| > thr with an earlier column counts
    assert corr_filter(df, ["b", "a", "c"], 0.85, greedy=True) == ["b", "c"]


def test_vif_drops_the_collinear_column(spark):
    df, _ = _frame(spark)
    dropped, kept = vif_filter(df, ["a", "b", "c", "d"], 10.0)
    assert len(dropped) >= 1 and all(v <= 10.0 for _c, v in kept)
    assert top_correlated(df, "a", ["a", "b", "c", "d"], n=1)[0][0] == "b"


def test_correlation_in_one_gram_pass_with_nulls_and_constants(spark):
    import numpy as np
    import pandas as pd
    from kiln.operators.select import correlation_matrix
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) + 1e6
    x[:, 11] = 3.0
    x[rng.random(x.shape) < 0.1] = np.nan
    names = [f"c{i}" for i in range(12)]
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in x]
    got = correlation_matrix(spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(3), names)
    want = pd.DataFrame(x, columns=names).corr().to_numpy()
    assert np.allclose(got[:11, :11], want[:11, :11], atol=1e-8) and np.isnan(got[11, :11]).all()


def test_block_products_by_any_route(spark):
    import pandas as pd

    from kiln.operators.gram import correlation_long
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 23)) @ rng.normal(size=(23, 23)) + 50
    x[rng.random(x.shape) < 0.15] = np.nan
    x[:, 5] = 2.0
    names = [f"c.{i}" for i in range(23)]
    df = spark.createDataFrame([tuple(float(v) if i % 2 else (None if np.isnan(v) else float(v)) for i, v in enumerate(r)) for r in x],     # nulls and NaN
                               ", ".join(f"`{c}` double" for c in names)).repartition(5)
    want = pd.DataFrame(x, columns=names).corr().to_numpy()
    np.fill_diagonal(want, 1.0)
    want[5, :5] = want[5, 6:] = want[:5, 5] = want[6:, 5] = np.nan
    for kw in ({"block": 7, "tiles": 3}, {"block": 256}, {"few": 40}):
        assert np.allclose(correlation_matrix(df, names, **kw), want, atol=1e-9, equal_nan=True), kw
    got = {(r["a"], r["b"]): r["r"] for r in correlation_long(df, names, block=5, tiles=4).collect()}
    assert len(got) == 23 * 22 // 2
    assert all((r is None and np.isnan(want[names.index(a), names.index(b)])) or np.isclose(r, want[names.index(a), names.index(b)]) for (a, b), r in got.items())


def test_many_blocks(spark):
    from pyspark.sql import functions as F
    d = 600
    df = spark.range(400).select(F.posexplode(F.array(*[F.lit(0)])).alias("p", "z"), "id").select(
        *[F.when((F.col("id") + i) % 50 != 0, F.sin(F.col("id") * (1 + i % 97)) + F.lit(i)).alias(f"x{i}") for i in range(d)])
    m = correlation_matrix(df, df.columns, block=100, tiles=8)
    assert m.shape == (d, d) and np.allclose(np.diag(m), 1) and np.isclose(m[3, 100], m[100, 3])
    a, b = (np.array([np.nan if (k + i) % 50 == 0 else np.sin(k * (1 + i % 97)) for k in range(400)]) for i in (3, 590))
    both = ~np.isnan(a) & ~np.isnan(b)
    assert np.isclose(m[3, 590], np.corrcoef(a[both], b[both])[0, 1])


def test_nan_is_missing_in_fits(spark):
    from kiln.operators.aggregate import entity_aggregate
    from kiln.operators.impute import fit_impute, null_cells
    from kiln.operators.outliers import fit_clip_iqr
    from kiln.operators.scale import fit_robust_scale, fit_standard_scale
    nan = float("nan")
    rows = [(1.0, "a"), (2.0, "a"), (nan, None), (4.0, None), (None, None), (100.0, "b")]
    df = spark.createDataFrame(rows, "x double, k string")
    same = spark.createDataFrame([(None if x != x else x, k) for x, k in rows], "x double, k string")
    assert null_cells(df) == null_cells(same) == 5
    for method in ("mean", "median", "zero"):
        filled = fit_impute(df, ["x"], method).transform(df)
        assert [r["x"] for r in filled.collect()] == [r["x"] for r in fit_impute(same, ["x"], method).transform(same).collect()]
    for fit in (fit_clip_iqr, fit_robust_scale, fit_standard_scale):
        assert fit(df, ["x"]).params_dict == fit(same, ["x"]).params_dict
    assert [r["x"] for r in fit_clip_iqr(df, ["x"]).transform(df).collect()][2] is None
    got = {r["k"]: (r["x"], r["k_mode"]) for r in entity_aggregate(df.selectExpr("k", "x", "k AS k2", "x AS k_mode"), "k", ["x"], [], ["k_mode"]).collect()}
    assert got[None] == (4.0, 4.0) and got["a"] == (3.0, 1.0)
