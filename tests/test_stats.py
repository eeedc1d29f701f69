import numpy as np
import pytest

from kiln.functions.stats import quantiles

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


def _np(vals, probs):
    v = np.array([x for x in vals if x is not None], dtype=float)
    return [float(np.quantile(v, p)) for p in probs]


@pytest.mark.parametrize("path", ["percentile", "refine"])
def test_quantiles_match_numpy(spark, path):
    rng = np.random.default_rng(1)
    vals = list(rng.lognormal(size=3000)) + [5.0] * 400 + [None] * 50 + list(rng.integers(0, 7, 500).astype(float))
    df = spark.createDataFrame([(None if v is None else float(v),) for v in vals], "x double")
    kw = {"collect_limit": 37, "buckets": 16} if path == "refine" else {}
    got = quantiles(df, ["x"], PROBS, **kw)["x"]
    assert np.allclose(got, _np(vals, PROBS), rtol=0, atol=1e-12)


def test_quantiles_edge_columns(spark):
    df = spark.createDataFrame([(None, 3.0, 1), (None, 3.0, 2)], "a double, b double, c int")
    q = quantiles(df, ["a", "b", "c"], [0.5])
    assert q["a"] == [None]
    assert q["b"] == [3.0]
    assert q["c"] == [1.5]


def test_quantiles_with_infinities_and_extremes(spark):
    inf = float("inf")
    rng = np.random.default_rng(2)
    vals = list(rng.normal(size=500)) + [inf, inf, -inf, 1e308, -1e308, 5e-324, 0.0, -0.0]
    df = spark.createDataFrame([(float(v), float(abs(v))) for v in vals], "x double, y double")
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]
    for kw in ({}, {"collect_limit": 3, "buckets": 4}):
        got = quantiles(df, ["x", "y"], probs, **kw)
        for name, col in (("x", vals), ("y", [abs(v) for v in vals])):
            v = sorted(col)
            for p, q in zip(probs, got[name]):
                h = (len(v) - 1) * p
                lo, hi = v[int(h)], v[min(int(h) + 1, len(v) - 1)]
                want = lo if h == int(h) or lo == hi else (hi if hi == inf else lo if lo == -inf else lo + (hi - lo) * (h - int(h)))
                assert q == want or np.isclose(q, want, rtol=1e-12)


def test_quantiles_of_only_infinities_and_nan(spark):
    df = spark.createDataFrame([(float("inf"), float("nan"))] * 3 + [(float("-inf"), 1.0)], "x double, y double")
    q = quantiles(df, ["x", "y"], [0.0, 1.0])
    assert q["x"] == [float("-inf"), float("inf")]
    assert q["y"][0] == 1.0 and np.isnan(q["y"][1])
