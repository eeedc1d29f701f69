"""
keep-first dedup is idempotent; fill leaves no null after the first value."""
import numpy as np
import pytest

from kiln.functions.stats import quantiles
from kiln.operators.dedup import dedup_signal
from kiln.operators.timeseries import fill_forward

SHAPES = {
    "heavy_ties": lambda r: r.integers(0, 5, 2000).astype(float),
    "wide_range": lambda r: np.concatenate([r.normal(0, 1, 1500), [1e12, -1e12, 3e9]]),
    "tiny_gaps": lambda r: 1.0 + r.integers(0, 50, 1800) * 1e-13,
    "lognormal": lambda r: r.lognormal(0, 3, 2500),
}


@pytest.mark.parametrize("shape", sorted(SHAPES))
def test_quantiles_refinement_equals_numpy(spark, shape):
    r = np.random.default_rng(len(shape))
    v = SHAPES[shape](r)
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = quantiles(df, ["x"], probs, collect_limit=25, buckets=8)["x"]
    exp = [float(np.quantile(v, p)) for p in probs]
    assert np.allclose(got, exp, rtol=1e-12, atol=0), (got, exp)


def test_dedup_idempotent_and_fill_complete(spark):
    r = np.random.default_rng(4)
    rows = [(i, int(r.integers(0, 5)), int(r.integers(0, 3)), None if r.random() < 0.3 else float(r.normal()))
            for i in range(600)]
    df = spark.createDataFrame(rows, "id long, a long, b long, v double")
    once = dedup_signal(df.select("id", "a", "b"), ["id"], "id")
    twice = dedup_signal(once, ["id"], "id")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    filled = fill_forward(df, "id", "a", ["v"], leading=None, buckets=5).collect()
    by_key: dict = {}
    for row in sorted(filled, key=lambda x: x["id"]):
        seen = by_key.setdefault(row["a"], [False])
        if row["v"] is not None:
            seen[0] = True
        assert not (seen[0] and row["v"] is None)
