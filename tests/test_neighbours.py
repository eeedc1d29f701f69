"""Exact neighbours and local outlier factors against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.operators import neighbours
from kiln.operators.neighbours import local_outliers, nearest, vertices


def plain_lof(x, k):
    """All pairs; ties do not matter for the rows used here."""
    x = np.asarray(x, float)
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(dist, np.inf)
    k = min(k, len(x) - 1)
    order = np.argsort(dist, axis=1, kind="stable")[:, :k]
    far = np.take_along_axis(dist, order, 1)[:, -1]
    reach = np.maximum(np.take_along_axis(dist, order, 1), far[order]).mean(axis=1)
    density = np.array([1 / r if r > 0 else np.inf for r in reach])
    return np.array([np.mean([1.0 if density[j] == own else density[j] / own for j in o]) for o, own in zip(order, density)]), dist, order


def skewed(n=2000, seed=4):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(0, 0.01, (n // 2, 3)), rng.normal(5, 1, (n // 3, 3)), rng.uniform(-20, 20, (n - n // 2 - n // 3, 3))])
    x[:60] = x[0]                                       # more copies than neighbours
    x[100:108] = x[100]
    return x


@pytest.mark.parametrize("small", [False, True])
def test_local_outliers_of_skewed_rows(spark, monkeypatch, small):
    if small:                                           # many cells, slices and lanes
        for name, value in (("SLICE", 64), ("CELL", 100), ("QUERIES", 50), ("BROADCAST_ROWS", 1)):
            monkeypatch.setattr(neighbours, name, value)
    x = skewed()
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id int, a double, b double, c double").withColumn("v", F.lit("clash")).repartition(5)
    got = {r["id"]: r["lof"] for r in local_outliers(df, ["a", "b", "c"], 20).collect()}
    want = plain_lof(x, 20)[0]
    assert len(got) == len(x) and np.allclose([got[i] for i in range(len(x))], want, rtol=1e-9)
    near = {r["v"]: r["near"] for r in nearest(vertices(df, ["a", "b", "c"]), 20).collect()}
    assert len(near) == len(np.unique(x, axis=0)) and all(sum(e["w"] for e in a) == 20 for a in near.values())


def test_slices_are_spared(spark, monkeypatch):
    """Far cells are not asked: the copies are a small share of vertices times slices."""
    monkeypatch.setattr(neighbours, "SLICE", 64)
    monkeypatch.setattr(neighbours, "CELL", 64)
    seen, answered = [], neighbours._answered
    monkeypatch.setattr(neighbours, "_answered", lambda copies, *rest: (seen.append(copies.count()), answered(copies, *rest))[1])
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 1, (4000, 2))
    df = spark.createDataFrame(x.tolist(), "a double, b double")
    assert nearest(vertices(df, ["a", "b"]), 10).count() == 4000
    assert seen[0] < 4000 * (4000 / 64) / 4


def test_local_outliers_of_awkward_rows(spark):
    rows = [(0, 1.0, 1), (1, None, 1), (2, float("nan"), 2), (3, float("inf"), 2), (4, -0.0, 1), (5, 0.0, 1), (6, 3.0, None)]
    df = spark.createDataFrame(rows, "id int, a double, `b.c` int")
    got = {r["id"]: r["lof"] for r in local_outliers(df, ["a", "b.c"]).collect()}
    assert [got[i] is None for i in range(7)] == [False, True, True, True, False, False, True] and got[4] == got[5]
    assert np.allclose([got[0], got[4]], plain_lof([[1, 1], [0, 1], [0, 1]], 20)[0][:2])
    assert [r["lof"] for r in local_outliers(df.filter("id = 0"), ["a"]).collect()] == [1.0]
    assert local_outliers(df.limit(0), ["a"]).collect() == []
    same = local_outliers(spark.range(100).withColumn("a", F.lit(2.5)), ["a"], 5)
    assert {r["lof"] for r in same.collect()} == {1.0}


def test_validate_reports_the_share_of_local_outliers(spark):
    from kiln.operators.validate import validate
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 0.1, (300, 2)), [[30, 0], [0, -900]]])
    df = spark.createDataFrame([(float(a), float(b), None) for a, b in x] + [(None, 1.0, None)], "a double, b double, empty double")
    found = validate(df, with_local_outliers=True).filter("check = 'local_outliers'").collect()
    spread = x / np.ptp(x, axis=0)
    assert [(r["value"], r["passed"]) for r in found] == [(float((plain_lof(spread, 20)[0] > 1.5).mean()), True)]
