"""Ward clustering against a plain version that compares all pairs at every merge."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.operators.agglomerative import agglomerative, fit_ward
from kiln.operators.cluster import calinski_harabasz, fit_clusters


def plain_ward(x, k):
    groups = [[i] for i in range(len(x))]
    while len(groups) > k:
        means, n = np.array([x[g].mean(axis=0) for g in groups]), np.array([len(g) for g in groups], float)
        cost = np.multiply.outer(n, n) / np.add.outer(n, n) * ((means[:, None] - means[None]) ** 2).sum(axis=2)
        cost[np.tril_indices(len(groups))] = np.inf
        a, b = np.unravel_index(cost.argmin(), cost.shape)
        groups[a] += groups.pop(b)
    return {frozenset(g) for g in groups}


def frame(spark, x):
    return spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], ["id", *"abcdefgh"[:x.shape[1]]]).repartition(4)


def within(x, label):
    return sum(((x[label == c] - x[label == c].mean(axis=0)) ** 2).sum() for c in set(label))


def test_ward_is_the_rows_tree_where_leaves_suffice(spark):
    x = np.random.default_rng(8).normal(0, 1, (140, 3))
    x[:20] = x[20]                                      # copies
    df = frame(spark, x)
    tree = fit_ward(df, ["a", "b", "c"])
    ladder = {k: (w, s) for k, w, s in tree.ladder(range(1, 8))}
    assert ladder[1][1] is None
    for k in (2, 4, 7):
        out = tree.assign(df, ["a", "b", "c"], k)
        rows = out.select("id", "cluster").collect()
        groups = [frozenset(r["id"] for r in rows if r["cluster"] == c) for c in range(k)]
        assert set(groups) == plain_ward(x, k) and [len(g) for g in groups] == sorted(map(len, groups), reverse=True)
        label = np.array([r["cluster"] for r in sorted(rows)])
        assert ladder[k][0] == pytest.approx(within(x, label), rel=1e-9)
        assert ladder[k][1] == pytest.approx(calinski_harabasz(out, ["a", "b", "c"]).first()["score"], rel=1e-9)


def test_ward_over_leaves(spark):
    rng = np.random.default_rng(9)
    at = rng.uniform(-50, 50, (5, 2)) + 1e6             # a large offset keeps its digits
    kind = rng.choice(5, 6000, p=[0.6, 0.2, 0.1, 0.06, 0.04])
    x = at[kind] + rng.normal(0, 1, (6000, 2))
    tree, out = agglomerative(frame(spark, x), ["a", "b"], 5, leaves=100)
    label = np.array([r["cluster"] for r in out.select("id", "cluster").orderBy("id").collect()])
    assert len(tree.n) <= 100 and tree.n.sum() == 6000
    assert [set(kind[label == c]) for c in range(5)] == [{c} for c in range(5)]
    _tree, labeled, curve = fit_clusters(frame(spark, x), ["a", "b"], "Agglomerative")
    assert [k for k, _ in curve] == list(range(2, 11)) and labeled.columns[-2:] == ["cluster", "certainty"]
    assert labeled.agg(F.count_distinct("cluster")).first()[0] in dict(curve)
    assert tree.ladder([5])[0][1] == pytest.approx(within(x, label), rel=1e-6)


def test_ward_of_awkward_rows(spark):
    df = spark.createDataFrame([(0, 1.0), (1, None), (2, float("nan")), (3, float("inf")), (4, 9.0), (5, 9.0)], "cluster int, `a.b` double")
    tree, out = agglomerative(df.withColumn("id", F.col("cluster")), ["a.b"], 10)
    assert {r["id"]: r["cluster"] for r in out.collect()} == {0: 1, 1: None, 2: None, 3: None, 4: 0, 5: 0} and list(tree.n) in ([2, 1], [1, 2])
    assert [r["cluster"] for r in agglomerative(df.limit(0), ["a.b"], 3)[1].collect()] == []
    assert [r["cluster"] for r in agglomerative(df.filter("cluster in (1, 2)"), ["a.b"], 3)[1].collect()] == [None, None]
