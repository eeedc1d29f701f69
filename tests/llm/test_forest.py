"""Near vectors against the cosine of every pair."""

import math

import numpy as np
import pytest

from kiln.llm import forest


def plain(rows, least=0.9):
    """(vec_id, embedding) -> (vec_id, n_links, component_id, kept) rows from all pairs, and the linked pairs."""
    good = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    if good:
        size = len(rows[min(good, key=lambda i: (rows[i][0] is None, rows[i][0] or 0, len(rows[i][1])))][1])
        good = [i for i in good if len(rows[i][1]) == size]
    x = np.array([rows[i][1] for i in good], float)
    x = x / np.abs(x).max(axis=1, keepdims=True) if good else x
    x = x / np.linalg.norm(x, axis=1, keepdims=True) if good else x
    near = (x @ x.T >= least) if good else np.zeros((0, 0), bool)
    links, low = {i: 0 for i in range(len(rows))}, {i: rows[i][0] for i in range(len(rows))}
    for a, i in enumerate(good):
        links[i] = int(near[a].sum()) - 1
    todo = set(range(len(good)))
    while todo:
        group, edge = set(), {todo.pop()}
        while edge:
            group |= edge
            edge = {int(b) for a in edge for b in np.flatnonzero(near[a])} - group
        todo -= group
        ids = [rows[good[a]][0] for a in group if rows[good[a]][0] is not None]
        for a in group:
            low[good[a]] = min(ids, default=None)
    return [(r[0], links[i], low[i], r[0] is not None and r[0] == low[i]) for i, r in enumerate(rows)]


def make_vectors(d=24):
    rng = np.random.default_rng(4)
    unit = lambda x: x / np.linalg.norm(x)
    out = [unit(rng.normal(size=d)) for _ in range(300)]
    big = unit(rng.normal(size=d))
    out += [unit(big + rng.normal(size=d) * 0.02) for _ in range(150)]                       # a tight group
    loose = unit(rng.normal(size=d))
    out += [unit(loose + rng.normal(size=d) * 0.07) for _ in range(60)]                      # cosines on both sides of 0.9
    out += [unit(v + rng.normal(size=d) * s) for v in out[:60] for s in (0.03, 0.08)]
    chain = unit(rng.normal(size=d))
    for _ in range(20):
        chain = unit(chain + rng.normal(size=d) * 0.07)
        out.append(chain)
    rows = [(int(k), np.float32(v).tolist()) for k, v in zip(rng.permutation(len(out)), out)]
    rows += [(2000 + k, rows[0][1]) for k in range(80)] + [(2100, [x * 3 for x in rows[1][1]]), (5, rows[7][1]), (None, rows[9][1]), (None, rows[0][1])]
    rows += [(3000, None), (3001, [0.0] * d), (3002, [math.nan] * d), (3003, [None, *rows[0][1][1:]]), (3004, []), (3005, [1.0] * (d + 2)), (3006, [0.0] * d), (None, None), (3007, [math.inf] * d)]
    return rows


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "'clash' AS v", "1 AS m", "2 AS ball", "3 AS x", "4 AS node", "5 AS label").repartition(3)
    return [tuple(r) for r in forest.near_vectors(df, **kw).collect()]


def test_one_leaf_finds_every_link(spark):
    rows = make_vectors()
    assert sorted(run(spark, rows), key=str) == sorted(plain(rows), key=str)
    assert sorted(run(spark, rows, ball_sample=0), key=str) == sorted(plain(rows), key=str)


@pytest.mark.parametrize("kw", [{"leaf": 40}, {"leaf": 40, "leaf_most": 100, "sample": 200, "ball_sample": 100}])
def test_recall_of_small_leaves(spark, kw):
    rows = make_vectors()
    got, want = run(spark, rows, **kw), plain(rows)
    assert sorted((r[0] for r in got), key=str) == sorted((r[0] for r in want), key=str)
    assert sum(r[1] for r in got) >= 0.97 * sum(r[1] for r in want)
    by_id = {r[0]: r for r in want if r[0] is not None}
    assert all(r[1] <= by_id[r[0]][1] for r in got if r[0] is not None and r[0] != 5)        # no link below the limit
    assert np.mean([r[2] == by_id[r[0]][2] for r in got if r[0] is not None and r[0] != 5]) > 0.95


def test_none_and_alone(spark):
    assert run(spark, []) == []
    assert sorted(run(spark, [(1, None), (2, [0.0, 0.0]), (None, None)]), key=str) == sorted([(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, False)], key=str)
    assert run(spark, [(4, [1.0, 0.0])]) == [(4, 0, 4, True)]


def test_query_whole_table(spark):
    from test_models import SF
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(tuple(r) for r in forest.op13(spark, SF).collect()) == sorted(plain(rows))
