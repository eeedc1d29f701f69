"""Trees from histograms against plain ones; rotations; exact level ranks."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.operators import histogram as H
from kiln.operators import model_select as M


def plain_tree(rows, depth, score):
    """Recursive best cut of (x, y) rows by brute force: a function from x to the rows of its leaf."""
    def grow(rows, level):
        best = None
        for cut in sorted({x for x, _ in rows})[:-1] if level < depth else []:
            left, right = [r for r in rows if r[0] <= cut], [r for r in rows if r[0] > cut]
            cost = score(left) + score(right)
            if cost < score(rows) - 1e-9 * max(1, score(rows)) and (best is None or cost < best[0] - 1e-12):
                best = cost, cut, left, right
        if best is None:
            return lambda x: rows
        _, cut, left, right = best
        a, b = grow(left, level + 1), grow(right, level + 1)
        return lambda x: a(x) if x <= cut else b(x)
    return grow(rows, 0)


def gini(rows):
    counts = {}
    for _, y in rows:
        counts[y] = counts.get(y, 0) + 1
    return len(rows) - sum(c * c for c in counts.values()) / len(rows)


def spread(rows):
    mean = sum(y for _, y in rows) / len(rows)
    return sum((y - mean) ** 2 for _, y in rows)


def plain_power(rows, folds, depth, clf):
    pairs = []
    for k in range(folds):
        train = [(x, y) for x, y, f in rows if f != k]
        tree = plain_tree(train, depth, gini if clf else spread)
        for x, y, f in rows:
            if f == k:
                leaf = [b for _, b in tree(x)]
                pairs.append((y, min(set(leaf), key=lambda v: (-leaf.count(v), v)) if clf else sum(leaf) / len(leaf)))
    if not clf:
        mid = float(np.median([y for _, y, _ in rows]))
        return max(0.0, 1 - sum(abs(a - b) for a, b in pairs) / sum(abs(y - mid) for _, y, _ in rows))

    def f1(pairs):
        out = 0
        for c in {a for a, _ in pairs}:
            hit, actual, said = (sum(t) for t in zip(*[(a == b == c, a == c, b == c) for a, b in pairs]))
            out += actual * (2 * hit / (actual + said) if hit else 0)
        return out / len(pairs)
    ys = [y for _, y, _ in rows]
    top = min(set(ys), key=lambda v: (-ys.count(v), v))
    low = f1([(y, top) for y in ys])
    return 0.0 if low >= 1 else max(0.0, (f1(pairs) - low) / (1 - low))


def test_power_of_every_feature_against_plain_trees(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        c = rng.choice(["a", "b", "b", "c"])
        rows.append((float(ord(c) - 97 + rng.randrange(3)), float(rng.randrange(12)), c, {"a": 1.0, "b": 5.0, "c": 2.0}[c] + rng.randrange(3), i % 4))
    df = spark.createDataFrame(rows, "tells double, noise double, cls string, num double, fold int").repartition(3)
    for target, column, clf in (("cls", 2, True), ("num", 3, False)):
        if not clf:
            df = df.withColumn("num", F.col("num") + F.rand(3) * 0).withColumn("wide", F.col("num") * 1.0)
        frame = df if clf else df.select("tells", "noise", "fold", (F.col("num") + F.col("tells") / 100 + F.col("noise") / 1000).alias("num"))
        want_rows = [tuple(r) for r in frame.select("tells", "noise", target, "fold").collect()]
        got = dict(M.predictive_power(frame, ["tells", "noise"], target, max_depth=3, fold="fold"))
        for at, name in enumerate(("tells", "noise")):
            assert got[name] == pytest.approx(plain_power([(r[at], r[2], r[3]) for r in want_rows], 4, 3, clf), abs=1e-9), (target, name)
    assert M.predictive_power(df.limit(0), ["tells", "noise"], "cls") == [("tells", 0.0), ("noise", 0.0)]


def test_power_uses_few_jobs(spark):
    df = spark.range(300).select(*[((F.col("id") * (k + 3)) % 17).cast("double").alias(f"x{k}") for k in range(40)], (F.col("id") % 3).cast("string").alias("y"))
    before = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("power", "power")
    M.predictive_power(df, [f"x{k}" for k in range(40)], "y")
    many = len(before.getJobIdsForGroup("power"))
    spark.sparkContext.setJobGroup("power2", "power2")
    M.predictive_power(df, ["x0", "x1"], "y")
    assert many <= len(before.getJobIdsForGroup("power2")) + 4
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_levels_are_ranked_exactly_at_any_number(spark):
    rows = [(f"v{i:04d}", i) for i in range(900) for _ in range(1 + i % 3)] + [(None, 5)]
    df = spark.createDataFrame(rows, "t text".replace("text", "string") + ", i int").repartition(4)
    order = sorted({(-(1 + i % 3), f"v{i:04d}") for i in range(900)})
    want = {v: k + 1.0 for k, (_, v) in enumerate(order)}
    got = M.encoded(df.withColumn("u", F.col("t")), ["t"]).select("u", "t").distinct().collect()
    assert {r["u"]: r["t"] for r in got} == want | {None: None}


def plain_boost(x, y, classes, rounds, depth):
    """Softmax boosting over every cut of every column, row by row."""
    score, gains = [[0.0] * classes for _ in y], {}
    for _ in range(rounds):
        grads = []
        for s, t in zip(score, y):
            e = [math.exp(v) for v in s]
            p = [v / sum(e) for v in e]
            grads.append([(p[c] - (t == c), p[c] * (1 - p[c])) for c in range(classes)])
        for c in range(classes):
            def leaf(rows):
                return -H.RATE * sum(grads[i][c][0] for i in rows) / (sum(grads[i][c][1] for i in rows) + H.LAMBDA)

            def worth(rows):
                return sum(grads[i][c][0] for i in rows) ** 2 / (sum(grads[i][c][1] for i in rows) + H.LAMBDA)

            def grow(rows, level):
                best = None
                if level < depth:
                    for f in range(len(x[0])):
                        for cut in sorted({x[i][f] for i in rows})[:-1]:
                            left, right = [i for i in rows if x[i][f] <= cut], [i for i in rows if x[i][f] > cut]
                            if min(sum(grads[i][c][1] for i in part) for part in (left, right)) < H.LEAST_WEIGHT:
                                continue
                            gain = (worth(left) + worth(right) - worth(rows)) / 2
                            if gain > 1e-9 and (best is None or gain > best[0] + 1e-12):
                                best = gain, f, left, right
                if best is None:
                    value = leaf(rows)
                    for i in rows:
                        score[i][c] += value
                    return
                gains[best[1]] = gains.get(best[1], 0.0) + best[0]
                grow(best[2], level + 1)
                grow(best[3], level + 1)
            grow(list(range(len(y))), 0)
    return gains


def test_softmax_boosting_against_a_plain_one(spark):
    rng = random.Random(6)
    x = [[float(rng.randrange(6)), float(rng.randrange(5)), float(rng.randrange(4))] for _ in range(160)]
    y = [0 if a[0] < 2 else (1 if a[1] > 2 or rng.random() < 0.1 else 2) for a in x]
    df = spark.createDataFrame([(*a, float(b)) for a, b in zip(x, y)], "p double, q double, r double, __y double").repartition(3)
    whole, tail = H.softmax_boost(df, ["p", "q", "r"], 3, [["p", "q", "r"], ["q", "r"]], rounds=3, depth=2)
    want = plain_boost(x, y, 3, 3, 2)
    assert {"pqr"[f]: v for f, v in want.items()}.keys() == whole.keys()
    for f, v in want.items():
        assert whole["pqr"[f]] == pytest.approx(v, rel=1e-6)
    some = plain_boost([a[1:] for a in x], y, 3, 3, 2)
    assert {"qr"[f] for f in some} == tail.keys() and all(tail["qr"[f]] == pytest.approx(v, rel=1e-6) for f, v in some.items())


def test_sulov_with_three_classes(spark):
    rng = random.Random(1)
    rows = [((c := rng.randrange(3)) + rng.random() / 2, rng.random(), "xyz"[c]) for _ in range(300)]
    df = spark.createDataFrame(rows, "tells double, noise double, y string")
    kept, mi = M.sulov_select(df, ["noise", "tells"], "y", trees=4)
    assert "tells" in kept and mi[0][0] == "tells"


def test_rotation_and_importance(spark):
    n = 103
    df = spark.createDataFrame([(i, float(i * i), float(-i)) for i in range(n)], "i int, a double, b double").repartition(3)
    got = M.rotated(df, ["a", "b"], [1, 3], order_by="i", buckets=1).select("i", "__x", "__r").collect()
    assert len(got) == n
    for r in got:
        for k, shift in enumerate((1, 3)):
            j = (r["i"] + shift) % n
            assert r["__r"][k] == [float(j * j), float(-j)]
    few = M.rotated(df.filter("i < 2"), ["a"], [1, 2, 5], order_by="i", buckets=1).orderBy("i").collect()
    assert [r["__r"] for r in few] == [[[1.0], [0.0], [1.0]], [[0.0], [1.0], [0.0]]]
    many = M.rotated(df.withColumn("__rid", F.xxhash64("i")), ["a", "b"], [1, 2], buckets=5).collect()
    for k in range(2):          # a rotation only moves values
        assert sorted(r["__r"][k][0] for r in many) == sorted(r["a"] for r in many)
    rng = np.random.default_rng(0)
    rows = [(float(x), float(z), "p" if x > 0 else "q") for x, z in rng.normal(size=(400, 2))]
    imp = dict(M.permutation_importance(spark.createDataFrame(rows, "x double, z double, y string"), ["x", "z"], "y", trees=8))
    assert imp["x"] > 0.3 and abs(imp["z"]) < 0.05
    reg = dict(M.permutation_importance(spark.createDataFrame([(x, z, 3 * x + z / 100) for x, z, _ in rows], "x double, z double, y double"), ["x", "z"], "y", trees=8))
    assert reg["x"] > 0.5 and abs(reg["z"]) < 0.1
    assert M.permutation_importance(spark.createDataFrame([], "x double, y string"), ["x"], "y") == [("x", 0.0)]


def test_rotation_of_one_bucket_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "ROWS_PER_BUCKET", 10)
    n = 103
    df = spark.createDataFrame([(i, float(i)) for i in range(n)], "i int, a double").repartition(3)
    out = M.rotated(df, ["a"], [1, 7, 45], order_by="i", buckets=1)
    got = out.select("i", "__r").collect()
    assert sorted(r["i"] for r in got) == list(range(n))
    assert all(r["__r"] == [[float((r["i"] + s) % n)] for s in (1, 7, 45)] for r in got)
    assert "__blk" in next(line for line in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window" in line)
    tied = M.rotated(df.withColumn("k", F.lit(1)), ["a"], [1], order_by="k", buckets=1).collect()     # equal keys: one circle all the same
    assert sorted(r["__r"][0][0] for r in tied) == [float(i) for i in range(n)]
    by_rid = M.rotated(df.withColumn("__rid", F.xxhash64("i")), ["a"], [3], buckets=2).collect()
    assert sorted(r["__r"][0][0] for r in by_rid) == [float(i) for i in range(n)]


def test_sulov_passes_read_held_columns(spark, monkeypatch):
    from kiln.session import reads_cache
    seen, real = [], M.is_classification
    monkeypatch.setattr(M, "is_classification", lambda df, t: seen.append((reads_cache(df), sorted(df.columns))) or real(df, t))
    df = spark.createDataFrame([(float(i % 7), float(i % 3), i % 2, "wide") for i in range(60)], "a double, b double, y int, text string")
    M.sulov_select(df, ["a", "b"], "y", trees=2)
    assert seen == [(True, ["a", "b", "y"])] and not reads_cache(df)
