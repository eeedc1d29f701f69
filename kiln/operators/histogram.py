"""Trees from mergeable histograms: predictive power of every feature (SEL-06, VAL-10/11) and softmax boosting (SEL-07).

Features are cut into ``BINS`` bins at their quantiles (one aggregate); rows are counted by
task into histograms of (feature, fold, bin, label) or of a tree's (node, feature, bin), and
only the histograms travel.  The number of jobs depends on neither features nor folds nor
classes: predictive power takes one pass (two for numbers), boosting one a level of a
round, for all classes and all feature lists together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.stats import qcol

BINS = 64
DEPTH, RATE, LAMBDA, LEAST_WEIGHT = 3, 0.3, 1.0, 1e-3


def bin_cuts(base: DataFrame, features, bins: int = BINS) -> list[np.ndarray]:
    """Ascending inner cuts of each feature; a value's bin is the number of cuts below it."""
    probs = [k / bins for k in range(1, bins)]
    row = base.agg(*[F.percentile_approx(qcol(c), probs, 10_000).alias(f"c{i}") for i, c in enumerate(features)]).first()
    return [np.unique(np.array(row[f"c{i}"] or [], float)) for i in range(len(features))]


def tasks_of(df: DataFrame) -> DataFrame:
    """Tasks emit whole histograms, so they take many splits rather than one."""
    spark = df.sparkSession
    return df.coalesce(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))


# ---------------------------------------------------------------- one-feature trees

def _impurity(n: np.ndarray, s: np.ndarray, q: np.ndarray | None) -> np.ndarray:
    """Weighted impurity (Gini or variance) of counts n and label sums s (rows x labels) or sums s and squares q."""
    with np.errstate(divide="ignore", invalid="ignore"):
        out = n - (s * s).sum(axis=-1) / n if q is None else q - s[..., 0] ** 2 / n
    return np.where(n > 0, out, 0.0)


def bin_tree(n: np.ndarray, s: np.ndarray, q: np.ndarray | None, depth: int) -> np.ndarray:
    """Segment number of each bin after the best cuts of one feature's bins, ``depth`` levels of them; the first of equals."""
    segment = np.zeros(len(n), int)
    todo, made = [(0, len(n), 0)], 1
    while todo:
        low, high, level = todo.pop()
        if level == depth or high - low < 2:
            continue
        cn, cs = np.cumsum(n[low:high]), np.cumsum(s[low:high], axis=0)
        cq = None if q is None else np.cumsum(q[low:high])
        whole = _impurity(cn[-1:], cs[-1:], None if q is None else cq[-1:])[0]
        parts = (_impurity(cn[:-1], cs[:-1], None if q is None else cq[:-1])
                 + _impurity(cn[-1] - cn[:-1], cs[-1] - cs[:-1], None if q is None else cq[-1] - cq[:-1]))
        parts[(cn[:-1] == 0) | (cn[-1] == cn[:-1])] = np.inf
        best = int(parts.argmin())
        if not parts[best] < whole - 1e-9 * max(1.0, abs(whole)):
            continue
        cut = low + best + 1
        segment[cut:high], made = made, made + 1
        todo += [(low, cut, level + 1), (cut, high, level + 1)]
    return segment


def _filled(pdf, folds: int, bins: int, labels: int):
    """Dense arrays (fold, bin, label) of counts and (fold, bin) of sums from a feature's rows."""
    n, s, q = np.zeros((folds, bins, labels)), np.zeros((folds, bins)), np.zeros((folds, bins))
    at = pdf["fold"].to_numpy(), pdf["bin"].to_numpy()
    np.add.at(n, (*at, pdf["label"].to_numpy()), pdf["n"].to_numpy())
    np.add.at(s, at, pdf["s"].to_numpy())
    np.add.at(q, at, pdf["q"].to_numpy())
    return n, s, q


def weighted_f1(confusion: np.ndarray) -> float:
    """F1 of each class (rows: actual, columns: predicted), weighted by the actual counts."""
    hit, actual, predicted = np.diag(confusion), confusion.sum(axis=1), confusion.sum(axis=0)
    with np.errstate(divide="ignore", invalid="ignore"):
        f1 = np.where(hit > 0, 2 * hit / (actual + predicted), 0.0)
    return float((f1 * actual).sum() / actual.sum())


def class_power(pdf, folds: int, depth: int) -> float:
    """Predictive power of one feature from its (fold, bin, label) counts."""
    labels = int(pdf["label"].max()) + 1
    n, _, _ = _filled(pdf, folds, int(pdf["bin"].max()) + 1, labels)
    confusion = np.zeros((labels, labels))
    for k in range(folds):
        train = n.sum(axis=0) - n[k]
        segment = bin_tree(train.sum(axis=1), train, None, depth)
        for g in np.unique(segment):
            confusion[:, train[segment == g].sum(axis=0).argmax()] += n[k][segment == g].sum(axis=0)
    counts = n.sum(axis=(0, 1))
    base = np.zeros((labels, labels))
    base[:, counts.argmax()] = counts
    low = weighted_f1(base)
    return 0.0 if low >= 1 else max(0.0, (weighted_f1(confusion) - low) / (1 - low))


def bin_means(pdf, folds: int, depth: int) -> np.ndarray:
    """Prediction (fold, bin) of one feature's regression trees from its (fold, bin) counts, sums and squares."""
    n, s, q = _filled(pdf, folds, int(pdf["bin"].max()) + 1, 1)
    n = n[..., 0]
    out = np.zeros(n.shape)
    for k in range(folds):
        tn, ts, tq = n.sum(axis=0) - n[k], s.sum(axis=0) - s[k], q.sum(axis=0) - q[k]
        segment = bin_tree(tn, ts[:, None], tq, depth)
        overall = ts.sum() / tn.sum() if tn.sum() else 0.0
        for g in np.unique(segment):
            held = tn[segment == g].sum()
            out[k, segment == g] = ts[segment == g].sum() / held if held else overall
    return out


def _label_histogram(base: DataFrame, features, cuts, clf: bool, centre: float) -> DataFrame:
    """(f, fold, bin, label, n, s, q): rows of every feature's bins by fold and label, one scan."""
    def counted(batches):
        total: dict = {}
        for batch in batches:
            y, fold = np.asarray(batch.column(len(features))), np.asarray(batch.column(len(features) + 1)).astype(np.int64)
            label = y.astype(np.int64) if clf else np.zeros(len(y), np.int64)
            v = np.zeros(len(y)) if clf else y - centre
            for f, cut in enumerate(cuts):
                code = np.searchsorted(cut, np.asarray(batch.column(f)), side="left")
                keys, at = np.unique(np.column_stack([fold, code, label]), axis=0, return_inverse=True)
                at = at.reshape(-1)
                sums = np.column_stack([np.bincount(at, minlength=len(keys)), np.bincount(at, v, len(keys)), np.bincount(at, v * v, len(keys))])
                for key, add in zip(map(tuple, keys.tolist()), sums):
                    key = (f, *key)
                    total[key] = total[key] + add if key in total else add
        if total:
            keys, sums = np.array(list(total)), np.array(list(total.values()))
            yield pa.RecordBatch.from_arrays([*(pa.array(keys[:, i].astype(np.int32)) for i in range(4)), *(pa.array(sums[:, i]) for i in range(3))],
                                             names=["f", "fold", "bin", "label", "n", "s", "q"])

    rows = tasks_of(base.select(*[qcol(c) for c in features], "__y", "__fold"))
    found = rows.mapInArrow(counted, "f int, fold int, bin int, label int, n double, s double, q double")
    return found.groupBy("f", "fold", "bin", "label").agg(*[F.sum(c).alias(c) for c in ("n", "s", "q")])


def feature_power(base: DataFrame, features, clf: bool, folds: int, depth: int, median: float | None = None, cuts=None) -> list[float]:
    """Predictive power of each feature of a prepared table (``__y``, ``__fold``); ``median`` of the target for numbers."""
    cuts = bin_cuts(base, features) if cuts is None else cuts
    hist = _label_histogram(base, features, cuts, clf, median or 0.0)
    if clf:
        def scored(pdf):
            import pandas as pd
            return pd.DataFrame({"f": [int(pdf["f"].iloc[0])], "score": [class_power(pdf, folds, depth)]})
        got = {r["f"]: r["score"] for r in hist.groupBy("f").applyInPandas(scored, "f int, score double").collect()}
        return [got.get(f, 0.0) for f in range(len(features))]

    def predicted(pdf):
        import pandas as pd
        return pd.DataFrame({"f": [int(pdf["f"].iloc[0])], "means": [bin_means(pdf, folds, depth).ravel().tolist()]})
    means = {r["f"]: np.array(r["means"]).reshape(folds, -1) for r in hist.groupBy("f").applyInPandas(predicted, "f int, means array<double>").collect()}
    if not means:
        return [0.0] * len(features)

    def missed(batches):
        total = np.zeros(len(features) + 1)
        for batch in batches:
            y, fold = np.asarray(batch.column(len(features))) - median, np.asarray(batch.column(len(features) + 1)).astype(np.int64)
            for f, cut in enumerate(cuts):
                total[f] += np.abs(y - means[f][fold, np.searchsorted(cut, np.asarray(batch.column(f)), side="left")]).sum()
            total[-1] += np.abs(y).sum()
        yield pa.RecordBatch.from_pydict({"f": pa.array(range(len(features) + 1), pa.int32()), "missed": total})

    rows = tasks_of(base.select(*[qcol(c) for c in features], "__y", "__fold"))
    off = {r["f"]: r["m"] for r in rows.mapInArrow(missed, "f int, missed double").groupBy("f").agg(F.sum("missed").alias("m")).collect()}
    whole = off[len(features)]
    return [max(0.0, 1 - off[f] / whole) if whole else 0.0 for f in range(len(features))]


# ---------------------------------------------------------------- softmax boosting

class Tree:
    """A tree in heap order from 1: feature (-1: a leaf), cut (bins up to it go left) and value of each node."""

    def __init__(self, depth: int):
        self.feature, self.cut, self.value = np.full(2 << depth, -1), np.zeros(2 << depth, int), np.zeros(2 << depth)

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        at = np.ones(len(codes), np.int64)
        while (inner := self.feature[at] >= 0).any():
            rows = np.flatnonzero(inner)
            here = at[rows]
            at[rows] = 2 * here + (codes[rows, self.feature[here]] > self.cut[here])
        return at


def gradients(codes: np.ndarray, y: np.ndarray, trees: list, classes: int):
    """Softmax gradient and curvature (rows x classes) of a model; ``trees`` has a list of trees a class."""
    score = np.zeros((len(y), classes))
    for c in range(classes):
        for tree in trees[c]:
            score[:, c] += tree.value[tree.nodes(codes)]
    p = np.exp(score - score.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    return p - (y[:, None] == np.arange(classes)), p * (1 - p)


def best_split(g: np.ndarray, h: np.ndarray, columns) -> tuple:
    """(gain, feature, cut, left G, left H, G, H) from (feature, bin) sums of a node; the first of equals, feature -1 if none."""
    total_g, total_h = g[columns[0]].sum(), h[columns[0]].sum()
    left_g, left_h = np.cumsum(g, axis=1)[:, :-1], np.cumsum(h, axis=1)[:, :-1]
    right_g, right_h = total_g - left_g, total_h - left_h
    gain = (left_g ** 2 / (left_h + LAMBDA) + right_g ** 2 / (right_h + LAMBDA) - total_g ** 2 / (total_h + LAMBDA)) / 2
    gain[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT)] = -np.inf
    others = np.ones(len(g), bool)
    others[columns] = False
    gain[others] = -np.inf
    f, cut = np.unravel_index(gain.argmax(), gain.shape)
    if not gain[f, cut] > 1e-9:
        return 0.0, -1, 0, 0.0, 0.0, total_g, total_h
    return float(gain[f, cut]), int(f), int(cut), float(left_g[f, cut]), float(left_h[f, cut]), float(total_g), float(total_h)


def softmax_boost(base: DataFrame, features, classes: int, lists=None, rounds: int = 20, depth: int = DEPTH, bins: int = BINS, cuts=None) -> list[dict]:
    """Gain of every used feature, a dict for each list of ``features`` in ``lists`` (default: one list, all): gradient
    boosting with softmax loss over ``__y`` in 0..classes - 1.

    A level of a round is one pass: tasks sum gradients by (list, class, node) into (feature, bin) histograms, a merging
    task streams over a node's histograms and picks its split, and the driver gets one row a node.
    """
    from kiln.session import materialize
    features = list(features)
    lists = [features] if lists is None else lists
    columns = [[features.index(c) for c in part] for part in lists]
    cuts = bin_cuts(base, features, bins) if cuts is None else cuts
    width = max(2, 1 + max(len(c) for c in cuts))

    def coded(batches):
        for batch in batches:
            codes = np.column_stack([np.searchsorted(cut, np.asarray(batch.column(f)), side="left") for f, cut in enumerate(cuts)]).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in codes], pa.binary()), pa.array(np.asarray(batch.column(len(features))).astype(np.int32))],
                                             names=["codes", "y"])

    rows = tasks_of(materialize(base.select(*[qcol(c) for c in features], "__y").mapInArrow(coded, "codes binary, y int")))
    models = [[[] for _ in range(classes)] for _ in lists]
    gains: list[dict] = [{} for _ in lists]
    keys = ["list", "class", "node"]

    def summed(growing, level):
        def run(batches):
            size = len(features) * width
            total = {k: np.zeros((2, size)) for k in ((m, c, node) for m, c in growing for node in range(1 << level, 2 << level))}
            base_at = np.arange(len(features)) * width
            for batch in batches:
                if not batch.num_rows:
                    continue
                codes = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, len(features))
                y = np.asarray(batch.column(1))
                for m in {m for m, _ in growing}:
                    g, h = gradients(codes, y, models[m], classes)
                    for c in range(classes):
                        if (m, c) not in growing:
                            continue
                        at = growing[m, c].nodes(codes)
                        for node in np.unique(at[at >= 1 << level]).tolist():
                            some = at == node
                            place = (codes[some] + base_at).ravel()
                            total[m, c, node] += [np.bincount(place, np.repeat(w[some, c], len(features)), size) for w in (g, h)]
            for (m, c, node), t in total.items():
                if t[1].any():
                    yield pa.RecordBatch.from_arrays([*(pa.array([v], pa.int32()) for v in (m, c, node)), pa.array([t.tobytes()], pa.binary())], names=[*keys, "sums"])
        return run

    def chosen(batches):
        key, total = None, None

        def out():
            g, h = total.reshape(2, len(features), width)
            split = best_split(g, h, columns[key[0]])
            types = (pa.float64(), pa.int32(), pa.int32(), *[pa.float64()] * 4)
            return pa.RecordBatch.from_arrays([*(pa.array([v], pa.int32()) for v in key), *(pa.array([v], t) for v, t in zip(split, types))],
                                              names=[*keys, "gain", "feature", "cut", "lg", "lh", "g", "h"])
        for batch in batches:
            for row in batch.to_pylist():
                new = tuple(row[k] for k in keys)
                if key is not None and new != key:
                    yield out()
                    total = None
                key, sums = new, np.frombuffer(row["sums"], float)
                total = sums.copy() if total is None else total + sums
        if key is not None:
            yield out()

    for _ in range(rounds):
        growing = {(m, c): Tree(depth) for m in range(len(lists)) for c in range(classes)}
        trees = dict(growing)
        for level in range(depth):
            if not growing:
                break
            found = (rows.mapInArrow(summed(growing, level), "list int, class int, node int, sums binary").repartition(*keys).sortWithinPartitions(*keys)
                     .mapInArrow(chosen, "list int, class int, node int, gain double, feature int, cut int, lg double, lh double, g double, h double")).collect()
            split = set()
            for r in found:
                m, c, node = r["list"], r["class"], r["node"]
                tree = trees[m, c]
                if level == 0:
                    tree.value[1] = -RATE * r["g"] / (r["h"] + LAMBDA)
                if r["feature"] < 0:
                    continue
                split.add((m, c))
                tree.feature[node], tree.cut[node] = r["feature"], r["cut"]
                tree.value[2 * node] = -RATE * r["lg"] / (r["lh"] + LAMBDA)
                tree.value[2 * node + 1] = -RATE * (r["g"] - r["lg"]) / (r["h"] - r["lh"] + LAMBDA)
                name = features[r["feature"]]
                gains[m][name] = gains[m].get(name, 0.0) + r["gain"]
            growing = {k: t for k, t in growing.items() if k in split}
        for (m, c), tree in trees.items():
            models[m][c].append(tree)
        if not any((t.feature >= 0).any() for t in trees.values()):
            break
    return gains
