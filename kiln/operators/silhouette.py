"""Euclidean silhouette without pairs of all rows (CLU-09), by sampling with a stated error bound.

A row's mean distance to a cluster is estimated from a Poisson sample of the cluster: a
member is drawn with a probability in proportion to the larger of its even share and its
share of the distances to a few first members, so that far members, which carry the sums,
are not missed; drawn distances are divided by their probability.  With
t = ln(4 n k / delta) / (2 epsilon^2), all sums are within epsilon (relative) with
probability 1 - delta, and the silhouette within 4 epsilon / (1 - epsilon) of the exact one.
A cluster of t members or fewer is taken whole; if all are, the value is exact (bound 0).

Passes: sizes, distances to the first members, the sample, the rows against the sample.
What the driver and a task hold is the samples: about 2 t vectors a cluster, which grows
with the logarithm of the rows, and one row a cluster.

Defined cases: rows with a missing (null, NaN) feature or label are left out; a row alone
in its cluster counts 0; fewer than two clusters give None.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.stats import known, qcol

EPSILON, DELTA, SEED = 0.1, 0.05, 42
BLOCK = 256


def _points(df: DataFrame, cols, cluster: str) -> DataFrame:
    """(c: label as text, x: array of doubles) of the rows that have all features."""
    cols = list(cols)
    if len(cols) == 1 and dict(df.dtypes)[cols[0]].startswith("array"):
        x = qcol(cols[0]).cast("array<double>")
    else:
        x = F.array(*[known(qcol(c).cast("double")) for c in cols])
    points = df.select(qcol(cluster).cast("string").alias("c"), x.alias("x"))
    return points.filter(F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)) & F.col("c").isNotNull())


def _matrix(column, d: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), d)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distance of every row of x to every row of y."""
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None] - 2 * x @ y.T, 0.0))


def euclidean_silhouette(df: DataFrame, cols, cluster: str = "cluster", epsilon: float = EPSILON, delta: float = DELTA, seed: int = SEED) -> dict:
    """silhouette (None below two clusters), bound (of its error, with probability 1 - delta), n, k, sampled."""
    points = _points(df, cols, cluster)
    row = points.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d")).first()
    sizes = {r["c"]: r["count"] for r in points.groupBy("c").count().collect()}           # a row a cluster
    n, k, d = row["n"], len(sizes), row["d"]
    if k < 2:
        return {"silhouette": None, "bound": None, "n": n, "k": k, "sampled": 0}
    names = sorted(sizes)
    t = math.ceil(math.log(4 * n * k / delta) / (2 * epsilon ** 2))
    centre = np.array(points.agg(F.array(*[F.avg(F.col("x")[i]) for i in range(d)]).alias("m")).first()["m"], float)
    large = [c for c in names if sizes[c] > t]
    first: dict = {}
    if large:
        shares = F.create_map(*[e for c in large for e in (F.lit(c), F.lit(min(1.0, 2 * math.log(2 * k / delta) / sizes[c])))])
        drawn = points.filter(F.rand(seed) < F.try_element_at(shares, F.col("c"))).collect()
        for r in drawn:
            first.setdefault(r["c"], []).append(np.array(r["x"]) - centre)
        first = {c: np.array(v) for c, v in first.items()}

    def reach(batches):
        total = {c: np.zeros(len(v)) for c, v in first.items()}
        for batch in batches:
            c, x = np.array(batch.column(0).to_pylist(), object), _matrix(batch.column(1), d) - centre
            for name, v in first.items():
                some = x[c == name]
                for at in range(0, len(some), BLOCK):
                    total[name] += distances(some[at:at + BLOCK], v).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([c for c, v in total.items() for _ in v], pa.string()), pa.array([j for v in total.values() for j in range(len(v))], pa.int32()),
                                          pa.array(np.concatenate([np.empty(0), *total.values()]))], names=["c", "j", "w"])

    weights: dict = {c: np.zeros(len(v)) for c, v in first.items()}
    if first:
        for r in points.mapInArrow(reach, "c string, j int, w double").groupBy("c", "j").agg(F.sum("w").alias("w")).collect():
            weights[r["c"]][r["j"]] = r["w"]

    def chances(batches):
        for batch in batches:
            c, x = np.array(batch.column(0).to_pylist(), object), _matrix(batch.column(1), d) - centre
            p = np.ones(len(c))
            for name in large:
                some = np.flatnonzero(c == name)
                share = np.full(len(some), 1 / sizes[name])
                w = weights.get(name, np.empty(0))
                if (w > 0).any():
                    for at in range(0, len(some), BLOCK):
                        part = some[at:at + BLOCK]
                        share[at:at + BLOCK] = np.maximum(share[at:at + BLOCK], (distances(x[part], first[name][w > 0]) / w[w > 0]).max(axis=1))
                p[some] = np.minimum(1.0, t * share)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=["c", "x", "p"])

    sample = points.mapInArrow(chances, "c string, x array<double>, p double").filter(F.rand(seed + 1) < F.col("p")).collect()
    held = {c: (np.array([r["x"] for r in sample if r["c"] == c]).reshape(-1, d) - centre, np.array([r["p"] for r in sample if r["c"] == c])) for c in names}

    def scored(batches):
        total, rows = 0.0, 0
        for batch in batches:
            c, x = np.array(batch.column(0).to_pylist(), object), _matrix(batch.column(1), d) - centre
            for at in range(0, len(c), BLOCK):
                part, label = x[at:at + BLOCK], c[at:at + BLOCK]
                sums = np.column_stack([distances(part, y) @ (1 / p) for y, p in (held[name] for name in names)])
                own = label[:, None] == np.array(names, object)[None]
                count = np.array([sizes[name] for name in names], float)
                near = np.where(own, np.inf, sums / count).min(axis=1)
                mine, size = sums[own], np.broadcast_to(count, own.shape)[own]
                a = mine / np.maximum(size - 1, 1)
                top = np.maximum(a, near)
                s = np.where((size > 1) & (top > 0), (near - a) / np.where(top > 0, top, 1), 0.0)
                total, rows = total + s.sum(), rows + len(s)
        yield pa.RecordBatch.from_pydict({"s": [float(total)], "n": pa.array([rows], pa.int64())})

    got = points.mapInArrow(scored, "s double, n bigint").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    exact = all(r["p"] >= 1 for r in sample) and len(sample) == n
    return {"silhouette": got["s"] / got["n"], "bound": 0.0 if exact else 4 * epsilon / (1 - epsilon), "n": n, "k": k, "sampled": len(sample)}
