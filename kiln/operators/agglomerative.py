"""Agglomerative clustering with Ward's criterion (CLU-11) on mergeable clustering features.

The rows are summed up as leaves: rows, mean and squared distances of the vectors nearest
to one of ``LEAVES`` centres.  These sums merge by addition, so tasks keep one set each and
Spark adds them up.  The centres start as a sample of the distinct vectors by hash and
move to their leaf's mean for ``PASSES`` passes; with no more distinct vectors than leaves
every vector is a leaf of its own, and the tree is Ward's tree of the rows.  The leaves are
merged by a nearest-neighbour chain, which needs no table of their distances; the driver
holds the leaves only (``LEAVES`` vectors, whatever the number of rows).

The sum of squares within k clusters is that of the leaves plus the cost of their merges,
so the ladder of all k (and Calinski-Harabasz of each) costs no further pass.

Defined cases: rows with a missing or infinite value get no cluster and are not counted;
equal rows share a leaf; ties merge the leaves first in hash order; k above the number
of leaves gives one cluster a leaf; without rows every label is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.stats import qcol
from kiln.operators.neighbours import blocks, matrix, squares, vector, vertices
from kiln.session import materialize

LEAVES = 1024
PASSES = 4


def nearest_leaf(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([np.empty(0, int), *[squares(x[part], centres).argmin(axis=1) for part in blocks(len(x))]])


def features(points: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, mean and sum of squares about the mean of the vectors nearest to each centre."""
    size, d = centres.shape

    def sums(batches):
        n, off, square = np.zeros(size, np.int64), np.zeros((size, d)), np.zeros(size)
        for batch in batches:
            x, w = matrix(batch.column("x"), d), batch.column("w").to_numpy()
            leaf = nearest_leaf(x, centres)
            step = x - centres[leaf]
            np.add.at(n, leaf, w)
            np.add.at(off, leaf, step * w[:, None])
            np.add.at(square, leaf, (step * step).sum(axis=1) * w)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(n[held]), pa.array(square[held]), pa.array(list(off[held]), pa.list_(pa.float64()))], names=["leaf", "n", "square", "off"])

    parts = points.select("x", "w").mapInArrow(sums, "leaf int, n bigint, square double, off array<double>")
    total = parts.groupBy("leaf").agg(F.sum("n").alias("n"), F.sum("square").alias("square"), F.array(*[F.sum(F.col("off")[i]) for i in range(d)]).alias("off"))
    n, off, square = np.zeros(size, np.int64), np.zeros((size, d)), np.zeros(size)
    for r in total.collect():                       # a row a leaf
        n[r["leaf"]], square[r["leaf"]], off[r["leaf"]] = r["n"], r["square"], r["off"]
    shift = off / np.maximum(n, 1)[:, None]
    return n, centres + shift, np.maximum(square - n * (shift * shift).sum(axis=1), 0.0)


def ward_merges(n: np.ndarray, means: np.ndarray) -> list[tuple[float, int, int]]:
    """(cost, leaf, leaf) of all merges, cheapest first: a leaf stands for the cluster that holds it.

    The chain goes to the nearest cluster until two are nearest to each other."""
    weight, centre, live = n.astype(float), means.copy(), np.ones(len(n), bool)
    merges, trail = [], []
    while len(merges) < len(n) - 1:
        if not trail:
            trail.append(int(np.flatnonzero(live)[0]))
        tip = trail[-1]
        step = centre - centre[tip]
        cost = np.where(live, weight * weight[tip] / (weight + weight[tip]) * (step * step).sum(axis=1), np.inf)
        cost[tip] = np.inf
        near = int(cost.argmin())
        if len(trail) > 1 and cost[trail[-2]] <= cost[near]:
            near = trail[-2]
            del trail[-2:]
            keep, gone = min(tip, near), max(tip, near)
            merges.append((float(cost[near]), keep, gone))
            total = weight[keep] + weight[gone]
            centre[keep] = (centre[keep] * weight[keep] + centre[gone] * weight[gone]) / total
            weight[keep], live[gone] = total, False
        else:
            trail.append(near)
    return sorted(merges, key=lambda m: m[0])       # equal costs stay in the order of the chain


class WardTree:
    """Leaves (centres that rows go to, their rows and means) and the merges over them."""

    def __init__(self, centres, n, means, square):
        self.centres, self.n, self.means, self.square = centres, n, means, square
        self.merges = ward_merges(n, means)

    def labels(self, k: int) -> np.ndarray:
        """Cluster of each leaf, numbered by size (most rows first; ties: the first leaf)."""
        group = np.arange(len(self.n))
        for _, keep, gone in self.merges[:max(len(self.n) - k, 0)]:
            group[group == group[gone]] = group[keep]
        names, first, of = np.unique(group, return_index=True, return_inverse=True)
        rank = np.empty(len(names), int)
        rank[np.lexsort((first, -np.bincount(of, weights=self.n)))] = np.arange(len(names))
        return rank[of]

    def ladder(self, ks) -> list[tuple[int, float, float | None]]:
        """(k, sum of squares within, Calinski-Harabasz or None where it is undefined) for each k."""
        costs, rows = np.array([m[0] for m in self.merges]), int(self.n.sum())
        whole, out = float(self.square.sum() + costs.sum()), []
        for k in ks:
            within = float(self.square.sum() + costs[:max(len(self.n) - k, 0)].sum())
            defined = 1 < k < rows and within > 0
            out.append((k, within, (whole - within) / (k - 1) / (within / (rows - k)) if defined else None))
        return out

    def assign(self, df: DataFrame, cols, k: int, name: str = "cluster") -> DataFrame:
        """The rows with the cluster of their nearest leaf (new rows too); a batch at a time, no shuffle."""
        centres, labels, d = self.centres, self.labels(k).astype(np.int32), self.centres.shape[1]

        @F.pandas_udf("int")
        def nearest(vectors: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for x in vectors:
                held = x.notna().to_numpy()
                out = pd.array([None] * len(x), dtype="Int32")
                if held.any() and len(labels):
                    out[held] = labels[nearest_leaf(np.stack(x[held].to_list()).reshape(-1, d), centres)]
                yield pd.Series(out)

        return df.select(*[qcol(c) for c in df.columns if c != name], nearest(vector(cols)).alias(name))


def fit_ward(df: DataFrame, cols, leaves: int = LEAVES, passes: int = PASSES) -> WardTree:
    points = materialize(vertices(df, cols))
    centres = np.array([r["x"] for r in points.orderBy("v").limit(leaves).collect()], float).reshape(-1, len(list(cols)))
    n, means, square = features(points, centres)
    for _ in range(passes if points.count() > len(centres) else 0):
        centres = means[n > 0]
        n, means, square = features(points, centres)
    held = n > 0
    return WardTree(centres[held], n[held], means[held], square[held])


def agglomerative(df: DataFrame, cols, k: int, leaves: int = LEAVES) -> tuple[WardTree, DataFrame]:
    """(tree, the rows with ``cluster``: 0 is the largest)."""
    tree = fit_ward(df, cols, leaves)
    return tree, tree.assign(df, cols, k)
