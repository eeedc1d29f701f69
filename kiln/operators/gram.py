"""Pairwise-complete correlations of any number of columns (AGG-08) from block products.

The columns are cut into blocks of ``BLOCK``.  A task multiplies its batches block by
block (centred values, and masks where a block has missing values), so it holds one sum
a pair of blocks, a *tile*: ``TILES`` tiles at most in one scan of the rows, more scans
for more tiles.  The tasks' tiles meet in two levels (lanes, then one row a tile); a
merging task streams over rows sorted by tile and holds one tile at a time, so neither a
task's memory nor a group grows with the number of tasks.  What leaves is a block of
coefficients a tile.

Missing means null or NaN.  A few columns (``FEW``) go to Spark's own aggregates: one
pass without Python, the same coefficients.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.stats import known, qcol

FEW = 8
BLOCK = 256
TILES = 64
LANES = 32
PART = "bi int, bj int, lane int, sums binary"
SAMES = ("bi", "bj")


def pair_corr(x, y):
    """Column: Pearson coefficient over the rows that hold both, null where undefined."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(a, b), F.sqrt(F.var_pop(a)) * F.sqrt(F.var_pop(b)))


def _products(tiles, bounds):
    """Sums of each tile over a task's rows: n, the two sums and sums of squares over rows that hold both, the products."""
    def products(batches):
        from pyspark import TaskContext

        total = {(i, j): np.zeros((6, bounds[i][1] - bounds[i][0], bounds[j][1] - bounds[j][0])) for i, j in tiles}
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks = {}
            for b in {b for t in tiles for b in t}:
                columns = batch.columns[bounds[b][0]:bounds[b][1]]
                held = np.column_stack([~np.asarray(c.is_null()) for c in columns])
                x = np.column_stack([np.asarray(c.fill_null(0.0)) for c in columns])
                blocks[b] = x, x * x, None if held.all() else held.astype(float)
            for (i, j), t in total.items():
                (x, xx, hx), (y, yy, hy) = blocks[i], blocks[j]
                t[5] += x.T @ y
                if hx is None and hy is None:
                    t[0] += len(x)
                    t[1] += x.sum(axis=0)[:, None]
                    t[2] += y.sum(axis=0)[None]
                    t[3] += xx.sum(axis=0)[:, None]
                    t[4] += yy.sum(axis=0)[None]
                else:
                    hx, hy = np.ones_like(x) if hx is None else hx, np.ones_like(y) if hy is None else hy
                    t += np.stack([hx.T @ hy, x.T @ hy, hx.T @ y, xx.T @ hy, hx.T @ yy, np.zeros_like(t[5])])
        lane = TaskContext.get().partitionId() % LANES
        for (i, j), t in total.items():
            if t[0].any():
                yield _row(i, j, lane, t)
    return products


def _row(i, j, lane, t):
    return pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([lane], pa.int32()), pa.array([t.tobytes()], pa.binary())],
                                      names=["bi", "bj", "lane", "sums"])


def _merged(finish: bool):
    """Add up the rows of a tile (and lane); they follow each other."""
    def merged(batches):
        key, total = None, None
        for batch in batches:
            for row in batch.to_pylist():
                new = (row["bi"], row["bj"], None if finish else row["lane"])
                if key is not None and new != key:
                    yield from out(key, total)
                    total = None
                key, sums = new, np.frombuffer(row["sums"], float)
                total = sums.copy() if total is None else total + sums
        if key is not None:
            yield from out(key, total)

    def out(key, total):
        if not finish:
            yield _row(*key, total)
            return
        # the driver knows a tile's shape; the six sums share it
        n, sx, sy, sxx, syy, sxy = total.reshape(6, -1)
        with np.errstate(divide="ignore", invalid="ignore"):
            vx, vy = sxx - sx * sx / n, syy - sy * sy / n
            r = (sxy - sx * sy / n) / np.sqrt(vx * vy)
            r[(n < 2) | (vx <= 1e-12 * sxx) | (vy <= 1e-12 * syy)] = np.nan
        yield _row(key[0], key[1], 0, np.clip(r, -1.0, 1.0))
    return merged


def correlation_tiles(df: DataFrame, cols, block: int = BLOCK, tiles: int = TILES) -> tuple[list[DataFrame], list[tuple[int, int]]]:
    """Tables (one a scan) of the tiles' coefficients, row-major doubles, and the blocks' bounds."""
    d = len(cols)
    bounds = [(low, min(d, low + block)) for low in range(0, d, block)]
    raw = df.select(*[known(qcol(c).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)])
    row = raw.agg(*[F.avg(f"v{i}").alias(f"m{i}") for i in range(d)]).first()
    finite = [m if (m := row[f"m{i}"]) is not None and np.isfinite(m) else 0.0 for i in range(d)]
    centred = raw.select(*[(F.col(f"v{i}") - F.lit(finite[i])).alias(f"v{i}") for i in range(d)])
    spark = df.sparkSession
    # a task emits whole tiles, so it takes many splits rather than one
    centred = centred.coalesce(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    every = [(i, j) for i in range(len(bounds)) for j in range(i, len(bounds))]
    out = []
    for at in range(0, len(every), tiles):
        parts = centred.mapInArrow(_products(every[at:at + tiles], bounds), PART)
        lanes = parts.repartition(*SAMES, "lane").sortWithinPartitions(*SAMES, "lane").mapInArrow(_merged(False), PART)
        out.append(lanes.repartition(*SAMES).sortWithinPartitions(*SAMES).mapInArrow(_merged(True), PART).select("bi", "bj", "sums"))
    return out, bounds


def correlation_matrix(df: DataFrame, cols, block: int = BLOCK, tiles: int = TILES, few: int = FEW) -> np.ndarray:
    """Pairwise-complete Pearson matrix (NaN where undefined, 1 on the diagonal); columns x columns doubles on the driver."""
    cols = list(cols)
    d = len(cols)
    m = np.full((d, d), np.nan)
    if 2 <= d <= few:
        x = df.select(*[known(qcol(c).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)])
        pairs = list(combinations(range(d), 2))
        row = x.agg(*[pair_corr(F.col(f"v{i}"), F.col(f"v{j}")).alias(f"r{k}") for k, (i, j) in enumerate(pairs)]).first()
        for k, (i, j) in enumerate(pairs):
            if row[f"r{k}"] is not None:
                m[i, j] = m[j, i] = min(1.0, max(-1.0, row[f"r{k}"]))
    elif d > few:
        scans, bounds = correlation_tiles(df, cols, block, tiles)
        for scan in scans:
            for r in scan.collect():                       # the coefficients, once each
                (a, b), (p, q) = bounds[r["bi"]], bounds[r["bj"]]
                m[a:b, p:q] = np.frombuffer(r["sums"], float).reshape(b - a, q - p)
                m[p:q, a:b] = m[a:b, p:q].T
    np.fill_diagonal(m, 1.0)
    return m


def correlation_long(df: DataFrame, cols, block: int = BLOCK, tiles: int = TILES, few: int = FEW) -> DataFrame:
    """AGG-08 long form (a, b, r) for every pair a before b in ``cols`` order; from over ``few`` columns on, tasks write the pairs."""
    cols = list(cols)
    spark, schema = df.sparkSession, "a string, b string, r double"
    if len(cols) <= few:
        m = correlation_matrix(df, cols, few=few)
        return spark.createDataFrame([(cols[i], cols[j], None if np.isnan(m[i, j]) else float(m[i, j])) for i, j in combinations(range(len(cols)), 2)], schema)
    scans, bounds = correlation_tiles(df, cols, block, tiles)

    def pairs(batches):
        for batch in batches:
            for row in batch.to_pylist():
                (a, b), (p, q) = bounds[row["bi"]], bounds[row["bj"]]
                r = np.frombuffer(row["sums"], float).reshape(b - a, q - p)
                i, j = np.nonzero(np.add.outer(np.arange(a, b), -np.arange(p, q)) < 0)
                yield pa.RecordBatch.from_arrays([pa.array([cols[a + k] for k in i], pa.string()), pa.array([cols[p + k] for k in j], pa.string()),
                                                  pa.array(r[i, j], mask=np.isnan(r[i, j]))], names=["a", "b", "r"])
    held = [scan.mapInArrow(pairs, schema) for scan in scans]
    out = held[0]
    for more in held[1:]:
        out = out.unionByName(more)
    return out
