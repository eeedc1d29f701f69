"""Exact nearest neighbours of all rows, and the local outlier factor on top of them (VAL-09).

Equal vectors are one vertex with a weight, so copies never meet each other.  The exact k
neighbours of a vertex come from partitions instead of all pairs:

1. the vertices are dealt to their nearest pivot (a bounded sample by hash) and sorted by
   cell and distance to the pivot; runs of ``SLICE`` vertices are slices (rings of a cell);
2. inside its slice, and from the pivots, a vertex learns a bound of its k-th distance;
3. it is copied to the slices that can hold a nearer one: those whose ring its ball meets
   (triangle inequality) in cells that its ball reaches (hyperplane between two pivots);
4. a slice answers blocks of copies, and the answers of a vertex are merged.

A task holds one slice and ``QUERIES`` copies: a slice that many vertices ask is given to
many tasks.  The driver holds the pivots (``PIVOTS`` vectors at most) and one row a cell.
The bounds only spare work, so the result is exact at every size; the more dimensions
the data really have, the fewer slices they spare.

Ties: neighbours at equal distance are taken in the order of their vertex key.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions.stats import known, qcol
from kiln.session import materialize

K = 20
SLICE = 1024
CELL = 4 * SLICE
PIVOTS = 2048
QUERIES = 16_384
BLOCK = 256
BROADCAST_ROWS = 1_000_000
SLACK = 1e-9            # of a bound: rounding never spares a slice that ties with it


def matrix(column, d: int) -> np.ndarray:
    """The rows of a column of lists of d numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), float).reshape(len(column), d)


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distance of every row of x to every row of y, summed column by column."""
    total = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        step = x[:, j, None] - y[None, :, j]
        total += step * step
    return total


def blocks(n: int):
    return (slice(at, min(at + BLOCK, n)) for at in range(0, n, BLOCK))


def vector(cols) -> Column:
    """The numeric columns as one vector, null where one is missing (null, NaN) or infinite."""
    parts = [F.when(F.abs(x) < float("inf"), x + F.lit(0.0)) for x in (known(qcol(c).cast("double")) for c in cols)]
    return F.when(~F.exists(F.array(*parts), lambda v: v.isNull()), F.array(*parts))


def key(x: Column) -> Column:
    return F.md5(F.concat_ws(",", x.cast("array<string>")))


def vertices(df: DataFrame, cols) -> DataFrame:
    """(v key, x vector, w rows) of the distinct vectors."""
    points = df.select(vector(cols).alias("x")).filter(F.col("x").isNotNull())
    return points.groupBy("x").agg(F.count("*").alias("w")).select(key(F.col("x")).alias("v"), "x", "w")


def _dealt(points: DataFrame, pivots: np.ndarray, k: int) -> DataFrame:
    """(v, x, w, cell, r distance to the pivot, near bound from the pivots)."""
    d = pivots.shape[1]

    def deal(batches):
        for batch in batches:
            x = matrix(batch.column("x"), d)
            cell, r, near = np.zeros(len(x), np.int32), np.zeros(len(x)), np.full(len(x), np.inf)
            for part in blocks(len(x)):
                dist = np.sqrt(squares(x[part], pivots))
                cell[part], r[part] = dist.argmin(axis=1), dist.min(axis=1)
                if len(pivots) > k:
                    near[part] = np.partition(dist, k, axis=1)[:, k]        # k others at most this far, itself apart
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(r), pa.array(near)], names=["v", "x", "w", "cell", "r", "near"])

    return points.mapInArrow(deal, "v string, x array<double>, w bigint, cell int, r double, near double")


def _sliced(dealt: DataFrame, d: int, k: int) -> DataFrame:
    """(v, x, w, cell, r, s slice, u bound of the k-th distance); the frame is sorted by cell and r."""
    size = SLICE

    def sliced(part: pa.Table, s: int) -> pa.RecordBatch:
        x, u = matrix(part["x"], d), part["near"].to_numpy().copy()
        if len(x) > k:
            for b in blocks(len(x)):
                u[b] = np.minimum(u[b], np.sqrt(np.partition(squares(x[b], x), k, axis=1)[:, k]))
        part = part.drop(["near"]).append_column("s", pa.array(np.full(len(x), s, np.int64))).append_column("u", pa.array(u))
        return part.combine_chunks().to_batches()[0]

    def cut(batches):
        s, held = TaskContext.get().partitionId() << 32, None
        for batch in chain(batches, [None]):
            if batch is not None:
                held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            if held is None or not len(held):
                continue
            cells = held["cell"].to_numpy()
            edges, at = [0, *(np.flatnonzero(np.diff(cells)) + 1), len(cells)], 0
            for low, high in zip(edges, edges[1:]):
                at = low
                while high - at >= size or (high > at and (high < len(cells) or batch is None)):
                    yield sliced(held.slice(at, min(size, high - at)), s)
                    s, at = s + 1, min(at + size, high)
            held = held.slice(at)

    return dealt.mapInArrow(cut, "v string, x array<double>, w bigint, cell int, r double, s bigint, u double")


def _reached(points: DataFrame, pivots: np.ndarray, rings: dict) -> DataFrame:
    """(v, x, u, cell, low, high): the cells that a vertex's ball reaches and the distances to their pivot it covers."""
    d = pivots.shape[1]
    apart = np.sqrt(squares(pivots, pivots))
    least, most = (np.array([rings.get(j, (np.inf, -np.inf))[i] for j in range(len(pivots))]) for i in (0, 1))

    def reach(batches):
        for batch in batches:
            x, u, own = matrix(batch.column("x"), d), batch.column("u").to_numpy(), batch.column("cell").to_numpy()
            for part in blocks(len(x)):
                dist, ball, mine = np.sqrt(squares(x[part], pivots)), u[part, None], own[part]
                wide = ball * (1 + SLACK) + SLACK * (1 + dist)
                home = dist[np.arange(len(mine)), mine][:, None]
                gap = apart[mine]
                beyond = np.divide(dist ** 2 - home ** 2, 2 * gap, out=np.zeros_like(dist), where=gap > 0)
                i, j = np.nonzero((dist - wide <= most) & (dist + wide >= least) & (beyond <= wide))
                rows = pa.array(i + part.start)
                yield pa.RecordBatch.from_arrays([batch.column("v").take(rows), batch.column("x").take(rows), batch.column("u").take(rows), pa.array(j.astype(np.int32)),
                                                  pa.array((dist - wide)[i, j]), pa.array((dist + wide)[i, j])], names=["v", "x", "u", "cell", "low", "high"])

    return points.select("v", "x", "u", "cell").mapInArrow(reach, "v string, x array<double>, u double, cell int, low double, high double")


def _answered(copies: DataFrame, members: DataFrame, d: int, k: int) -> DataFrame:
    """(v, m neighbour, d distance, w its rows): the nearest of each slice; both frames have (s, lane)."""
    def answer(asked: pa.Table, held: pa.Table) -> pa.Table:
        out = {"v": [], "m": [], "d": [], "w": []}
        if len(asked) and len(held):
            held = held.sort_by("v")                    # places follow the keys: they settle ties
            x, names, weights = matrix(held["x"], d), held["v"], held["w"].to_numpy()
            place = {v: i for i, v in enumerate(names.to_pylist())}
            q, bound = matrix(asked["x"], d), asked["u"].to_numpy() * (1 + SLACK)
            mine = np.array([place.get(v, -1) for v in asked["v"].to_pylist()])
            for part in blocks(len(q)):
                dist, limit = np.sqrt(squares(q[part], x)), bound[part].copy()
                if len(x) > k:
                    limit = np.minimum(limit, np.partition(dist, k, axis=1)[:, k])
                i, j = np.nonzero(dist <= limit[:, None])
                w = weights[j] - (mine[part][i] == j)
                i, j, w = i[w > 0], j[w > 0], w[w > 0]
                order = np.lexsort((j, dist[i, j], i))
                i, j, w = i[order], j[order], w[order]
                before = np.cumsum(w) - w
                first = np.searchsorted(i, i)
                some = before - before[first] < k if len(i) else np.zeros(0, bool)
                i, j, w = i[some], j[some], w[some]
                out["v"].append(asked["v"].take(pa.array(i + part.start)).combine_chunks())
                out["m"].append(names.take(pa.array(j)).combine_chunks())
                out["d"].append(pa.array(dist[i, j]))
                out["w"].append(pa.array(w.astype(np.int64)))
        kinds = {"v": pa.string(), "m": pa.string(), "d": pa.float64(), "w": pa.int64()}
        return pa.table({c: pa.chunked_array(out[c], kinds[c]) for c in kinds})

    return copies.groupBy("s", "lane").cogroup(members.groupBy("s", "lane")).applyInArrow(answer, "v string, m string, d double, w bigint")


def sized(df: DataFrame) -> DataFrame:
    """A written frame, broadcast if it has few rows; else joins shuffle it."""
    df = materialize(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def nearest(points: DataFrame, k: int = K) -> DataFrame:
    """(v, near: the k nearest other rows as (d distance, m vertex, w rows of it), nearest first).

    ``points`` as of ``vertices``.  A vertex's own further rows are neighbours at distance 0;
    of k rows or fewer all others are; a row alone has no line here."""
    points = materialize(points)
    n, d = (lambda r: (r["n"], r["d"]))(points.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d")).first())
    spark = points.sparkSession
    if not n:
        return spark.createDataFrame([], "v string, near array<struct<d: double, m: string, w: bigint>>")
    pivots = np.array([r["x"] for r in points.orderBy("v").limit(min(PIVOTS, n // CELL + 1)).collect()], float)
    dealt = _dealt(points, pivots, k)
    tasks = min(n // CELL + 1, max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ordered = dealt.repartitionByRange(tasks, "cell", "r", "v").sortWithinPartitions("cell", "r", "v")
    held = materialize(_sliced(ordered, d, k))
    rings = {r["cell"]: (r["least"], r["most"]) for r in held.groupBy("cell").agg(F.min("r").alias("least"), F.max("r").alias("most")).collect()}
    slices = sized(held.groupBy("cell", "s").agg(F.min("r").alias("least"), F.max("r").alias("most")))
    reached = _reached(held, pivots, rings)
    copies = materialize(reached.join(slices, "cell").filter("low <= most AND high >= least").select("s", "v", "x", "u"))
    lanes = sized(copies.groupBy("s").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("lanes")))
    asked = copies.join(lanes, "s").withColumn("lane", F.pmod(F.xxhash64("v"), F.col("lanes")).cast("int")).drop("lanes")
    members = held.select("s", "v", "x", "w").join(lanes, "s").withColumn("lane", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1))).drop("lanes")
    found = _answered(asked, members, d, k).groupBy("v").agg(F.slice(F.array_sort(F.collect_list(F.struct("d", "m", "w"))), 1, k).alias("a"))
    before = F.transform("a", lambda e, i: F.struct(e["d"].alias("d"), e["m"].alias("m"), F.least(
        e["w"], F.lit(k) - F.aggregate(F.slice("a", F.lit(1), i), F.lit(0).cast("bigint"), lambda t, y: t + y["w"])).alias("w")))
    return found.select("v", F.filter(before, lambda e: e["w"] > 0).alias("near"))


def local_outliers(df: DataFrame, cols, k: int = K, name: str = "lof") -> DataFrame:
    """The rows of ``df`` with their local outlier factor: the mean reachability density of a row's k
    nearest rows by its own (about 1 inside a cluster, more for a row that lies sparser than its neighbours).

    Defined cases: rows with a missing or infinite value get null and are no neighbours; a row
    alone gets 1; rows with k copies or more are infinitely dense and get 1; a column called
    ``name`` is replaced."""
    points = materialize(vertices(df, cols))
    near = materialize(nearest(points, k))
    reach = near.select(F.col("v").alias("m"), F.element_at("near", -1)["d"].alias("far"))
    links = near.select("v", F.explode("near").alias("e")).select("v", "e.*")
    weighted = links.join(reach, "m").groupBy("v").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.greatest("d", "far")).alias("r"))
    density = materialize(weighted.select("v", F.when(F.col("r") > 0, F.col("n") / F.col("r")).otherwise(float("inf")).alias("own")))
    ratio = F.when(F.col("other") == F.col("own"), 1.0).otherwise(F.try_divide("other", "own"))
    scored = (links.join(density.select(F.col("v").alias("m"), F.col("own").alias("other")), "m").join(density, "v")
              .groupBy("v").agg((F.sum(F.col("w") * ratio) / F.sum("w")).alias("score")))
    mine = "__v"
    while mine in df.columns:
        mine += "_"
    joined = df.withColumn(mine, key(vector(cols))).join(scored.select(F.col("v").alias(mine), F.col("score").alias(mine + "_score")), mine, "left")
    kept = [qcol(c) for c in df.columns if c != name]
    return joined.select(*kept, F.when(vector(cols).isNotNull(), F.coalesce(qcol(mine + "_score"), F.lit(1.0))).alias(name))
