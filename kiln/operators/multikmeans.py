"""Many k-means models in one pass per iteration (the k sweep, CLU-02).

The reference sweeps k = 2..10 with 10 restarts each: 90 models.  Fitting
them one after the other costs ~90 x 20 passes over the data.  Here every
pass serves all models at once:

* seeding (k-means||): one pass draws every model's first centre, each of
  ``SEED_ROUNDS`` further passes draws 2k candidates for every model, one more
  counts the points nearest each candidate, and the 1 + 4k weighted candidates
  of a model (a size that k sets, not the data) are reclustered to k centres.  So
  the passes are four, whatever k and the number of models.  Points are drawn
  with probability proportional to their squared distance to the model's
  candidates by an exponential race: key = E / D^2 with E ~ Exp(1) from a hash of
  (row id, model, round); the smallest keys win -- exact weighted sampling
  without replacement over all points;
* Lloyd iterations: each part's points lie in cells of at most ``CELL`` near points
  (median splits of the widest coordinate), cut once and cached as packed arrays.
  ``mapInArrow`` tests every cell for every active model: where one centre is nearest
  all over the cell's box, the cell counts as its mean, times its points; only the
  other cells are opened and their points assigned with numpy.  Runs of ``TILE`` cells
  are tested first in the same way, which also tells the centres that may be nearest
  in them.  That is the exact assignment; a pass costs the points along the borders
  of clusters and a small share of the rest.
  Per-part sums come out as (slot, value) rows, a slot for each count, coordinate and
  cost; one ``groupBy(slot).sum`` returns the new centres (models x k x d rows).
  Converged models drop out of later passes.

Inputs are vectors less the column means (so distances keep their digits on large
offsets) with a hash of the vector as row id, dealt evenly over at least every core and
cached once (a lost part is computed again with the same ids): seeds depend on the data
alone, not on its partitions; equal points count once in the seeding.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.operators.base import ColumnRules, register

# The per-partition functions of this module run inside Python workers: ship
# them by value with each task so executors need numpy/pandas but not kiln.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: ship kiln with --py-files instead
    pass

EXP_SALT = 0x5bd1e995
SEED_ROUNDS = 2       # rounds of 2k candidates after the first centre
RACE_BUCKETS = 64     # lists of winners merged before the last one
RECLUSTER_STEPS = 20  # Lloyd steps over a model's candidates
CHUNK = 4096          # rows whose distances to all centres are held at once
PART_BYTES = 32 << 20 # of points in a cached part
CELL = 32             # points of a cell at most
SUMMERS = 4           # tasks that add the parts' sums (files of many more would take most of a pass)
TILE = 512            # cells of a run, tested as one first (a power of two; its points stay in the core's cache)


def _points(vec: DataFrame, features: str) -> tuple[DataFrame, int, np.ndarray]:
    """(rid, x0..x{d-1}) as plain double columns (cheap Arrow batches), and the means they are less."""
    held, given = vec.select(features), vec.storageLevel.useMemory or vec.storageLevel.useDisk
    if not given:
        held.persist(StorageLevel.MEMORY_AND_DISK)      # else the input is made again for each of the reads below
    first = held.first()
    if first is None:
        raise ValueError("k-means needs at least one row")
    d = len(first[features])
    arr = vector_to_array(F.col(features))
    raw = held.select(*[arr[j].alias(f"x{j}") for j in range(d)])
    row = raw.agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"x{j}").alias(f"m{j}") for j in range(d)]).first()
    means = np.array([row[f"m{j}"] for j in range(d)], float)
    # a table of one row group, or a shuffle made few by its size, would leave all passes to a few tasks
    parts = max(vec.sparkSession.sparkContext.defaultParallelism, -(-row["n"] * 8 * (d + 1) // PART_BYTES))
    pts = raw.repartition(parts).select(*[(F.col(f"x{j}") - F.lit(float(means[j]))).alias(f"x{j}") for j in range(d)],
                     F.xxhash64(*[f"x{j}" for j in range(d)]).alias("rid"))
    pts.persist(StorageLevel.MEMORY_AND_DISK).count()
    if not given:
        held.unpersist()
    return pts, d, means


def _chunks(batches, d: int):
    """(coordinates, row ids) of at most CHUNK rows."""
    names = [f"x{j}" for j in range(d)]
    for pdf in batches:
        for i in range(0, len(pdf), CHUNK):
            part = pdf.iloc[i:i + CHUNK]
            yield part[names].to_numpy(dtype=np.float64), part["rid"].to_numpy().astype(np.int64).view(np.uint64)


def _uniform(rid: np.ndarray, salt: int) -> np.ndarray:
    """splitmix64 of (row id, salt) -> uniform (0, 1); deterministic per row."""
    with np.errstate(over="ignore"):
        z = rid + np.uint64(salt % (2 ** 64)) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / float(2 ** 53)


def _sq_dist(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :], 0.0)


def _to_centres(x: np.ndarray):
    """centres -> squared distances of the chunk's rows to them, a row a centre (few enough to stay in the core's cache)."""
    xx, xt = (x * x).sum(1)[None, :], np.ascontiguousarray(x.T)
    return lambda c: np.maximum(xx - 2 * (c @ xt) + (c * c).sum(1)[:, None], 0.0)


def _in_cells(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points (n, d) in cells of near points: coordinates (d, cells, slots), a cell's last slot twice
    where it has a point less, and (means, reaches, points, squares about the mean) of the cells."""
    n, d = x.shape
    levels = max(0, int(np.ceil(np.log2(n / CELL))))
    order, at = np.arange(n), np.arange(n)
    for level in range(levels):
        segment = (at << level) // n
        starts = np.searchsorted(segment, np.arange(1 << level))
        now = x[order]
        widest = (np.maximum.reduceat(now, starts) - np.minimum.reduceat(now, starts)).argmax(1)
        order = order[np.lexsort((now[at, widest[segment]], segment))]
    cells = 1 << levels
    starts = np.searchsorted((at << levels) // n, np.arange(cells))
    points = np.diff(np.append(starts, n))
    slots = starts[:, None] + np.minimum(np.arange(points.max()), points[:, None] - 1)
    packed = np.ascontiguousarray(x[order].T)[:, slots]
    held = np.arange(points.max()) < points[:, None]
    means = (packed * held).sum(2) / points
    off = np.abs(packed - means[:, :, None])
    return packed, np.vstack([means, off.max(2), points[None, :], (off * off * held).sum((0, 2))[None, :]])


def _blocks(pts: DataFrame, d: int) -> DataFrame:
    """The cells of each part as packed arrays, a row a part (parts are of PART_BYTES at most)."""
    def run(batches):
        x = [np.stack([b.column(f"x{j}").to_numpy(zero_copy_only=False) for j in range(d)], 1) for b in batches if b.num_rows]
        if x:
            packed, cells = _in_cells(np.concatenate(x).astype(np.float64))
            yield pa.RecordBatch.from_pydict({"slots": pa.array([packed.shape[2]], pa.int32()), "points": [packed.tobytes()], "cells": [cells.tobytes()]})

    return pts.mapInArrow(run, "slots int, points binary, cells binary").persist(StorageLevel.MEMORY_AND_DISK)


def _unpacked(batches, d: int):
    """(points, cells) as :func:`_in_cells` gives them."""
    for batch in batches:
        for i in range(batch.num_rows):
            cells = np.frombuffer(batch.column("cells")[i].as_buffer(), np.float64).reshape(2 * d + 2, -1)
            yield np.frombuffer(batch.column("points")[i].as_buffer(), np.float64).reshape(d, cells.shape[1], batch.column("slots")[i].as_py()), cells


def _nearest(scores: np.ndarray) -> np.ndarray:
    """One row is true in each column: the first of the largest scores."""
    best = scores == scores.max(0)
    return best if np.count_nonzero(best) == scores.shape[1] else np.arange(len(scores))[:, None] == scores.argmax(0)


def _tally(total: np.ndarray, x: np.ndarray, weight: np.ndarray, scores: np.ndarray) -> float:
    """Adds points (d, n) of some weight to the counts and sums of their nearest centres; gives their squared distances, added up."""
    part = _nearest(scores) * weight
    total[:, 0] += part.sum(1)
    total[:, 1:] += part @ x.T
    return float(np.maximum((x * x).sum(0) - 2 * scores.max(0), 0.0) @ weight)


def _leads(scores: np.ndarray, apart: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """How far the best centre of a box leads each centre at the box's corner that is worst for it (infinite for itself)."""
    best, at = scores.argmax(0), np.arange(scores.shape[1])
    lead = scores[best, at] - scores
    for gaps, r in zip(apart, reach):
        lead -= gaps[:, best] * r
    lead[best, at] = np.inf
    return lead


def _tiles(cells: np.ndarray, d: int, width: int) -> np.ndarray:
    """Runs of cells as larger cells, in the same form."""
    mean, reach, count, square = np.split(cells.reshape(2 * d + 2, -1, width), [d, 2 * d, 2 * d + 1])
    points = count.sum(2)
    centre = (mean * count).sum(2) / points
    off = np.abs(mean - centre[:, :, None])
    return np.vstack([centre, (off + reach).max(2), points, (square + (off * off).sum(0) * count).sum(2)])


def _assigned(points: np.ndarray, cells: np.ndarray, models: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, float]]:
    """Every model's (count and sums of each centre, cost) over the points of some cells."""
    d, slots = len(points), points.shape[2]
    width = min(TILE, cells.shape[1])
    tiles = _tiles(cells, d, width)
    half = {m: (c * c).sum(1)[:, None] / 2 for m, c in models.items()}
    # leads below this may be rounding
    size = float(2 * (tiles[:d] ** 2).sum(0).max() + 2 * (tiles[d:2 * d] ** 2).sum(0).max())
    least = {m: 1e-12 * (size + 2 * half[m].max()) for m in models}
    apart = {m: np.abs(c.T[:, :, None] - c.T[:, None, :]) for m, c in models.items()}
    total, cost, left = {}, {}, {}
    for m, c in models.items():
        total[m] = np.zeros((len(c), d + 1))
        scores = c @ tiles[:d] - half[m]
        lead = _leads(scores, apart[m], tiles[d:2 * d])
        left[m] = ~(lead > least[m]) | np.isinf(lead)       # the centres that may be nearest in a tile
        shut = left[m].sum(0) == 1
        cost[m] = _tally(total[m], tiles[:d, shut], tiles[2 * d, shut], scores[:, shut]) + float(tiles[-1, shut].sum())
        left[m][:, shut] = False
    for t in range(tiles.shape[1]):
        mine = cells[:, t * width:(t + 1) * width]
        mean, reach, count, square = mine[:d], mine[d:2 * d], mine[2 * d], mine[-1]
        x = np.ascontiguousarray(points[:, t * width:(t + 1) * width])
        held = (np.arange(slots) < count[:, None]).astype(np.float64)
        for m, c in models.items():
            some = np.flatnonzero(left[m][:, t])
            if not len(some):
                continue
            near, drop, part = c[some], half[m][some], np.zeros((len(some), d + 1))
            scores = near @ mean - drop
            shut = _leads(scores, apart[m][:, some[:, None], some], reach).min(0) > least[m]
            if shut.any():
                cost[m] += _tally(part, mean[:, shut], count[shut], scores[:, shut]) + float(square[shut].sum())
            opened = np.flatnonzero(~shut)
            if len(opened):
                those = x.take(opened, 1).reshape(d, -1) if len(opened) < width else x.reshape(d, -1)
                cost[m] += _tally(part, those, held[opened].ravel(), near @ those - drop)
            total[m][some] += part
    return {m: (total[m], cost[m]) for m in models}


def _race(pts: DataFrame, cand: dict[int, np.ndarray], draw: dict[int, int], step: int,
          seeds: dict[int, int], d: int) -> dict[int, np.ndarray]:
    """``draw[m]`` new candidates for every model: the smallest keys of the race.  Each
    task keeps its own ``draw[m]`` best, buckets of keys keep theirs, then one winner list a model."""
    bc = pts.sparkSession.sparkContext.broadcast((cand, draw, seeds, step))

    def run(batches):
        cand_, draw_, seeds_, step_ = bc.value
        best = {m: (np.zeros(0), np.zeros((0, d))) for m in draw_}
        for x, rid in _chunks(batches, d):
            dist = _to_centres(x)
            for m, want in draw_.items():
                key = -np.log(_uniform(rid, seeds_[m] * 1000003 + step_ * 7919 + EXP_SALT))
                if m in cand_:
                    d2 = dist(cand_[m]).min(0)
                    with np.errstate(divide="ignore"):
                        key = np.where(d2 > 0, key / d2, np.inf)
                had, least = best[m]
                maybe = np.flatnonzero(key < (had[-1] if len(had) == want else np.inf))   # others can't be among the best
                if not len(maybe):
                    continue
                keys, first = np.unique(np.concatenate([had, key[maybe]]), return_index=True)
                first = first[:want]
                best[m] = (keys[:len(first)], np.concatenate([least, x[maybe]])[first])
        rows = [(m, draw_[m], float(k), x.tolist()) for m, (ks, xs) in best.items() for k, x in zip(ks, xs)]
        yield pd.DataFrame(rows, columns=["m", "want", "key", "x"])

    won = pts.mapInPandas(run, "m int, want int, key double, x array<double>").dropDuplicates(["m", "key"])
    for by in (["m", F.pmod(F.hash("key"), F.lit(RACE_BUCKETS))], ["m"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("key"))
        won = won.withColumn("rank", rank).where(F.col("rank") <= F.col("want")).drop("rank")
    out: dict[int, list] = {}
    for r in sorted(won.collect(), key=lambda r: (r["m"], r["key"])):   # models x draws rows
        out.setdefault(r["m"], []).append(r["x"])
    bc.unpersist()
    return {m: np.array(xs) for m, xs in out.items()}


def _recluster(cand: np.ndarray, weight: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k centres of a model's weighted candidates: weighted k-means++, then Lloyd steps."""
    cand, weight = cand[weight > 0], weight[weight > 0]
    rng = np.random.default_rng(seed)
    at = [int(rng.choice(len(cand), p=weight / weight.sum()))]
    while len(at) < k:
        mass = weight * _sq_dist(cand, cand[at]).min(1)
        mass[at] = 0.0
        if mass.sum() <= 0:      # fewer distinct points than k: repeat a centre
            at.append(at[-1])
        else:
            at.append(int(rng.choice(len(cand), p=mass / mass.sum())))
    centres = cand[at]
    for _ in range(RECLUSTER_STEPS):
        near = _sq_dist(cand, centres).argmin(1)
        mass = np.bincount(near, weight, k)
        sums = np.stack([np.bincount(near, weight * c, k) for c in cand.T], 1)
        centres = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1)[:, None], centres)
    return centres


def _seed(pts: DataFrame, blocks: DataFrame, models: dict[int, tuple[int, int]], seeds: dict[int, int], d: int) -> dict[int, np.ndarray]:
    """Starting centres of all models (k-means||)."""
    cand = _race(pts, {}, {m: 1 for m in models}, 0, seeds, d)
    for step in range(1, SEED_ROUNDS + 1):
        for m, new in _race(pts, cand, {m: 2 * k for m, (k, _s) in models.items()}, step, seeds, d).items():
            cand[m] = np.concatenate([cand[m], new])
    counts = _lloyd_pass(blocks, cand, d, sums=False)
    out = {m: _recluster(cand[m], counts[m][0][:, 0], k, seeds[m] % 2 ** 32) for m, (k, _s) in models.items()}
    return out


def _lloyd_pass(blocks: DataFrame, centres: dict[int, np.ndarray], d: int, sums: bool = True) -> dict[int, tuple[np.ndarray, float]]:
    """One assignment pass for all models: (count and, if wanted, sums of each centre, inertia)."""
    bc = blocks.sparkSession.sparkContext.broadcast(centres)
    width = d + 1 if sums else 1

    def run(batches):
        models = bc.value
        total = np.zeros(sum(len(c) * width + 1 for c in models.values()))
        for points, cells in _unpacked(batches, d):
            total += np.concatenate([np.append(t[:, :width], cost) for t, cost in _assigned(points, cells, models).values()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["slot", "v"])

    # the result is models x k x d rows whatever the data size
    got = blocks.mapInArrow(run, "slot int, v double").repartition(SUMMERS, "slot").groupBy("slot").agg(F.sum("v").alias("v")).toArrow()
    bc.unpersist()
    total = np.zeros(got.num_rows)
    total[got.column("slot").to_numpy()] = got.column("v").to_numpy()
    out, at = {}, 0
    for m, c in centres.items():
        to = at + len(c) * width
        out[m] = total[at:to].reshape(len(c), width), float(total[to])
        at = to + 1
    return out


def multi_kmeans(vec: DataFrame, configs: list[tuple[int, int]], features: str = "features",
                 max_iter: int = 300, tol: float = 1e-4,
                 init: dict[tuple[int, int], np.ndarray] | None = None) -> dict[tuple[int, int], tuple[np.ndarray, float]]:
    """Fit k-means for every (k, seed) in ``configs`` together, from the centres in ``init``
    where given.  Returns {(k, seed): (centres, inertia)}."""
    pts, d, means = _points(vec, features)
    init = None if init is None else {c: np.asarray(x, float) - means for c, x in init.items()}
    fits = fit_points(pts, d, configs, max_iter, tol, init)
    pts.unpersist()
    return {c: (centres + means, inertia) for c, (centres, inertia) in fits.items()}


def fit_points(pts: DataFrame, d: int, configs, max_iter: int = 300, tol: float = 1e-4, init=None):
    """:func:`multi_kmeans` on centred points."""
    vr = pts.agg(*[F.var_pop(f"x{j}").alias(f"v{j}") for j in range(d)]).first()
    var = np.array([vr[f"v{j}"] or 0.0 for j in range(d)])
    thr = tol * float(var.mean()) if len(var) else 0.0
    models = dict(enumerate(configs))
    seeds = {m: s * 7919 + k for m, (k, s) in models.items()}
    blocks = _blocks(pts, d)
    centres = _seed(pts, blocks, models, seeds, d) if init is None else {m: init[c] for m, c in models.items()}
    active = set(models)
    for _it in range(max_iter):
        if not active:
            break
        for m, (total, _cost) in _lloyd_pass(blocks, {m: centres[m] for m in sorted(active)}, d).items():
            count = total[:, :1]
            new = np.where(count > 0, total[:, 1:] / np.maximum(count, 1), centres[m])
            shift = float(((new - centres[m]) ** 2).sum())
            centres[m] = new
            if shift <= thr:
                active.discard(m)
    # inertia of the final centres
    fits = {models[m]: (centres[m], cost) for m, (_total, cost) in _lloyd_pass(blocks, centres, d).items()}
    blocks.unpersist()
    return fits


# ---------------------------------------------------------------- fitted model
@register("nearest_centre")
def _apply_nearest(spec: dict, df: DataFrame) -> DataFrame:
    """cluster = index of the nearest centre (squared Euclidean, first on ties),
    computed with array expressions on the JVM: works in batch and streaming."""
    x = vector_to_array(F.col(spec["inputCol"]))
    d2 = [F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in c]), lambda a, b: (a - b) * (a - b)),
                      F.lit(0.0), lambda acc, y: acc + y) for c in spec["centres"]]
    arr = F.array(*d2)
    return df.withColumn(spec["predictionCol"], (F.array_position(arr, F.array_min(arr)) - 1).cast("int"))


def centroid_model(centres: np.ndarray, input_col: str = "features", prediction_col: str = "prediction",
                   inertia: float | None = None) -> ColumnRules:
    return ColumnRules.of("nearest_centre", {"centres": np.asarray(centres).tolist(), "inputCol": input_col,
                                             "predictionCol": prediction_col, "inertia": inertia})


def best_models(fits: dict, ks) -> dict[int, tuple[np.ndarray, float]]:
    """Best start (lowest inertia, then lowest seed) for each k."""
    out = {}
    for (k, s), (c, inertia) in sorted(fits.items(), key=lambda t: (t[0][0], t[1][1], t[0][1])):
        if k in ks and k not in out:
            out[k] = (c, inertia)
    return out
