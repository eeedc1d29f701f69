"""Log and Yeo-Johnson transforms (TRF-01..03).

Yeo-Johnson lambda is the maximum-likelihood value.  Each search pass takes the
count, mean and sum of squares of ``psi(x, lambda)`` for every column and grid point
with numpy over Arrow batches, a chunk at a time; only these partial sums leave a task.
The searched columns are cached for the passes, so that a pass does not repeat the
steps before it.  While the best point lies on
the bracket's edge the bracket moves on with twice the width; then the grid
narrows around the best point until the step is < 1e-6.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions.stats import qcol
from kiln.operators.base import ColumnRules, register
from kiln.session import held


# ---------------------------------------------------------------- log
@register("log")
def _apply_log(spec: dict, df: DataFrame) -> DataFrame:
    cols = [c for c in spec["cols"] if c in df.columns]
    x = {c: qcol(c).cast("double") for c in cols}
    if spec.get("outside") == "limit":
        return df.withColumns({c: F.when(v == 0, float("-inf")).when(v < 0, float("nan")).otherwise(F.ln(v)) for c, v in x.items()}) if cols else df
    return df.withColumns({c: F.ln(v) for c, v in x.items()}) if cols else df


def fit_log(df: DataFrame, cols, outside: str = "error") -> ColumnRules:
    """Natural log; a column with a value <= 0 is rejected at fit time.  ``outside="limit"``
    keeps its rows, -inf for 0 (the limit) and NaN below, counted in the step's ``n_outside``."""
    if outside not in ("error", "limit"):
        raise ValueError(f"outside is 'error' or 'limit', not {outside!r}")
    cols = [c for c in cols if c in df.columns]
    n_outside = {}
    if cols:
        row = df.agg(*[F.count_if(qcol(c) <= 0).alias(str(i)) for i, c in enumerate(cols)]).first()
        n_outside = {c: row[str(i)] for i, c in enumerate(cols) if row[str(i)]}
        if n_outside and outside == "error":
            raise ValueError(f"log transform needs strictly positive values: {list(n_outside)}")
    return ColumnRules.of("log", {"cols": cols, "outside": outside, "n_outside": n_outside})


# ---------------------------------------------------------------- Yeo-Johnson
def yeo_johnson_expr(x: Column, lam) -> Column:
    """psi_lambda(x); ``lam`` a float or a Column."""
    lam_c = F.lit(lam) if not isinstance(lam, Column) else lam
    pos = F.when(F.abs(lam_c) < 1e-12, F.log1p(x)).otherwise((F.pow(x + 1.0, lam_c) - 1.0) / lam_c)
    neg = F.when(F.abs(lam_c - 2.0) < 1e-12, -F.log1p(-x)) \
        .otherwise(-(F.pow(1.0 - x, 2.0 - lam_c) - 1.0) / (2.0 - lam_c))
    return F.when(x >= 0, pos).otherwise(neg)


@register("yeo_johnson")
def _apply_yj(spec: dict, df: DataFrame) -> DataFrame:
    out = {c: yeo_johnson_expr(qcol(c).cast("double"), lam)
           for c, lam in spec["lambdas"].items() if c in df.columns}
    return df.withColumns(out) if out else df


CHUNK = 8192          # values transformed at once


def _psi(x: np.ndarray, lam: float) -> np.ndarray:
    """psi_lambda of finite values."""
    out = np.empty_like(x)
    up = x >= 0
    p, q = x[up], -x[~up]
    with np.errstate(over="ignore"):
        out[up] = np.log1p(p) if abs(lam) < 1e-12 else (np.power(p + 1.0, lam) - 1.0) / lam
        out[~up] = -np.log1p(q) if abs(lam - 2.0) < 1e-12 else -(np.power(q + 1.0, 2.0 - lam) - 1.0) / (2.0 - lam)
    return out


def _merged(a, b):
    """(n, mean, squares about the mean) of two disjoint sets of values."""
    n = a[0] + b[0]
    if not a[0] or not b[0]:
        return a if a[0] else b
    with np.errstate(over="ignore", invalid="ignore"):
        delta = b[1] - a[1]
        return n, a[1] + delta * b[0] / n, a[2] + b[2] + delta * delta * a[0] * b[0] / n


def _yj_moments(grids: list[list[float]]):
    """Task of a pass: (column, point, n, mean, squares about the mean) of psi; point -1 holds the sum of
    signed log1p as its mean."""
    def run(batches):
        got: dict[tuple[int, int], tuple] = {}
        for batch in batches:
            for i, grid in enumerate(grids):
                values = np.asarray(batch.column(i).drop_null(), dtype=np.float64)
                for at in range(0, len(values), CHUNK):
                    x = values[at:at + CHUNK]
                    n, logs = got.get((i, -1), (0, 0.0, 0.0))[:2]
                    got[(i, -1)] = n + len(x), logs + float((np.sign(x) * np.log1p(np.abs(x))).sum()), 0.0
                    for k, lam in enumerate(grid):
                        y = _psi(x, lam)
                        with np.errstate(over="ignore", invalid="ignore"):
                            mean = float(y.mean())
                            part = len(y), mean, float(((y - mean) ** 2).sum())
                        got[(i, k)] = _merged(got[(i, k)], part) if (i, k) in got else part
        rows = list(got.items())
        yield pa.RecordBatch.from_arrays([pa.array([c[0] for c, _ in rows], pa.int32()), pa.array([c[1] for c, _ in rows], pa.int32()),
                                          pa.array([v[0] for _, v in rows], pa.int64()), pa.array([v[1] for _, v in rows], pa.float64()),
                                          pa.array([v[2] for _, v in rows], pa.float64())], ["i", "k", "n", "m", "s"])
    return run


def _yj_pass(df: DataFrame, grids: dict[str, list[float]]) -> dict[str, list[tuple[float, float]]]:
    """Log-likelihood of every (column, lambda) in one pass; a task returns columns x points rows, as many as the
    driver merges from it."""
    got: dict[tuple[int, int], tuple] = {}
    part = df.select(*[qcol(c) for c in grids]).mapInArrow(_yj_moments(list(grids.values())), "i int, k int, n long, m double, s double")
    for r in sorted(part.collect()):
        key, v = (r["i"], r["k"]), (r["n"], r["m"], r["s"])
        if r["k"] < 0 and key in got:
            got[key] = got[key][0] + v[0], got[key][1] + v[1], 0.0
        else:
            got[key] = _merged(got[key], v) if key in got else v
    out = {}
    for i, (c, grid) in enumerate(grids.items()):
        n, s, _ = got.get((i, -1), (0, 0.0, 0.0))
        out[c] = []
        for k, lam in enumerate(grid):
            v = got[(i, k)][2] / n if n else math.nan
            fits = math.isfinite(v) and v > 0
            out[c].append((lam, -n / 2.0 * math.log(v) + (lam - 1.0) * s if fits else -math.inf))
    return out


def fit_yeo_johnson(df: DataFrame, cols, lo: float = -5.0, hi: float = 5.0,
                    points: int = 21, tol: float = 1e-6, widest: float = 1e4) -> ColumnRules:
    """``lo`` and ``hi`` are where the search begins; it goes on outside as far as ``widest``."""
    cols = [c for c in cols if c in df.columns]
    lambdas: dict[str, float] = {}
    if not cols:
        return ColumnRules.of("yeo_johnson", {"lambdas": {}})
    finite = {c: F.when(F.abs(qcol(c).cast("double")) < float("inf"), qcol(c).cast("double")) for c in cols}
    src = df.select(*[finite[c].alias(c) for c in cols]).repartition(df.sparkSession.sparkContext.defaultParallelism)
    with held(src):
        lambdas.update(_search_lambdas(src, cols, lo, hi, points, tol, widest))
    return ColumnRules.of("yeo_johnson", {"lambdas": lambdas})


def _search_lambdas(df: DataFrame, cols, lo, hi, points, tol, widest) -> dict[str, float]:
    x = {c: qcol(c) for c in cols}
    r = df.agg(*[(F.max(x[c]) - F.min(x[c])).alias(f"r{i}") for i, c in enumerate(cols)]).first()
    # constant or empty columns: lambda 1 (identity-like)
    lambdas = {c: 1.0 for i, c in enumerate(cols) if not r[f"r{i}"]}
    brackets = {c: (lo, hi) for c in cols if c not in lambdas}
    inside: set[str] = set()                       # columns whose maximum is bracketed
    while brackets:
        grids = {c: [a + (b - a) * k / (points - 1) for k in range(points)] for c, (a, b) in brackets.items()}
        for c, pts in _yj_pass(df, grids).items():
            a, b = brackets.pop(c)
            step = (b - a) / (points - 1)
            lam, ll = max(pts, key=lambda t: (t[1], -abs(t[0] - 1.0)))
            lambdas[c] = lam if ll > -math.inf else 1.0
            at = [p[0] for p in pts].index(lam)
            if ll == -math.inf:
                continue
            if c not in inside and at in (0, points - 1) and abs(lam) < widest:
                width = 2.0 * (b - a)
                brackets[c] = (lam - width, lam + step) if at == 0 else (lam - step, lam + width)
                continue
            inside.add(c)
            if step > tol:
                brackets[c] = (lam - step, lam + step)
    return lambdas
